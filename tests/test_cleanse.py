from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cabstar.operators.cleanse import OPTIONAL_FEES, cleanse, curated_rules


def _raw_row(**over):
    row = {
        "vendorid": "7", "tpep_pickup_datetime": "2019-06-30 23:52:10",
        "tpep_dropoff_datetime": "2019-07-01 00:04:40", "passenger_count": "3", "trip_distance": "1.75",
        "ratecodeid": "2", "store_and_fwd_flag": "Y", "pulocationid": "48", "dolocationid": "13",
        "payment_type": "2", "fare_amount": "9.25", "extra": "0.5", "mta_tax": "0.25", "tip_amount": "1.15",
        "tolls_amount": "2.5", "improvement_surcharge": "0.3", "total_amount": "13.95",
        "source_file_name": "june.parquet",
    }
    row.update(over)
    return row


def _frame(spark, rows):
    cols = list(rows[0])
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ", ".join(f"{c} string" for c in cols))


def test_duplicate_removed_and_zero_passengers_rejected(spark):
    rows = [
        _raw_row(),
        _raw_row(),
        _raw_row(),
        _raw_row(passenger_count="0", pulocationid="77"),
        _raw_row(passenger_count="-2", source_file_name="july.parquet"),
    ]
    out = cleanse(_frame(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["passenger_count"] == 3
    assert (r["pickup_year"], r["pickup_month"], r["pickup_day"]) == (2019, 6, 30)
    assert r["trip_duration_minutes"] == 12.5
    assert r["tpep_dropoff_datetime"] == datetime(2019, 7, 1, 0, 4, 40)
    assert r["dropoff_date"].isoformat() == "2019-07-01"


def test_optional_fee_columns_added_as_null_double(spark):
    out = cleanse(_frame(spark, [_raw_row()]))
    for fee in OPTIONAL_FEES:
        assert dict(out.dtypes)[fee] == "double"
    assert out.select(*OPTIONAL_FEES).first() == (None, None, None)


def test_contract_types(spark):
    types = dict(cleanse(_frame(spark, [_raw_row()])).dtypes)
    assert types["vendorid"] == "int" and types["passenger_count"] == "int"
    assert types["tpep_pickup_datetime"] == "timestamp_ntz"
    assert types["total_amount"] == "double" and types["pickup_date"] == "date"


def test_raw_column_names_are_case_insensitive(spark):
    df = _frame(spark, [_raw_row()]).withColumnRenamed("vendorid", "VendorID").withColumnRenamed(
        "ratecodeid", "RatecodeID")
    out = cleanse(df)
    assert "vendorid" in out.columns and "ratecodeid" in out.columns
    assert out.first()["vendorid"] == 7


def test_lenient_casts(spark):
    rows = [_raw_row(vendorid="1.7", pulocationid="x", source_file_name="a"),
            _raw_row(vendorid="3", pulocationid=None, source_file_name="b")]
    out = {r["source_file_name"]: r for r in cleanse(_frame(spark, rows)).collect()}
    assert out["a"]["vendorid"] == 1 and out["a"]["pulocationid"] is None
    assert out["b"]["vendorid"] == 3


def test_same_trip_in_two_files_kept_twice_unless_lineage_ignored(spark):
    rows = [_raw_row(source_file_name="a"), _raw_row(source_file_name="b")]
    assert cleanse(_frame(spark, rows)).count() == 2
    assert cleanse(_frame(spark, rows), ignore_lineage=True).count() == 1


@pytest.mark.parametrize(
    "override, kept",
    [
        ({"passenger_count": None}, False),
        ({"passenger_count": "0"}, False),
        ({"passenger_count": "1"}, True),
        ({"trip_distance": "0"}, False),
        ({"trip_distance": "0.01"}, True),
        ({"fare_amount": "0"}, False),
        ({"fare_amount": "-5"}, False),
        ({"total_amount": "0"}, False),
        ({"total_amount": "0.01"}, True),
        ({"tpep_pickup_datetime": None}, False),
        ({"tpep_dropoff_datetime": None}, False),
        ({"tpep_dropoff_datetime": "2019-06-30 23:52:09"}, False),
        ({"tpep_dropoff_datetime": "2019-06-30 23:52:10"}, True),
        ({"tpep_pickup_datetime": "not a time"}, False),
    ],
)
def test_curated_rule_boundaries(spark, override, kept):
    assert cleanse(_frame(spark, [_raw_row(**override)])).count() == (1 if kept else 0)


def test_rules_are_named(spark):
    names = [r.name for r in curated_rules()]
    assert len(names) == len(set(names)) == 8


def test_missing_required_column_is_refused(spark):
    with pytest.raises(ValueError, match="tip_amount"):
        cleanse(_frame(spark, [_raw_row()]).drop("tip_amount"))


def test_typed_predicates_reach_the_scan(spark, scratch):
    df = _frame(spark, [_raw_row()]).select(
        F.col("vendorid").cast("int"), F.col("tpep_pickup_datetime").cast("timestamp_ntz"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz"), F.col("passenger_count").cast("int"),
        *[F.col(c).cast("double") for c in ["trip_distance", "fare_amount", "total_amount"]],
        "ratecodeid", "store_and_fwd_flag", "pulocationid", "dolocationid", "payment_type", "extra", "mta_tax",
        "tip_amount", "tolls_amount", "improvement_surcharge",
    )
    df.write.parquet(f"{scratch}/raw")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = cleanse(spark.read.parquet(f"{scratch}/raw"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    for f in ["GreaterThan(passenger_count,0)", "GreaterThan(trip_distance,0.0)", "GreaterThan(fare_amount,0.0)",
              "IsNotNull(tpep_pickup_datetime)"]:
        assert f in pushed
