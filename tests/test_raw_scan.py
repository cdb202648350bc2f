import pytest
from pyspark.sql import functions as F

from cabstar.operators.cleanse import cleanse
from cabstar.sources.raw import scan_raw
from cabstar.sources.trips import raw_trips
from tests.conftest import SF_SMALL


def test_files_of_different_types_and_names_are_read(spark, scratch):
    rows = raw_trips(spark, SF_SMALL).drop("source_file_name").limit(300).cache()
    old = rows.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
    mid = rows.withColumns({"passenger_count": F.col("passenger_count").cast("double"), "Airport_fee": F.lit(1.25)})
    new = rows.withColumns({"airport_fee": F.lit(2), "congestion_surcharge": F.lit(0.5)})
    for i, df in enumerate((old, mid.withColumnRenamed("vendorid", "VendorID"), new), 1):
        df.coalesce(1).write.parquet(f"{scratch}/raw/year=2024/month={i:02d}")
    found = scan_raw(spark, f"{scratch}/raw")
    assert found.count() == 900 and dict(found.dtypes)["passenger_count"] == "int"
    fees = {r["month"]: r["fee"] for r in found.groupBy("month").agg(F.max("airport_fee").alias("fee")).collect()}
    assert fees == {1: None, 2: 1.25, 3: 2.0}
    assert found.select("source_file_name").distinct().count() == 3
    assert cleanse(found.drop("year", "month")).count() == 3 * cleanse(rows.withColumn("source_file_name", F.lit("x"))).count()


def test_missing_required_column_is_refused(spark, scratch):
    raw_trips(spark, SF_SMALL).drop("tip_amount", "source_file_name").limit(5).write.parquet(f"{scratch}/raw")
    with pytest.raises(ValueError, match="tip_amount"):
        scan_raw(spark, f"{scratch}/raw")
