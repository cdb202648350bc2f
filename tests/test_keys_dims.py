from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cabstar.functions import keys as K
from cabstar.operators import dims as D
from cabstar.sources import reference as ref


@pytest.mark.parametrize("flag, key", [("N", 1), ("Y", 2), (None, -1), ("x", -1)])
def test_flag_key(spark, flag, key):
    assert spark.createDataFrame([(flag,)], "f string").select(K.flag_key("f")).first()[0] == key


@pytest.mark.parametrize(
    "distance, minutes, total, key",
    [(0.0, 10.0, 10.0, 2), (0.0, 300.0, 900.0, 2), (1.0, 240.0, 10.0, 1), (1.0, 240.5, 10.0, 3),
     (1.0, 300.0, 900.0, 3), (1.0, 10.0, 500.0, 1), (1.0, 10.0, 500.01, 4), (1.0, None, 10.0, 1)],
)
def test_quality_classifier_first_match(spark, distance, minutes, total, key):
    df = spark.createDataFrame([(distance, minutes, total)], "d double, m double, t double")
    assert df.select(K.quality_key("d", "m", "t")).first()[0] == key


@pytest.mark.parametrize("count, group", [(1, "Single"), (2, "Small Group"), (4, "Small Group"), (5, "Large Group"),
                                          (9, "Large Group"), (0, "Unknown"), (None, "Unknown")])
def test_passenger_group(spark, count, group):
    assert spark.createDataFrame([(count,)], "c int").select(K.passenger_group("c")).first()[0] == group


@pytest.mark.parametrize("hour, part", [(4, "Night"), (5, "Morning"), (10, "Morning"), (11, "Midday"),
                                         (15, "Midday"), (16, "Evening"), (20, "Evening"), (21, "Night"), (0, "Night")])
def test_daypart(spark, hour, part):
    assert spark.createDataFrame([(hour,)], "h int").select(K.daypart("h")).first()[0] == part


def test_date_and_time_keys_with_unknown(spark):
    df = spark.createDataFrame([(datetime(2025, 3, 7, 9, 5, 2),), (None,)], "t timestamp_ntz")
    got = df.select(K.date_key(F.to_date("t")), K.time_key("t")).collect()
    assert tuple(got[0]) == (20250307, 90502) and tuple(got[1]) == (-1, -1)


def test_duration_is_whole_seconds(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 1, 10), datetime(2025, 1, 1, 10, 20, 30))], "p timestamp_ntz, d timestamp_ntz")
    assert df.select(K.duration_minutes("p", "d")).first()[0] == 20.5


def test_dim_date_reference_range(spark):
    dim = D.dim_date(D.literal_bounds(spark, "2020-01-01", "2035-12-31"))
    assert dim.count() == 5844 + 1
    assert dim.where("date_key = -1").count() == 1
    row = dim.where("calendar_date = DATE'2021-01-01'").first()
    assert row["week_of_year"] == 53 and row["calendar_year"] == 2021  # ISO week, Gregorian year
    assert row["day_of_week"] == "Friday" and row["day_of_week_number"] == 5 and not row["is_weekend"]
    sunday = dim.where("calendar_date = DATE'2021-01-03'").first()
    assert sunday["day_of_week_number"] == 7 and sunday["is_weekend"]
    assert row["month_start_date"] == date(2021, 1, 1) and row["month_end_date"] == date(2021, 1, 31)
    assert row["calendar_month_name"] == "January" and row["calendar_month_short_name"] == "Jan"
    assert row["year_month"] == "2021-01" and row["date_key"] == 20210101


def test_dim_time(spark):
    dim = D.dim_time(spark)
    assert dim.count() == 86401 and dim.select(F.countDistinct("time_key")).first()[0] == 86401
    r = dim.where("time_key = 235959").first()
    assert (r["hour"], r["minute"], r["second"], r["daypart"]) == (23, 59, 59, "Night")
    assert dict(dim.dtypes)["time_key"] == "int"


def test_code_dims_label_fallback_and_unknown(spark):
    codes = spark.createDataFrame(
        [("vendor", 1), ("vendor", 5), ("vendor", -1), ("payment_type", 4), ("rate_code", 9),
         ("location", 7), ("passenger_count", 3)], "kind string, code int")
    vendor = {r["vendor_key"]: r for r in D.code_dim(codes, "vendor").collect()}
    assert vendor[1]["vendor_name"] == ref.VENDOR_NAMES[0][1]
    assert vendor[5]["vendor_name"] == "Unknown Vendor 5"
    assert vendor[-1]["vendor_name"] == "Unknown Vendor" and vendor[-1]["is_current"]
    assert len(vendor) == 3  # the -1 code is not a member twice
    assert {r["payment_type_description"] for r in D.code_dim(codes, "payment_type").collect()} == {
        "Dispute", "Unknown Payment Type"}
    assert {r["rate_code_description"] for r in D.code_dim(codes, "rate_code").collect()} == {
        "Unknown Rate Code 9", "Unknown Rate Code"}
    loc = {r["location_key"]: r for r in D.dim_location(codes).collect()}
    assert loc[7]["zone"] == "Location 7" and loc[7]["borough"] == "Unknown"
    assert loc[-1]["zone"] == "Unknown Location"
    zones = spark.createDataFrame([(7, "Queens", "JFK Airport", "Airports")],
                                  "location_id int, borough string, zone string, service_zone string")
    assert D.dim_location(codes, zones).where("location_key = 7").first()["zone"] == "JFK Airport"
    pc = {r["passenger_count_key"]: r["passenger_group"] for r in D.dim_passenger_count(codes).collect()}
    assert pc == {3: "Small Group", -1: "Unknown"}
    assert dict(D.code_dim(codes, "vendor").dtypes)["vendor_key"] == "int"


def test_static_dims(spark):
    assert ref.dim_trip_flags(spark).count() == 3
    q = ref.dim_trip_quality(spark)
    assert q.count() == 5 and q.where("trip_quality_key = -1").count() == 1


def test_wall_clock_columns_ignore_the_session_zone(spark):
    df = spark.createDataFrame([(datetime(2025, 3, 9, 1, 30), datetime(2025, 3, 9, 3, 30))],
                               "p timestamp_ntz, d timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # DST starts 2025-03-09 02:00
    try:
        got = df.select(K.duration_minutes("p", "d"), K.time_key("d"), K.date_key(F.to_date("d"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == (120.0, 33000, 20250309)
