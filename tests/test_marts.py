from pyspark.sql import functions as F

from cabstar.functions.money import exact_sum
from cabstar.operators.marts import MARTS, build_mart, build_marts


SCHEMA = ("vendorid int, payment_type int, passenger_count int, tpep_pickup_datetime string, "
          "trip_distance double, fare_amount double, tip_amount double, total_amount double")


def _curated(spark):
    rows = [
        (6, 4, 5, "2018-02-28 23:59:59", 0.004, 7.25, 0.0, 8.5),
        (6, 2, 1, "2018-02-28 00:00:00", 0.004, 12.5, 2.5, 16.25),
        (2, 2, 5, "2018-02-28 12:30:00", 0.004, 30.25, 4.05, 36.1),
        (2, 2, 1, "2018-03-01 00:00:00", 1.234, 5.0, 1.0, 6.75),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_marts_by_hand(spark):
    marts = build_marts(_curated(spark))
    daily = {r["pickup_date"].isoformat(): r for r in marts["daily_revenue"].collect()}
    feb = daily["2018-02-28"]
    assert (feb["total_trips"], feb["total_passengers"], feb["total_revenue"]) == (3, 11, 60.85)
    assert (feb["total_fare"], feb["total_tips"], feb["avg_revenue_per_trip"]) == (50.0, 6.55, 20.28)
    payment = {(r["payment_type"], r["pickup_month"]): r for r in marts["payment_type_analysis"].collect()}
    assert payment[2, 2]["total_trips"] == 2 and payment[2, 2]["tip_pct"] == 0.1532  # 6.55 / 42.75
    assert payment[2, 3]["tip_pct"] == 0.2 and payment[4, 2]["tip_pct"] == 0.0
    vendor = {(r["vendorid"], r["pickup_month"]): r for r in marts["vendor_revenue"].collect()}
    assert vendor[6, 2]["total_revenue"] == 24.75 and vendor[2, 3]["avg_trip_distance"] == 1.23
    passenger = {(r["passenger_count"], r["pickup_month"]): r for r in marts["passenger_analysis"].collect()}
    assert passenger[5, 2]["total_trips"] == 2 and passenger[1, 2]["total_fare"] == 12.5


def test_three_decimal_values_are_not_cut(spark):
    total = _curated(spark).agg(exact_sum("trip_distance").alias("d"), F.sum("trip_distance").alias("plain")).first()
    assert total["d"] == 1.246 and abs(total["plain"] - 1.246) < 1e-12


def test_nan_infinity_and_huge_values_sum_as_plain_sums(spark):
    nan, inf = float("nan"), float("inf")
    cases = [[1.5, nan], [1.5, inf], [inf, -inf], [1e300, 2.0], [nan], [None], [0.1, 0.2, None]]
    rows = [(i, x) for i, xs in enumerate(cases) for x in xs]
    df = spark.createDataFrame(rows, "k int, x double").groupBy("k")
    for r in df.agg(exact_sum("x").alias("exact"), F.sum("x").alias("plain")).collect():
        if r["k"] == 6:
            assert r["exact"] == 0.3
        else:
            assert str(r["exact"]) == str(r["plain"])
    mart = build_mart(spark.createDataFrame([(1, 1, 1, "2018-02-01 00:00:00", nan, 1.0, 0.0, 2.0)], SCHEMA), "daily_revenue")
    assert str(mart.first()["avg_trip_distance"]) == "nan" and mart.first()["total_revenue"] == 2.0


def test_sums_of_mixed_magnitudes_and_decimals_are_exact(spark):
    """Hundredths, other decimals and large values go through different sums; the total is that of the DECIMALs."""
    values = [0.1, 0.2, -0.3, 19.99, -0.0, 99_999.99, 100_000.0, 123_456.78, 1.005, 0.001, 1e-7, 5e12, -7.125, 1e-12]
    rows = [(k, x) for k, xs in enumerate([values, values[:6], values[6:], [0.0], [-0.01] * 3]) for x in xs]
    df = spark.createDataFrame(rows, "k int, x double").repartition(5)
    want = {r["k"]: float(r["s"]) for r in df.groupBy("k").agg(F.sum(F.col("x").cast("decimal(28,10)")).alias("s")).collect()}
    assert {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum("x").alias("s")).collect()} == want


def test_one_pass_equals_single_aggregates(spark):
    curated = _curated(spark)
    combined = build_marts(curated)
    for name in MARTS:
        assert sorted(combined[name].collect()) == sorted(build_mart(curated, name).collect())


def test_zero_fare_gives_zero_tip_pct(spark):
    rows = [(1, 9, 1, "2025-01-01 10:00:00", 1.0, 0.0, 1.0, 1.0)]
    schema = ("vendorid int, payment_type int, passenger_count int, tpep_pickup_datetime string, "
              "trip_distance double, fare_amount double, tip_amount double, total_amount double")
    out = build_mart(spark.createDataFrame(rows, schema), "payment_type_analysis").first()
    assert out["tip_pct"] == 0.0


def test_money_is_exact_and_rounds_half_up(spark):
    # 0.1 + 0.2 as doubles is 0.30000000000000004; cents summation is exact
    rows = [(1, 1, 1, "2025-01-01 10:00:00", 1.0, 0.1, 0.0, 0.1), (1, 1, 1, "2025-01-01 11:00:00", 1.0, 0.2, 0.0, 0.2),
            (1, 1, 1, "2025-01-01 12:00:00", 1.0, 1.005, 0.0, 1.005)]
    schema = ("vendorid int, payment_type int, passenger_count int, tpep_pickup_datetime string, "
              "trip_distance double, fare_amount double, tip_amount double, total_amount double")
    out = build_mart(spark.createDataFrame(rows[:2], schema), "daily_revenue").first()
    assert out["total_revenue"] == 0.3
    avg = build_mart(spark.createDataFrame([rows[2]], schema), "daily_revenue").first()["avg_revenue_per_trip"]
    assert avg == 1.01


def test_four_marts_read_the_curated_table_once(spark, scratch):
    from cabstar.operators.marts import build_marts_combined

    _curated(spark).write.parquet(f"{scratch}/silver")
    combined = build_marts_combined(spark.read.parquet(f"{scratch}/silver"))
    plan = combined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Expand" in plan
    assert combined.count() == 2 + 3 + 3 + 3  # days; vendors, payment types and passenger counts by month


def test_a_single_mart_expands_nothing(spark):
    plan = build_mart(_curated(spark), "vendor_revenue")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
