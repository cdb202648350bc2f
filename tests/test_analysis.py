"""As-of and interval joins, running totals, change sets, bags and sketches against plain versions."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cabstar.operators.changes import bag_counts, change_set, except_all, intersect_all
from cabstar.operators.intervals import overlap_join
from cabstar.operators.sketches import daily_sketches, estimates, merged
from cabstar.operators.timeline import asof_join, running_totals

BEGIN = datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else BEGIN + timedelta(minutes=minutes)


def moments(rng, n, hot=0.5):
    """(key, minute) with one hot key, null keys and times, and ties."""
    key = lambda: 1 if rng.random() < hot else rng.choice([2, 3, 4, None])
    return [(key(), rng.choice([None, *range(0, 9000, 7)])) for _ in range(n)]


def test_asof_join_equals_comparing_all_rows(spark):
    rng = random.Random(1)
    asked = [(i, k, at(m)) for i, (k, m) in enumerate(moments(rng, 400))]
    known = [(i % 5, k, at(m), rng.choice([None, "a", "b"])) for i, (k, m) in enumerate(moments(rng, 300, 0.7))]
    left = spark.createDataFrame(asked, "id long, key long, t timestamp_ntz").repartition(5)
    right = spark.createDataFrame(known, "seq long, user long, t timestamp_ntz, _t string").repartition(3)
    want = {}
    for i, k, t in asked:
        fits = [r for r in known if None not in (k, t, r[2]) and r[1] == k and r[2] <= t]
        best = max(fits, key=lambda r: (r[2], r[0], r[3] is not None, r[3] or ""), default=(None,) * 4)
        want[i] = (best[2], best[3])
    take = {"seen": "t", "_r": "_t"}
    for seconds in (3600, 10**7):  # many ranges and one
        got = asof_join(left, right, [("key", "user")], "t", "t", take, ["seq"], range_seconds=seconds)
        assert got.columns == ["id", "key", "t", "seen", "_r"]
        assert {r.id: (r.seen, r["_r"]) for r in got.collect()} == want
    none = asof_join(left, right.limit(0), [("key", "user")], "t", "t", take)
    assert none.count() == 400 and none.where("seen is not null").count() == 0
    assert asof_join(left.limit(0), right, [("key", "user")], "t", "t", take).count() == 0


def test_asof_rows_of_a_hot_key_are_spread(spark):
    rows = spark.range(4000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 900).cast("timestamp_ntz").alias("t"))
    plan = asof_join(rows, rows, [("k", "k")], "t", "t", {"seen": "t"})._jdf.queryExecution().toString()
    assert "hashpartitioning(_k0" in plan and "_range" in plan.split("hashpartitioning(_k0", 1)[1][:30]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_running_totals_equal_the_plain_window(spark):
    rng = random.Random(2)
    rows = [(i, k, at(m), rng.choice([None, 0.1, 2.25, 1e6])) for i, (k, m) in enumerate(moments(rng, 600, 0.8))]
    df = spark.createDataFrame(rows, "id long, k long, t timestamp_ntz, amount double").repartition(4)
    w = Window.partitionBy("k").orderBy("t", "id")
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    seconds = lambda c: F.unix_micros(c.cast("timestamp"))
    plain = df.select(
        "id",
        F.sum(F.col("amount").cast("decimal(28,10)")).over(up_to).cast("double").alias("total"),
        F.row_number().over(w).cast("long").alias("n"),
        F.floor((seconds(F.col("t")) - seconds(F.lag("t").over(w))) / 1_000_000).alias("gap"),
    )
    for width in (3600, 10**8):
        got = running_totals(df, "k", "t", ["id"], {"total": "amount"}, "n", "gap", width)
        assert {tuple(r) for r in got.select("id", "total", "n", "gap").collect()} == {tuple(r) for r in plain.collect()}
    assert running_totals(df.limit(0), "k", "t", ["id"], {"total": "amount"}).count() == 0


def test_overlap_join_equals_comparing_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for i, (k, m) in enumerate(moments(rng, 250, 0.6)):
        length = rng.choice([0, 5, 7, 60, 60, 3000, -5, None])
        rows.append((i, k, at(m), at(None if m is None or length is None else m + length)))
    df = spark.createDataFrame(rows, "id long, k long, a timestamp_ntz, left timestamp_ntz").repartition(4)
    found = overlap_join(df, df, [("k", "k")], ("a", "left"), ("a", "left"), bucket_seconds=1800)
    got = Counter((r.left.id, r.right.id, r.overlap_seconds) for r in found.collect())
    good = [r for r in rows if None not in r[1:] and r[2] <= r[3]]
    want = Counter()
    for x in good:
        for y in good:
            begin, end = max(x[2], y[2]), min(x[3], y[3])
            if x[1] == y[1] and begin <= end:
                want[x[0], y[0], int((end - begin).total_seconds())] += 1
    assert got == want
    plan = found._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_change_set(spark):
    schema = "k long, a string, b double"
    old = [(1, "x", 1.0), (2, "x", None), (3, "x", 1.0), (4, "t", 1.0), (4, "t", 1.0), (5, "p", 1.0), (5, "q", 2.0), (None, "n", 0.0)]
    new = [(1, "x", 1.0), (2, "y", 2.0), (6, "x", 1.0), (4, "t", 1.0), (5, "q", 1.0), (5, "p", 2.0), (None, "n", 3.0)]
    o, n = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).select("b", "a", "k")
    got = {r.k: tuple(r)[1:] for r in change_set(o, n, ["k"]).collect()}
    assert got == {
        2: ("changed", 1, 1, "a,b"), 3: ("deleted", 1, 0, ""), 4: ("changed", 2, 1, ""), 5: ("changed", 2, 2, ""),
        6: ("inserted", 0, 1, ""), None: ("changed", 1, 1, "b"),
    }
    assert change_set(o, o.repartition(3), ["k"]).count() == 0
    assert change_set(o.limit(0), n, ["k"]).where("change <> 'inserted'").count() == 0
    with pytest.raises(ValueError, match="different columns"):
        change_set(o, n.drop("b"), ["k"])


def test_bags_equal_except_all_and_intersect_all(spark):
    rng = random.Random(4)
    rows = lambda n: [(rng.choice([None, 1, 2, 3]), rng.choice(["a", None])) for _ in range(n)]
    schema = "x long, n_left string"
    a, b = (spark.createDataFrame(rows(n), schema).repartition(3) for n in (80, 50))
    count = lambda df: {tuple(r)[:-1]: r.n for r in df.collect()}
    bag = lambda df: dict(Counter(map(tuple, df.collect())))
    a, b = a.withColumnRenamed("n_left", "y"), b.withColumnRenamed("n_left", "y")
    assert count(except_all(a, b)) == bag(a.exceptAll(b))
    assert count(intersect_all(a, b)) == bag(a.intersectAll(b))
    hot = a.unionAll(spark.range(5000).selectExpr("1L as x", "'a' as y"))
    assert bag_counts(hot, b).agg(F.sum("n_left")).first()[0] == 5080
    assert except_all(a.limit(0), b).count() == 0


@pytest.mark.parametrize("scale", [2_000, 60_000])
def test_sketches_keep_their_error_bounds(spark, scale):
    trips = spark.range(scale).select(
        F.concat(F.lit("trip"), F.col("id")).alias("trip_id"),
        F.lit(2024).alias("pickup_year"),
        (F.col("id") % 3 + 1).cast("int").alias("pickup_month"),
        (F.col("id") % 28 + 1).cast("int").alias("pickup_day"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).alias("total_amount"),
    )
    twice = trips.unionAll(trips.where("pickup_day < 5"))  # further copies don't count
    days = daily_sketches(twice)
    assert dict(days.dtypes)["trips_sketch"] == dict(days.dtypes)["revenue_sketch"] == "binary"
    months = estimates(merged(days, ["pickup_year", "pickup_month"])).collect()
    year = estimates(merged(merged(days, ["pickup_year", "pickup_month"]), ["pickup_year"])).first()
    for r, size in [*((m, scale / 3) for m in months), (year, scale)]:
        assert abs(r.trips - size) <= 4 * 0.016 * size
    amounts = sorted(r[0] for r in twice.select("total_amount").collect())
    for name, q in (("revenue_p25", 0.25), ("revenue_p50", 0.5), ("revenue_p75", 0.75), ("revenue_p95", 0.95)):
        rank = sum(a <= year[name] for a in amounts) / len(amounts)
        assert abs(rank - q) <= 3 * 0.0165
    assert estimates(merged(daily_sketches(trips.limit(0)), ["pickup_year"])).count() == 0
