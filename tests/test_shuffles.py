"""How often rows travel: one shuffle for duplicates and row numbers, none for what nobody asks."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cabstar.operators import changes
from cabstar.operators.changes import change_set
from cabstar.operators.intervals import MAX_TASKS, TASK_ROWS, overlap_join, pair_tasks
from cabstar.plans.analysis import overlapping_trips
from cabstar.plans.registry import FIXED_LOAD, QUERIES, warehouse
from cabstar.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_trips_are_placed_once_for_duplicates_and_numbers(spark):
    w = warehouse(spark, SF)
    plan = w.fact._jdf.queryExecution().executedPlan().toString()
    numbered = plan[plan.index("row_number()") :]
    first = numbered.index("Exchange")  # below the window: sort, distinct, then the one shuffle
    assert "REPARTITION_BY_COL" in numbered[first:].splitlines()[0] and "HashAggregate" in numbered[:first]
    plain = w.silver.select("tpep_pickup_datetime", "total_amount", "source_file_name")
    fact = w.fact.select("pickup_ts", "total_amount", "source_file_name")
    assert fact.exceptAll(plain).count() == plain.exceptAll(fact).count() == 0


@pytest.mark.parametrize("name", ["summary_location", "check_summary_fk", "check_row_counts", "dim_vendor"])
def test_rows_are_not_numbered_where_nobody_asks(spark, name):
    plan = optimized(QUERIES[name](spark, SF))
    assert not any("Join" in line and "_group#" in line for line in plan.splitlines())


def test_line_items_travel_once(spark):
    lines = optimized(warehouse(spark, SF).raw).splitlines()
    depth = {key: next(i for i, line in enumerate(lines) if "Join" in line and key in line) for key in ("l_orderkey#", "o_custkey#")}
    assert depth["l_orderkey#"] < depth["o_custkey#"]  # orders meet customers below


def test_overlaps_of_a_frame_with_itself_shuffle_it_once(spark):
    trips = spark.range(3000).select(
        F.col("id"), (F.col("id") % 5).alias("zone"), F.timestamp_seconds(F.col("id") * 900).cast("timestamp_ntz").alias("a")
    )
    trips = trips.withColumn("b", F.col("a") + F.expr("INTERVAL 2 HOURS"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = overlap_join(trips, trips, [("zone", "zone")], ("a", "b"), ("a", "b"))
        found = found.where("left.id < right.id").select("key0", "left.id", F.col("right.id").alias("other"))
        assert found.count() == sum(1 for i in range(3000) for j in range(i + 1, min(i + 9, 3000)) if i % 5 == j % 5)
        found.collect()
        assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pairs_of_trips_are_written_by_dictionary(spark, scratch):
    """Ids of 64 characters: a task with more than fit in a dictionary writes out each of every further pair."""
    begin = F.timestamp_seconds(F.floor(F.col("id") / 25) * 600).cast("timestamp_ntz")
    trips = spark.range(100_000, numPartitions=4).select(
        F.sha2(F.col("id").cast("string"), 256).alias("trip_id"),
        (F.col("id") % 25).cast("int").alias("pu_location_key"),
        begin.alias("pickup_ts"),
        (begin + F.expr("make_interval(0, 0, 0, 0, 0, 25 + id % 10)")).alias("dropoff_ts"),
    )
    found = overlapping_trips(Warehouse(trips, FIXED_LOAD, overrides={"fact_trip": trips}))
    found.write.parquet(f"{scratch}/pairs")
    encodings = {"trip_id": set(), "other_trip_id": set()}
    for file in Path(f"{scratch}/pairs").glob("*.parquet"):
        data = pq.ParquetFile(file).metadata
        for column in (data.row_group(g).column(c) for g in range(data.num_row_groups) for c in range(data.num_columns)):
            if column.path_in_schema in encodings:
                encodings[column.path_in_schema].update(column.encodings)
    assert all(e and "PLAIN" not in e for e in encodings.values()), encodings
    span = ("pickup_ts", "dropoff_ts")
    plain = overlap_join(trips, trips, [("pu_location_key", "pu_location_key")], span, span)
    plain = plain.where("left.trip_id < right.trip_id").selectExpr("key0", "left.trip_id", "right.trip_id", "overlap_seconds")
    stored = spark.read.parquet(f"{scratch}/pairs")
    assert stored.count() == plain.count() > 200_000 and stored.exceptAll(plain).isEmpty()


def test_tasks_of_pairs_grow_with_the_intervals():
    assert [pair_tasks(n) for n in (0, 1, TASK_ROWS, TASK_ROWS + 1, 10 * TASK_ROWS, 10**12)] == [1, 1, 1, 2, 10, MAX_TASKS]


def test_keys_that_share_a_bit_with_a_changed_one_are_unchanged(spark, monkeypatch):
    old = spark.range(500).select("id", F.lit("x").alias("a"), (F.col("id") % 7).alias("b"))
    new = old.where("id <> 3").withColumn("a", F.when(F.col("id") % 50 == 0, "y").otherwise(F.col("a")))
    want = {(i, "changed", "a") for i in range(0, 500, 50)} | {(3, "deleted", "")}
    for words in (1, changes.FILTER_WORDS):  # 64 bits for 500 keys, and enough
        monkeypatch.setattr(changes, "FILTER_WORDS", words)
        found = change_set(old, new, ["id"])
        assert {(r.id, r.change, r.changed_columns) for r in found.collect()} == want
        assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_star_view_sends_no_trips_by_a_dimension_key(spark):
    assert optimized(QUERIES["star_view"](spark, SF)).count("rightHint=(strategy=broadcast)") == 11
