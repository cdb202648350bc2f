"""Analyses beyond the star's reports: as-of and interval joins, changes, running totals, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstar.operators.changes import change_set, except_all, intersect_all
from cabstar.operators.intervals import overlap_join, pair_tasks
from cabstar.operators.sessions import sessions
from cabstar.operators.sketches import daily_sketches, estimates, merged
from cabstar.operators.timeline import asof_join, running_totals
from cabstar.plans.defects import defective
from cabstar.plans.warehouse import Warehouse


def last_dropoff(w: Warehouse) -> DataFrame:
    """For each trip the latest dropoff in its pickup zone at or before the pickup, and the zone's idle time."""
    take = {"earlier_trip_id": "trip_id", "earlier_dropoff_ts": "dropoff_ts"}
    keys = [("pu_location_key", "do_location_key")]
    asked = w.fact.select("trip_id", "pu_location_key", "pickup_ts")
    known = w.fact.select("trip_id", "do_location_key", "dropoff_ts")
    found = asof_join(asked, known, keys, "pickup_ts", "dropoff_ts", take, ties=["trip_id"])
    idle = F.unix_micros(F.col("pickup_ts").cast("timestamp")) - F.unix_micros(F.col("earlier_dropoff_ts").cast("timestamp"))
    return found.select(
        "trip_id", "pu_location_key", "pickup_ts", *take, F.floor(idle / 1_000_000).cast("long").alias("idle_seconds")
    )


def events_with_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the latest order that its user had placed by then."""
    events, orders = (spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("events", "orders"))
    take = {"o_orderkey": "o_orderkey", "o_orderdate": "o_orderdate", "o_totalprice": "o_totalprice"}
    events = events.select("event_id", "user_id", "ts", "event_type")
    return asof_join(events, orders, [("user_id", "o_custkey")], "ts", "o_orderdate", take, ties=["o_orderkey"])


def purchase_after_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with its user's latest view at or before it."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select("event_id", "user_id", "ts", "event_type", "value")
    bought = events.where("event_type = 'purchase'").drop("event_type")
    take = {"view_id": "event_id", "view_ts": "ts", "view_value": "value"}
    return asof_join(bought, events.where("event_type = 'view'"), [("user_id", "user_id")], "ts", "ts", take, ties=["event_id"])


def overlapping_trips(w: Warehouse) -> DataFrame:
    """Pairs of trips from one pickup zone that were under way at one time.

    The trips are counted first, as the pairs are far more: raw rows, of which a few are
    rejected later, or those of a fact that is stored.
    """
    tasks = pair_tasks(w.overrides.get("fact_trip", w.raw).count())
    trips = w.fact.select("trip_id", "pu_location_key", "pickup_ts", "dropoff_ts")
    span = ("pickup_ts", "dropoff_ts")
    pairs = overlap_join(trips, trips, [("pu_location_key", "pu_location_key")], span, span, tasks=tasks)
    pairs = pairs.where(F.col("left.trip_id") < F.col("right.trip_id"))
    return pairs.select(
        F.col("key0").alias("pu_location_key"),
        F.col("left.trip_id").alias("trip_id"),
        F.col("right.trip_id").alias("other_trip_id"),
        "overlap_seconds",
    )


def fact_changes(w: Warehouse) -> DataFrame:
    """How the fact with injected defects differs from the sound one."""
    return change_set(w.fact, defective(w).fact, ["trip_id"])


def vendor_changes(w: Warehouse) -> DataFrame:
    """How the dimension with injected defects differs from the sound one."""
    return change_set(w.dims["dim_vendor"], defective(w).dims["dim_vendor"], ["vendor_key"])


def _business_rows(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    columns = [c for c in w.raw.columns if c in w.silver.columns]
    return w.raw.select(*columns), w.silver.select(*columns)


def rows_not_curated(w: Warehouse) -> DataFrame:
    """Raw rows that the curated layer lacks, with how many of each: rejected ones and further copies."""
    return except_all(*_business_rows(w))


def rows_curated(w: Warehouse) -> DataFrame:
    """Rows of both layers, with how many of each are in both."""
    return intersect_all(*_business_rows(w))


def vendor_running(w: Warehouse) -> DataFrame:
    """Each trip with its vendor's trips and revenue so far and the time since the vendor's previous trip."""
    trips = w.fact.select("trip_id", "vendor_key", "pickup_ts", "total_amount")
    totals = {"running_revenue": "total_amount"}
    return running_totals(trips, "vendor_key", "pickup_ts", ["trip_id"], totals, "running_trips", "gap_seconds")


def monthly_estimates(w: Warehouse) -> DataFrame:
    """Distinct trips and revenue quantiles of a month, from the days' sketches."""
    return estimates(merged(daily_sketches(w.fact), ["pickup_year", "pickup_month"]))


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users' events, closed by six hours without one."""
    return sessions(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"), gap="6 hours")
