"""Reporting queries over the star schema (quality, batches, daily, vendor, payment).

Each is a roll-up of the fact to the dimension key, joined with the (small) dimension,
re-aggregated by the dimension attribute; see ``cabstar.plans.star``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.plans.star import dim_join, reaggregate, rollup, rounded
from cabstar.plans.warehouse import Warehouse


def quality_distribution(w: Warehouse) -> DataFrame:
    measures = ["total_trips", "total_revenue"]
    rolled = dim_join(
        rollup(w.fact, ["trip_quality_key"], measures), w.dims["dim_trip_quality"], "trip_quality_key", "trip_quality_key",
        {"quality_code": "quality_code", "quality_description": "quality_description"},
    )
    return (
        reaggregate(rolled, ["quality_code", "quality_description"])
        .select("quality_code", "quality_description", F.col("_p_trips").alias("total_trips"),
                rounded("total_revenue", 2).alias("total_revenue"))
        .orderBy(F.col("total_trips").desc(), "quality_code")
    )


def batch_audit(w: Warehouse) -> DataFrame:
    return w.dims["dim_ingestion_batch"].select(
        "batch_id", "job_name", "source_table", "source_record_count", "valid_record_count",
        "rejected_record_count", "target_base_path", "ingestion_batch_key",
    ).orderBy(F.col("ingestion_batch_key").desc()).drop("ingestion_batch_key")


def daily_revenue(w: Warehouse) -> DataFrame:
    measures = ["total_trips", "total_revenue", "avg_revenue", "avg_trip_distance"]
    rolled = dim_join(rollup(w.fact, ["pickup_date_key"], measures), w.dims["dim_date"], "pickup_date_key", "date_key",
                      {"calendar_date": "calendar_date"})
    return (
        reaggregate(rolled, ["calendar_date"])
        .select("calendar_date", F.col("_p_trips").alias("total_trips"),
                rounded("total_revenue", 2).alias("total_revenue"),
                rounded("avg_revenue", 2).alias("avg_revenue"),
                rounded("avg_trip_distance", 2).alias("avg_trip_distance"))
        .orderBy("calendar_date")
    )


def vendor_performance(w: Warehouse) -> DataFrame:
    measures = ["total_trips", "total_revenue", "revenue_per_mile"]
    rolled = dim_join(rollup(w.fact, ["vendor_key"], measures), w.dims["dim_vendor"], "vendor_key", "vendor_key",
                      {"vendor_name": "vendor_name"})
    return (
        reaggregate(rolled, ["vendor_name"])
        .select("vendor_name", F.col("_p_trips").alias("total_trips"),
                rounded("total_revenue", 2).alias("total_revenue"),
                rounded("revenue_per_mile", 2).alias("revenue_per_mile"))
        .orderBy(F.col("total_revenue").desc(), "vendor_name")
    )


def payment_behaviour(w: Warehouse) -> DataFrame:
    measures = ["total_trips", "total_revenue", "total_tips", "tip_pct"]
    rolled = dim_join(rollup(w.fact, ["payment_type_key"], measures), w.dims["dim_payment_type"], "payment_type_key",
                      "payment_type_key", {"payment_type_description": "payment_type_description"})
    return (
        reaggregate(rolled, ["payment_type_description"])
        .select("payment_type_description", F.col("_p_trips").alias("total_trips"),
                rounded("total_revenue", 2).alias("total_revenue"),
                rounded("total_tips", 2).alias("total_tips"),
                rounded("tip_pct", 4).alias("tip_pct"))
        .orderBy(F.col("total_revenue").desc(), "payment_type_description")
    )
