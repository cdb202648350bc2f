"""Load audit: one ``dim_ingestion_batch`` row per warehouse load.

Source, valid and rejected counts come from one conditional aggregate over the curated
input (no separate count jobs), and the row itself is built on the executors from that
one-row result, so nothing passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.operators.cleanse import all_of
from cabstar.operators.fact import normalize_trips, validate_batch_id, warehouse_rules

AUDIT_COLUMNS = [
    "ingestion_batch_key", "batch_id", "job_name", "job_run_id", "source_system", "source_dataset",
    "source_table", "target_base_path", "load_started_utc", "load_completed_utc", "source_record_count",
    "valid_record_count", "rejected_record_count",
]


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def default_batch_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")


@dataclass(frozen=True)
class LoadInfo:
    batch_id: str
    job_name: str = "cabstar_star_schema"
    job_run_id: str = "not_provided"
    source_system: str = "NYC TLC Yellow Taxi"
    source_dataset: str = "yellow_tripdata"
    source_table: str = "silver"
    target_base_path: str = ""
    load_started_utc: str | None = None
    load_completed_utc: str | None = None


def load_counts(curated: DataFrame) -> DataFrame:
    """One row: source_record_count, valid_record_count (warehouse rules), in one pass."""
    return normalize_trips(curated).agg(
        F.count(F.lit(1)).alias("source_record_count"),
        F.count_if(all_of(warehouse_rules())).alias("valid_record_count"),
    )


def dim_ingestion_batch(counts: DataFrame, info: LoadInfo) -> DataFrame:
    key = validate_batch_id(info.batch_id)
    started = info.load_started_utc or utc_now()
    completed = info.load_completed_utc or utc_now()
    return counts.select(
        F.lit(key).cast("bigint").alias("ingestion_batch_key"),
        F.lit(info.batch_id).alias("batch_id"),
        F.lit(info.job_name).alias("job_name"),
        F.lit(info.job_run_id).alias("job_run_id"),
        F.lit(info.source_system).alias("source_system"),
        F.lit(info.source_dataset).alias("source_dataset"),
        F.lit(info.source_table).alias("source_table"),
        F.lit(info.target_base_path).alias("target_base_path"),
        F.lit(started).alias("load_started_utc"),
        F.lit(completed).alias("load_completed_utc"),
        F.col("source_record_count").cast("bigint"),
        F.col("valid_record_count").cast("bigint"),
        (F.col("source_record_count") - F.col("valid_record_count")).cast("bigint").alias("rejected_record_count"),
    )
