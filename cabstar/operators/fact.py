"""Curated trips -> atomic trip fact (one row per valid trip, smart keys, hashed id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstar.functions.casts import lenient_cast
from cabstar.functions.keys import (
    UNKNOWN_KEY,
    date_key,
    duration_minutes,
    flag_key,
    per_trip_tip_ratio,
    quality_key,
    surrogate_id,
    time_key,
)
from cabstar.operators.cleanse import Rule, align_schema, all_of
from cabstar.operators.lineage import BUCKET_SECONDS, number_within, places, time_bucket

# Fixed values of the warehouse contract.
ID_COLUMNS = ["vendorid", "ratecodeid", "payment_type", "pulocationid", "dolocationid", "passenger_count"]
MEASURE_COLUMNS = [
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
]
# The documented lineage order; the remaining business columns follow as tie-breakers so
# tied rows are identical and the numbering is repeatable.
LINEAGE_ORDER = [
    "pickup_ts", "dropoff_ts", "vendorid", "pulocationid", "dolocationid", "payment_type",
    "fare_amount", "total_amount", "trip_distance",
]
LINEAGE_TIEBREAK = [
    "passenger_count", "ratecodeid", "store_and_fwd_flag", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
]

FACT_COLUMNS = [
    "trip_id", "ingestion_batch_key", "pickup_date_key", "dropoff_date_key", "pickup_time_key",
    "dropoff_time_key", "vendor_key", "payment_type_key", "rate_code_key", "pu_location_key",
    "do_location_key", "passenger_count_key", "trip_flags_key", "trip_quality_key", "source_file_name",
    "source_row_number", "pickup_ts", "dropoff_ts", "trip_count", "passenger_count", "trip_distance",
    "trip_duration_minutes", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount",
    "tip_pct", "pickup_year", "pickup_month", "pickup_day",
]


def warehouse_rules() -> list[Rule]:
    """A fact row needs both timestamps in order and non-negative distance and total."""
    c = F.col
    return [
        Rule("pickup_present", c("pickup_ts").isNotNull()),
        Rule("dropoff_present", c("dropoff_ts").isNotNull()),
        Rule("dropoff_not_before_pickup", c("dropoff_ts") >= c("pickup_ts")),
        Rule("distance_not_negative", c("trip_distance") >= 0),
        Rule("total_not_negative", c("total_amount") >= 0),
    ]


def numbering_places(bucket_seconds: int = BUCKET_SECONDS) -> dict[str, Column]:
    """The columns by which ``build_fact_trip`` numbers curated trips, for ``cleanse(placed_by=...)``."""
    return places("source_file_name", time_bucket("tpep_pickup_datetime", bucket_seconds))


def normalize_trips(curated: DataFrame) -> DataFrame:
    """Typed trips with NULL ids as -1 and NULL measures as 0.0, plus calendar columns.

    Lineage: a ``source_file_name`` already on the input (the raw file recorded at
    cleansing) is kept; only when absent is the scanned file stamped. The columns of
    ``numbering_places`` stay.
    """
    df = align_schema(curated)
    lineage = F.col("source_file_name") if "source_file_name" in df.columns else F.col("_metadata.file_path")
    pickup = lenient_cast(df, "tpep_pickup_datetime", "timestamp_ntz")
    dropoff = lenient_cast(df, "tpep_dropoff_datetime", "timestamp_ntz")
    flag = lenient_cast(df, "store_and_fwd_flag", "string") if "store_and_fwd_flag" in df.columns else F.lit(None)
    return df.select(
        lineage.cast("string").alias("source_file_name"),
        pickup.alias("pickup_ts"),
        dropoff.alias("dropoff_ts"),
        *[F.coalesce(lenient_cast(df, c, "int"), F.lit(UNKNOWN_KEY)).alias(c) for c in ID_COLUMNS],
        flag.cast("string").alias("store_and_fwd_flag"),
        *[F.coalesce(lenient_cast(df, c, "double"), F.lit(0.0)).alias(c) for c in MEASURE_COLUMNS],
        *[c for c in numbering_places() if c in df.columns],
    ).withColumns(
        {
            "pickup_date": F.to_date("pickup_ts"),
            "dropoff_date": F.to_date("dropoff_ts"),
            "pickup_year": F.year("pickup_ts").cast("int"),
            "pickup_month": F.month("pickup_ts").cast("int"),
            "pickup_day": F.dayofmonth("pickup_ts").cast("int"),
            "trip_duration_minutes": duration_minutes("pickup_ts", "dropoff_ts"),
        }
    )


def valid_trips(normalized: DataFrame) -> DataFrame:
    return normalized.where(all_of(warehouse_rules()))


def validate_batch_id(batch_id: str) -> int:
    """Batch ids are numeric (UTC yyyyMMddHHmmss by default); fail before any Spark work."""
    if not batch_id or not batch_id.isdigit():
        raise ValueError(f"batch_id must be numeric, got {batch_id!r}")
    return int(batch_id)


def build_fact_trip(curated: DataFrame, batch_id: str, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """The fact of curated trips; trips placed by ``numbering_places(bucket_seconds)`` aren't shuffled again."""
    batch_key = validate_batch_id(batch_id)
    valid = valid_trips(normalize_trips(curated))
    numbered = number_within(
        valid,
        "source_file_name",
        LINEAGE_ORDER + LINEAGE_TIEBREAK,
        time_bucket("pickup_ts", bucket_seconds),
        "source_row_number",
    )
    c = F.col
    trip_id = surrogate_id(
        [
            F.lit(batch_id), c("source_file_name"), c("source_row_number"), c("pickup_ts"), c("dropoff_ts"),
            c("vendorid"), c("pulocationid"), c("dolocationid"), c("total_amount"),
        ]
    )
    return numbered.select(
        trip_id.alias("trip_id"),
        F.lit(batch_key).cast("bigint").alias("ingestion_batch_key"),
        date_key("pickup_date").alias("pickup_date_key"),
        date_key("dropoff_date").alias("dropoff_date_key"),
        time_key("pickup_ts").alias("pickup_time_key"),
        time_key("dropoff_ts").alias("dropoff_time_key"),
        c("vendorid").alias("vendor_key"),
        c("payment_type").alias("payment_type_key"),
        c("ratecodeid").alias("rate_code_key"),
        c("pulocationid").alias("pu_location_key"),
        c("dolocationid").alias("do_location_key"),
        c("passenger_count").alias("passenger_count_key"),
        flag_key("store_and_fwd_flag").alias("trip_flags_key"),
        quality_key("trip_distance", "trip_duration_minutes", "total_amount").alias("trip_quality_key"),
        "source_file_name",
        "source_row_number",
        "pickup_ts",
        "dropoff_ts",
        F.lit(1).alias("trip_count"),
        "passenger_count",
        "trip_distance",
        "trip_duration_minutes",
        *MEASURE_COLUMNS[1:],
        per_trip_tip_ratio("tip_amount", "fare_amount").alias("tip_pct"),
        "pickup_year",
        "pickup_month",
        "pickup_day",
    ).select(*FACT_COLUMNS)
