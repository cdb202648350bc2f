"""Static reference rows of the warehouse, with explicit schemas (keys are INT)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Code -> label tables of the taxi feed, and the unknown-member labels.
VENDOR_NAMES = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc"),
    (6, "Myle Technologies"),
    (7, "Helix"),
]
PAYMENT_TYPE_NAMES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
RATE_CODE_NAMES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]
TRIP_FLAG_ROWS = [
    (-1, "Unknown", "Unknown"),
    (1, "N", "Not stored before forwarding"),
    (2, "Y", "Stored before forwarding"),
]
TRIP_QUALITY_ROWS = [
    (-1, "UNKNOWN", "Unknown quality state", False, False, False),
    (1, "VALID_STANDARD", "Valid standard trip", False, False, False),
    (2, "ZERO_DISTANCE", "Valid trip with zero distance", True, False, False),
    (3, "LONG_DURATION", "Valid trip longer than four hours", False, True, False),
    (4, "HIGH_AMOUNT", "Valid trip with total amount over 500", False, False, True),
]
UNKNOWN_VENDOR = "Unknown Vendor"
UNKNOWN_PAYMENT_TYPE = "Unknown Payment Type"
UNKNOWN_RATE_CODE = "Unknown Rate Code"
UNKNOWN_LOCATION = ("Unknown", "Unknown Location", "Unknown")  # borough, zone, service_zone
UNKNOWN_LABEL = "Unknown"


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def code_labels(spark: SparkSession, rows: list[tuple[int, str]], code: str, label: str) -> DataFrame:
    return spark.createDataFrame(rows, _schema((code, T.IntegerType()), (label, T.StringType())))


def dim_trip_flags(spark: SparkSession) -> DataFrame:
    schema = _schema(
        ("trip_flags_key", T.IntegerType()),
        ("store_and_fwd_flag", T.StringType()),
        ("store_and_fwd_description", T.StringType()),
    )
    return spark.createDataFrame(TRIP_FLAG_ROWS, schema)


def dim_trip_quality(spark: SparkSession) -> DataFrame:
    schema = _schema(
        ("trip_quality_key", T.IntegerType()),
        ("quality_code", T.StringType()),
        ("quality_description", T.StringType()),
        ("is_zero_distance", T.BooleanType()),
        ("is_long_duration", T.BooleanType()),
        ("is_high_amount", T.BooleanType()),
    )
    return spark.createDataFrame(TRIP_QUALITY_ROWS, schema)
