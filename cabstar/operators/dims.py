"""Dimension builders. Each dimension carries exactly one unknown member (key -1).

Code dimensions come from one pass over the fact: every code column is exploded into
(kind, code) pairs and made distinct, so map-side partial aggregation leaves only the
distinct codes of each task to shuffle. Label tables are tiny in-memory relations;
Catalyst knows their exact size and broadcasts them on its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstar.functions.keys import UNKNOWN_KEY, date_key, daypart, passenger_group
from cabstar.sources import reference as ref


@dataclass(frozen=True)
class CodeDim:
    kind: str
    key: str
    code: str
    label: str
    names: list[tuple[int, str]]
    unknown_label: str
    extra: dict[str, bool] = field(default_factory=dict)


CODE_DIMS = {
    "vendor": CodeDim("vendor", "vendor_key", "vendorid", "vendor_name", ref.VENDOR_NAMES, ref.UNKNOWN_VENDOR,
                      {"is_current": True}),
    "payment_type": CodeDim("payment_type", "payment_type_key", "payment_type", "payment_type_description",
                            ref.PAYMENT_TYPE_NAMES, ref.UNKNOWN_PAYMENT_TYPE),
    "rate_code": CodeDim("rate_code", "rate_code_key", "ratecodeid", "rate_code_description",
                         ref.RATE_CODE_NAMES, ref.UNKNOWN_RATE_CODE),
}

# fact key column -> code kind
FACT_CODE_COLUMNS = [
    ("vendor", "vendor_key"),
    ("payment_type", "payment_type_key"),
    ("rate_code", "rate_code_key"),
    ("passenger_count", "passenger_count_key"),
    ("location", "pu_location_key"),
    ("location", "do_location_key"),
]


def fact_codes(fact: DataFrame) -> DataFrame:
    """Distinct (kind, code) pairs of every code column of the fact, in one scan."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("int").alias("code")) for k, c in FACT_CODE_COLUMNS])
    return fact.select(F.inline(pairs)).distinct()


def _known(codes: DataFrame, kind: str) -> DataFrame:
    return codes.where((F.col("kind") == kind) & (F.col("code") != UNKNOWN_KEY)).select("code")


def _one_row(spark: SparkSession, values: list, schema: T.StructType) -> DataFrame:
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame([tuple(values)], nullable)


def code_dim(codes: DataFrame, name: str) -> DataFrame:
    spec = CODE_DIMS[name]
    spark = codes.sparkSession
    labels = ref.code_labels(spark, spec.names, "code", "_label")
    fallback = F.concat(F.lit(spec.unknown_label + " "), F.col("code").cast("string"))
    extras = [F.lit(v).alias(k) for k, v in spec.extra.items()]
    members = (
        _known(codes, spec.kind)
        .join(labels, "code", "left")
        .select(
            F.col("code").alias(spec.key),
            F.col("code").alias(spec.code),
            F.coalesce(F.col("_label"), fallback).alias(spec.label),
            *extras,
        )
    )
    unknown = _one_row(spark, [UNKNOWN_KEY, UNKNOWN_KEY, spec.unknown_label, *spec.extra.values()], members.schema)
    return members.unionByName(unknown)


def dim_location(codes: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Pickup and dropoff location ids, labelled from an optional zone lookup."""
    spark = codes.sparkSession
    ids = _known(codes, "location").select(F.col("code").alias("location_id"))
    fallback_zone = F.concat(F.lit("Location "), F.col("location_id").cast("string"))
    if zones is not None:
        ids = ids.join(zones.select("location_id", "borough", "zone", "service_zone"), "location_id", "left")
        borough, zone, service = F.col("borough"), F.col("zone"), F.col("service_zone")
    else:
        borough = zone = service = F.lit(None).cast("string")
    members = ids.select(
        F.col("location_id").alias("location_key"),
        "location_id",
        F.coalesce(borough, F.lit(ref.UNKNOWN_LABEL)).alias("borough"),
        F.coalesce(zone, fallback_zone).alias("zone"),
        F.coalesce(service, F.lit(ref.UNKNOWN_LABEL)).alias("service_zone"),
    )
    unknown = _one_row(spark, [UNKNOWN_KEY, UNKNOWN_KEY, *ref.UNKNOWN_LOCATION], members.schema)
    return members.unionByName(unknown)


def dim_passenger_count(codes: DataFrame) -> DataFrame:
    spark = codes.sparkSession
    members = _known(codes, "passenger_count").select(
        F.col("code").alias("passenger_count_key"),
        F.col("code").alias("passenger_count"),
        passenger_group("code").alias("passenger_group"),
    )
    unknown = _one_row(spark, [UNKNOWN_KEY, UNKNOWN_KEY, ref.UNKNOWN_LABEL], members.schema)
    return members.unionByName(unknown)


def calendar_bounds(fact: DataFrame) -> DataFrame:
    """One row (start, end): whole calendar years spanning every pickup and dropoff."""
    return fact.agg(
        F.make_date(F.year(F.min("pickup_ts")), F.lit(1), F.lit(1)).alias("start"),
        F.make_date(F.year(F.max("dropoff_ts")), F.lit(12), F.lit(31)).alias("end"),
    )


def literal_bounds(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.to_date(F.lit(start)).alias("start"), F.to_date(F.lit(end)).alias("end"))


def _calendar_columns(d: Column) -> list[Column]:
    dow = (F.weekday(d) + 1).cast("int")  # ISO: Monday 1 .. Sunday 7
    return [
        date_key(d).alias("date_key"),
        d.alias("calendar_date"),
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"),
        F.date_format(d, "MMMM").alias("calendar_month_name"),
        F.date_format(d, "MMM").alias("calendar_month_short_name"),
        F.dayofmonth(d).alias("calendar_day"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        dow.alias("day_of_week_number"),
        dow.isin(6, 7).alias("is_weekend"),
        F.trunc(d, "MM").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    ]


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day in [start, end] (bounds: one row) plus the unknown member."""
    spark = bounds.sparkSession
    days = bounds.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("d"))
    members = days.select(*_calendar_columns(F.col("d")))
    unknown = _one_row(
        spark,
        [UNKNOWN_KEY, None, -1, -1, -1, "Unknown", "UNK", -1, -1, -1, "Unknown", -1, False, None, None, "Unknown"],
        members.schema,
    )
    return unknown.unionByName(members)


def dim_time(spark: SparkSession) -> DataFrame:
    """86,400 seconds of the day plus the unknown member; generated on executors."""
    s = F.col("id")
    hour, minute, second = (s / 3600).cast("int"), ((s / 60) % 60).cast("int"), (s % 60).cast("int")
    members = spark.range(86400).select(
        (hour * 10000 + minute * 100 + second).alias("time_key"),
        hour.alias("hour"),
        minute.alias("minute"),
        second.alias("second"),
        daypart(hour).alias("daypart"),
    )
    unknown = _one_row(spark, [UNKNOWN_KEY, -1, -1, -1, ref.UNKNOWN_LABEL], members.schema)
    return unknown.unionByName(members)
