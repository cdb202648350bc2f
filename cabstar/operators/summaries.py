"""Atomic fact -> four daily summary facts (daily, vendor, payment type, route).

Same one-pass GROUPING SETS shape as the marts: the fact is scanned once for all four.
Sums are exact (DECIMAL), averages are exact total / count, durations are
averaged from whole seconds, so every value is independent of row order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstar.functions.money import exact_sum

# Per-trip ratios have up to 17 significant digits; summed exactly at 18 decimals.
RATIO = T.DecimalType(38, 18)


@dataclass(frozen=True)
class SummarySpec:
    name: str
    keys: list[str]
    measures: list[str]


SUMMARIES: dict[str, SummarySpec] = {
    "daily": SummarySpec(
        "fact_daily_trip_summary",
        ["pickup_date_key", "pickup_year"],
        ["total_trips", "total_passengers", "total_revenue", "total_fare", "total_tips",
         "avg_trip_distance", "avg_trip_duration_minutes", "avg_revenue"],
    ),
    "vendor": SummarySpec(
        "fact_vendor_daily_summary",
        ["pickup_date_key", "vendor_key", "pickup_year", "pickup_month"],
        ["total_trips", "total_revenue", "total_tips", "avg_trip_distance", "avg_revenue"],
    ),
    "payment": SummarySpec(
        "fact_payment_daily_summary",
        ["pickup_date_key", "payment_type_key", "pickup_year", "pickup_month"],
        ["total_trips", "total_revenue", "total_fare", "total_tips", "avg_tip_pct"],
    ),
    "location": SummarySpec(
        "fact_location_daily_summary",
        ["pickup_date_key", "pu_location_key", "do_location_key", "pickup_year", "pickup_month"],
        ["total_trips", "total_revenue", "total_tips", "avg_trip_distance", "avg_trip_duration_minutes"],
    ),
}


def _seconds() -> Column:
    return F.unix_timestamp("dropoff_ts") - F.unix_timestamp("pickup_ts")


def _partials() -> list[Column]:
    return [
        F.sum("trip_count").alias("total_trips"),
        F.sum("passenger_count").alias("total_passengers"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_sum("fare_amount").alias("total_fare"),
        exact_sum("tip_amount").alias("total_tips"),
        F.count(F.lit(1)).alias("_n"),
        exact_sum("trip_distance").alias("_distance"),
        F.sum(_seconds()).alias("_seconds"),
        F.sum(F.col("tip_pct").cast(RATIO)).alias("_tip_pct"),
    ]


def _measure(name: str) -> Column:
    derived = {
        "avg_trip_distance": F.col("_distance") / F.col("_n"),
        "avg_trip_duration_minutes": F.col("_seconds").cast("double") / F.col("_n") / F.lit(60.0),
        "avg_revenue": F.col("total_revenue") / F.col("_n"),
        "avg_tip_pct": F.col("_tip_pct").cast("double") / F.col("_n"),
    }
    return derived.get(name, F.col(name))


def _finish(spec: SummarySpec) -> list[Column]:
    return [*[F.col(k) for k in spec.keys], *[_measure(m).alias(m) for m in spec.measures]]


def build_summary(fact: DataFrame, name: str) -> DataFrame:
    spec = SUMMARIES[name]
    return fact.groupBy(*spec.keys).agg(*_partials()).select(*_finish(spec))


def build_summaries_combined(fact: DataFrame, names: list[str] | None = None) -> DataFrame:
    names = names or list(SUMMARIES)
    all_keys: list[str] = []
    for n in names:
        all_keys += [k for k in SUMMARIES[n].keys if k not in all_keys]
    return fact.groupingSets([SUMMARIES[n].keys for n in names], *all_keys).agg(
        *_partials(), F.grouping_id().alias("_gid")
    )


def split_summaries(combined: DataFrame, names: list[str] | None = None) -> dict[str, DataFrame]:
    names = names or list(SUMMARIES)
    all_keys = [c for c in combined.columns if c.endswith("_key") or c in ("pickup_year", "pickup_month")]
    out = {}
    for n in names:
        spec = SUMMARIES[n]
        gid = 0
        for k in all_keys:
            gid = (gid << 1) | (0 if k in spec.keys else 1)
        out[n] = combined.where(F.col("_gid") == gid).select(*_finish(spec))
    return out


def build_summaries(fact: DataFrame) -> dict[str, DataFrame]:
    return split_summaries(build_summaries_combined(fact))
