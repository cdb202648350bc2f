"""Curated -> four revenue marts (daily, vendor, payment type, passenger count).

A single mart is a plain ``groupBy``. A load that writes all four computes them from one
scan: a GROUPING SETS aggregate expands each row to one per mart and aggregates map-side;
its result is written once and each mart is a filter on ``grouping_id`` over that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstar.functions.casts import lenient_cast
from cabstar.functions.money import exact_sum, round_half_up

PERIOD = ["pickup_year", "pickup_month"]


@dataclass(frozen=True)
class MartSpec:
    name: str
    keys: list[str]
    passengers: bool = False  # total_passengers measure
    tip_ratio: bool = False   # tip_pct instead of the two averages


MARTS: dict[str, MartSpec] = {
    "daily_revenue": MartSpec("daily_revenue", ["pickup_date", *PERIOD], passengers=True),
    "vendor_revenue": MartSpec("vendor_revenue", ["vendorid", *PERIOD]),
    "payment_type_analysis": MartSpec("payment_type_analysis", ["payment_type", *PERIOD], tip_ratio=True),
    "passenger_analysis": MartSpec("passenger_analysis", ["passenger_count", *PERIOD]),
}

_SOURCE_COLUMNS = {
    "passenger_count": "int",
    "vendorid": "int",
    "payment_type": "int",
    "trip_distance": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
}


def prepare_mart_source(curated: DataFrame) -> DataFrame:
    """Prune to the eight columns the marts read and (re)derive the period columns."""
    pickup = lenient_cast(curated, "tpep_pickup_datetime", "timestamp_ntz")
    return curated.select(
        F.to_date(pickup).alias("pickup_date"),
        F.year(pickup).cast("int").alias("pickup_year"),
        F.month(pickup).cast("int").alias("pickup_month"),
        *[lenient_cast(curated, name, kind).alias(name) for name, kind in _SOURCE_COLUMNS.items()],
    )


def _partials() -> list[Column]:
    """Exact partial measures shared by every mart (DECIMAL sums, counts)."""
    return [
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("passenger_count").alias("total_passengers"),
        exact_sum("fare_amount").alias("_fare"),
        exact_sum("tip_amount").alias("_tips"),
        exact_sum("total_amount").alias("_revenue"),
        exact_sum("trip_distance").alias("_distance"),
        F.count("trip_distance").alias("_n_distance"),
        F.count("total_amount").alias("_n_revenue"),
    ]


def _finish(spec: MartSpec) -> list[Column]:
    out = [*[F.col(k) for k in spec.keys], F.col("total_trips")]
    if spec.passengers:
        out.append(F.col("total_passengers"))
    out += [
        round_half_up(F.col("_fare"), 2).alias("total_fare"),
        round_half_up(F.col("_tips"), 2).alias("total_tips"),
        round_half_up(F.col("_revenue"), 2).alias("total_revenue"),
    ]
    if spec.tip_ratio:
        ratio = F.when(F.col("_fare") != 0, F.col("_tips") / F.col("_fare")).otherwise(F.lit(0.0))
        out.append(round_half_up(ratio, 4).alias("tip_pct"))
    else:
        out += [
            round_half_up(F.col("_distance") / F.col("_n_distance"), 2).alias("avg_trip_distance"),
            round_half_up(F.col("_revenue") / F.col("_n_revenue"), 2).alias("avg_revenue_per_trip"),
        ]
    return out


def build_mart(curated: DataFrame, name: str) -> DataFrame:
    spec = MARTS[name]
    source = prepare_mart_source(curated)
    return source.groupBy(*spec.keys).agg(*_partials()).select(*_finish(spec))


def build_marts_combined(curated: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One-pass aggregate of several marts; rows carry ``_gid`` (Spark ``grouping_id``)."""
    names = names or list(MARTS)
    source = prepare_mart_source(curated)
    all_keys: list[str] = []
    for n in names:
        all_keys += [k for k in MARTS[n].keys if k not in all_keys]
    sets = [MARTS[n].keys for n in names]
    return source.groupingSets(sets, *all_keys).agg(*_partials(), F.grouping_id().alias("_gid"))


def split_marts(combined: DataFrame, names: list[str] | None = None) -> dict[str, DataFrame]:
    names = names or list(MARTS)
    all_keys = [c for c in combined.columns if not c.startswith("_") and c not in ("total_trips", "total_passengers")]
    out = {}
    for n in names:
        spec = MARTS[n]
        # grouping_id bit i (most significant first) is 1 when key i is aggregated away.
        gid = 0
        for k in all_keys:
            gid = (gid << 1) | (0 if k in spec.keys else 1)
        out[n] = combined.where(F.col("_gid") == gid).select(*_finish(spec))
    return out


def build_marts(curated: DataFrame) -> dict[str, DataFrame]:
    return split_marts(build_marts_combined(curated))
