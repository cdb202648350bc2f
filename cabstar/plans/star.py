"""Querying the star schema at scale: aggregate first, join later.

A report "fact JOIN dimension GROUP BY dimension attribute" is computed as
  1. roll the fact up to the grain of the foreign keys it needs (partial aggregation
     happens map-side, so only one row per task and key crosses the network),
  2. join that small roll-up with the dimension (small to small: no fact-sized join,
     no broadcast of data whose size is not known),
  3. re-aggregate the exact partial measures by the dimension attributes.
This equals join-then-aggregate, duplicate dimension keys included (each joined dim row
carries its key's totals, as each fact row would be repeated). Partial measures are
integer and DECIMAL sums and counts, so re-aggregation is exact and order-free.

The denormalised ``star_view`` (every fact row with all its dimensions) cannot be
pre-aggregated; there every dimension is broadcast. A dimension has a row a day, second or
code, however many trips there are; a shuffle join by such a key would send all trips of a
vendor, or of the one batch, to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstar.functions.money import exact_parts, exact_total

#: Money and distance measures: partial name -> fact column.
_EXACT = {"revenue": "total_amount", "fare": "fare_amount", "tips": "tip_amount", "distance": "trip_distance"}


#: Measure -> the partials it is made of.
_NEEDS = {
    "total_trips": ("trips",),
    "total_passengers": ("passengers",),
    "known_passengers": ("known_passengers",),
    "total_revenue": ("revenue",),
    "total_fare": ("fare",),
    "total_tips": ("tips",),
    "total_distance": ("distance",),
    "avg_revenue": ("revenue", "trips"),
    "avg_fare": ("fare", "trips"),
    "avg_trip_distance": ("distance", "trips"),
    "avg_trip_duration_minutes": ("seconds", "trips"),
    "revenue_per_trip": ("revenue", "trip_count"),
    "revenue_per_mile": ("revenue", "distance"),
    "tip_pct": ("tips", "fare"),
}


def _parts(name: str) -> tuple[str, str, str]:
    return f"_p_{name}", f"_p_{name}_decimal", f"_p_{name}_others"


def _partials(name: str) -> list[Column]:
    if name in _EXACT:
        return [part.alias(p) for p, part in zip(_parts(name), exact_parts(_EXACT[name]))]
    known = F.col("passenger_count")
    plain = {
        "trips": lambda: F.count(F.lit(1)),
        "trip_count": lambda: F.sum("trip_count"),
        "passengers": lambda: F.sum(known),
        "known_passengers": lambda: F.sum(F.when(known >= 0, known)),
        "seconds": lambda: F.sum(F.unix_timestamp("dropoff_ts") - F.unix_timestamp("pickup_ts")),
    }
    return [plain[name]().alias(f"_p_{name}")]


def rollup(fact: DataFrame, keys: list[str | Column], measures: Sequence[str]) -> DataFrame:
    """Fact rolled up to ``keys`` with the exact partials ``_p_*`` that ``measures`` are made of."""
    needed = dict.fromkeys(p for m in measures for p in _NEEDS[m])
    return fact.groupBy(*keys).agg(*[part for name in needed for part in _partials(name)])


def reaggregate(df: DataFrame, by: list[str | Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in df.columns if c.startswith("_p_")])


def measure(name: str) -> Column:
    """Final measure from re-aggregated partials (reference BI definitions)."""

    def value(partial: str) -> Column:
        return exact_total(*map(F.col, _parts(partial))) if partial in _EXACT else F.col(f"_p_{partial}")

    first, *per = (value(p) for p in _NEEDS[name])
    if not per:
        return first
    if name == "avg_trip_duration_minutes":
        return first.cast("double") / per[0] / F.lit(60.0)
    if name in ("revenue_per_mile", "tip_pct"):
        return first / F.nullif(per[0], F.lit(0.0))
    return first / per[0]


def rounded(name: str, digits: int) -> Column:
    return F.round(measure(name), digits)


def dim_join(rolled: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, attrs: dict[str, str]) -> DataFrame:
    """Inner-join a roll-up with a dimension, bringing ``attrs`` (dim column -> output name)."""
    d = dim.select(F.col(dim_key).alias(fact_key), *[F.col(c).alias(a) for c, a in attrs.items()])
    return rolled.join(d, fact_key, "inner")


def star_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Every fact row with the attributes of all ten dimensions (left joins keep every trip)."""
    spec = [
        ("dim_date", "pickup_date_key", "date_key",
         ["calendar_date", "calendar_year", "calendar_quarter", "calendar_month", "year_month", "day_of_week",
          "day_of_week_number", "is_weekend"], ""),
        ("dim_time", "pickup_time_key", "time_key", ["hour", "daypart"], ""),
        ("dim_vendor", "vendor_key", "vendor_key", ["vendor_name"], ""),
        ("dim_payment_type", "payment_type_key", "payment_type_key", ["payment_type_description"], ""),
        ("dim_rate_code", "rate_code_key", "rate_code_key", ["rate_code_description"], ""),
        ("dim_location", "pu_location_key", "location_key", ["borough", "zone", "service_zone"], "pickup_"),
        ("dim_location", "do_location_key", "location_key", ["borough", "zone", "service_zone"], "dropoff_"),
        ("dim_passenger_count", "passenger_count_key", "passenger_count_key", ["passenger_group"], ""),
        ("dim_trip_flags", "trip_flags_key", "trip_flags_key", ["store_and_fwd_description"], ""),
        ("dim_trip_quality", "trip_quality_key", "trip_quality_key", ["quality_code"], ""),
        ("dim_ingestion_batch", "ingestion_batch_key", "ingestion_batch_key", ["batch_id"], ""),
    ]
    out = fact
    for table, fk, key, cols, prefix in spec:
        d = dims[table].select(F.col(key).alias(f"_k_{fk}"), *[F.col(c).alias(prefix + c) for c in cols])
        out = out.join(F.broadcast(d), out[fk] == d[f"_k_{fk}"], "left").drop(f"_k_{fk}")
    return out
