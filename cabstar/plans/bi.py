"""Dashboard queries defined by the warehouse's BI design (KPIs, time, vendor, payment,
location/route pages and the dashboard filter set), computed aggregate-first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabstar.plans.star import dim_join, measure, reaggregate, rollup
from cabstar.plans.warehouse import Warehouse


def _by(w: Warehouse, fk: str, dim: str, dim_key: str, attrs: list[str], measures: list[str]) -> DataFrame:
    """Measures of the fact grouped by attributes of one dimension."""
    rolled = dim_join(rollup(w.fact, [fk], measures), w.dims[dim], fk, dim_key, {a: a for a in attrs})
    return reaggregate(rolled, attrs).select(*attrs, *[measure(m).alias(m) for m in measures])


def _top(df: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    return df.orderBy(F.col(by).desc(), F.col(tie)).limit(n)


# B1 / B2 ------------------------------------------------------------------------------
def kpis(w: Warehouse) -> DataFrame:
    measures = ["total_trips", "total_revenue", "total_fare", "total_tips", "revenue_per_trip"]
    return rollup(w.fact, [], measures).select(*[measure(m).alias(m) for m in measures])


def monthly_metrics(w: Warehouse) -> DataFrame:
    return _by(w, "pickup_date_key", "dim_date", "date_key", ["year_month"],
               ["total_trips", "revenue_per_trip", "revenue_per_mile", "tip_pct", "avg_fare",
                "avg_trip_distance", "avg_trip_duration_minutes"])


# B3 -----------------------------------------------------------------------------------
def revenue_by_date(w: Warehouse) -> DataFrame:
    return _by(w, "pickup_date_key", "dim_date", "date_key", ["calendar_date"], ["total_trips", "total_revenue"])


def revenue_by_month(w: Warehouse) -> DataFrame:
    return _by(w, "pickup_date_key", "dim_date", "date_key", ["year_month"], ["total_trips", "total_revenue"])


def revenue_by_quarter(w: Warehouse) -> DataFrame:
    return _by(w, "pickup_date_key", "dim_date", "date_key", ["calendar_year", "calendar_quarter"],
               ["total_trips", "total_revenue"])


def weekend_vs_weekday(w: Warehouse) -> DataFrame:
    return _by(w, "pickup_date_key", "dim_date", "date_key", ["is_weekend"],
               ["total_trips", "total_revenue", "avg_revenue"])


# B4 -----------------------------------------------------------------------------------
def revenue_by_vendor(w: Warehouse) -> DataFrame:
    return _by(w, "vendor_key", "dim_vendor", "vendor_key", ["vendor_name"], ["total_revenue"])


def payment_share(w: Warehouse) -> DataFrame:
    per_type = _by(w, "payment_type_key", "dim_payment_type", "payment_type_key", ["payment_type_description"],
                   ["total_trips"])
    # one row per payment type: the grand total is a window over that tiny result
    everything = Window.partitionBy(F.lit(0))
    return per_type.withColumn("trip_share", F.col("total_trips") / F.sum("total_trips").over(everything))


# B5 / B6 ------------------------------------------------------------------------------
def weekday_hour_heatmap(w: Warehouse) -> DataFrame:
    # hours, not seconds of the day: a roll-up on the time key would be as large as the fact
    hour = F.floor(F.col("pickup_time_key") / 10000).cast("int").alias("pickup_hour")
    rolled = rollup(w.fact, ["pickup_date_key", hour], ["total_trips"])
    rolled = dim_join(rolled, w.dims["dim_date"], "pickup_date_key", "date_key",
                      {"day_of_week": "day_of_week", "day_of_week_number": "day_of_week_number"})
    hours = w.dims["dim_time"].groupBy("hour").agg(F.first("hour").alias("known"))
    rolled = dim_join(rolled, hours, "pickup_hour", "hour", {"known": "hour"})
    attrs = ["day_of_week", "day_of_week_number", "hour"]
    return reaggregate(rolled, attrs).select(*attrs, measure("total_trips").alias("total_trips"))


def revenue_by_daypart(w: Warehouse) -> DataFrame:
    return _by(w, "pickup_time_key", "dim_time", "time_key", ["daypart"],
               ["total_trips", "avg_revenue"])


# B7 / B8 ------------------------------------------------------------------------------
def vendor_table(w: Warehouse) -> DataFrame:
    return _by(w, "vendor_key", "dim_vendor", "vendor_key", ["vendor_name"],
               ["total_trips", "total_revenue", "revenue_per_mile", "tip_pct", "avg_trip_distance", "avg_revenue"])


def payment_table(w: Warehouse) -> DataFrame:
    return _by(w, "payment_type_key", "dim_payment_type", "payment_type_key", ["payment_type_description"],
               ["total_trips", "total_revenue", "total_fare", "total_tips", "tip_pct"])


# B9 / B10 -----------------------------------------------------------------------------
def top_pickup_zones(w: Warehouse, n: int = 10) -> DataFrame:
    per_zone = _by(w, "pu_location_key", "dim_location", "location_key", ["zone"], ["total_trips"])
    return _top(per_zone.withColumnRenamed("zone", "pickup_zone"), "total_trips", "pickup_zone", n)


def top_dropoff_zones(w: Warehouse, n: int = 10) -> DataFrame:
    per_zone = _by(w, "do_location_key", "dim_location", "location_key", ["zone"], ["total_revenue"])
    return _top(per_zone.withColumnRenamed("zone", "dropoff_zone"), "total_revenue", "dropoff_zone", n)


def routes(w: Warehouse) -> DataFrame:
    loc = w.dims["dim_location"]
    measures = ["total_trips", "total_revenue", "avg_trip_distance"]
    rolled = rollup(w.fact, ["pu_location_key", "do_location_key"], measures)
    rolled = dim_join(rolled, loc, "pu_location_key", "location_key", {"zone": "pickup_zone"})
    rolled = dim_join(rolled, loc, "do_location_key", "location_key", {"zone": "dropoff_zone"})
    attrs = ["pickup_zone", "dropoff_zone"]
    return reaggregate(rolled, attrs).select(*attrs, *[measure(m).alias(m) for m in measures])


# B11 ----------------------------------------------------------------------------------
@dataclass(frozen=True)
class FilterSet:
    """Dashboard filters; None means 'all'. Dates are inclusive ISO strings."""

    date_from: str | None = None
    date_to: str | None = None
    vendors: tuple[str, ...] | None = None
    payment_types: tuple[str, ...] | None = None
    rate_codes: tuple[str, ...] | None = None
    pickup_zones: tuple[str, ...] | None = None
    dropoff_zones: tuple[str, ...] | None = None
    passenger_groups: tuple[str, ...] | None = None
    dayparts: tuple[str, ...] | None = None
    months: tuple[str, ...] | None = None  # year-month labels, such as 1996-02
    weekdays: tuple[str, ...] | None = None
    weekend: bool | None = None


def filtered_fact(w: Warehouse, f: FilterSet) -> DataFrame:
    """Fact rows passing every active filter: each filter becomes a key set of its (small)
    dimension, semi-joined with the fact."""
    d = w.dims
    c = F.col
    rules = []
    if f.date_from or f.date_to:
        cond = F.lit(True)
        if f.date_from:
            cond = cond & (c("calendar_date") >= F.to_date(F.lit(f.date_from)))
        if f.date_to:
            cond = cond & (c("calendar_date") <= F.to_date(F.lit(f.date_to)))
        rules.append(("pickup_date_key", d["dim_date"].where(cond).select(c("date_key").alias("_k"))))
    dates = [(f.months, "year_month"), (f.weekdays, "day_of_week"), (None if f.weekend is None else (f.weekend,), "is_weekend")]
    for values, attr in dates:
        if values is not None:
            rules.append(("pickup_date_key", d["dim_date"].where(c(attr).isin(*values)).select(c("date_key").alias("_k"))))
    picks = [
        (f.vendors, "vendor_key", "dim_vendor", "vendor_key", "vendor_name"),
        (f.payment_types, "payment_type_key", "dim_payment_type", "payment_type_key", "payment_type_description"),
        (f.rate_codes, "rate_code_key", "dim_rate_code", "rate_code_key", "rate_code_description"),
        (f.pickup_zones, "pu_location_key", "dim_location", "location_key", "zone"),
        (f.dropoff_zones, "do_location_key", "dim_location", "location_key", "zone"),
        (f.passenger_groups, "passenger_count_key", "dim_passenger_count", "passenger_count_key", "passenger_group"),
        (f.dayparts, "pickup_time_key", "dim_time", "time_key", "daypart"),
    ]
    for values, fk, dim, key, attr in picks:
        if values is not None:
            rules.append((fk, d[dim].where(c(attr).isin(*values)).select(c(key).alias("_k"))))
    out = w.fact
    for fk, keys in rules:
        out = out.join(keys, out[fk] == keys["_k"], "left_semi")
    return out


def filtered_kpis_by_vendor(w: Warehouse, f: FilterSet) -> DataFrame:
    measures = ["total_trips", "total_revenue", "avg_revenue"]
    rolled = dim_join(rollup(filtered_fact(w, f), ["vendor_key"], measures), w.dims["dim_vendor"], "vendor_key",
                      "vendor_key", {"vendor_name": "vendor_name"})
    return reaggregate(rolled, ["vendor_name"]).select("vendor_name", *[measure(m).alias(m) for m in measures])


# B12 / B13 ----------------------------------------------------------------------------
def peak_days(w: Warehouse, n: int = 10) -> DataFrame:
    return _top(revenue_by_date(w), "total_trips", "calendar_date", n)


def store_and_forward(w: Warehouse) -> DataFrame:
    return _by(w, "trip_flags_key", "dim_trip_flags", "trip_flags_key", ["store_and_fwd_description"],
               ["total_trips", "total_revenue", "avg_revenue"])


def rate_code_revenue(w: Warehouse) -> DataFrame:
    return _by(w, "rate_code_key", "dim_rate_code", "rate_code_key", ["rate_code_description"],
               ["total_trips", "total_revenue", "avg_revenue"])


def passenger_groups(w: Warehouse) -> DataFrame:
    return _by(w, "passenger_count_key", "dim_passenger_count", "passenger_count_key", ["passenger_group"],
               ["total_trips", "total_passengers", "known_passengers", "avg_revenue", "avg_trip_distance", "total_tips",
                "tip_pct"])
