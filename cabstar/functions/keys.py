"""Derived trip columns and dimension smart keys, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_KEY = -1

# Fixed values of the warehouse contract: trip-quality thresholds.
LONG_TRIP_MINUTES = 240
HIGH_AMOUNT = 500


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def duration_minutes(pickup: str | Column, dropoff: str | Column) -> Column:
    """Whole-second trip duration in minutes: (unix(dropoff) - unix(pickup)) / 60.0."""
    return (F.unix_timestamp(_c(dropoff)) - F.unix_timestamp(_c(pickup))) / F.lit(60.0)


def date_key(date_col: str | Column) -> Column:
    """yyyyMMdd as INT, -1 when the date is NULL (integer arithmetic, no formatting)."""
    d = _c(date_col)
    key = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    return F.coalesce(key.cast("int"), F.lit(UNKNOWN_KEY))


def time_key(ts_col: str | Column) -> Column:
    """HHmmss as INT, -1 when the timestamp is NULL."""
    t = _c(ts_col)
    key = F.hour(t) * 10000 + F.minute(t) * 100 + F.second(t)
    return F.coalesce(key.cast("int"), F.lit(UNKNOWN_KEY))


def flag_key(flag_col: str | Column) -> Column:
    """store_and_fwd_flag: N -> 1, Y -> 2, anything else -> -1."""
    f = _c(flag_col)
    return F.when(f == "N", F.lit(1)).when(f == "Y", F.lit(2)).otherwise(F.lit(UNKNOWN_KEY))


def quality_key(distance: str | Column, minutes: str | Column, total: str | Column) -> Column:
    """First matching class: zero distance 2, longer than 4 h 3, over 500 4, else 1.

    A NULL duration falls through to the next test, so the key is never -1.
    """
    return (
        F.when(_c(distance) == 0, F.lit(2))
        .when(_c(minutes) > LONG_TRIP_MINUTES, F.lit(3))
        .when(_c(total) > HIGH_AMOUNT, F.lit(4))
        .otherwise(F.lit(1))
    )


def per_trip_tip_ratio(tip: str | Column, fare: str | Column) -> Column:
    """tip / fare when fare > 0, else 0.0 (the per-trip tip percentage)."""
    return F.when(_c(fare) > 0, _c(tip) / _c(fare)).otherwise(F.lit(0.0))


def surrogate_id(parts: list[Column]) -> Column:
    """SHA-256 hex of the '|'-joined text of ``parts``; a NULL part contributes ''."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def passenger_group(count_col: str | Column) -> Column:
    c = _c(count_col)
    return (
        F.when(c == 1, F.lit("Single"))
        .when(c.between(2, 4), F.lit("Small Group"))
        .when(c >= 5, F.lit("Large Group"))
        .otherwise(F.lit("Unknown"))
    )


def daypart(hour_col: str | Column) -> Column:
    h = _c(hour_col)
    return (
        F.when(h.between(5, 10), F.lit("Morning"))
        .when(h.between(11, 15), F.lit("Midday"))
        .when(h.between(16, 20), F.lit("Evening"))
        .otherwise(F.lit("Night"))
    )
