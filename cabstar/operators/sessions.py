"""Session windows of events: batch and stream, and events freed of copies as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstar.functions.money import exact_sum
from cabstar.operators.lineage import time_bucket

RANGE_SECONDS = 86400


def _micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def _numbered(df: DataFrame, keys: Sequence[str], start: str, last: str, gap: str) -> DataFrame:
    """Rows with ``_session``: it rises where nothing of the keys' earlier rows lies within ``gap``."""
    ordered = Window.partitionBy(*keys).orderBy(start, last)
    before = F.max(last).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = before.isNull() | (F.col(start) > before + F.expr(f"INTERVAL {gap}"))
    marked = df.withColumn("_begins", begins.cast("int"))
    return marked.withColumn("_session", F.sum("_begins").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))


def sessions(
    events: DataFrame, gap: str = "30 minutes", user: str = "user_id", ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Sessions of each user: ``session_start``, ``last_event``, ``n_events``, ``total_value``.

    An event at most ``gap`` after its user's previous one belongs to the same session.
    Events without user or time belong to none; repeated events count each time. A user's
    events are first brought into sessions by day, so a hot user is many tasks; sessions
    that go on over midnight are then joined from these.
    """
    rows = events.dropna(subset=[user, ts]).select(user, ts, value, time_bucket(ts, RANGE_SECONDS).alias("_range"))
    # sums as exact decimals, so that parts add up to the same total
    amount = F.col(value).try_cast("decimal(28,10)").alias("_value")
    days = _numbered(rows.select(user, "_range", F.col(ts).alias("_a"), F.col(ts).alias("_z"), amount), [user, "_range"], "_a", "_z", gap)
    ends = [F.min("_a").alias("_a"), F.max("_z").alias("_z")]
    days = days.groupBy(user, "_range", "_session").agg(*ends, F.count("*").alias("_n"), F.sum("_value").alias("_value"))
    whole = _numbered(days.drop("_session"), [user], "_a", "_z", gap)
    whole = whole.groupBy(user, "_session").agg(*ends, F.sum("_n").alias("_n"), F.sum("_value").alias("_value"))
    return whole.select(
        user,
        F.col("_a").alias("session_start"),
        F.col("_z").alias("last_event"),
        F.col("_n").alias("n_events"),
        F.col("_value").cast("double").alias("total_value"),
    )


def streamed_sessions(
    events: DataFrame, gap: str = "30 minutes", late: str = "1 hour", user: str = "user_id", ts: str = "ts", value: str = "value"
) -> DataFrame:
    """The same sessions of a stream, given out (append mode) once the watermark has passed their end.

    State holds a user's open sessions alone. Events more than ``late`` behind the latest time
    seen are left out; all others get into their session in whatever order they arrive.
    """
    known = events.dropna(subset=[user, ts]).withWatermark(ts, late)
    # a window ends with its last event plus the gap, which still belongs to it
    window = F.session_window(ts, gap)
    found = known.groupBy(user, window.alias("_w")).agg(
        F.min(ts).alias("session_start"),
        F.max(ts).alias("last_event"),
        F.count("*").alias("n_events"),
        exact_sum(value).alias("total_value"),
    )
    return found.select(user, "session_start", "last_event", "n_events", "total_value")


def first_arrivals(events: DataFrame, late: str = "1 hour", key: str = "event_id", ts: str = "ts") -> DataFrame:
    """A stream's events without further copies of a key, keeping keys no longer than ``late``.

    A copy that comes within ``late`` of event time is left out. Events behind the watermark
    don't get here; their number is in the progress reports (``late_events``).
    """
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def late_events(query) -> int:
    """How many events the stateful operators of a finished query dropped as late."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
