"""As-of joins and running totals along a key's time line, without one task a key.

A plain window over a key sorts all its rows in one task. Here a time line is cut into
ranges of ``range_seconds``; rows are shuffled by (key, range), so a key that holds a third
of the table is spread over its ranges. What a range takes over from earlier ones (the last
row, the total so far) comes from an aggregate with a row for each (key, range), joined on
the same two columns the window is partitioned by: the rows themselves move once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstar.functions.money import EXACT
from cabstar.operators.lineage import time_bucket

#: A day: narrow enough that one key's rows of a range fit in a task.
RANGE_SECONDS = 86400
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def _keys(keys: Sequence[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    take: Mapping[str, str],
    ties: Sequence[str] = (),
    range_seconds: int = RANGE_SECONDS,
) -> DataFrame:
    """Every left row with the latest right row of equal keys at or before its time.

    ``keys`` are pairs of a left and a right column, ``take`` gives names to right columns. Of
    right rows at one time the one with the largest ``ties`` counts, then with the largest
    values taken (nulls are smallest). A left row with a null key or time, or without an
    earlier right row, gets nulls; right rows with a null key or time match nothing. Both
    sides are united and sorted within ranges; each range that begins without a right row
    takes over the last one of the earlier ranges.
    """
    names = _keys(keys)
    order = ["_t", "_side", *(f"_o{i}" for i in range(len(ties))), "_r"]
    value = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(take.values())))
    rows = right.select(
        *(F.col(f"`{r}`").alias(k) for k, (_, r) in zip(names, keys, strict=True)),
        F.col(f"`{right_time}`").alias("_t"),
        F.lit(0).alias("_side"),
        *(F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(ties)),
        value.alias("_r"),
        F.lit(None).cast(left.schema).alias("_l"),
    ).dropna(subset=[*names, "_t"])
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema.fields if f.name.startswith("_o") or f.name == "_r"}
    asked = left.select(
        *(F.col(f"`{c}`").alias(k) for k, (c, _) in zip(names, keys, strict=True)),
        F.col(f"`{left_time}`").alias("_t"),
        F.lit(1).alias("_side"),
        F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("_l"),
    ).withColumns(nothing)
    both = rows.unionByName(asked).withColumn("_range", time_bucket("_t", range_seconds))

    at = [*names, "_range"]
    ordered = Window.partitionBy(*at).orderBy(*(F.col(c).asc_nulls_first() for c in order)).rowsBetween(*_UP_TO)
    within = both.withColumn("_own", F.last("_r", ignorenulls=True).over(ordered)).where("_side = 1")
    # the last right row of each range, then of all ranges before it
    ends = both.groupBy(*at).agg(F.max(F.when(F.col("_side") == 0, F.struct(*order))).alias("_last"))
    earlier = Window.partitionBy(*names).orderBy("_range").rowsBetween(*_BEFORE)
    carried = ends.withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier)["_r"]).drop("_last")
    carried = carried.where(F.col("_carry").isNotNull())
    found = within.join(carried, at, "left").withColumn("_own", F.coalesce("_own", "_carry"))
    taken = [F.col(f"_own.c{i}").alias(name) for i, name in enumerate(take)]
    return found.select(*(F.col("_l")[c].alias(c) for c in left.columns), *taken)


def running_totals(
    df: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str],
    totals: Mapping[str, str],
    count: str = "running_rows",
    gap: str = "gap_seconds",
    range_seconds: int = RANGE_SECONDS,
) -> DataFrame:
    """Append running sums, the running count and the seconds since the key's previous row.

    Rows of a key are in order of ``time`` and then ``ties`` (nulls first), which must tell
    rows apart for repeatable results. ``totals`` names the running sum of each column, an
    exact decimal sum returned as DOUBLE (null until there is a value). The gap is null for a
    key's first row and where either time is null. A null key is a key like others.
    """
    at = ["_key", "_range"]
    rows = df.withColumns({"_key": F.struct(F.col(f"`{key}`").alias("key")), "_range": time_bucket(time, range_seconds)})
    rows = rows.withColumn("_range", F.coalesce("_range", F.lit(-(1 << 62))))  # null times come first
    ordered = Window.partitionBy(*at).orderBy(*(F.col(f"`{c}`").asc_nulls_first() for c in (time, *ties)))
    up_to, seconds = ordered.rowsBetween(*_UP_TO), lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    exact = {name: F.col(f"`{c}`").try_cast(EXACT) for name, c in totals.items()}
    own: dict[str, Column] = {f"_s_{name}": F.sum(x).over(up_to) for name, x in exact.items()}
    own |= {"_n": F.row_number().over(ordered), "_prev": F.lag(seconds(time)).over(ordered)}
    within = rows.withColumns(own)

    sums = [F.sum(x).alias(f"_b_{name}") for name, x in exact.items()]
    parts = rows.groupBy(*at).agg(F.count("*").alias("_rows"), F.max(seconds(time)).alias("_end"), *sums)
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(*_BEFORE)
    carried = {f"_b_{name}": F.sum(f"_b_{name}").over(earlier) for name in totals}
    carried |= {"_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)), "_end": F.last("_end").over(earlier)}
    joined = within.join(parts.withColumns(carried).drop("_rows"), at)

    def total(name: str) -> Column:
        before, here = F.col(f"_b_{name}"), F.col(f"_s_{name}")
        both = F.coalesce(before, F.lit(0)).cast(EXACT) + F.coalesce(here, F.lit(0)).cast(EXACT)
        return F.when(before.isNotNull() | here.isNotNull(), both).cast("double").alias(name)

    previous = F.when(F.col("_n") == 1, F.col("_end")).otherwise(F.col("_prev"))
    return joined.select(
        *(F.col(f"`{c}`") for c in df.columns),
        *map(total, totals),
        (F.col("_before") + F.col("_n")).cast("long").alias(count),
        F.floor((seconds(time) - previous) / 1_000_000).cast("long").alias(gap),
    )
