"""Joins of intervals that share a moment, as equi-joins on time buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.operators.lineage import time_bucket

#: Width of a bucket; most intervals should fall into one or two.
BUCKET_SECONDS = 3 * 3600

#: Intervals for a task that pairs them, and the most tasks that ``pair_tasks`` asks for.
TASK_ROWS, MAX_TASKS = 6_000, 20_000


def pair_tasks(rows: int) -> int:
    """Tasks for an ``overlap_join`` of so many intervals whose pairs are written.

    A task reads few rows and writes each of them in many pairs. Parquet keeps the distinct
    values of a column in a dictionary of 1 MB a row group, 15,000 ids of 64 characters, and
    beyond that writes every value out. Tasks of ``TASK_ROWS`` intervals stay below it with
    their copies in further buckets, so that a pair holds places in dictionaries, not ids.
    """
    return min(MAX_TASKS, max(1, -(-rows // TASK_ROWS)))


def _spread(df: DataFrame, keys: Sequence[str], start: str, end: str, seconds: int, side: str) -> DataFrame:
    """A row for each bucket that an interval touches; all columns as one struct."""
    first, last = time_bucket(F.col(f"`{start}`"), seconds), time_bucket(F.col(f"`{end}`"), seconds)
    valid = df.where(F.col(f"`{start}`") <= F.col(f"`{end}`")).dropna(subset=list(keys))
    return valid.select(
        *(F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keys)),
        F.explode(F.sequence(first, last)).alias("_bucket"),
        first.alias(f"_first_{side}"),
        F.col(f"`{start}`").alias(f"_start_{side}"),
        F.col(f"`{end}`").alias(f"_end_{side}"),
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(side),
    )


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    bucket_seconds: int = BUCKET_SECONDS,
    tasks: int | None = None,
) -> DataFrame:
    """Pairs of rows of equal keys whose closed time intervals share a moment.

    Returns the keys as ``key0``, ``key1`` ..., the structs ``left`` and ``right`` and
    ``overlap_seconds`` (0 where they only touch). An interval is copied to every bucket it touches and meets others there; the pair
    is given out in the one bucket in which the later of the two begins, so it comes once and
    nothing has to be made distinct. A hot key is spread over its buckets. Rows with a null
    key, start or end, and those that end before they start, meet nothing; repeated rows pair
    each time.

    No condition is about one side alone, so a frame joined with itself is shuffled once and
    read twice, as long as the caller takes the same columns of ``left`` and ``right``.

    ``tasks`` deals the buckets to so many tasks (see ``pair_tasks``); by default Spark sizes
    them by what they read, which says nothing of the pairs they make. Tasks dealt by number
    are not split by Spark's skew join; that would begin at 256 MB a task (by default), some three
    million intervals in one bucket of one key. Choose narrower buckets for such a key.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    a = _spread(left, [k for k, _ in keys], *left_range, bucket_seconds, "left")
    b = _spread(right, [k for _, k in keys], *right_range, bucket_seconds, "right")
    if tasks:
        a, b = (side.repartition(tasks, *names, "_bucket") for side in (a, b))
    meet = a.join(b, [*names, "_bucket"]).where(
        (F.col("_bucket") == F.greatest("_first_left", "_first_right"))
        & (F.col("_start_left") <= F.col("_end_right"))
        & (F.col("_start_right") <= F.col("_end_left"))
    )
    begin, end = F.greatest("_start_left", "_start_right"), F.least("_end_left", "_end_right")
    seconds = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(begin.cast("timestamp"))) / 1_000_000
    keyed = (F.col(name).alias(f"key{i}") for i, name in enumerate(names))
    return meet.select(*keyed, "left", "right", F.floor(seconds).cast("long").alias("overlap_seconds"))
