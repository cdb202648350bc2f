"""Row numbers within a lineage group (e.g. per source file), without a single-task sort.

``row_number() OVER (PARTITION BY file ORDER BY ...)`` sends each file to one task: a
file holding a third of the data is sorted by one core. Here rows are numbered within
(file, bucket), where a bucket is a range of the first sort key (an hour of pickup
times), and the rows of the file's earlier buckets are added:

    row number = rows of the same file in earlier buckets + number within the bucket

The counts come from a small (file, bucket) aggregate, joined on the same two keys the
window is partitioned by, so the rows are shuffled once, and not at all if they come placed
by ``places``. It is a left join on unique keys: where nobody asks for the numbers, the
optimizer drops it with the window. Nothing is written or run while the plan is built, and
the numbers don't depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a bucket of pickup times. Make it smaller if an hour of one file is hot.
BUCKET_SECONDS = 3600


def time_bucket(ts: str | Column, seconds: int = BUCKET_SECONDS) -> Column:
    """Bucket number of a timestamp; grows with it."""
    return F.floor(F.unix_timestamp(ts) / seconds)


def places(group_col: str, bucket: Column) -> dict[str, Column]:
    """The columns that rows are numbered by, without NULLs, so that window and join share one partitioning."""
    return {
        "_group": F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")),
        "_bucket": F.coalesce(bucket.cast("bigint"), F.lit(-(1 << 62))),
    }


def number_within(
    df: DataFrame, group_col: str, order_cols: list[str], bucket: Column, out_col: str = "row_number"
) -> DataFrame:
    """Append ``out_col`` (INT) = row_number() over (partition by group_col order by order_cols).

    Ordering is ascending with NULLs first, as in Spark's window default. ``bucket`` must be
    NULL where the first order column is, and never fall where that column rises. Rows that
    hold the columns of ``places`` already keep them.
    """
    by = places(group_col, bucket)
    keyed = df.withColumns({name: column for name, column in by.items() if name not in df.columns})
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    numbered = keyed.withColumn("_n", F.row_number().over(Window.partitionBy("_group", "_bucket").orderBy(*order)))
    earlier = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    counts = counts.withColumn("_before", F.sum("_rows").over(earlier))
    counts = counts.groupBy("_group", "_bucket").agg(F.max("_before").alias("_before"))  # tells the optimizer: unique
    joined = numbered.join(counts, ["_group", "_bucket"], "left")
    number = (F.coalesce("_before", F.lit(0)) + F.col("_n")).cast("int")
    return joined.withColumn(out_col, number).select(*(c for c in df.columns if c not in by), out_col)
