"""Sharding by a two-pass external shuffle, in built-in functions only.

Pass one scatters whole records into buckets that fit in memory, by seeded hashes, through
Spark's shuffle files. Pass two brings each bucket into a random order (``shuffle`` is a
Fisher-Yates shuffle of an array) and writes it. The buckets one after the other are one
random order of all records, and shards are equal runs of it: their row counts are at most
one apart. Copies of a record hash alike, so they are counted first and scattered by their
number; a record that holds a third of the table doesn't fill a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from cabstar.llm.common import stored

SEED = 11
#: Bytes of text in a bucket, on average, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 32 << 20, 64
#: Copies of one record that a task makes at a time.
COPIES = 4096
#: So many buckets' starts (16 bytes each) are broadcast; the optimizer decides beyond that.
SENT_BUCKETS = 1 << 20


def record_size(text: Column) -> Column:
    """UTF-8 bytes of a text and 1 for its end; null is empty."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def _copies(groups: DataFrame) -> DataFrame:
    """A row with its number ``copy`` (from 0) for each of the ``n`` copies; many copies are made by many tasks."""
    parts = F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))
    groups = groups.withColumn("part", F.explode(parts)).repartition("h1", "h2", "part")
    first = F.col("part") * COPIES
    return groups.withColumn("copy", F.explode(F.sequence(first, F.least(first + COPIES, F.col("n")) - 1))).drop("n", "part")


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 8,
    seed: int = SEED,
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write all records in random order as Parquet files under ``shard=<number>``.

    A file row has ``record`` (a struct of all columns, so that no name can clash) and
    ``slot``, its place in the shard from 0; each file is in slot order. Every row is
    written, repeated ones as often as they come; null and empty texts are records like
    others. One seed gives the same order for the same rows and number of buckets,
    however the input is divided. An empty table gives no files.
    """
    spark = docs.sparkSession
    record = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(record.alias("record"), record_size(F.col(f"`{text_col}`")).alias("size"))
    hashes = [F.xxhash64(F.lit(seed + i), "record").alias(f"h{i}") for i in (1, 2)]
    tags = stored(rows.select(*hashes, "size"), "shard-tags")
    total, size = tags.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(LEAST_BUCKETS, -(-size // bucket_bytes))

    repeated = tags.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    repeated = stored(repeated, "shard-copies")
    key, copies = ["h1", "h2"], not repeated.isEmpty()
    bucket = F.pmod(F.xxhash64("h1", "h2", "copy"), F.lit(buckets)).cast("int").alias("bucket")

    def scattered(df: DataFrame, *more: str) -> DataFrame:
        """Each row of ``df`` with its bucket; of repeated rows one is kept and copied."""
        once = df.withColumn("copy", F.lit(0).cast("long"))
        if copies:
            again = df.join(repeated, key, "left_semi").groupBy(*key)
            again = again.agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in more))
            once = once.join(repeated, key, "left_anti").unionByName(_copies(again))
        return once.select(bucket, "h1", "copy", *more)

    counts = scattered(tags.select(*key)).groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    starts = stored(starts, "shard-starts")

    dealt = scattered(rows.select(*hashes, "record"), "record").repartitionById(buckets, F.col("bucket"))
    piles = dealt.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("h1", "copy", "record"))).alias("pile"))
    piles = piles.select("bucket", F.shuffle("pile", seed).alias("pile"))
    piles = piles.join(F.broadcast(starts) if buckets <= SENT_BUCKETS else starts, "bucket")
    mixed = piles.select("start", F.posexplode("pile").alias("place", "row"))
    mixed = mixed.select((F.col("start") + F.col("place")).alias("p"), "row.record")
    mixed = mixed.withColumn("shard", F.expr(f"cast(p * {shards} div {max(total, 1)} as int)"))
    slot = F.expr(f"p - (shard * {total} + {shards - 1}) div {shards}").alias("slot")
    mixed = mixed.select("shard", slot, "record").sortWithinPartitions("shard", "slot")
    mixed.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The files' rows: ``record`` (of the written schema), ``slot`` and ``shard``."""
    fields = [StructField("record", schema), StructField("slot", LongType()), StructField("shard", IntegerType())]
    return spark.read.schema(StructType(fields)).parquet(path)
