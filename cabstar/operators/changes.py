"""What differs between two tables: change sets by key, and bags with multiplicities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits in the map of hashes that differ: 16 MB of longs at the most, whatever the tables' size.
FILTER_WORDS = 1 << 20


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def change_set(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ: keys, ``change``, ``n_old``, ``n_new``, ``changed_columns``.

    ``change`` is inserted, deleted or changed; ``changed_columns`` are, comma-joined in the
    old table's order, the columns whose smallest or largest value under the key differs
    (empty for inserted and deleted keys). Null keys are keys like others. A key may come
    several times; it is unchanged if both sides hold the same rows equally often. Both tables
    must have the same columns.

    First rows are compared by digest: only 64-bit hashes of keys, counts and sums of digests are
    shuffled, combined on the map side, so a hot key costs a row a task. The hashes that differ
    set bits of one map of ``FILTER_WORDS`` words at most, which every task gets; only rows whose
    bit is set travel, and their keys are compared once more by themselves, so keys that share a
    bit or a hash with one that differs do no harm.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("the tables have different columns")
    columns = [c for c in old.columns if c not in keys]
    key = [F.col(f"`{c}`") for c in keys]
    digest = F.xxhash64(*(F.col(f"`{c}`") for c in old.columns))

    def compared(df: DataFrame, is_old: int) -> DataFrame:
        sign = 1 if is_old else -1
        return df.withColumns({
            "_hash": F.xxhash64(*key),
            "_old": F.lit(is_old),
            "_high": F.shiftright(digest, 32) * sign,
            "_low": digest.bitwiseAND(F.lit(0xFFFFFFFF)) * sign,
        })

    both = compared(old, 1).unionByName(compared(new, 0))
    sums = [F.sum("_old").alias("n_old"), F.sum(1 - F.col("_old")).alias("n_new"), F.sum("_high").alias("_high"), F.sum("_low").alias("_low")]
    unequal = "n_old <> n_new or _high <> 0 or _low <> 0"

    word, bit = F.pmod(F.shiftright("_hash", 6), F.lit(FILTER_WORDS)), F.expr("shiftleft(1L, cast(_hash & 63 as int))")
    differ = both.groupBy("_hash").agg(*sums).where(unequal)
    words = differ.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    rows = both.withColumn("_word", word).join(F.broadcast(words), "_word").where(F.col("_bits").bitwiseAND(bit) != 0)

    ends = []
    for i, c in enumerate(columns):
        for side, is_old in (("o", 1), ("n", 0)):
            value = F.when(F.col("_old") == is_old, F.col(f"`{c}`"))
            ends += [F.min(value).alias(f"_min_{side}{i}"), F.max(value).alias(f"_max_{side}{i}")]
    found = rows.groupBy(*(c.alias(f"_k{i}") for i, c in enumerate(key))).agg(*sums, *ends).where(unequal)
    changed = [
        F.when(~(_same(F.col(f"_min_o{i}"), F.col(f"_min_n{i}")) & _same(F.col(f"_max_o{i}"), F.col(f"_max_n{i}"))), F.lit(c))
        for i, c in enumerate(columns)
    ]
    change = F.when(F.col("n_old") == 0, "inserted").when(F.col("n_new") == 0, "deleted").otherwise("changed")
    return found.select(
        *(F.col(f"_k{i}").alias(c) for i, c in enumerate(keys)),
        change.alias("change"),
        "n_old",
        "n_new",
        F.when(change == "changed", F.concat_ws(",", *changed)).otherwise("").alias("changed_columns"),
    )


def bag_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each different row of either table with ``n_left`` and ``n_right``, how often it stands there.

    Columns go by name; nulls equal each other. One aggregation of signed counts, combined
    on the map side: no sort of either table and no join, and copies of a hot row cost a row
    a task.
    """
    columns = [F.col(f"`{c}`") for c in left.columns]
    a = left.select(*columns, F.lit(1).alias("_left"))
    b = right.select(*columns, F.lit(0).alias("_left"))
    counted = a.unionAll(b).groupBy(*columns)
    return counted.agg(F.sum("_left").alias("n_left"), F.sum(1 - F.col("_left")).alias("n_right"))


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that ``left`` holds oftener than ``right``, with ``n``, by how much."""
    counts = bag_counts(left, right).where("n_left > n_right")
    return counts.select(*(F.col(f"`{c}`") for c in left.columns), (F.col("n_left") - F.col("n_right")).alias("n"))


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that both hold, with ``n``, how often at least."""
    counts = bag_counts(left, right).where("n_left > 0 and n_right > 0")
    return counts.select(*(F.col(f"`{c}`") for c in left.columns), F.least("n_left", "n_right").alias("n"))
