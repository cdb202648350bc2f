"""Spelling variant grouping by dense prefix-suffix tiles.

Two words are near if they are one inserted, deleted or replaced code point apart. That is
so exactly if their lengths differ by one at most and their common prefix and common suffix
together reach the longer length minus one. Words are rows of padded code-point matrices;
a tile compares two blocks of rows at once, forwards and (on reversed words) backwards.

Only blocks that can hold near words meet. With ``t`` the longer length minus one and ``a``
a third of it, the common prefix p of near words decides which part they surely share: the
first ``t - a`` code points (p >= t - a), the last ``t - a`` (p <= a), or the first and last
``a + 1`` (between). Words that share such a part lie side by side, so one tile spans many
small groups; a group beyond ``GROUP_WORDS`` is split into parts of which every two meet in
a tile of their own, on any executor. Each near pair is found in just one group.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.llm.common import operator, stored

#: A-Z lower-cased; bytes of other characters stay.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Different words of a task that are counted before they are passed on, and rows at a time.
HELD_WORDS, _ROWS = 300_000, 1000
#: Words of a group that meet in one tile unit, rows of a block, and code points a tile compares at once.
GROUP_WORDS, BLOCK_WORDS, TILE_POINTS = 1024, 64, 1 << 20
#: Near pairs that travel together.
PAIRS = 10_000
#: Kinds of groups, by what their words share.
HEAD, TAIL, ENDS = range(3)


@operator
def word_counts(
    docs: DataFrame,
    least_length: int = 5,
    least_count: int = 3,
    noise: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word`` and ``n`` of the runs of Latin letters in whole texts, A-Z lower-cased.

    Words have ``least_length`` code points or more and come ``least_count`` times or more
    in all texts. With ``noise`` a run loses one code point where the crc32 of
    ``<id>:<run>`` is a multiple of it (a null id is written as nothing). Null and empty
    texts have no words; repeated rows count each time.
    """
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def row(held: Counter, doc, text) -> None:
        plain = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
        start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
        for run, n in Counter(pattern.findall(plain)).items():
            if noise and not (h := zlib.crc32(run.encode(), start)) % noise:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            held[run] += n

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], schema=schema)
        for whole in batches:
            for first in range(0, whole.num_rows, _ROWS):
                for doc, text in zip(*(c.to_pylist() for c in whole.slice(first, _ROWS).columns), strict=True):
                    if text:
                        row(held, doc, text)
                if len(held) >= HELD_WORDS:
                    yield out()
                    held = Counter()
        if held:
            yield out()
        pa.default_memory_pool().release_unused()

    found = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(counts, "word string, n long")
    found = found.where(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least_count)


def _shared(words: DataFrame) -> DataFrame:
    """Each word under the parts that it may share with near words: ``m`` (longer length), ``kind``, ``key``."""
    at = words.withColumn("m", F.explode(F.array(F.length("word"), F.length("word") + 1)))
    t, word = F.col("m") - 1, F.col("word")
    a = F.floor(t / 3).cast("int")
    parts = {
        HEAD: F.substring(word, F.lit(1), t - a),
        TAIL: F.right(word, t - a),
        ENDS: F.concat(F.substring(word, F.lit(1), a + 1), F.right(word, a + 1)),
    }
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.xxhash64(part).alias("key")) for k, part in parts.items()))
    return at.withColumn("_k", F.explode(kinds)).select("m", "_k.kind", "_k.key", "word", "n")


def _points(words: list[str]) -> np.ndarray:
    """Code points, a row a word, padded with zeros."""
    return np.array(words).view(np.uint32).reshape(len(words), -1)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of ``a`` with each of ``b``; full width if equal."""
    same = np.ones((len(a), len(b)), bool)
    length = np.zeros(same.shape, np.int32)
    for x, y in zip(a.T, b.T, strict=True):
        same &= x[:, None] == y[None, :]
        length += same
        if not same.any():
            break
    return length


class Unit:
    """Rows of one tile unit or of several small ones, in order: words, lengths, groups and parts."""

    def __init__(self, columns: list):
        self.m, self.kind, self.group, self.part, self.own = columns[:5]
        self.word = columns[5]
        self.length = np.fromiter(map(len, self.word), np.int64, len(self.word))

    def blocks(self) -> list[slice]:
        """Runs of rows whose matrices stay small, however long a word is."""
        found, first = [], 0
        while first < len(self.word):
            width = self.length[first : first + BLOCK_WORDS].max()
            size = min(BLOCK_WORDS, max(1, isqrt(TILE_POINTS // int(width))))
            found.append(slice(first, first + size))
            first += size
        return found

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of near words of one group, each pair once."""
        found = []
        blocks = self.blocks()
        for i, x in enumerate(blocks):
            for y in blocks[i:]:
                if self.group[y.start] > self.group[min(x.stop, len(self.word)) - 1]:
                    break
                found += [np.stack(self.tile(x, y))]
        return tuple(np.concatenate(found, axis=1)) if found else (np.empty(0, int),) * 2

    def tile(self, x: slice, y: slice) -> tuple[np.ndarray, np.ndarray]:
        words = self.word[x] + self.word[y]
        size, forwards, backwards = len(self.word[x]), _points(words), _points([w[::-1] for w in words])
        head, tail = (_common(p[:size], p[size:]) for p in (forwards, backwards))
        of = lambda v: (v[x][:, None], v[y][None, :])
        (la, lb), (ga, gb), (oa, ob) = of(self.length), of(self.group), of(self.own)
        longer, m = np.maximum(la, lb), self.m[x][:, None]
        t, third = longer - 1, (longer - 1) // 3
        kind = np.where(head >= t - third, HEAD, np.where(head <= third, TAIL, ENDS))
        near = (abs(la - lb) <= 1) & (head + tail >= t) & (head < longer) & (ga == gb)
        near &= (longer == m) & (kind == self.kind[x][:, None])
        near &= (self.part[x][:, None] == 0) | (oa != ob)  # parts of a split group meet with others
        if x == y:
            near &= np.tri(size, k=-1, dtype=bool).T
        a, b = near.nonzero()
        return a + x.start, b + y.start


@operator
def near_words(words: DataFrame) -> DataFrame:
    """All pairs of near words, in both directions: ``word``, ``n``, ``near``, ``near_n``.

    ``words`` holds different words with their counts ``n``; null and empty ones are near
    nothing. Words may be of any length.
    """
    shared = _shared(words.select("word", F.col("n").cast("long").alias("n")).where("length(word) > 0"))
    key = ["m", "kind", "key"]
    large = shared.groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > GROUP_WORDS)
    large = stored(large.withColumn("parts", F.ceil(F.col("size") / GROUP_WORDS).cast("int")).drop("size"), "spelling-groups")
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64(F.lit(1), "word"), parts).cast("int")
    units = shared.join(large, key, "left").withColumn("own", own)
    units = units.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    part = F.when(F.col("own") == F.col("other"), 0).otherwise(1)
    units = units.select(
        *key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), part.alias("part"), "own", "word", "n"
    )
    unit = [*key, "i", "j"]
    units = units.repartition(*unit).sortWithinPartitions(*unit, "own", "word")

    def found(table: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Near pairs of the whole units of ``table``; ``group`` numbers them from 0."""
        column = lambda c: table.column(c).to_numpy()
        rows = [column("m"), column("kind"), group, column("part"), column("own"), table.column("word").to_pylist()]
        ends = np.flatnonzero(np.diff(group, append=-1)) + 1
        first, held = 0, []
        for k, end in enumerate(ends):
            if k + 1 < len(ends) and ends[k + 1] - first <= BLOCK_WORDS:
                continue  # as many whole units as fill a block
            if end - first > 1:
                held += [np.stack(Unit([c[first:end] for c in rows]).near()) + first]
            first = end
            if held and (k + 1 == len(ends) or sum(x.shape[1] for x in held) >= PAIRS):
                a, b = np.concatenate(held, axis=1)
                u, v = (table.take(pa.array(np.concatenate(x))) for x in ((a, b), (b, a)))
                columns = [x.column(c) for x in (u, v) for c in ("word", "n")]
                yield from pa.table(columns, names=["word", "n", "near", "near_n"]).to_batches()
                held = []

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            rest = new if rest is None else pa.concat_tables([rest, new]).combine_chunks()
            starts = np.any([np.diff(rest.column(c).to_numpy()) != 0 for c in unit], axis=0)
            if starts.any():  # the last unit may go on in the next batch
                group = np.concatenate([[0], np.cumsum(starts)])
                last = int(np.flatnonzero(starts)[-1]) + 1
                yield from found(rest.slice(0, last), group[:last])
                rest = rest.slice(last)
        if rest is not None and rest.num_rows:
            yield from found(rest, np.zeros(rest.num_rows, int))
        pa.default_memory_pool().release_unused()

    return units.mapInArrow(pairs, "word string, n long, near string, near_n long")


def spelling_forms(words: DataFrame, times: int = 2) -> DataFrame:
    """Each word with its near words' number, its form and its root.

    The form is the near word of largest count (ties: smallest in code-point order) if that
    is ``times`` the word's own count or more, else null; ``form_n`` is its count. The root
    is the last word on the way from form to form, the word itself without one. Counts grow
    along that way, so it ends; it is followed by doubling, in rounds that grow with the
    logarithm of its length. An empty table gives no rows.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent as the word")
    near = near_words(words)
    alone = words.select("word", F.col("n").cast("long").alias("n"))
    both = near.unionByName(alone.withColumns({"near": F.lit(None).cast("string"), "near_n": F.lit(None).cast("long")}))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
    found = both.groupBy("word", "n").agg(F.count("near").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= times * F.col("n")
    form, form_n = F.when(is_form, F.col("best.near")), F.when(is_form, -F.col("best.less"))
    found = stored(found.select("word", "n", "n_near", form.alias("form"), form_n.alias("form_n")), "spelling-forms")

    steps = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        to = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = stored(steps.join(to, "root", "left").select("word", "root", "further"), "spelling-roots")
        if ahead.where("further is not null").isEmpty():
            break
        steps = ahead.select("word", F.coalesce("further", "root").alias("root"))
    roots = ahead.select("word", "root")
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
