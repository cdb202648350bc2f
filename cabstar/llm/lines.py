"""Line dedup by a deletion-neighbourhood join.

Lines are compared by their words (ASCII letters, digits and all other characters beyond
ASCII; A-Z lower-cased). The edit bound is one word inserted, deleted or replaced, in a
pair whose longer line has ``fuzzy_words`` or more; shorter lines must be equal. A line's
variants within the bound are the line itself and the line without each one of its words,
as hashed keys:

* two lines without their i-th word are equal: they differ in that word at most;
* a line equals another one without one of its words: that word was inserted.

Two lines within the bound share the first or the last half of their words, so only lines
with such a partner emit variants; that leaves nothing out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.llm.common import Memo, map_rows, operator, stored, words_of
from cabstar.sources.sinks import scratch_scope

#: Lines of fewer words than asked are short headings only below so many bytes (five Chinese or Japanese characters).
SHORT_BYTES = 16
#: A line with more than one in so many of all lines is hot; no more than so many lines can be.
HOT_KEYS = 10_000

_M = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_M, -1, 1 << 64))
_word = Memo(lambda w: xxhash.xxh3_64_intdigest(w))
_powers = [np.ones(1, np.uint64)]


def _signed(x: int) -> int:
    return x - (1 << 63)


def _hash(words: list[bytes], seed: int = 0) -> int:
    return _signed(xxhash.xxh3_64_intdigest(b" ".join(words), seed=seed))


def _power(n: int) -> np.ndarray:
    """_M ** k for k below n, modulo 2 ** 64."""
    while len(_powers[0]) < n:
        old = _powers[0]
        _powers[0] = np.concatenate([old, old * old[-1] * np.uint64(_M)])
    return _powers[0][:n]


def half_keys(words: list[bytes]) -> set[int]:
    """Keys of the halves that a line can share with one of its own length or one word more or less."""
    n = len(words)
    halves = {n // 2, (n + 1) // 2}
    return {_hash(words[:h], 1) for h in halves} | {_hash(words[n - h :], 2) for h in halves}


def variants(words: list[bytes]) -> np.ndarray:
    """Keys of the line without its i-th word for each i, and at last of the line itself."""
    n = len(words)
    h = np.fromiter(map(_word.__getitem__, words), np.uint64, n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _power(n), dtype=np.uint64)])
    keys = np.append(sums[:-1] + (sums[-1] - sums[1:]) * _INVERSE, sums[-1])
    lengths = np.full(n + 1, n - 1, np.uint64)
    lengths[-1] = n
    keys = (keys ^ keys >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93) + lengths * np.uint64(_M)
    return (keys ^ keys >> np.uint64(32)).view(np.int64)


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one word inserted, deleted or replaced turns one line into the other."""
    if abs(len(a) - len(b)) > 1:
        return False
    p, n = 0, min(len(a), len(b))
    while p < n and a[p] == b[p]:
        p += 1
    s = 0
    while s < n - p and a[-1 - s] == b[-1 - s]:
        s += 1
    return max(len(a), len(b)) - p - s <= 1


def _pack(text: str | None) -> bytes | None:
    return None if text is None else zstandard.compress(text.encode("utf-8", "surrogatepass"), 3)


def _unpack(packed: bytes | None) -> str | None:
    return None if packed is None else zstandard.decompress(packed).decode("utf-8", "surrogatepass")


def _lines(docs: DataFrame, least: int, fuzzy: int) -> DataFrame:
    """id, h, line (number), key, halves, short of every line that has a word.

    ``short`` lines are those of fewer than ``least`` words and ``SHORT_BYTES`` bytes.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, number, key, halves, short = [], [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for k, line in enumerate(text.split("\n") if text else ()):
                    words = words_of(line)
                    if words:
                        at.append(i)
                        number.append(k)
                        key.append(_hash(words))
                        short.append(len(words) < least and sum(map(len, words)) < SHORT_BYTES)
                        halves.append(list(half_keys(words)) if len(words) >= max(least, fuzzy - 1) else [])
            at = pa.array(at, pa.int64())
            made = [pa.array(number, pa.int32()), pa.array(key, pa.int64()), pa.array(halves, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *made, pa.array(short, pa.bool_())],
                names=["id", "h", "line", "key", "halves", "short"],
            )

    schema = f"id {kind}, h long, line int, key long, halves array<long>, short boolean"
    return docs.select("id", "h", "text").mapInArrow(rows, schema)


def _with_lines(docs: DataFrame, wanted: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Documents joined to their rows of ``wanted`` (id, h, x), as the array ``xs``; texts travel compressed."""
    packed = map_rows(docs, lambda: lambda t: (_pack(t),), "packed binary", ("text",), ("id", "h", *columns))
    lists = wanted.groupBy("id", "h").agg(F.collect_list("x").alias("xs")).toDF("id_", "h_", "xs")
    return packed.join(lists, packed["id"].eqNullSafe(lists["id_"]) & (packed["h"] == lists["h_"]), how)


def _candidate_words(docs: DataFrame, places: DataFrame) -> DataFrame:
    """key and words of candidate lines, from the documents in which they stand first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, words = [], []
            for packed, xs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = _unpack(packed).split("\n")
                for x in xs:
                    keys.append(x["key"])
                    words.append(b" ".join(words_of(lines[x["line"]])))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(words, pa.binary())], names=["key", "words"])

    places = places.select("id", "h", F.struct("line", "key").alias("x"))
    found = _with_lines(docs, places, (), "inner").select("packed", "xs").mapInArrow(rows, "key long, words binary")
    return found.groupBy("key").agg(F.min("words").alias("words"))


def _variant_rows(lines: DataFrame, fuzzy: int) -> DataFrame:
    """variant, place (of the word left out; -1: none), key."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part, found = batch.slice(a, 2000), []
                for words in part.column(1).to_pylist():
                    v = variants(words.split(b" "))
                    found.append((v, np.append(np.arange(len(v) - 1), -1)) if len(v) > fuzzy else (v[-1:], np.array([-1])))
                sizes = [len(v) for v, _ in found]
                made = [np.concatenate([v for v, _ in found]), np.concatenate([p for _, p in found]).astype(np.int32)]
                key = np.repeat(part.column(0).to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays([*map(pa.array, made), pa.array(key)], names=["variant", "place", "key"])

    return lines.select("key", "words").mapInArrow(rows, "variant long, place int, key long")


def _earlier_partners(rows: DataFrame) -> DataFrame:
    """(key, partner): an earlier line with an equal variant, for each way to share one.

    Lines that share a variant and a place are all within the bound of each other, so the
    earliest stands for all of them; the line that is the variant is a partner of them all.
    """
    lacking, whole = rows.where("place >= 0"), rows.where("place < 0")
    me, them = F.struct("first", "key"), ("variant", "place")
    first_at = lacking.groupBy(*them).agg(F.min(me).alias("f"))
    same_place = lacking.join(first_at, list(them)).select("key", "first", "f")
    own = whole.select("variant", me.alias("f"))
    inserted = lacking.join(own, "variant").select("key", "first", "f")
    first_of = lacking.groupBy("variant").agg(F.min(me).alias("f"))
    deleted = whole.join(first_of, "variant").select("key", "first", "f")
    links = same_place.union(inserted).union(deleted).where(F.col("f.first") < F.col("first"))
    return links.select("key", F.col("f.key").alias("partner")).distinct()


def _verified(links: DataFrame, words: DataFrame) -> DataFrame:
    both = links.join(words, "key").join(words.toDF("partner", "other"), "partner")
    row = lambda a, b: (within_one(a.split(b" "), b.split(b" ")),)
    return map_rows(both, lambda: row, "ok boolean", ("words", "other"), ("key",)).where("ok").select("key").distinct()


def _removed(docs: DataFrame, least_words: int, fuzzy_words: int) -> DataFrame:
    """id, h, x of the lines that repeat earlier ones."""
    lines = stored(_lines(docs, least_words, fuzzy_words), "lines")
    order = F.struct("id", "h", "line")
    ends = F.min(order).alias("first"), F.max(order).alias("last")
    count = F.count(F.lit(1)).alias("n")
    first = stored(lines.groupBy("key").agg(*ends, F.first("halves").alias("halves"), count), "lines-first")

    halves = first.select("key", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("key").alias("a"), F.max("key").alias("z")).where("a <> z")
    partners = halves.join(shared.select("half"), "half", "left_semi").select("key").distinct()
    places = first.join(partners, "key", "left_semi").select("key", "first.id", "first.h", "first.line")
    words = stored(_candidate_words(docs, places), "lines-words")

    rows = _variant_rows(words, fuzzy_words)
    equal = rows.groupBy("variant").agg(F.min("key").alias("a"), F.max("key").alias("z")).where("a <> z")
    rows = rows.join(equal.select("variant"), "variant", "left_semi")
    rows = stored(rows.join(first.select("key", "first"), "key"), "lines-variants")
    near = _verified(_earlier_partners(rows), words).withColumn("near", F.lit(True))

    marks = stored(first.join(near, "key", "left").where("near or first <> last").select("key", "first", "near", "n"), "lines-marks")
    total = first.agg(F.sum("n")).first()[0] or 0
    # at most HOT_KEYS keys hold more than that share of all lines; theirs meet their mark in place
    hot = F.broadcast(marks.where(F.col("n") * HOT_KEYS > total))
    common = lines.join(hot, "key", "left_anti").join(marks.where(F.col("n") * HOT_KEYS <= total), "key")
    found = lines.join(hot, "key").unionByName(common)
    removed = found.where(F.coalesce("near", F.lit(False)) | (order > F.col("first")))
    # lines from 0 on; a short line, which stays, as -1 and below
    return removed.select("id", "h", F.when(F.col("short"), -1 - F.col("line")).otherwise(F.col("line")).alias("x"))


@operator
def dedup_lines(
    docs: DataFrame,
    keep: Sequence[str] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = 2,
    fuzzy_words: int = 8,
) -> DataFrame:
    """Remove lines that repeat an earlier line of the corpus, up to one word.

    Lines (separated by newlines) are in order of the document's id, the text's hash and
    their place. A line is removed if any earlier line is equal or, where the longer one
    has ``fuzzy_words`` or more, one word apart; whether that line is itself removed makes
    no difference. Lines without words stay, and those of fewer than ``least_words`` whose
    words have fewer than ``SHORT_BYTES`` bytes (a sentence without spaces is one word, but
    is not short); with ``least_words`` 1 none is exempt. Returns for each input row
    the id, ``keep``, the text without those lines, ``n_lines``, ``n_removed``, ``n_left``
    (remaining lines of ``least_words`` or more) and ``n_new`` (remaining lines of any
    word that equal no earlier line of the corpus). Null texts stay null with 0
    lines; null ids come first; rows equal in id and text are the same document and get
    the same result.
    """
    keep = [c for c in keep if c not in (id_col, text_col, "n_lines", "n_removed", "n_left", "n_new")]
    docs = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("h"),
        F.col(text_col).alias("text"),
        *(F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)),
    )
    with scratch_scope(docs.sparkSession):
        removed = stored(_removed(docs, least_words, fuzzy_words), "lines-removed", lasting=True)

    def rows_():
        def row(packed, xs):
            text = _unpack(packed)
            if not text:
                return text, 0, 0, 0, 0
            gone, all_lines = {x for x in xs or () if x >= 0}, text.split("\n")
            left = [x for k, x in enumerate(all_lines) if k not in gone] if gone else all_lines
            sizes, short = [len(words_of(x)) for x in left], {x for x in xs or () if x < 0}  # repeated rows repeat them
            full, new = sum(n >= least_words for n in sizes), sum(n > 0 for n in sizes) - len(short)
            return "\n".join(left), len(all_lines), len(all_lines) - len(left), full, new

        return row

    kept = [f"keep_{i}" for i in range(len(keep))]
    found = _with_lines(docs, removed, kept, "left")
    schema = "text string, n_lines long, n_removed long, n_left long, n_new long"
    found = map_rows(found, rows_, schema, ("packed", "xs"), ("id", *kept))
    names = {"id": id_col, "text": text_col, **dict(zip(kept, keep, strict=True))}
    return found.select(*(F.col(c).alias(names.get(c, c)) for c in found.columns))
