"""Simple-8b word-aligned coding of ids, and token files made of such blocks.

A 64-bit word has a 4-bit selector and 60 bits of data that hold as many ids as fit at the
selector's width. Ids of ``ESCAPE_BITS`` or more are zero in the words and stand beside
them as (position, value). A block also has the position of the first id of every
``STRIDE``-th word, so any range of ids is decoded from the words that hold it.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cabstar.llm.common import BREAK, SPACE, Memo, byte_letters, latin_classes, map_rows, operator, special_pattern

#: Ids in a word and bits of each, by selector (the published coding's).
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE_BITS = 20
STRIDE = 128
#: Ids in a block, at least; a document is never split.
BLOCK_IDS = 1 << 16

_COUNTS = np.array(COUNTS)
_SELECTOR = {c: s for s, c in enumerate(COUNTS)}
_HEAD = struct.Struct("<4sIQQQ")
_MAGIC = b"S8B1"


@lru_cache(maxsize=1)
def _widths() -> np.ndarray:
    """Bits of each id below 2 ** ESCAPE_BITS."""
    return np.repeat(np.arange(ESCAPE_BITS + 1, dtype=np.uint8), [1, *(1 << b for b in range(ESCAPE_BITS))])


def pack(ids: np.ndarray) -> bytes:
    """A block of unsigned 32-bit ids."""
    n, most = len(ids), COUNTS[0]
    values = np.zeros(n + most, np.uint64)
    values[:n] = ids
    escaped = np.flatnonzero(ids >> np.uint32(ESCAPE_BITS))
    escapes = values[escaped]
    values[escaped] = 0
    best = np.ones(n, np.uint8)
    peak, span = _widths()[values], 1  # peak[i]: the widest of the ids i .. i + span - 1
    for count in sorted(COUNTS)[1:]:
        while span < count:
            step = min(span, count - span)
            peak, span = np.maximum(peak[:-step], peak[step:]), span + step
        fits = peak[:n] <= BITS[_SELECTOR[count]]
        if not fits.any():
            break  # more ids in a word have fewer bits each: none fits either
        np.putmask(best, fits, count)
    jump, at, i = best.tobytes(), [], 0
    while i < n:
        at.append(i)
        i += jump[i]
    at = np.array(at, np.int64)
    words = np.zeros(len(at), np.uint64)
    taken = best[at]
    for count in np.unique(taken).tolist():
        s = _SELECTOR[count]
        rows = np.flatnonzero(taken == count)
        word = np.full(len(rows), s << 60, np.uint64)
        for k in range(count if BITS[s] else 0):
            word |= values[at[rows] + k] << np.uint64(k * BITS[s])
        words[rows] = word
    head = _HEAD.pack(_MAGIC, len(escaped), n, len(words), STRIDE)
    parts = (at[::STRIDE].astype("<u8"), words.astype("<u8"), escaped.astype("<u8"), escapes.astype("<u4"))
    return head + b"".join(p.tobytes() for p in parts)


def unpack(block: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids first .. last - 1 of a block as unsigned 32-bit integers."""
    magic, n_escaped, n, n_words, stride = _HEAD.unpack_from(block)
    if magic != _MAGIC:
        raise ValueError("not a block of this format")
    last = n if last is None else min(last, n)
    at, n_starts = _HEAD.size, -(-n_words // stride)
    starts = np.frombuffer(block, "<u8", n_starts, at).astype(np.int64)
    at += 8 * n_starts
    if last <= first:
        return np.zeros(0, np.uint32)
    a, b = np.searchsorted(starts, first, "right") - 1, np.searchsorted(starts, last, "left")
    words = np.frombuffer(block, "<u8", n_words, at)[a * stride : b * stride]
    selectors = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(_COUNTS[selectors])
    begin = starts[a] + ends - _COUNTS[selectors]
    out = np.zeros(starts[a] + ends[-1] + 1, np.uint32)
    for s in np.unique(selectors).tolist():
        if BITS[s]:
            rows, mask = np.flatnonzero(selectors == s), np.uint64((1 << BITS[s]) - 1)
            for k in range(COUNTS[s]):
                out[begin[rows] + k] = (words[rows] >> np.uint64(k * BITS[s])) & mask
    at += 8 * n_words
    where = np.frombuffer(block, "<u8", n_escaped, at).astype(np.int64)
    value = np.frombuffer(block, "<u4", n_escaped, at + 8 * n_escaped)
    held = (where >= first) & (where < last)
    out[where[held]] = value[held]
    return out[first:last]


class WordEncoder:
    """A byte-level tokenizer whose ids are remembered for each word of its split pattern.

    Plain Latin texts are split into words by numpy, equal words of a batch of texts are
    found by hash, and the library's BPE model encodes each of them once. Other texts are
    cut before spaces between two characters that aren't white space (there a word always
    begins), and the library encodes these runs.
    """

    _AT_SPACE = re.compile(r"\s | \s")
    _SAFE = re.compile(r"(?<=\S) (?=\S)")
    #: Words up to this length are compared by hash (one random factor for each place).
    _HASHED = 64
    _FACTORS = np.random.default_rng(8).integers(1 << 62, 1 << 63, _HASHED + 1, np.uint64) | np.uint64(1)

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = special_pattern(self.tokenizer)
        self.letters = dict(enumerate(byte_letters()))
        self.words = Memo(self._word, 400_000)
        self.first = Memo(self._run, 50_000)
        self.later = Memo(lambda t: self._run(" " + t), 50_000)

    def _word(self, word: str) -> bytes:
        if word.isascii():  # white space stands only at the begin of a word
            letters = self.letters[ord(word[0])] + word[1:]
        else:
            letters = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _run(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _cuts(self, text: str) -> np.ndarray | None:
        """Where the words of a plain Latin text begin; None for other texts."""
        classes = latin_classes(text)
        if classes is None or (self.special and self.special.search(text)):
            return None
        blank = classes <= BREAK
        if (blank[1:] & blank[:-1]).any():
            return None  # how white space in a row is split depends on what follows
        new = (classes[1:] != classes[:-1]) & (classes[:-1] != SPACE)
        return np.concatenate([[0], np.flatnonzero(new) + 1])

    def _keys(self, raw: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A hash of each word; long words have one of their own."""
        place = np.arange(len(raw)) - np.repeat(begin, sizes)
        values = (raw.astype(np.uint64) + np.uint64(1)) * self._FACTORS[np.minimum(place, self._HASHED)]
        keys = np.add.reduceat(values, begin)
        long = np.flatnonzero(sizes > self._HASHED)
        keys[long] = long.astype(np.uint64)
        return keys

    def _plain(self, texts: list[str], cuts: list[np.ndarray]) -> list[bytes]:
        text = "".join(texts)
        at = np.cumsum([0, *map(len, texts)])
        begin = np.concatenate([c + a for c, a in zip(cuts, at, strict=False)])
        sizes = np.diff(np.append(begin, len(text)))
        keys = self._keys(np.frombuffer(text.encode("latin-1"), np.uint8), begin, sizes)
        _, first, same = np.unique(keys, return_index=True, return_inverse=True)
        places = zip(begin[first].tolist(), (begin + sizes)[first].tolist(), strict=True)
        found = self.words.all([text[a:b] for a, b in places])
        flat = np.frombuffer(b"".join(found), "<u4")
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start, count = (np.cumsum(n) - n)[same], n[same]
        ends = np.cumsum(count)
        ids = flat[np.repeat(start - (ends - count), count) + np.arange(ends[-1])].tobytes()
        of_text = [0, *ends[np.cumsum([len(c) for c in cuts]) - 1].tolist()]
        return [ids[4 * a : 4 * b] for a, b in zip(of_text, of_text[1:], strict=False)]

    def _other(self, text: str) -> bytes:
        out = []
        for part in self.special.split(text) if self.special else [text]:
            if self.special and self.special.fullmatch(part):
                out.append(struct.pack("<I", self.tokenizer.token_to_id(part)))
            elif part:
                runs = self._SAFE.split(part) if self._AT_SPACE.search(part) else part.split(" ")
                out.append(self.first[runs[0]])
                out.extend(map(self.later.__getitem__, runs[1:]))
        return b"".join(out)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers; null and empty have none."""
        cuts = [self._cuts(t) if t else None for t in texts]
        plain = [i for i, c in enumerate(cuts) if c is not None]
        out = [b""] * len(texts)
        if plain:
            for i, ids in zip(plain, self._plain([texts[i] for i in plain], [cuts[i] for i in plain]), strict=True):
                out[i] = ids
        for i, text in enumerate(texts):
            if text and cuts[i] is None:
                out[i] = self._other(text)
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """One for each Python worker: it is kept between tasks."""
    return WordEncoder(path)


FILES = "shard int, first long, n_ids long, doc_ids array<long>, n_tokens array<long>, block binary"


@operator
def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode whole texts, append ``end_id`` to each, and write blocks in order of the id.

    A row of the files is a block of whole documents: ``shard`` (files are in order of it),
    ``first`` (ids before the block in its shard), the documents' ids and token counts and
    the packed ids. Null ids come first; among equal ids the order is that of the text's
    hash, so that many rows of one id can be dealt to several tasks.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = struct.pack("<I", end_id)
        shard, first, size = TaskContext.get().partitionId(), 0, 0
        names, counts, parts = [], [], []

        def block() -> pa.RecordBatch:
            packed = pack(np.frombuffer(b"".join(parts), "<u4"))
            row = [[shard], [first], [size], [names], [counts], [packed]]
            types = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types, strict=True)],
                names=["shard", "first", "n_ids", "doc_ids", "n_tokens", "block"],
            )

        rows = (whole.slice(a, 1000) for whole in batches for a in range(0, whole.num_rows, 1000))
        for batch in rows:
            for name, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                names.append(name)
                counts.append(len(ids) // 4 + 1)
                parts += ids, end
                size += counts[-1]
                if size >= block_ids:
                    yield block()
                    first, size, names, counts, parts = first + size, 0, [], [], []
        if names:
            yield block()

    order = ["_id", F.xxhash64("_text")]
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(blocks, FILES).write.option("compression", "zstd").parquet(path)


@operator
def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Read token files back: doc_id, start, n_tokens, ids_crc32 and, if wanted, the ids.

    ``start`` counts the ids of all documents before. Only the shards' totals are brought
    together to count them, a row for each task that wrote.
    """
    files = spark.read.parquet(path)

    def rows():
        def row(first, names, counts, block):
            values, at, out = unpack(block), 0, []
            for name, n in zip(names, counts, strict=True):
                raw = values[at : at + n].astype("<u4").tobytes()
                out.append({"id": name, "at": first + at, "n": n, "crc": zlib.crc32(raw), "ids": raw if ids else None})
                at += n
            return (out,)

        return row

    item = "array<struct<id:long,at:long,n:long,crc:long,ids:binary>>"
    docs = map_rows(files, rows, f"docs {item}", ("first", "doc_ids", "n_tokens", "block"), ("shard",))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    found = docs.select("shard", F.inline("docs")).join(F.broadcast(offsets), "shard")
    columns = [
        F.col("id").alias("doc_id"),
        (F.col("offset") + F.col("at")).alias("start"),
        F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    ]
    return found.select(*columns, *(["ids"] if ids else []))
