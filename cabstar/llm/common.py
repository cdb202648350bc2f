"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import wraps
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from cabstar.session import ship_package
from cabstar.sources.sinks import materialize

#: Separators of the word rule ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on lower-cased text:
#: every ASCII character except digits and letters; all other characters are word characters.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a Parquet table of the data folder."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def operator(function: Callable) -> Callable:
    """Marks a function whose work runs in Python workers; its first argument has the session."""

    @wraps(function)
    def run(first, *args, **options):
        ship_package(first if isinstance(first, SparkSession) else first.sparkSession)
        return function(first, *args, **options)

    return run


def stored(df: DataFrame, label: str, lasting: bool = False) -> DataFrame:
    """Cut lineage: write to the cluster's shared checkpoint folder and read back.

    Inside ``scratch_scope`` the table is deleted when the scope ends, unless it is ``lasting``.
    """
    return materialize(df, f"llm-{label}", lasting)


def words_of(text: str | None) -> list[bytes]:
    """Words of the rule above as UTF-8 bytes, A-Z lower-cased; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


#: Rows of a batch that are Python objects at a time.
_ROWS = 1000


def map_rows(
    df: DataFrame, rows: Callable[[], Callable[..., tuple]], schema: str, inputs: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Add columns row by row inside Arrow batches, without a shuffle.

    ``rows()`` is called once a task and returns the row function; that gets the values of
    ``inputs`` and returns one value for each field of ``schema``. The result has the
    columns ``keep`` untouched and those of ``schema``; a new column takes the place of a
    kept one of the same name. Other columns are not read.
    """
    new = StructType.fromDDL(schema)
    keep = [c for c in keep if c not in new.names]
    arrow = to_arrow_schema(new)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = rows()
        for whole in it:
            for first in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(first, _ROWS)
                kept = batch.columns[: len(keep)]
                out = zip(*map(row, *(batch.column(i).to_pylist() for i in places)), strict=True)
                made = [pa.array(c, f.type) for c, f in zip(out, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keep, *new.names])
        pa.default_memory_pool().release_unused()  # the worker stays for later stages

    more = [c for c in inputs if c not in keep]  # a kept input travels once
    places = [keep.index(c) if c in keep else len(keep) + more.index(c) for c in inputs]
    given = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(more)]
    fields = StructType([StructField(c, df.schema[c].dataType) for c in keep] + new.fields)
    return df.select(*(F.col(f"`{c}`") for c in keep), *given).mapInArrow(batches, fields)


def lower_ascii(text) -> F.Column:
    """Lower-case A-Z only (JVM side)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Runs of Unicode White_Space (what ``\s`` means to the tokenizers library).
WHITE_SPACE = re.compile("[\t-\r \u0085   -     　]+")


class Memo(dict):
    """``make(key)`` kept for short keys, ``limit`` at most.

    When it is full the younger half goes: common keys are met early, so the older half
    holds most of them.
    """

    def __init__(self, make: Callable, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                for young in list(islice(self, self.limit // 2, None)):
                    del self[young]
            self[key] = value
        return value

    def all(self, keys: list) -> list:
        """The values of many keys, faster than one by one."""
        values = list(map(self.get, keys))
        if None in values:
            values = [self[k] if v is None else v for k, v in zip(keys, values, strict=True)]
        return values


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabularies of byte-level tokenizers.

    Printable bytes stand for themselves; the others follow from U+0100 in byte order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


#: Classes of Latin-1 characters: 0 others, 1 space, 2 other white space, 3 letters, 4 digits, 5 signs.
OTHER, SPACE, BREAK, LETTER, DIGIT, SIGN = range(6)
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F], _CLASS[0x20], _CLASS[9:14], _CLASS[0x30:0x3A] = SIGN, SPACE, BREAK, DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _CLASS[0xC0:] = LETTER
_CLASS[[0xD7, 0xF7]] = OTHER


def latin_classes(text: str) -> np.ndarray | None:
    """The class of each character of a text of plain Latin-1 without apostrophes, else None.

    For these characters the split patterns of the tokenizers cut where the class changes.
    """
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    classes = _CLASS[np.frombuffer(raw, np.uint8)]
    return None if b"'" in raw or not classes.all() else classes


def special_pattern(tokenizer) -> re.Pattern | None:
    """Matches the special tokens, which the library cuts out of a text before all else."""
    names = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
