"""Benchmark decontamination with one Aho-Corasick automaton.

A window is ``window`` consecutive words of an item (a shorter item is one window). Any
window holds a whole block of ``ceil(window / 2)`` words that starts at a multiple of that
length, so the automaton holds just these blocks, each item word once, and a match is
extended to both sides word by word; the extended run counts if it is a window or longer.
Every document is scanned once, in place, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.llm.common import map_rows, operator, stored, words_of

#: Words in the original text; A-Z are included here as the text is not lower-cased.
_WORDS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Characters of benchmark text for one automaton (about 60 bytes of memory each).
AUTOMATON_CHARS = 4_000_000

SCHEMA = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"


class Scanner:
    """The automaton over item blocks, with the items' words to extend matches."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window, self.items = window, [(str(i), words_of(t)) for i, t in items]
        seed = (window + 1) // 2
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(self.items):
            if 0 < len(words) < window:
                places.setdefault(self.joined(words), []).append((k, 0))
            for p in range(0, len(words) - seed + 1, seed) if len(words) >= window else ():
                places.setdefault(self.joined(words[p : p + seed]), []).append((k, p))
        self.automaton = ahocorasick.Automaton()
        for block, at in places.items():
            self.automaton.add_word(block, (block.count(" ") - 1, at))
        if places:
            self.automaton.make_automaton()

    @staticmethod
    def joined(words: list[bytes]) -> str:
        return (b" " + b" ".join(words) + b" ").decode("latin-1")

    def runs(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges [first, end) that windows cover, merged, and the items they are of."""
        if not words or not len(self.automaton):
            return [], set()
        text = self.joined(words)
        found = list(self.automaton.iter(text))
        if not found:
            return [], set()
        spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        ends = np.searchsorted(spaces, [end for end, _ in found]).tolist()
        covered: dict[tuple[int, int], int] = {}  # by item and diagonal: the end of the last run
        ranges, items = [], set()
        for end, (_, (n, at)) in zip(ends, found, strict=True):
            for k, p in at:
                name, item = self.items[k]
                first = end - n
                if covered.get((k, first - p), -1) >= end:
                    continue
                last, a, b = end, p, p + n
                while first and a and words[first - 1] == item[a - 1]:
                    first, a = first - 1, a - 1
                while last < len(words) and b < len(item) and words[last] == item[b]:
                    last, b = last + 1, b + 1
                covered[k, first - a] = last
                if last - first >= min(self.window, len(item)):
                    ranges.append((first, last))
                    items.add(name)
        return _union(ranges), items


def _scan(docs: DataFrame, items: list[tuple[str, str]], window: int, last: bool, keep: Sequence[str], text: str) -> DataFrame:
    """One pass; unless it is the last the text and the covered ranges stay for the next."""

    def rows():
        scanner = Scanner(items, window)

        def row(text, ranges, names):
            words = words_of(text)
            found, new = scanner.runs(words)
            ranges = _union([*((r["a"], r["b"]) for r in ranges or ()), *found])
            names = sorted(new | set(names or ()))
            if not last:
                return [{"a": a, "b": b} for a, b in ranges], names
            spans = []
            if ranges:
                at = [m.span() for m in _WORDS.finditer(text)]
                spans = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in ranges]
            return len(words), sum(b - a for a, b in ranges), names, spans

        return row

    schema = SCHEMA if last else "_ranges array<struct<a:int,b:int>>, _names array<string>"
    kept = keep if last or text in keep else (*keep, text)
    return map_rows(docs, rows, schema, (text, "_ranges", "_names"), kept)


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@operator
def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    automaton_chars: int = AUTOMATON_CHARS,
) -> DataFrame:
    """Where windows of benchmark items occur in documents.

    Returns one row for each input row: the columns ``keep``, ``n_words``, ``n_hit`` (words
    inside any occurrence of a window), ``items`` (ids with occurring windows, as sorted
    strings) and ``spans`` (character offsets of the merged occurrences in the original
    text). Null or empty texts have no words; items without words have no window; a null
    item id is the string ``None``. Repeated documents give repeated rows.

    The benchmark's size is checked first: beyond ``automaton_chars`` its items are dealt
    into several automata and the documents are scanned once for each, in turn.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text_col).alias("t"))
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    passes = max(1, -(-size // automaton_chars))
    text = text_col if text_col in keep else "_text"
    state = docs.select(
        *keep,
        *([] if text_col in keep else [F.col(text_col).alias(text)]),
        F.lit(None).cast("array<struct<a:int,b:int>>").alias("_ranges"),
        F.lit(None).cast("array<string>").alias("_names"),
    )
    for k in range(passes):
        part = items if passes == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == k)
        known = [(r["i"], r["t"]) for r in part.where("t is not null").distinct().collect()]
        state = _scan(state, known, window, k == passes - 1, keep, text)
        if k < passes - 1:
            state = stored(state, "decontaminate")
    return state


def contaminated(n_hit="n_hit", n_words="n_words"):
    """The rule: any hit, and hits are at least a twentieth of the words."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
