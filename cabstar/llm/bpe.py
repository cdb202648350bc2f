"""BPE encoding and decoding with forced boundaries.

Two adjacent letters that are adjacent inside no vocabulary token can never be merged
across, so a word may be cut between them and its fragments encoded one by one; the ids of
the fragments, one after the other, are those of the word. The tokenizer's own normalizer
and pre-tokenizer give the words (in plain Latin text numpy finds the same ones); the ids of
words and fragments are remembered.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from cabstar.llm.common import (
    BREAK,
    DIGIT,
    WHITE_SPACE,
    Memo,
    byte_letters,
    latin_classes,
    map_rows,
    operator,
    special_pattern,
)

#: Control characters that Python takes for white space but Unicode doesn't.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Fixed value: the split pattern whose cuts in plain Latin text are found by numpy.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Fragments up to this length are merged in a plain list, longer ones by a heap.
_SHORT = 100


class ForcedBoundaryBpe:
    """Encoder and decoder of a tokenizer file of kind BPE whose pre-tokenizer drops white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        ends = len(self.suffix)
        bare = (t[:-ends] if ends and t.endswith(self.suffix) else t for t in self.vocab)
        self.inside = {pair for t in bare for pair in zip(t, t[1:], strict=False)}
        self.special = special_pattern(self.tokenizer)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.names = {i: t.encode() for t, i in self.vocab.items()} | {i: t.encode() for i, t in added.items()}
        self.fragments = Memo(self._fragment, limit=50_000)
        self.words = Memo(self._word, limit=50_000)
        self.plain_words = Memo(self._plain_word, limit=80_000)
        self.chunks = Memo(self._chunk, limit=50_000)
        self.letters = dict(enumerate(byte_letters()))
        splits = [p["pattern"].get("Regex") for p in spec["pre_tokenizer"].get("pretokenizers", ()) if "pattern" in p]
        self.plain = splits == [_SPLIT]

    def cut(self, word: str) -> list[str]:
        """Fragments of a word; the last one carries the end-of-word suffix."""
        at = [i for i, pair in enumerate(zip(word, word[1:], strict=False), 1) if pair not in self.inside]
        if not at:
            return [word + self.suffix]
        at = [0, *at, len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:], strict=False)]
        return [*parts[:-1], parts[-1] + self.suffix]

    def _word(self, word: str) -> bytes:
        parts = self.cut(word)
        return self._fragment(parts[0]) if len(parts) == 1 else b"".join([self.fragments[f] for f in parts])

    def _fragment(self, fragment: str) -> bytes:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        ends = self.suffix and fragment.endswith(self.suffix)
        parts = list(fragment[: -len(self.suffix)] if ends else fragment)
        if ends:
            parts[-1] += self.suffix
        parts = self._merged(parts) if len(parts) <= _SHORT else self._merged_by_heap(parts)
        return array("I", map(self.vocab.__getitem__, parts)).tobytes()

    def _merged(self, parts: list[str]) -> list[str]:
        get, none = self.ranks.get, len(self.ranks)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
        return parts

    def _merged_by_heap(self, parts: list[str]) -> list[str]:
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (rank := self.ranks.get((parts[i], parts[j]))) is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j], after[i] = left + right, "", after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p]

    def _plain_word(self, word: str) -> bytes:
        return self._word(word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))

    def _chunk(self, chunk: str) -> bytes:
        t = self.tokenizer
        words = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(chunk))
        return b"".join([self.words[word] for word, _ in words])

    def _plain(self, text: str) -> bytes | None:
        """Ids of a text that is plain Latin when lower-cased; such text has no other normal form."""
        text = text.lower()
        classes = latin_classes(text) if self.plain else None
        if classes is None:
            return None
        new = np.append(True, (classes[1:] != classes[:-1]) | (classes[1:] == DIGIT))
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(text))
        word = classes[begin] > BREAK
        at = zip(begin[word].tolist(), end[word].tolist(), strict=True)
        return b"".join(self.plain_words.all([text[a:b] for a, b in at]))

    def encode(self, text: str | None) -> array:
        """Ids of a whole text; null and empty have none."""
        ids = array("I")
        for part in self.special.split(text) if text and self.special else [text or ""]:
            if self.special and self.special.fullmatch(part):
                ids.append(self.tokenizer.token_to_id(part))
            elif part and (plain := self._plain(part)) is not None:
                ids.frombytes(plain)
            else:
                plain = not any(c in part for c in _NOT_SPACE)
                chunks = part.split() if plain else [c for c in WHITE_SPACE.split(part) if c]
                ids.frombytes(b"".join(map(self.chunks.__getitem__, chunks)))
        return ids

    def decode(self, ids: Sequence[int]) -> bytes:
        """UTF-8 of the text that the library's ``decode`` gives without a decoder in its file."""
        return b" ".join(map(self.names.__getitem__, ids))


@lru_cache(maxsize=1)
def coder(path: str) -> ForcedBoundaryBpe:
    """One for each Python worker: it is kept between tasks."""
    return ForcedBoundaryBpe(path)


SCHEMA = "n_tokens long, ids binary, decoded binary"
DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


@operator
def encode_texts(
    docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text_col: str = "text", digests: bool = False
) -> DataFrame:
    """Encode every whole text and decode its ids again; a row for each input row.

    Returns ``keep``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and
    ``decoded`` (UTF-8); with ``digests`` lowercase hex SHA-256 of both in their place, so
    that the ids need not leave the task. Null and empty texts have no ids.
    """

    def rows():
        bpe = coder(path)

        def row(text):
            ids = bpe.encode(text)
            raw, decoded = ids.tobytes(), bpe.decode(ids)
            if digests:
                return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()
            return len(ids), raw, decoded

        return row

    return map_rows(docs, rows, DIGEST if digests else SCHEMA, (text_col,), keep)
