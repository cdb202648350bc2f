"""Token counts by a linear longest-match automaton.

The trie of the vocabulary has failure links as in fast word-piece tokenization: where a
node has no child for the next byte, the automaton pops the pieces that the greedy longest
match would take there (how many is precomputed) and goes on from the node for what is
left of the matched bytes. Each byte is read once; no piece is built.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Sequence
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.llm.common import WHITE_SPACE, Memo, byte_letters, map_rows, operator


class LongestMatch:
    """Counts greedy pieces of a word; -1 if some rest of it begins with no piece."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.child: dict[int, int] = {}  # by node * 256 + byte; the root is node 0
        terminal, depth, parents = [False], [0], [(0, 0)]
        for piece in vocabulary:
            node = 0
            for b in piece:
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(depth)
                    terminal.append(False)
                    parents.append((node, b))
                    depth.append(depth[node] + 1)
                node = self.child[key]
            terminal[node] = node > 0
        n = len(depth)
        self.fail, self.pops = [-1] * n, [0] * n
        children: list[list[int]] = [[] for _ in range(n)]
        for v in range(1, n):
            children[parents[v][0]].append(v)
        queue = deque(children[0])
        while queue:
            v = queue.popleft()
            parent, b = parents[v]
            if terminal[v]:
                self.fail[v], self.pops[v] = 0, 1
            else:
                z, popped = self.fail[parent], self.pops[parent]
                while z > 0 and (z << 8 | b) not in self.child:
                    popped += self.pops[z]
                    z = self.fail[z]
                if z >= 0 and (z << 8 | b) in self.child:
                    self.fail[v], self.pops[v] = self.child[z << 8 | b], popped
            queue.extend(children[v])

    def count(self, word: bytes) -> int:
        child, fail, pops = self.child, self.fail, self.pops
        node = total = 0
        for b in word:
            while (step := child.get(node << 8 | b)) is None:
                if not node or fail[node] < 0:
                    return -1
                total += pops[node]
                node = fail[node]
            node = step
        while node:
            if fail[node] < 0:
                return -1
            total += pops[node]
            node = fail[node]
        return total


class Counter:
    """Counts of whole texts: words are runs without white space, each with a space before it."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.automaton = LongestMatch(vocabulary)
        self.words = Memo(lambda w: self.automaton.count(b" " + w.encode("utf-8", "surrogatepass")))

    def count(self, text: str | None) -> tuple[int, int, int]:
        """Tokens, words and words that have no pieces (each of them is one token)."""
        if not text:
            return 0, 0, 0
        plain = not any(c in text for c in "\x1c\x1d\x1e\x1f")
        words = text.split() if plain else [w for w in WHITE_SPACE.split(text) if w]
        counts = list(map(self.words.__getitem__, words))
        unknown = counts.count(-1)
        return sum(counts) + 2 * unknown, len(words), unknown


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """One for each Python worker, over the tokens of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = {c: b for b, c in enumerate(byte_letters())}
    return Counter(bytes(byte[c] for c in token) for token in vocab)


SCHEMA = "n_tokens long, n_words long, n_unknown long"


@operator
def token_counts(docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Greedy longest-match token counts of whole texts; a row for each input row.

    ``path`` is a byte-level tokenizer file whose tokens are the vocabulary. Null and empty
    texts count nothing; repeated rows give repeated results.
    """

    def rows():
        return counter(path).count

    return map_rows(docs, rows, SCHEMA, (text_col,), keep)


def by_source(counts: DataFrame, source_col: str = "source") -> DataFrame:
    """Documents and tokens of each source."""
    return counts.groupBy(source_col).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
