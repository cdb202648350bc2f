"""Ranked lexical search by two trees, over documents and over items.

A document is a vector with a coordinate for each term of the items, from the term's share
in it; an item has its terms' weights as coordinates, and a score is the inner product.
Nodes of either tree hold the largest value of each coordinate below them, so the product
of two nodes' maxima bounds all scores between them. A pair of nodes is left, with all the
pairs below it, where that bound is less than the smallest k-th best score that the node's
items have so far. Other pairs are opened down to the leaves, best bounds first, and scored
there. Bounds never fall below a score, so nothing that ranks is lost.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabstar.llm.common import map_rows, operator, stored, words_of

#: Items that are searched for at a time: bytes of their texts and rows.
ITEM_BYTES, ITEM_ROWS = 128 << 10, 2000
#: Rows of a leaf of either tree, numbers in a document matrix, and documents of one tree at most.
ITEM_LEAF, DOC_LEAF, MATRIX, TREE_DOCS = 2, 32, 4 << 20, 1024
#: A document's share of a term is an integer below this.
SHARE = 1_000_000
#: Groups of tasks whose best rows meet before all of them do.
MERGED = 256


class Node:
    """``rows`` below the node, in order; ``parts`` are its two children, none for a leaf."""

    def __init__(self, rows: np.ndarray, parts: tuple[Node, Node] | tuple[()] = ()):
        self.rows, self.parts = rows, parts


class ItemTree:
    """Items by their rarest terms; a node's maxima are the weights of all terms below it."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        self.terms, self.weights = terms, weights
        # doubles hold all sums exactly, but for items of very many terms
        self.type = np.float64 if int(weights.sum()) * SHARE < 1 << 53 else np.int64
        rarest = lambda i: tuple(sorted(terms[i].tolist(), key=lambda t: (-weights[t], t)))
        self.root = self._node(np.array(sorted(range(len(terms)), key=rarest), np.int64))

    def _node(self, rows: np.ndarray) -> Node:
        half = len(rows) // 2
        node = Node(rows, (self._node(rows[:half]), self._node(rows[half:])) if len(rows) > ITEM_LEAF else ())
        node.terms = np.unique(np.concatenate([p.terms for p in node.parts] or [self.terms[i] for i in rows]))
        node.maxima = self.weights[node.terms].astype(self.type)
        if not node.parts:
            held = [np.isin(node.terms, self.terms[i], assume_unique=True) for i in rows]
            node.vectors = np.array(held) * node.maxima
        return node


class DocTree:
    """Documents divided by the heaviest terms that tell them apart; nodes hold coordinate maxima."""

    def __init__(self, shares: np.ndarray, weights: np.ndarray):
        self.shares, self.weights = shares, weights
        self.root = self._node(np.arange(len(shares)))

    def _node(self, rows: np.ndarray) -> Node:
        own = self.shares[rows]
        if len(rows) <= DOC_LEAF:
            node = Node(rows)
            node.maxima = own.max(axis=0)
            return node
        have = np.count_nonzero(own, axis=0)
        term = int(np.argmax(self.weights * np.minimum(have, len(rows) - have)))
        order = rows[np.argsort(-own[:, term], kind="stable")]
        cut = min(max(int(have[term]), len(rows) // 8), len(rows) - len(rows) // 8)  # holders of the term apart from others
        node = Node(order, (self._node(order[:cut]), self._node(order[cut:])))
        node.maxima = np.maximum(*(p.maxima for p in node.parts))
        return node


class Search:
    """The best ``k`` documents of each item among those added so far."""

    def __init__(self, items: ItemTree, k: int):
        self.items, self.k = items, k
        self.best = [np.empty((3, 0), np.int64) for _ in items.terms]  # score, id is null, id
        self.least = np.zeros(len(items.terms), items.type)  # the k-th best score, 0 before there is one
        self.scored = 0

    def add(self, shares: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Documents by their shares of all terms, a row a document."""
        docs = DocTree(shares, self.items.weights)
        open_pairs = [(self._bound(self.items.root, docs.root), self.items.root, docs.root)]
        while open_pairs:
            bound, item, doc = open_pairs.pop()
            if bound <= 0 or bound < self.least[item.rows].min():
                continue
            if not item.parts and not doc.parts:
                self._score(item, doc, shares, ids, null)
                continue
            by_item = item.parts and (not doc.parts or len(item.rows) * DOC_LEAF >= len(doc.rows) * ITEM_LEAF)
            pairs = [(i, doc) for i in item.parts] if by_item else [(item, d) for d in doc.parts]
            open_pairs += sorted(((self._bound(*p), *p) for p in pairs), key=lambda x: x[0])  # the best is next

    @staticmethod
    def _bound(item: Node, doc: Node):
        return doc.maxima[item.terms] @ item.maxima

    def _score(self, item: Node, doc: Node, shares: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        self.scored += len(item.rows) * len(doc.rows)
        scores = shares[np.ix_(doc.rows, item.terms)] @ item.vectors.T
        for i, column in zip(item.rows, scores.T, strict=True):
            found = (column > 0) & (column >= self.least[i])
            if not found.any():
                continue
            at = doc.rows[found]
            new = np.stack([column[found].astype(np.int64), null[at].astype(np.int64), ids[at]])
            both = np.concatenate([self.best[i], new], axis=1)
            self.best[i] = both[:, np.lexsort((both[2], both[1], -both[0]))[: self.k]]
            if self.best[i].shape[1] == self.k:
                self.least[i] = self.best[i][0, -1]


def _postings(docs: DataFrame, terms: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """Per document: ``id``, number of all its terms ``n``, and which of ``terms`` it holds how often."""

    def rows():
        number = {t: i for i, t in enumerate(terms)}

        def row(text):
            words = words_of(text)
            held = Counter(map(number.get, words))
            held.pop(None, None)
            return len(words), list(held), list(held.values())

        return row

    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return map_rows(docs, rows, "n long, terms array<int>, times array<long>", ("text",), ("id",)).where("n > 0")


def weight(n: int, df: int) -> int:
    """A term's weight by the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _best(docs: DataFrame, items: Sequence, k: int, id_col: str, text_col: str) -> DataFrame:
    """``item`` (its place in ``items``), ``doc_id`` and ``score``: each task's k best of every item, all ranked ones among them."""
    held = [sorted(set(words_of(r["text"]))) for r in items]
    terms = sorted(set().union(*held))
    number = {t: i for i, t in enumerate(terms)}
    postings = stored(_postings(docs, terms, id_col, text_col), "ranked-postings")
    total, length = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # a row a term of the items
    df = {r["t"]: r["count"] for r in counts}
    weights = np.array([weight(total, df.get(t, 0)) for t in range(len(terms))], np.int64)
    tree = ItemTree([np.array([number[t] for t in own], np.int64) for own in held], weights)
    size = max(1, min(TREE_DOCS, MATRIX // max(1, len(terms))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Search(tree, k)
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                ids, n, at, times = (part.column(c) for c in ("id", "n", "terms", "times"))
                tf = times.flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), np.diff(at.offsets.to_numpy()))
                m = np.array([100 - 50 + 50 * x * total // length for x in n.to_pylist()], np.int64)
                shares = np.zeros((part.num_rows, len(terms)), tree.type)
                shares[row, at.flatten().to_numpy()] = 1_000_000_000 * tf // (1000 * tf + 20 * m[row])
                found.add(shares, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        for i, (score, null, doc) in enumerate(found.best):
            if len(score):
                columns = [np.full(len(score), i, np.int32), pa.array(doc, mask=null.astype(bool)), score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["item", "doc_id", "score"])
        pa.default_memory_pool().release_unused()

    return postings.mapInArrow(search, "item int, doc_id long, score long")


@operator
def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Terms are runs without ASCII signs and spaces, A-Z lower-cased. Scores above 0 rank,
    highest first, ties by ascending id (null last). All documents with a term count in the
    statistics and all are searched; ids must be integers. Null and empty texts have no term
    and rank nowhere; items without terms have no rows. Equal item rows count once, items of
    one id and different texts each for themselves; repeated documents rank each.
    """
    spark = docs.sparkSession
    items = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).distinct()
    items = stored(items.where("text is not null"), "ranked-items")
    rows, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-size // ITEM_BYTES), -(-rows // ITEM_ROWS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    best_first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = []
    for b in range(blocks):  # a pass over the documents for each block of bounded size
        own = [r for r in items.where(block == b).collect() if words_of(r["text"])]
        if not own:
            continue
        best = _best(docs, own, k, id_col, text_col).withColumn("part", F.spark_partition_id() % MERGED)
        for key in (["item", "part"], ["item"]):
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*best_first))).where(f"rank <= {k}")
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        found.append(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    return reduce(DataFrame.unionAll, found)
