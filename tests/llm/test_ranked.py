"""Ranked search against scoring every document for every item."""

import math
import random

import numpy as np

from cabstar.llm import ranked
from cabstar.llm.common import words_of

DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def brute(docs, items, k):
    texts = [(d, words_of(t)) for d, t in docs if words_of(t)]
    total, length = len(texts), sum(len(w) for _, w in texts)
    out = []
    for item, text in set(items):
        scores = []
        for d, w in texts:
            m, score = 50 + 50 * len(w) * total // length, 0
            for t in set(words_of(text)):
                df = sum(t in x for _, x in texts)
                tf = w.count(t)
                score += math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            scores.append((-score, d is None, d or 0))
        best = sorted(s for s in scores if s[0] < 0)[:k]
        out += [(item, i, None if none else d, -s) for i, (s, none, d) in enumerate(best, 1)]
    return sorted(out, key=str)


def tables(seed):
    rng = random.Random(seed)
    vocabulary = [a + b for a in "abcdefgh" for b in ("", "é", "1", "xx")]
    text = lambda n: " ".join(rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(32)], k=n))
    docs = [(i, text(rng.randrange(40))) for i in range(150)]
    docs += [(None, docs[3][1]), (3, docs[3][1]), (500, None), (501, ""), (502, "- .\n"), (503, text(3000).upper())]
    docs += [(600 + i, "same text again ax") for i in range(40)]  # ties beyond k
    items = [(i, text(rng.randrange(1, 9))) for i in range(25)] + [(90, None), (91, ""), (92, "nowhere"), (93, "text AX")]
    return docs, items + [(93, "text AX"), (93, "again"), (None, "again c")]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ranked, "ITEM_LEAF", 3)
    monkeypatch.setattr(ranked, "DOC_LEAF", 4)
    for seed, block in ((1, 1 << 17), (2, 60)):  # 60: several passes over the documents
        monkeypatch.setattr(ranked, "ITEM_BYTES", block)
        docs, items = tables(seed)
        d = spark.createDataFrame(docs, DOC).repartition(3).selectExpr("*", "doc_id as id", "text as terms", "1 as n", "2 as score")
        i = spark.createDataFrame(items, ITEM).selectExpr("*", "1 as rank", "2 as item", "3 as doc_id")
        got = sorted(map(tuple, ranked.rank_documents(d, i, k=7).collect()), key=str)
        assert got == brute(docs, items, 7)


def test_empty_tables_and_long_items(spark):
    docs, items = spark.createDataFrame([(1, "a b"), (2, "b")], DOC), spark.createDataFrame([(1, "b c")], ITEM)
    assert ranked.rank_documents(docs.limit(0), items).count() == 0
    assert ranked.rank_documents(docs, items.limit(0)).count() == 0
    assert ranked.rank_documents(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, long), (2, "w1 w2"), (3, "zz")]
    got = ranked.rank_documents(spark.createDataFrame(rows, DOC), spark.createDataFrame([("x", long)], "item_id string, text string"))
    assert [(r.item_id, r["rank"], r.doc_id) for r in got.orderBy("rank").collect()] == [("x", 1, 1), ("x", 2, 2)]


def test_trees_leave_pairs_out(spark):
    rng = np.random.default_rng(6)
    groups = [np.arange(g * 5, g * 5 + 5) for g in range(40)]  # each item's terms stand in few documents
    tree = ranked.ItemTree(groups, np.full(200, 3000))
    shares = np.zeros((4000, 200))
    for d in range(4000):
        shares[d, groups[rng.integers(40)]] = rng.integers(1, 900_000, 5)
    search = ranked.Search(tree, 10)
    ids, null = np.arange(4000), np.zeros(4000, bool)
    for first in range(0, 4000, 1000):
        s = slice(first, first + 1000)
        search.add(shares[s], ids[s], null[s])
    for terms, best in zip(groups, search.best, strict=True):
        scores = shares[:, terms].sum(axis=1).astype(int) * 3000
        want = sorted((-x, i) for i, x in enumerate(scores) if x > 0)[:10]
        assert [(-s, i) for s, _, i in best.T.tolist()] == want
    assert search.scored < 0.5 * 4000 * 40
