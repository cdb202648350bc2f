"""Spelling variants against comparing every word with every other."""

import random
import re
import zlib
from collections import Counter

import pytest

from cabstar.llm import spelling
from cabstar.llm.queries import op12_spelling

WORDS = "word string, n long"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, times=2):
    out = {}
    for w, n in counts.items():
        near = [(-m, v) for v, m in counts.items() if one_edit(v, w)]
        best = min(near, default=(0, None))
        form = best[1] if near and -best[0] >= times * n else None
        out[w] = [form, None, n, len(near), -best[0] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {(w, *v) for w, v in out.items()}


def forms(spark, counts, **options):
    return {tuple(r) for r in spelling.spelling_forms(spark.createDataFrame(list(counts.items()), WORDS), **options).collect()}


def vocabulary(seed, letters="abcé", size=400):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randrange(5, 9))): int(2 ** rng.uniform(0, 9)) for _ in range(size)}


@pytest.mark.parametrize(("seed", "group"), [(1, 1024), (2, 6)])
def test_equals_brute_force(spark, monkeypatch, seed, group):
    monkeypatch.setattr(spelling, "GROUP_WORDS", group)  # 6: groups are split, parts meet in tiles of their own
    counts = vocabulary(seed) | {"x" * 5000: 9, "x" * 4999: 2, "x" * 5001: 40, "x" * 4000 + "y" + "x" * 1000: 80, "日本語日本": 4}
    assert forms(spark, counts) == brute(counts)
    near = spelling.near_words(spark.createDataFrame(list(counts.items()), WORDS)).collect()
    assert len(near) == len({(r.word, r.near) for r in near})


def test_large_groups_and_chains(spark):
    rng = random.Random(3)
    counts = {"common" + "".join(rng.choices("abcdefghij", k=4)): rng.randrange(1, 900) for _ in range(1500)}
    counts |= {"chain"[: 5 - i] + "z" * i + "chain": 3**i for i in range(6)}  # six forms in a row
    assert forms(spark, counts) == brute(counts)


def test_no_words_and_ties(spark):
    assert spelling.spelling_forms(spark.createDataFrame([], WORDS)).count() == 0
    counts = {"trees": 10, "treed": 10, "tree": 5, "other": 1}
    assert forms(spark, counts) == brute(counts)
    with pytest.raises(ValueError, match="twice"):
        spelling.spelling_forms(spark.createDataFrame([], WORDS), times=1)


def counted(docs, noise):
    out = Counter()
    for doc, text in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def test_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 20)
    rng = random.Random(4)
    base = ["Hello", "hellö", "ÀÉÎÕÜ", "a×b÷c", "four", "longer", "Ÿword", "K" * 6, "x" * 3000, "naïve", "日本語word"]
    docs = [(i, rng.choice([" ", "1", "\n", "."]).join(rng.choices(base, k=30))) for i in range(200)]
    docs += [(None, "Hello hello HELLO"), (7, None), (8, ""), (9, "hello"), (9, "hello")]
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "text as word", "doc_id as n")
    for noise in (None, 5):
        got = {r.word: r.n for r in spelling.word_counts(table, noise=noise).collect()}
        assert got == counted(docs, noise)
    assert spelling.word_counts(table.limit(0)).count() == 0


def test_query(spark):
    rows = op12_spelling(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    counts = counted(docs, 97)
    assert {(r.word, r.n) for r in rows} == set(counts.items())
    sample = random.Random(5).sample(rows, 60)
    for r in sample:
        near = [(-n, w) for w, n in counts.items() if one_edit(w, r.word)]
        assert r.n_near == len(near)
        best = min(near, default=(0, None))
        assert (r.form, r.form_n) == ((best[1], -best[0]) if near and -best[0] >= 2 * r.n else (None, None))
