"""Decontamination against a brute-force search of every window."""

import hashlib
import random
import re

from cabstar.llm import decontaminate
from cabstar.llm.queries import op9_decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOC = "doc_id long, text string"
ITEM = "item_id long, text string"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(text, items, window=13):
    doc, hit, found = words(text), set(), set()
    for key, item in items:
        w = words(item)
        wins = [w[i : i + window] for i in range(len(w) - window + 1)] if len(w) >= window else [w] if w else []
        for win in wins:
            for i in range(len(doc) - len(win) + 1):
                if doc[i : i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    found.add(str(key))
    return len(doc), len(hit), sorted(found)


def test_equals_brute_force_on_random_texts(spark):
    rng = random.Random(5)
    items = [(k, " ".join(rng.choices("ab é", k=rng.choice([1, 6, 7, 12, 13, 14, 20, 40])))) for k in range(30)]
    items += [(90, None), (91, ""), (92, " -- "), (3, items[4][1]), (4, items[4][1])]
    docs = [(i, "".join(rng.choices(["a", "b", "é", " ", " ", ", ", ".\n"], k=rng.randrange(150)))) for i in range(60)]
    docs += [(i + 100, f"X {items[i][1].upper()}! y") for i in range(30)] + [(200, None), (201, ""), (0, docs[0][1])]
    for size in (decontaminate.AUTOMATON_CHARS, 200):  # one automaton, then several passes
        got = decontaminate.contamination(
            spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), automaton_chars=size
        ).collect()
        want = sorted((i, *brute(t, items)) for i, t in docs)
        assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == want
        assert any(r.n_hit for r in got)


def test_spans_are_offsets_of_the_original_text(spark):
    item = "One two three four five six seven eight nine ten eleven twelve thirteen"
    text = "Été! " + item.upper().replace(" ", " -- ") + ", and so on"
    docs = spark.createDataFrame([(1, text)], DOC)
    (row,) = decontaminate.contamination(docs, spark.createDataFrame([(7, item)], ITEM)).collect()
    (span,) = row.spans
    assert text[span.start : span.end] == item.upper().replace(" ", " -- ")


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 9)], DOC + ", n_words long")
    bench = spark.createDataFrame([], ITEM)
    (row,) = decontaminate.contamination(docs, bench, keep=("doc_id", "n_words")).collect()
    assert (row.n_words, row.n_hit, row["items"]) == (2, 0, [])
    assert decontaminate.contamination(spark.createDataFrame([], DOC), bench).count() == 0


def test_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op9_decontaminate(spark, sf).collect():
        n, hit, found = brute(texts[r.doc_id], items)
        sha = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(found), sha)
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
