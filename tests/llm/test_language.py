"""Language identification: held-out accuracy and odd inputs."""

import math
import zlib
from collections import Counter

import pytest

from cabstar.llm import language
from cabstar.llm.queries import op4_language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(language.trainable(spark.read.parquet(f"{SF}/documents.parquet")))


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op4_language(spark, SF).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_sample_is_the_lowest_hashes_of_each_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and text is not null")
    docs = docs.union(docs.where("doc_id % 3 = 0"))  # repeated rows
    rows = docs.selectExpr("lang", "xxhash64(cast(doc_id as string)) as h", "text").collect()
    for n in (1, 37, 100_000):
        want = set()
        for x in {r.lang for r in rows}:
            want |= set(sorted({(r.h, r.lang, r.text) for r in rows if r.lang == x})[:n])
        got = language.sample(docs, "doc_id", "text", "lang", n).collect()
        assert {(r.h, r.lang, r.text) for r in got} == want and len(got) == len(want)


def test_prediction_equals_comparing_all_cosines(spark, model):
    """Vectors and cosines anew in plain Python, against every centroid."""

    def cosines(text):
        lower = text.lower().encode()
        lower = b" " + b" ".join(bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in lower).split()) + b" "
        counts = Counter()
        for n, odd in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
            for i in range(len(lower) - n + 1):
                counts[int.from_bytes(lower[i : i + n], "little") * odd % 2**32 >> 20] += 1
        vector = {g: math.log1p(c) * float(model.idf[g]) for g, c in counts.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        return [sum(v * float(centre[g]) for g, v in vector.items()) / norm for centre in model.centroids]

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 7 = 0 and n_chars < 5000").select("doc_id", "text")
    docs = docs.union(docs.where("doc_id % 2 = 0"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = language.identify(docs, model).collect()
    assert len(rows) == docs.count() > len(texts) > 100
    for r in rows:
        if language.has_letter(texts[r.doc_id]):
            every = cosines(texts[r.doc_id])
            assert abs(r.score - max(every)) < 1e-4
            assert any(x == r.lang_pred and c > max(every) - 1e-4 for x, c in zip(model.languages, every))
        else:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)


def test_odd_texts(spark, model):
    texts = [None, "", "123 --- !!", "²³", "a", "日本語", "x" * 200_000, "the and of " * 50_000, "\x00"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in language.identify(docs, model, keep=("doc_id", "score")).collect()}
    for i, t in enumerate(texts):
        assert (got[i].lang_pred == "und") == (t is None or not any(c.isalpha() for c in t))
    assert got[7].lang_pred == "en" and got[0].rejected and not got[4].rejected
    assert language.identify(docs.limit(0), model).count() == 0


def test_far_texts_are_rejected(spark, model):
    far = "zqxj kvwq zzkx qqjv xkzj wvqk " * 200
    docs = spark.createDataFrame([(1, far)], "doc_id long, text string")
    assert language.identify(docs, model).first().rejected


def test_fit_is_repeatable_and_handles_nothing(spark, model):
    docs = language.trainable(spark.read.parquet(f"{SF}/documents.parquet"))
    again = language.fit(docs.repartition(7))
    assert again.languages == model.languages and abs(again.centroids - model.centroids).max() < 1e-4
    empty = docs.limit(0)
    assert language.fit(empty) is None
    (row,) = language.identify(docs.limit(1), None).collect()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
    few = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([("aaa", "l1"), ("bbb", "l2"), (None, "l3"), ("ccc", None)])], "doc_id long, text string, lang string")
    assert sorted(language.fit(few).languages) == ["l1", "l2"]


def test_sparse_lengths_have_a_floor(spark, model):
    assert (model.floors > 0).all()
    texts = ["x" * 200_000, "zqxj kvwq zzkx qqjv xkzj wvqk " * 8_000, "qq zx jq vk"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.rejected for r in language.identify(docs, model).collect()] == [True] * 3


def test_short_cuts_of_labelled_texts_pass(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(language.held_out()).collect()
    for words in (1, 2, 4, 8):
        cuts = [(r.doc_id, " ".join((r.text or "").split()[20 : 20 + words])) for r in docs]
        cuts = [x for x in cuts if len(x[1].split()) == words and language.has_letter(x[1])]
        rows = language.identify(spark.createDataFrame(cuts, "doc_id long, text string"), model).collect()
        assert sum(r.rejected for r in rows) <= 0.02 * len(rows), words
