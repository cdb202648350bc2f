"""Every stage of the pipeline against a brute-force version on the stage's own input."""

import sys
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from cabstar.llm import language  # noqa: E402
from cabstar.llm.stages import COLUMNS  # noqa: E402
from tests.llm.test_decontaminate import brute as brute_hits  # noqa: E402
from tests.llm.test_jaccard import shingles  # noqa: E402
from tests.llm.test_lines import brute as brute_lines  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def passed(spark):
    """Input rows of each stage by doc_id, and the last stage's result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    inputs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        inputs.append({r.doc_id: r for r in docs.collect()})
        docs = stage(spark, docs, SF)
    return inputs, {r.doc_id: r for r in docs.collect()}


def test_stages_and_columns(passed):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_duplicates", "decontamination", "tokens"]
    for rows in passed[0]:
        assert rows and all(set(r.asDict()) == set(COLUMNS) for r in rows.values())


def test_language_keeps_clean_documents(spark, passed):
    before, after = passed[0][0], passed[0][1]
    assert len(after) >= 0.98 * len(before)
    assert all(after[i] == before[i] for i in after)
    assert all(language.has_letter(r.text) for r in after.values())


def test_line_dedup(passed):
    before, after = passed[0][1], passed[0][2]
    want = brute_lines([(i, before[i].text) for i in sorted(before)], least=1)
    for i, row in before.items():
        text, left = want[i, row.text]
        if text == row.text or left:
            assert after[i].text == text and after[i].n_chars == len(text) and after[i].source == row.source
        else:
            assert i not in after


def test_near_duplicates(passed):
    before, after = passed[0][2], passed[0][3]
    sets = {i: shingles(r.text, 5) for i, r in before.items()}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert set(after) == {i for i in sets if find(i) == i}
    assert all(after[i] == before[i] for i in after)


def test_decontamination(spark, passed):
    before, after = passed[0][3], passed[0][4]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, row in before.items():
        n, hit, _ = brute_hits(row.text, items)
        assert (i in after) == (not (hit > 0 and 20 * hit >= n))


def test_tokens(passed):
    before, result = passed[0][4], passed[1]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert set(result) == set(before)
    for i, row in result.items():
        assert row.n_tokens == len(library.encode(before[i].text, add_special_tokens=False).ids)


def test_run_gives_the_same(spark, passed):
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()} == {
        i: r.ids_sha256 for i, r in passed[1].items()
    }


def test_repeated_rows_and_empty_input(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the same words here twice over", "en", "s", 30)] * 2 + [(None, None, None, None, None)]
    near = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert near(spark, spark.createDataFrame(rows, schema), SF).count() == 2
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], schema), SF).count() == 0


def test_documents_that_arrive_twice_keep_their_new_lines(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = {1: "Header\nshared words here", 2: "Header\nunique", 3: "Header", None: "Header\nunique\nthird"}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items() for _ in range(2)], schema)
    stages = dict(corpus_pipeline.STAGES)
    got = stages["line_dedup"](spark, docs, SF)
    want = {None: "Header\nunique\nthird", 1: "shared words here"}  # null ids come first
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([*want.items()] * 2, key=str)
    assert sorted((r.doc_id for r in stages["near_duplicates"](spark, got, SF).collect()), key=str) == [1, None]


def test_documents_of_new_single_words_stay(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = ["words of the day\nand some more", "words of the day\napple\n日本語の文章です\npear", "words of the day\nPear", "words of the day\n--"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], schema)
    got = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SF).collect()}
    assert got == {0: texts[0], 1: "apple\n日本語の文章です\npear"}
