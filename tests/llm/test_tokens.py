"""Token operators against the tokenizers library, plain greedy matching and round trips."""

import hashlib
import json
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cabstar.llm import bpe, simple8b, wordpiece
from cabstar.llm.queries import op6_bpe, op8_token_files

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n", "a", " a", "a ", "a  b", "a \n b", "a\nb c\td", "  lead", "trail  \n", "don't WE'LL it's 's",
    "<|endoftext|>", "x<|startoftext|>y <|endoftext|> z", "<|endoftext|", "Straße ÀÉÎ ŒUVRE İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ",
    "été Å ́x", "日本語のテキスト、です。", "🙂🙃 👩‍👩‍👧 ​ 　x", "a\x1cb \x1f c\x85d\xa0e",
    "12345 3.14 1,000", "q" * 300, "xq" * 200, "a" * 700, "�﻿\x00\x01", "!!!??? --- ...", "\r\n\r\n x\r",
]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    letters = "aAeEoOtThHsSéÉßñ'’.,;:!?-_()0123456789 \n\t    日🙂xqzjkw"
    return ["".join(rng.choices(letters, k=rng.randrange(120))) for _ in range(n)]


def documents(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


def test_bpe_equals_the_library(spark):
    library, own = Tokenizer.from_file(WORDS), bpe.coder(WORDS)
    for text in ODD + random_texts(2000) + documents(spark):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert list(own.encode(text)) == want, text
        assert own.decode(want).decode() == library.decode(want, skip_special_tokens=False)


def test_cuts_are_only_where_no_token_spans_them():
    own = bpe.coder(WORDS)
    word = "xqzjkqqxzvbq"
    fragments = own.cut(word)
    assert len(fragments) > 2 and "".join(fragments) == word + own.suffix
    for a, b in zip(fragments, fragments[1:], strict=False):
        assert not any(a[-1] + b[0] in t for t in own.vocab)


def test_bpe_operator_and_query(spark):
    rows = [(1, "The cat", 5), (1, "The cat", 5), (2, None, 6), (None, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = bpe.encode_texts(docs, WORDS, keep=("doc_id", "n_tokens")).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 0), (1, 2), (1, 2), (2, 0)]
    assert bpe.encode_texts(docs.limit(0), WORDS).count() == 0
    library = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op6_bpe(spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def greedy(word, vocabulary):
    n, longest = 0, max(map(len, vocabulary))
    while word:
        size = next((k for k in range(min(longest, len(word)), 0, -1) if word[:k] in vocabulary), 0)
        if not size:
            return -1
        word, n = word[size:], n + 1
    return n


def test_automaton_equals_greedy_matching():
    rng = random.Random(1)
    for _ in range(300):
        vocabulary = {bytes(rng.choices(b"abc", k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 12))}
        automaton = wordpiece.LongestMatch(sorted(vocabulary))
        for _ in range(30):
            word = bytes(rng.choices(b"abcd" if rng.random() < 0.2 else b"abc", k=rng.randrange(10)))
            assert automaton.count(word) == greedy(word, vocabulary), (word, vocabulary)


def test_token_counts_of_whole_texts(spark):
    letters = {c: b for b, c in enumerate(wordpiece.byte_letters())}
    with open(BYTES, encoding="utf-8") as f:
        vocabulary = {bytes(letters[c] for c in t) for t in json.load(f)["model"]["vocab"]}
    texts = ODD + random_texts(100) + documents(spark)[:60]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in wordpiece.token_counts(docs, BYTES).collect():
        words = [w for w in wordpiece.WHITE_SPACE.split(texts[r.doc_id] or "") if w]
        assert r.n_words == len(words) and r.n_unknown == 0
        assert r.n_tokens == sum(greedy(b" " + w.encode(), vocabulary) for w in words)
    few = wordpiece.Counter([b" a", b"b"])
    assert few.count("ab abb x") == (1 + 1 + 1 + 1 + 1 + 1, 3, 1)
    assert wordpiece.token_counts(docs.limit(0), BYTES).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_simple8b_round_trip(seed):
    rng = np.random.default_rng(seed)
    for n in (0, 1, 2, 59, 60, 61, 239, 240, 241, 5000, 70_000):
        ids = (2.0 ** rng.uniform(0, rng.integers(1, 33), n)).astype(np.uint32)
        ids[rng.random(n) < 0.3] = 0
        if seed == 0:
            ids[:] = 0
        block = simple8b.pack(ids)
        assert (simple8b.unpack(block) == ids).all()
        for _ in range(5):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert (simple8b.unpack(block, a, b) == ids[a:b]).all()
    assert len(simple8b.pack(np.zeros(24_000, np.uint32))) < 2000


def test_word_encoder_equals_the_library(spark):
    library, own = Tokenizer.from_file(BYTES), simple8b.encoder(BYTES)
    texts = ODD + random_texts(2000) + documents(spark)
    for size in (1, 7, len(texts)):
        for a in range(0, len(texts), size):
            for text, ids in zip(texts[a : a + size], own.encode(texts[a : a + size]), strict=True):
                want = library.encode(text or "", add_special_tokens=False).ids
                assert np.frombuffer(ids, "<u4").tolist() == want, text


def test_token_files(spark, scratch):
    library = Tokenizer.from_file(BYTES)
    texts = ODD + random_texts(200)
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, "no id", 0), (7, "again", 0), (7, "again", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(5)
    simple8b.write_tokens(docs, f"{scratch}/t", BYTES, block_ids=50)
    got = simple8b.read_tokens(spark, f"{scratch}/t").orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    start = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(r.ids)) and ids[-1] == 0
        start += len(ids)
        if r.doc_id not in (None, 7):
            assert ids[:-1].tolist() == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
    empty = docs.limit(0)
    simple8b.write_tokens(empty, f"{scratch}/e", BYTES)
    assert simple8b.read_tokens(spark, f"{scratch}/e").count() == 0


def test_token_file_query(spark):
    library, start = Tokenizer.from_file(BYTES), 0
    got = {r.doc_id: r for r in op8_token_files(spark, SF).collect()}
    for i, text in enumerate(documents(spark)):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        want = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == want
        start += len(ids)
