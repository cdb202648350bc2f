"""The Jaccard join and components against comparing every pair of documents."""

import random

from cabstar.llm import jaccard
from cabstar.llm.components import components
from cabstar.llm.queries import op10_jaccard

DOC = "doc_id long, text string"


def shingles(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in lower.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(docs, size, percent):
    sets = [shingles(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((key, len(sets[i]), least.get(find(i))) for i, (key, _) in enumerate(docs)), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "x,", "Y"]
    base = [rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 12, 30, 60, 90])) for _ in range(10)]
    docs = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(3)] = rng.choices(vocabulary, k=rng.randrange(3))
        docs.append((i, rng.choice([" ", "\n"]).join(w)))
    rng.shuffle(docs)
    return docs


def run(spark, docs, size, percent, **options):
    table = spark.createDataFrame(docs, DOC).repartition(4)
    found = jaccard.similar_components(table, size=size, percent=percent, **options)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)


def test_equals_brute_force(spark):
    for seed, size, percent, rounds in ((1, 3, 90, 2), (2, 5, 80, 1), (3, 2, 60, 2)):
        docs = corpus(seed) + [(500, None), (501, ""), (502, " \n\t"), (503, "W1"), (504, "w1"), (505, "w " * 30_000)]
        assert run(spark, docs, size, percent, hub_rounds=rounds) == brute(docs, size, percent)


def test_chains_join_and_repeated_rows_stay(spark):
    words = [f"v{i}" for i in range(100)]
    chain = []
    for step in range(15):  # each is near the one before, the ends are far apart
        chain.append((100 - step, " ".join(words)))
        words[step * 6] = f"new{step}"
    docs = [*chain, chain[0], (None, chain[3][1]), (7, "quite another text")]
    assert run(spark, docs, 3, 90) == brute(docs, 3, 90)


def test_empty_table(spark):
    assert run(spark, [], 3, 90) == []
    assert run(spark, [(1, None)], 3, 90) == [(1, 0, 1)]


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1200)]
    found = components(spark.createDataFrame(path + star, "a long, b long"))
    got = {r.node: r.comp for r in found.collect()}
    assert got == {**dict.fromkeys(range(1, 301), 0), **dict.fromkeys(range(1001, 1200), 1000)}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op10_jaccard(spark, sf).collect()), key=str)
    assert got == brute(docs, 3, 90)


def test_nul_is_a_character_of_words(spark):
    docs = [(1, "a\x00b c"), (2, "a b c"), (3, "A\x00B  c"), (4, "\x00"), (5, "\x00\x00"), (6, "x" * 70 + "\x00y"), (7, "\x00a")]
    assert run(spark, docs, 3, 90) == brute(docs, 3, 90)


def test_one_of_each_keeps_documents_without_words(spark):
    rows = [(5, ""), (6, None), (7, " "), (8, "some words"), (9, "Some words"), (None, None)]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([*rows[:4], rows[5]], key=str)
