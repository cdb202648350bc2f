"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from cabstar.llm import ann
from cabstar.llm.queries import op1_nearest

VEC = "vec_id long, embedding array<float>"


def brute(rows, k, every):
    ids, out = [i for i, _ in rows], {}
    vectors = np.array([v for _, v in rows], np.float32).astype(float)
    for q, v in zip(ids, vectors, strict=True):
        if q % every == 0:
            score = (vectors * v).sum(axis=1)
            best = sorted((-s, i) for s, i in zip(score, ids, strict=True) if i != q)[:k]
            out[q] = [(i, -s) for s, i in best]
    return out


def by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_query_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = by_query(op1_nearest(spark, sf)), brute(rows, 20, 20)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    assert recall(got, want) >= 0.95
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, found in got.items():
        for i, score in found:
            assert abs(score - vectors[q] @ vectors[i]) < 1e-12


def test_unequal_norms_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 5)).astype(np.float32).tolist()) for i in range(900)]
    rows += [(i, rows[3][1]) for i in range(1000, 1300)]  # a large group of equal vectors
    got = by_query(ann.nearest(spark.createDataFrame(rows, VEC).repartition(3), F.col("vec_id") % 20 == 0))
    want = brute(rows, 20, 20)
    assert recall(got, want) >= 0.95
    assert all(i != q for q, found in got.items() for i, _ in found)
    assert [i for i, _ in got[1000]][:2] == [i for i, _ in want[1000]][:2]


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.5, 0.5]), (4, None), (5, []), (40, [0.0, 0.0]), (60, [1.0, None]),
            (80, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (20, [0.5, 0.5])]
    table = spark.createDataFrame(rows, VEC).withColumn("node", F.lit("x")).withColumn("id", F.lit(1))
    got = by_query(ann.nearest(table, F.col("vec_id") % 20 == 0))
    assert got == {0: [(3, 0.5), (20, 0.5)], 20: [(0, 0.5), (3, 0.5)]}
    assert by_query(ann.nearest(table.limit(0), F.col("vec_id") % 20 == 0)) == {}


def test_every_vector_is_indexed_and_edges_are_diverse(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(500)]
    nodes = ann.distinct_vectors(ann.valid_vectors(spark.createDataFrame(rows, VEC)), 3)
    index = ann.build_index(nodes, shard_rows=20).collect()
    assert sorted(r.node for r in index) == list(range(500)) and len({r.shard for r in index}) == 25
    assert all(len(r.edges) <= ann.DEGREE and len(set(r.edges)) == len(r.edges) for r in index)


def test_recall_in_a_whole_shard():
    """30,000 vectors of clusters that are larger than the beam, in one shard."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((200, 16))
    vectors = (centres[rng.integers(0, 200, ann.SHARD_ROWS)] + 0.3 * rng.standard_normal((ann.SHARD_ROWS, 16))).astype(np.float32)
    edges, entries = ann.build_graph(vectors, alphas=(1.2,))
    queries = vectors[::100]
    found, _ = ann.beam_search(queries, vectors, edges, entries, ann.BEAM)
    want = np.argsort(-(queries @ vectors.T), axis=1)[:, :20]
    assert np.mean([len(set(a[:20]) & set(b)) / 20 for a, b in zip(found, want, strict=True)]) >= 0.9
