"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard.

Distinct vectors are dealt evenly into shards. In each, a graph starts from random edges;
a greedy search for every vector from the medoid proposes its neighbours, and robust
pruning keeps the nearest of them and drops those that lie closer (by the factor
``alpha``) to a kept one, so edges stay diverse; reverse edges are added and pruned alike.
A query runs a beam search in each shard, and the shards' finds, rescored in double
precision, are merged. All searches and prunings run on numpy arrays of many vectors.

Inner products are searched as distances: the graph is built on vectors lengthened by one
component that gives all of a shard the same norm.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstar.llm.common import operator, stored

DEGREE = 32
BEAM = 64
#: A shard's vectors are held in one task's memory, so this bounds it.
SHARD_ROWS = 30_000
LEAST_SHARDS = 16
#: Queries that meet a shard in one task.
QUERY_BLOCK = 20_000
#: Entry nodes of a graph, times the root of its size, and how many of them a search begins at.
ENTRIES, _FIRST = 4, 16
_STEP, _BATCH = 4, 256


def beam_search(queries, vectors, edges, entries, beam, need_seen=False):
    """Nodes of largest inner product for each query, best first (-1: none), and all it saw.

    A search begins at the best of the ``entries``. Each step expands the best ``_STEP``
    nodes of a beam that are not expanded yet.
    """
    q, n = len(queries), len(vectors)
    beam = min(beam, n)
    entries = np.asarray(entries)
    first = min(beam, len(entries), _FIRST)
    rows = np.arange(q)[:, None]
    ids = np.full((q, beam), -1, np.int64)
    score = np.full((q, beam), -np.inf, np.float32)
    done = np.ones((q, beam), bool)
    near = queries @ vectors[entries].T
    at = np.argpartition(-near, first - 1, axis=1)[:, :first]
    ids[:, :first], score[:, :first], done[:, :first] = entries[at], np.take_along_axis(near, at, 1), False
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True
    seen[rows, ids[:, :first]] = True
    expanded = []
    while not done.all():
        open_ = np.where(done, -np.inf, score)
        pick = np.argpartition(-open_, min(_STEP, beam) - 1, axis=1)[:, :_STEP]
        live = np.take_along_axis(~done, pick, 1)
        np.put_along_axis(done, pick, True, 1)
        at = np.where(live, np.take_along_axis(ids, pick, 1), n)
        expanded.append(at)
        new = edges[at].reshape(q, -1)
        new[seen[rows, new]] = n
        new.sort(axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = n
        new = new[:, : max(1, int((new < n).sum(axis=1).max()))]
        seen[rows, new] = True
        gain = np.matmul(vectors[np.minimum(new, n - 1)], queries[:, :, None])[:, :, 0]
        gain[new == n] = -np.inf
        all_score = np.concatenate([score, gain], axis=1)
        best = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
        score = np.take_along_axis(all_score, best, 1)
        ids = np.take_along_axis(np.concatenate([ids, new], axis=1), best, 1)
        done = np.take_along_axis(np.concatenate([done, gain == -np.inf], axis=1), best, 1)
    order = np.argsort(-score, axis=1, kind="stable")
    ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
    ids[score == -np.inf] = -1
    return ids, np.concatenate(expanded, axis=1) if need_seen else None


def robust_prune(points, candidates, vectors, degree, alpha):
    """Diverse near neighbours of each point; ``candidates`` and the result hold n for none."""
    n = len(vectors)
    candidates = np.sort(np.where(candidates == points[:, None], n, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = n
    held = vectors[np.minimum(candidates, n - 1)]
    own = vectors[points][:, None, :]
    far = ((held - own) ** 2).sum(axis=2)
    far[candidates == n] = np.inf
    order = np.argsort(far, axis=1, kind="stable")[:, : 4 * degree]
    far, candidates = np.take_along_axis(far, order, 1), np.take_along_axis(candidates, order, 1)
    held = np.take_along_axis(held, order[:, :, None], 1)
    norm = (held**2).sum(axis=2)
    between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(held, held.transpose(0, 2, 1))
    alive, rows = np.isfinite(far), np.arange(len(points))
    out = np.full((len(points), degree), n, np.int64)
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        out[some, k] = candidates[rows, first][some]
        alive &= alpha * alpha * between[rows, first] > far
        alive[rows, first] = False
    return out


def build_graph(vectors: np.ndarray, degree=DEGREE, beam=BEAM, alphas=(1.0, 1.2), seed=0):
    """Edges (n rows of ``degree``; n stands for none) and the entry nodes, the medoid first."""
    n = len(vectors)
    norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
    extra = np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]
    space = np.concatenate([vectors, extra], axis=1).astype(np.float32)
    entry = int(((space - space.mean(axis=0)) ** 2).sum(axis=1).argmin())
    rng = np.random.default_rng(seed)
    others = rng.permutation(n)[: ENTRIES * math.isqrt(n)]  # a cluster larger than the beam is entered as others are
    entries = np.concatenate([[entry], others[others != entry]])
    edges = np.full((n + 1, degree), n, np.int64)  # the last row has the edges of none
    if n > 1:
        edges[:n, : min(degree, n - 1) // 2 + 1] = rng.integers(0, n, (n, min(degree, n - 1) // 2 + 1))
    centre = 2 * space  # squared distance order is that of 2 x.q - |x|^2; norms are equal here
    for alpha in alphas:
        order = rng.permutation(n)
        for a in range(0, n, _BATCH):
            points = order[a : a + _BATCH]
            _, expanded = beam_search(centre[points], space, edges, entries, beam, need_seen=True)
            near = robust_prune(points, np.concatenate([expanded, edges[points]], axis=1), space, degree, alpha)
            edges[points] = near
            _add_reverse(points, near, edges, space, degree, alpha)
    return edges, entries


def _add_reverse(points, near, edges, space, degree, alpha):
    n = len(space)
    target, source = near.ravel(), np.repeat(points, near.shape[1])
    real = target < n
    order = np.argsort(target[real], kind="stable")
    target, source = target[real][order], source[real][order]
    nodes, begin, count = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(begin, count)
    more = np.full((len(nodes), int(count.max(initial=0))), n, np.int64)
    more[np.repeat(np.arange(len(nodes)), count), place] = source
    for a in range(0, len(nodes), _BATCH):
        some = nodes[a : a + _BATCH]
        edges[some] = robust_prune(some, np.concatenate([edges[some], more[a : a + _BATCH]], axis=1), space, degree, alpha)


def _is_vector(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0)


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Distinct (id, v) of the vectors that take part."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    return rows.where(F.col("id").isNotNull() & F.coalesce(_is_vector(F.col("v")), F.lit(False))).distinct()


def distinct_vectors(rows: DataFrame, members: int) -> DataFrame:
    """(node, v, ids): each distinct vector with its ``members`` smallest ids; node is the smallest."""
    low = Window.partitionBy("v").orderBy("id")  # limited to these ids before the shuffle already
    few = rows.withColumn("n", F.row_number().over(low)).where(F.col("n") <= members)
    found = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return found.select(F.col("ids")[0].alias("node"), "v", "ids")


@operator
def build_index(nodes: DataFrame, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BEAM) -> DataFrame:
    """One graph for each shard: shard, place, node, ids, v, edges, entry. Every vector is indexed.

    Vectors of different lengths lie in different shards.
    """
    shards = max(LEAST_SHARDS, -(-nodes.count() // shard_rows))
    dealt = nodes.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", ignore_index=True)
        vectors = np.array(group["v"].tolist(), np.float32)
        edges, entries = build_graph(vectors, degree, beam, seed=int(group["shard"].iloc[0]))
        group["place"] = np.arange(len(group))
        group["entry"] = group["place"].isin(entries)
        group["edges"] = [e[e < len(group)].astype(np.int32) for e in edges[:-1]]
        return group[["dim", "shard", "place", "node", "ids", "v", "edges", "entry"]]

    kind = nodes.schema["v"].dataType.simpleString()
    schema = f"dim int, shard int, place int, node long, ids array<long>, v {kind}, edges array<int>, entry boolean"
    dealt = dealt.repartition(4 * shards, "dim", "shard")  # a number given isn't coalesced: shards stay in tasks of their own
    return dealt.groupBy("dim", "shard").applyInPandas(build, schema)


@operator
def search(
    index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM, block: int = QUERY_BLOCK, degree: int = DEGREE
) -> DataFrame:
    """For queries (node, v): ``found``, the k nearest (score, id) of all shards, best first.

    Queries go in blocks, each to every shard; a task holds one shard and one block.
    """
    blocks = max(1, -(-queries.count() // block))
    places = index.select(F.col("dim").alias("d"), F.col("shard").alias("s")).distinct()
    at = queries.select("node", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block"))
    at = at.join(F.broadcast(places), F.col("dim") == F.col("d"))  # one row for each shard
    at = at.select("d", "s", F.col("block").alias("b"), "node", "v")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    key = ["dim", "shard", "block"]

    def run(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"node": pd.Series(dtype="int64"), "score": pd.Series(dtype=object), "id": pd.Series(dtype=object)})
        if not len(shard) or not len(asked):
            return none
        shard = shard.sort_values("place", ignore_index=True)
        exact = np.array(shard["v"].tolist(), np.float64)
        vectors, n = exact.astype(np.float32), len(shard)
        edges = np.full((n + 1, degree), n, np.int64)
        for i, e in enumerate(shard["edges"]):
            edges[i, : len(e)] = e
        ids, entries, out = shard["ids"].tolist(), np.flatnonzero(shard["entry"]), []
        wanted = np.array(asked["v"].tolist(), np.float64)
        for a in range(0, len(asked), _BATCH):
            part = wanted[a : a + _BATCH]
            near, _ = beam_search(part.astype(np.float32), vectors, edges, entries, max(beam, k))
            for q, row, node in zip(part, near, asked["node"].iloc[a : a + _BATCH], strict=True):
                row = row[row >= 0]
                score = (exact[row] * q).sum(axis=1)
                best = sorted((-s, i) for s, r in zip(score.tolist(), row.tolist(), strict=True) for i in ids[r])[:k]
                out.append((int(node), [-s for s, _ in best], [i for _, i in best]))
        found = pd.DataFrame(out, columns=["node", "score", "id"])
        return found if len(found) else none

    tables = index.select(*key[:2], "place", "ids", "v", "edges", "entry", every), at
    pairs = tables[0].groupBy(key).cogroup(tables[1].groupBy("d", "s", "b"))
    found = pairs.applyInPandas(run, "node long, score array<double>, id array<long>")
    rows = found.select("node", F.inline(F.arrays_zip("score", "id")))
    best = Window.partitionBy("node").orderBy(F.desc("score"), "id")
    rows = rows.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    ranked = F.array_sort(F.collect_list(F.struct("n", "score", "id")))
    return rows.groupBy("node").agg(F.transform(ranked, lambda x: F.struct(x["score"], x["id"])).alias("found"))


@operator
def nearest(
    table: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = BEAM,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The k rows of largest inner product for every row for which ``queries`` holds.

    Returns query_id, rank (from 1), the found id and score (inner product in double
    precision); all but the query's own id are candidates, ties go to the smaller id.
    Vectors null, empty, zero or with null or non-finite components take no part; rows
    without an id neither; vectors meet those of their own length only. Equal rows count
    once. Equal vectors are one node of the graph, which stands for all their rows.
    """
    rows = stored(valid_vectors(table, id_col, vector_col), "ann-vectors")
    nodes = stored(distinct_vectors(rows, k + 1), "ann-nodes")
    index = stored(build_index(nodes, shard_rows, beam=beam), "ann-index")
    asked = rows.withColumnRenamed("id", id_col).where(queries).withColumnRenamed(id_col, "query_id")
    asked = stored(asked.join(nodes.select("v", "node"), "v").select("query_id", "node"), "ann-queries")
    vectors = nodes.join(asked.select("node").distinct(), "node", "left_semi").select("node", "v")
    found = asked.join(search(index, vectors, k + 1, beam), "node")
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = found.select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias(id_col), F.col("x.score").alias("score"))
