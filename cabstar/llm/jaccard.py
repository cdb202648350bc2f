"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A document is its set of word shingles, hashed to 64 bits. In one global order of shingles
(rarest first, by a sketch of their counts over all documents), two sets of Jaccard t or
more share a shingle among the first ``n - ceil(t n) + 1`` of each, and the first one they share
stands near enough to the front of both to leave room for the rest. Documents with the same
prefix and size form a group (exact copies always do); groups that share a prefix shingle
in such places are pairs; pairs are expanded to members. Their counts of shingles by bucket bound
how many two sets can share; pairs within that bound have their whole sets compared.

The result needs components, not all links within them. So each member is first compared
with one hub of each of its shingles; after that only pairs whose ends lie in different
components are left, and all of these are compared. No link between components is lost,
and a large group of near copies costs a few comparisons a member, not one for each pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstar.llm.common import map_rows, operator, stored
from cabstar.llm.components import components
from cabstar.sources.sinks import scratch_scope

#: A-Z lower-cased, and which bytes belong to words (all but white space).
_CHARS = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_IN_WORD = np.array([not (c == 32 or 9 <= c <= 13) for c in range(256)])
#: Buckets of the count sketch, and how many of them travel together.
BUCKETS_LOG2, CHUNK = 22, 4096
#: Buckets that bound the overlap of two sets.
OVERLAP_LOG2 = 6
_random = np.random.default_rng(10)
#: Nodes whose ids (16 bytes each) are broadcast to find their texts; beyond that texts are shuffled by id.
SENT_NODES = 1 << 20
#: An odd factor for each place in a word; longer words are hashed on their own.
_PLACES = 64
_FACTORS = _random.integers(1 << 62, 1 << 63, _PLACES, np.uint64) | np.uint64(1)
_MIX = _random.integers(1 << 62, 1 << 63, 64, np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _MIX[62]
    x = (x ^ x >> np.uint64(29)) * _MIX[63]
    return x ^ x >> np.uint64(32)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the runs without ASCII white space, A-Z lower-cased, in order."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    chars, at = _CHARS[raw], np.flatnonzero(_IN_WORD[raw])  # at: characters of words
    if not len(at):
        return np.zeros(0, np.uint64)
    first = np.flatnonzero(np.append(True, np.diff(at) > 1))  # where words begin, among these
    sizes = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    values = chars[at].astype(np.uint64) * _FACTORS[np.minimum(place, _PLACES - 1)]
    hashes = np.add.reduceat(values, first) + sizes.astype(np.uint64) * _MIX[61]
    for i in np.flatnonzero(sizes > _PLACES).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(chars[at[first[i]] : at[first[i]] + sizes[i]].tobytes())
    return _mixed(hashes)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` words in a row; of all words, if they are fewer."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(size, len(h))
    total = np.full(len(h) - k + 1, _MIX[60 - k], np.uint64)
    for i in range(k):
        total += h[i : len(h) - k + 1 + i] * _MIX[i]
    total = np.sort(_mixed(total))
    return total[np.append(True, total[1:] != total[:-1])]


def overlap_counts(shingles: np.ndarray) -> bytes:
    """Shingles by bucket, 255 at most (which then says nothing)."""
    counts = np.bincount(shingles & np.uint64((1 << OVERLAP_LOG2) - 1), minlength=1 << OVERLAP_LOG2)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def may_be_similar(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether rows of bucket counts leave room for the overlap that similar sets must have."""
    most = np.minimum(a, b).astype(np.int64).sum(axis=1)
    full = (a == 255).any(axis=1) | (b == 255).any(axis=1)
    return full | (100 * most >= percent * (n + m - most))


def set_id(shingles: np.ndarray) -> int | None:
    """Hash of a set (null for the empty one); equal sets are one node of the join."""
    return int(xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)) if len(shingles) else None


def prefix_length(n, percent: int):
    return n - -(-percent * n // 100) + 1


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _room(n: str, m: str, at: str, to: str, percent: int):
    """Whether sets of sizes n and m can be similar if their first common shingle is at these places.

    They share no more than what is left from there on. Of the shingles that two prefixes
    share the first one passes if the sets are similar, so every similar pair is kept.
    """
    left = F.least(F.col(n) - F.col(at), F.col(m) - F.col(to))
    return (100 + percent) * left >= percent * (F.col(n) + F.col(m))


def nodes_and_counts(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """A row for each document (id, hash of its text, node, n) and, from each task, its counts by bucket."""
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKETS_LOG2, np.uint32)
        names = ["id", "h", "node", "n", "chunk", "counts"]
        seen = False
        for batch in (whole.slice(a, 1000) for whole in batches for a in range(0, whole.num_rows, 1000)):
            seen = True
            nodes, sizes, held = [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(text, size)
                nodes.append(set_id(s))
                sizes.append(len(s))
                held.append(s)
            bucket, times = np.unique(np.concatenate(held) >> np.uint64(64 - BUCKETS_LOG2), return_counts=True)
            counts[bucket] += times.astype(np.uint32)
            null = [pa.nulls(len(nodes), pa.int32()), pa.nulls(len(nodes), pa.binary())]
            made = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made, *null], names=names)
        if seen:
            pack = zstandard.ZstdCompressor(1).compress
            parts = [pack(c.tobytes()) for c in counts.reshape(-1, CHUNK)]
            null = [pa.nulls(len(parts), batch.column(0).type), *(pa.nulls(len(parts), pa.int64()) for _ in range(3))]
            made = [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays([*null, *made], names=names)

    schema = f"id {kind}, h long, node long, n long, chunk int, counts binary"
    return docs.select(id_col, F.xxhash64(text_col), text_col).mapInArrow(rows, schema)


def rarity(rows: DataFrame) -> bytes:
    """A level for each bucket, from its count in all documents; always 2 ** BUCKETS_LOG2 bytes.

    The tasks' counts are added up as they stream by, chunk by chunk.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, sums = zstandard.ZstdDecompressor().decompress, {}
        for batch in batches:
            for chunk, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = np.frombuffer(unpack(part), np.uint32)
                sums[chunk] = sums.get(chunk, 0) + counts.astype(np.uint64)
        levels = [np.minimum(8 * np.log2(s + 1.0), 255).astype(np.uint8).tobytes() for s in sums.values()]
        made = [pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())]
        yield pa.RecordBatch.from_arrays(made, names=["chunk", "levels"])

    parts = rows.where("chunk is not null").select("chunk", "counts").repartition("chunk")
    levels = np.zeros((1 << BUCKETS_LOG2) // CHUNK, f"V{CHUNK}")
    for r in parts.mapInArrow(add, "chunk int, levels binary").collect():
        levels[r["chunk"]] = np.void(bytes(r["levels"]))
    return levels.tobytes()


def prefixes(docs: DataFrame, text_col: str, levels: bytes, size: int, percent: int) -> DataFrame:
    """Each document's node, size, prefix and group; a group is a prefix and a size."""

    def rows():
        level = np.frombuffer(levels, np.uint8)

        def row(text):
            s = shingle_set(text, size)
            if not len(s):
                return None, None, None, None, None
            rare = np.argsort(level[s >> np.uint64(64 - BUCKETS_LOG2)], kind="stable")
            prefix = s[rare[: prefix_length(len(s), percent)]]
            group = xxhash.xxh3_64_intdigest(prefix.tobytes(), seed=len(s)) - (1 << 63)
            return set_id(s), len(s), group, prefix.view(np.int64), overlap_counts(s)

        return row

    schema = "node long, n long, group long, prefix array<long>, overlap binary"
    return map_rows(docs, rows, schema, (text_col,)).where("node is not null")


def _texts(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Compressed texts of the nodes of ``pairs``, one for each node; no other text is moved."""
    one = F.min(F.struct("id", "h")).alias("one")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stored(nodes.join(ends, "node").groupBy("node").agg(one).select("node", "one.*"), "jaccard-wanted")
    rows = wanted.select(F.col("node"), F.col("id").alias("id_"), F.col("h").alias("h_"))
    rows = F.broadcast(rows) if wanted.count() <= SENT_NODES else rows
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    found = texts.join(rows, F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_")))

    def packed():
        pack = zstandard.ZstdCompressor(3).compress
        return lambda text: (pack(text.encode("utf-8", "surrogatepass")),)

    found = map_rows(found, packed, "packed binary", ("text",), ("node",))
    return stored(found.groupBy("node").agg(F.min("packed").alias("packed")), "jaccard-texts")


def verified(
    pairs: DataFrame, members: DataFrame, texts_of: Callable[[DataFrame], DataFrame], size: int, percent: int
) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar; ``texts_of(pairs)`` has the texts of their nodes."""
    counts = members.groupBy("node").agg(F.first("n").alias("n"), F.first("overlap").alias("overlap"))
    counted = pairs.join(counts.toDF("a", "n", "counts_a"), "a").join(counts.toDF("b", "m", "counts_b"), "b")

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(i).to_numpy() for i in (2, 3))
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(len(n), -1) for i in (4, 5))
                keep = pa.array(may_be_similar(a, b, n, m, percent))
                yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(keep)

    counted = counted.select("a", "b", "n", "m", "counts_a", "counts_b").mapInArrow(possible, "a long, b long")
    pairs = stored(counted, "jaccard-pairs")

    texts = texts_of(pairs)
    a = texts.select(F.col("node").alias("a"), F.col("packed").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("packed").alias("text_b"))

    def rows():
        unpack = zstandard.ZstdDecompressor().decompress
        last: dict[str, tuple] = {}

        def shingles(side, packed):
            if last.get(side, (None,))[0] != packed:  # rows of one hub follow each other
                last[side] = packed, shingle_set(unpack(packed).decode("utf-8", "surrogatepass"), size)
            return last[side][1]

        def row(x, y):
            return (similar(shingles("a", x), shingles("b", y), percent),)

        return row

    both = pairs.join(a, "a").join(b, "b")
    found = map_rows(both, rows, "ok boolean", ("text_a", "text_b"), ("a", "b"))
    return found.where("ok").select("a", "b")


def _named(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, hub_rounds: int) -> DataFrame:
    """id, h, node, n and comp (a node of the component, the same for all of it) of each document."""
    nodes = stored(nodes_and_counts(docs, id_col, text_col, size), "jaccard-nodes")
    levels = rarity(nodes)
    nodes = nodes.where("chunk is null").select("id", "h", "node", "n")
    members = stored(prefixes(docs, text_col, levels, size, percent), "jaccard-prefixes")
    member = members.select("group", "node").distinct()
    groups = members.groupBy("group").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    tokens = groups.select("group", "n", F.posexplode("prefix").alias("at", "token"))

    # prefix shingles of two groups or more; the others link nothing
    of_token = tokens.groupBy("token").count().where("count > 1").select("token")
    tokens = stored(tokens.join(of_token, "token"), "jaccard-tokens")
    inner = member.groupBy("group").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    grouped = tokens.select("group").union(inner.select("group")).distinct()
    member = stored(member.join(grouped, "group", "left_semi"), "jaccard-members")
    own = inner.select("group", F.col("group").alias("hub"))

    def similar_pairs(pairs: DataFrame) -> DataFrame:
        return verified(pairs, members, lambda found: _texts(docs, id_col, text_col, nodes, found), size, percent)

    def expanded(pairs: DataFrame) -> DataFrame:
        """Members of the first group with the smallest member of the hub's."""
        centre = member.groupBy("group").agg(F.min("node").alias("b")).withColumnRenamed("group", "hub")
        found = pairs.join(member.withColumnRenamed("node", "a"), "group").join(centre, "hub").where("a <> b")
        return found.select("a", "b").distinct()

    rows = tokens.withColumns({"low": F.lit(None).cast("long"), "high": F.lit(None).cast("long")})
    links = stored(similar_pairs(expanded(_hubs(rows, 0, percent).union(own))), "jaccard-links")
    comp = components(links)
    for round_ in range(1, hub_rounds):
        rows, own = _open(tokens, inner, member, comp)
        pairs = expanded(_hubs(rows, round_, percent).union(own.select("group", F.col("group").alias("hub"))))
        more = _contracted(similar_pairs(_across(pairs, comp)), comp)
        links = stored(more.union(comp.select(F.col("node").alias("a"), F.col("comp").alias("b"))), "jaccard-links")
        comp = components(links)

    # all pairs that are left: both ends share a prefix shingle or group, in different components
    rows, own = _open(tokens, inner, member, comp)
    left, right = rows.toDF("token", "g", "n", "at", "low", "high"), rows.toDF("token", "h", "m", "to", "low_", "high_")
    apart = ~_one_component("low", "high", "low_", "high_")
    pairs = left.join(right, "token").where(F.col("g") < F.col("h")).where(apart & _room("n", "m", "at", "to", percent))
    pairs = pairs.select("g", "h").distinct().union(own.select("group", "group"))
    ends = _labelled(member, comp, "node", "comp").select("group", "node", "comp")
    pairs = pairs.join(ends.toDF("g", "a", "comp_a"), "g").join(ends.toDF("h", "b", "comp_b"), "h")
    pairs = pairs.where("comp_a <> comp_b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _contracted(similar_pairs(pairs.distinct()), comp)
    comp = components(stored(more.union(comp.toDF("a", "b")), "jaccard-links"))

    named = nodes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return stored(named, "jaccard-named", lasting=True)


@operator
def similar_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    hub_rounds: int = 2,
) -> DataFrame:
    """Components of documents linked by Jaccard similarity of their word shingles.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of their sets of
    ``size`` words in a row (of all words, if they are fewer). Returns a row for each input
    row: the id, ``h`` (hash of its text), ``n_shingles``, ``component_id`` (smallest id
    reachable by links) and ``stays`` (whether the row is the one of its component with the
    smallest id, then hash). Null texts and texts without words have 0 shingles and their
    own id, and stay. Rows of equal id are separate documents; a null id is never the
    smallest of others.
    """
    with scratch_scope(docs.sparkSession):
        named = _named(docs, id_col, text_col, size, percent, hub_rounds)
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("first")
    least = named.where("node is not null").groupBy("comp").agg(F.min("id").alias("least"), least)
    own = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h"))
    return named.join(least, "comp", "left").select(
        F.col("id").alias(id_col),
        "h",
        F.col("n").alias("n_shingles"),
        F.coalesce("least", "id").alias("component_id"),
        F.when(F.col("node").isNull(), True).otherwise(own).alias("stays"),
    )


def _labelled(rows: DataFrame, comp: DataFrame, node: str, label: str) -> DataFrame:
    found = rows.join(comp.toDF(node, label), node, "left")
    return found.withColumn(label, F.coalesce(label, node))


def _across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    return _labelled(_labelled(pairs, comp, "a", "comp_a"), comp, "b", "comp_b").where("comp_a <> comp_b").select("a", "b")


def _contracted(links: DataFrame, comp: DataFrame) -> DataFrame:
    """Links between the components of their ends."""
    found = _labelled(_labelled(links, comp, "a", "comp_a"), comp, "b", "comp_b")
    return found.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct()


def _one_component(low: str, high: str, low_: str, high_: str) -> Column:
    """Whether all members of two groups lie in one component; no if that isn't known."""
    return F.coalesce((F.col(low) == F.col(high)) & (F.col(low_) == F.col(high_)) & (F.col(low) == F.col(low_)), F.lit(False))


def _hubs(rows: DataFrame, round_: int, percent: int) -> DataFrame:
    """Group and hub group of every token; a hub of its own for each token and round.

    The first round's hub has the token nearest to its front, which leaves most room.
    """
    rank = F.xxhash64("token", "group", F.lit(round_)) if round_ else F.col("at") / F.col("n")
    hub = {"rank": rank, "hub": "group", "m": "n", "to": "at", "low_": "low", "high_": "high"}
    hub = F.min(F.struct(*((F.col(c) if isinstance(c, str) else c).alias(k) for k, c in hub.items())))
    hub = rows.groupBy("token").agg(hub.alias("hub")).select("token", "hub.*")
    near = rows.join(hub, "token").where("group <> hub").where(~_one_component("low", "high", "low_", "high_"))
    return near.where(_room("n", "m", "at", "to", percent)).select("group", "hub").distinct()


def _open(tokens: DataFrame, inner: DataFrame, member: DataFrame, comp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the prefix shingles, and groups, whose members lie in two components or more.

    Rows carry the smallest and largest component of their group, ``low`` and ``high``.
    """
    of_group = _labelled(member, comp, "node", "comp").groupBy("group")
    of_group = of_group.agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    rows = tokens.join(of_group, "group").select(*tokens.columns, "low", "high")
    of_token = rows.groupBy("token").agg(F.min("low").alias("lowest"), F.max("high").alias("highest"))
    rows = rows.join(of_token.where("lowest <> highest").select("token"), "token", "left_semi")
    return rows, inner.select("group").join(of_group.where("low <> high"), "group", "left_semi")


@operator
def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """The documents, one of each component: that of the smallest id (then of the text's hash).

    Documents without words all stay. Of rows equal in id and text one stays.
    """
    found = similar_components(docs, id_col, text_col, size, percent)
    stays = found.where("stays").groupBy(id_col, "h").count().toDF("id_", "h_", "rows_")
    again = bool(stays.where("rows_ > 1").head(1))
    hashed = docs.withColumn("h_", F.xxhash64(text_col)).alias("d")
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("s.id_")) & (F.col("d.h_") == F.col("s.h_"))
    kept = hashed.join(stays.alias("s"), same, "left_semi")
    return (kept.dropDuplicates([id_col, "h_"]) if again else kept).drop("h_")
