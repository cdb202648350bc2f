"""Language identification by nearest centroid.

A text becomes the TF-IDF vector of its hashed byte bigrams and trigrams (lower-cased, runs
of other ASCII as one space), normalised to length 1. Each language has several centroids,
found by spherical k-means over a bounded sample of its labelled texts. A text gets the
language of the centroid of largest cosine, and is rejected if that cosine lies far below
what labelled texts of its length have.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cabstar.llm.common import operator, stored

#: Size of the hashed n-gram space.
DIMS_LOG2 = 12
DIMS = 1 << DIMS_LOG2
#: Labelled texts of each language that the model is fitted on, at most.
SAMPLE_PER_LANGUAGE = 1000
CENTROIDS = 4
#: Ids are counted by this many leading bits of their hash before the lowest are ranked.
RANGE_BITS = 12
#: A text is rejected below this share of the low quantile of its length's cosines.
QUANTILE, SLACK = 0.01, 0.5

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ODD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def ngrams(text: str) -> np.ndarray:
    """Hashed counts of a text's bigrams and trigrams."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    two = b[:-1] | b[1:] << np.uint32(8)
    three = two[:-1] | b[2:] << np.uint32(16)
    shift = np.uint32(32 - DIMS_LOG2)
    counts = np.bincount(two * _ODD[0] >> shift, minlength=DIMS)
    return counts + np.bincount(three * _ODD[1] >> shift, minlength=DIMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as TF-IDF vectors of length 1 (logarithmic term frequency)."""
    rows = np.log1p(counts, dtype=np.float32) * idf
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.maximum(norms, 1e-12)


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(counts.sum(axis=1), 1)).astype(int)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray  # least cosine that is not rejected, by length class

    def predict(self, counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection of each row of counts."""
        cosines = weighted(counts, self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0).astype(float)
        classes = np.minimum(length_class(counts), len(self.floors) - 1)
        return [self.languages[i] for i in best], score, score < self.floors[classes]


def length_floors(classes: np.ndarray, cosine: np.ndarray, enough: int = 20) -> np.ndarray:
    """Least cosine that is not rejected, by length class; 0 if no class has ``enough`` texts.

    A class of fewer texts has the floor of the next shorter one with enough. Below all of
    these the floor falls with the square root of the length, as cosines of short texts do.
    """
    full = [c for c in np.unique(classes) if (classes == c).sum() >= enough]
    floors = np.zeros(40)
    for i, c in enumerate(full):
        floors[c:] = SLACK * np.quantile(cosine[classes == c], QUANTILE)
        if i == 0:
            floors[:c] = floors[c] * np.sqrt(0.5) ** np.arange(c, 0, -1)
    return floors


def kmeans(rows: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means; the first centres are farthest from those before."""
    mean = rows.mean(axis=0)
    centres = [rows[np.argmax(rows @ mean)]]
    for _ in range(min(k, len(rows)) - 1):
        centres.append(rows[np.argmin(np.max(rows @ np.array(centres).T, axis=1))])
    centres = np.array(centres)
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.array([rows[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float32)


def sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """At most ``per_language`` texts of each language: those whose id hashes lowest.

    A task ranks ``per_language`` ids and one range of hashes, whatever a language's share.
    Rows of one id and language count once, with the smallest of their texts.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(text_col).alias("text")
    )
    # how many ids lie in each range of hashes tells which ranges hold the lowest; only those are ranked
    ids = rows.select("lang", "h").distinct().withColumn("range", F.shiftright("h", 64 - RANGE_BITS))
    lower = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ids.groupBy("lang", "range").count().withColumn("before", F.coalesce(F.sum("count").over(lower), F.lit(0)))
    last = ranges.where(F.col("before") < per_language).groupBy("lang").agg(F.max("range").alias("last"))
    low = Window.partitionBy("lang").orderBy("h")
    cut = ids.join(F.broadcast(last), "lang").where("range <= last")  # one row for each language
    cut = cut.withColumn("n", F.row_number().over(low)).where(f"n <= {per_language}")
    cut = F.broadcast(cut.groupBy("lang").agg(F.max("h").alias("cut")))  # one row for each language
    return rows.join(cut, "lang").where("h <= cut").groupBy("lang", "h").agg(F.min("text").alias("text"))


@operator
def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    k: int = CENTROIDS,
) -> Model | None:
    """Fit on a bounded sample; None without any labelled text that has a letter.

    The sample's vectors stay on the executors; the driver gets document frequencies
    (``DIMS`` numbers), ``k`` centroids a language and cosines by length class.
    """

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, text = (batch.column(i).to_pylist() for i in (0, 1))
            found = [(x, ngrams(t)) for x, t in zip(lang, text, strict=True) if has_letter(t)]
            if found:
                at = [np.flatnonzero(c).astype(np.int32) for _, c in found]
                n = [c[i].astype(np.int32) for (_, c), i in zip(found, at, strict=True)]
                lists = (pa.array(x, pa.list_(pa.int32())) for x in (at, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in found]), *lists], names=["lang", "gram", "n"]
                )

    texts = sample(labelled, id_col, text_col, lang_col, per_language).select("lang", "text")
    rows = stored(texts.mapInArrow(vectors, "lang string, gram array<int>, n array<int>"), "language")
    held = rows.select(F.explode(F.array_append("gram", F.lit(-1))).alias("gram")).groupBy("gram").count().collect()
    df = {r["gram"]: r["count"] for r in held}
    if not (files := df.pop(-1, 0)):
        return None
    idf = np.ones(DIMS, np.float32) * (np.log(files + 1) + 1)
    for gram, n in df.items():
        idf[gram] = np.log((files + 1) / (n + 1)) + 1

    def dense(grams, numbers) -> np.ndarray:
        counts = np.zeros((len(grams), DIMS), np.float32)
        for i, (gram, n) in enumerate(zip(grams, numbers, strict=True)):
            counts[i, gram] = n
        return counts

    def centres(group: pd.DataFrame) -> pd.DataFrame:
        counts = dense(group["gram"], group["n"])
        order = np.lexsort(counts[:, ::-1].T[-8:])  # not the order in which rows came
        counts = counts[order]
        vectors = weighted(counts, idf)
        found = kmeans(vectors, k)
        cosine, classes = (vectors @ found.T).max(axis=1), length_class(counts)
        out = [(group["lang"].iloc[0], c, [], []) for c in found[1:]]
        out.append((group["lang"].iloc[0], found[0], classes, cosine))
        return pd.DataFrame(out, columns=["lang", "centre", "class", "cosine"])

    schema = "lang string, centre array<float>, class array<int>, cosine array<float>"
    out = sorted(rows.groupBy("lang").applyInPandas(centres, schema).collect(), key=lambda r: (r["lang"], r["centre"]))
    classes = np.concatenate([r["class"] for r in out]).astype(int)
    cosine = np.concatenate([r["cosine"] for r in out])
    floors = length_floors(classes, cosine)
    languages, centroids = [r["lang"] for r in out], np.array([r["centre"] for r in out], np.float32)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                lang, gram, n = batch.slice(a, 256).columns
                cosines = weighted(dense(gram.to_pylist(), n.to_pylist()), idf) @ centroids.T
                own = pa.array(cosines.argmax(axis=1).astype(np.int32))
                yield pa.RecordBatch.from_arrays([own, lang], names=["centroid", "lang"])

    votes = rows.select("lang", "gram", "n").mapInArrow(nearest, "centroid int, lang string")
    votes = {(r["centroid"], r["lang"]): r["count"] for r in votes.groupBy("centroid", "lang").count().collect()}
    keep = sound_centroids(languages, votes)
    return Model([languages[i] for i in keep], centroids[keep], idf, floors)


def sound_centroids(languages: list[str], votes: dict[tuple[int, str], int]) -> list[int]:
    """Centroids whose language has most of the texts nearest to them.

    Texts labelled wrongly gather in centroids that lie among those of another language;
    these go. A language keeps at least the centroid that most of its own texts are nearest to.
    """
    own = [votes.get((i, x), 0) for i, x in enumerate(languages)]
    top = [max((n for (c, _), n in votes.items() if c == i), default=0) for i in range(len(languages))]
    keep = {i for i in range(len(languages)) if own[i] and own[i] == top[i]}
    for x in set(languages):
        mine = [i for i, y in enumerate(languages) if x == y]
        if not keep.intersection(mine):
            keep.add(max(mine, key=lambda i: own[i]))
    return sorted(keep)


@operator
def identify(
    docs: DataFrame, model: Model | None, keep: Sequence[str] = ("doc_id",), text_col: str = "text", rows: int = 256
) -> DataFrame:
    """Predict the language of every whole text; a row for each input row.

    Adds ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1) and ``rejected``.
    Null texts and texts without a letter are ``und`` with score 0 and are rejected, as is
    everything if there is no model. A tie goes to the language that sorts first. Repeated
    rows give repeated results.
    """
    new = ("lang_pred", "score", "rejected")
    keep = [c for c in keep if c not in new]
    place = keep.index(text_col) if text_col in keep else len(keep)  # a kept text travels once

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, rows):
                batch = whole.slice(a, rows)
                texts = batch.column(place).to_pylist()
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
                rejected = np.ones(len(texts), bool)
                at = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
                if at:
                    found, score[at], rejected[at] = model.predict(np.array([ngrams(texts[i]) for i in at]))
                    for i, x in zip(at, found, strict=True):
                        lang[i] = x
                made = [pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=[*keep, *new])

    fields = [StructField(c, docs.schema[c].dataType) for c in keep]
    fields += StructType.fromDDL("lang_pred string, score double, rejected boolean").fields
    text = [] if text_col in keep else [F.col(text_col).alias("_text")]
    return docs.select(*keep, *text).mapInArrow(predict, StructType(fields))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast(StringType())) % 3 == 1, F.lit(False))


def trainable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(F.crc32(F.col(id_col).cast(StringType())) % 3 != 1)
