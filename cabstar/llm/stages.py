"""The stages of ``corpus_pipeline``; each calls one operator and keeps or drops rows.

All but the last return the columns of ``documents``; documents keep their columns but for
the text that line dedup shortens (and ``n_chars`` with it).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstar.llm import bpe, decontaminate, jaccard, language, lines
from cabstar.llm.common import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go; ``lang`` is left as it was."""
    model = language.fit(language.trainable(docs))
    return language.identify(docs, model, keep=COLUMNS).where("not rejected").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and with them documents of which no line that is new is left."""
    found = lines.dedup_lines(docs, keep=("lang", "source"), least_words=1)
    found = found.where("n_removed = 0 or n_new > 0")
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays (five words, Jaccard 0.8)."""
    return jaccard.one_of_each(docs.select(*COLUMNS), size=5, percent=80)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages beyond the rule's share go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return found.where(~decontaminate.contaminated()).select(*COLUMNS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document that is left, with digests of them and of the decoded text."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_texts(docs, path, keep=("doc_id", "lang", "source"), digests=True)


STAGES = [
    ("language", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("tokens", tokenized),
]
