"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstar.llm import (
    ann,
    bpe,
    decontaminate,
    jaccard,
    language,
    licences,
    lines,
    ranked,
    shards,
    simple8b,
    spelling,
    urls,
    wordpiece,
)
from cabstar.llm.common import stored, table
from cabstar.session import checkpoint_dir


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"), least_words=1)
    return found.select("doc_id", "n_lines", "n_removed", "n_left", F.sha2(F.col("text"), 256).alias("text_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.fit(language.trainable(docs))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.flatten(F.transform(base, lambda m: m["starts"]))
    joined = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    score = F.array_max(F.transform("matches", lambda m: m["score"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("matches")).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return wordpiece.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    path = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    simple8b.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.read_tokens(spark, path, ids=False)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, bench).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = jaccard.similar_components(docs, size=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = f"{checkpoint_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    shards.write_shards(docs, path, shards=8)
    text = F.coalesce("record.text", F.lit(""))
    return shards.read_shards(spark, path, docs.schema).select(
        "record.doc_id",
        shards.record_size(text).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return spelling.spelling_forms(stored(spelling.word_counts(docs, noise=97), "spelling-words"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark")
    return ranked.rank_documents(docs, items, k=50)


QUERIES = {
    "op1_nearest": op1_nearest,
    "op2_line_dedup": op2_line_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_language": op4_language,
    "op5_licences": op5_licences,
    "op6_bpe": op6_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_token_files": op8_token_files,
    "op9_decontaminate": op9_decontaminate,
    "op10_jaccard": op10_jaccard,
    "op11_shards": op11_shards,
    "op12_spelling": op12_spelling,
    "op13_lexical": op13_lexical,
}
