"""Corpus pipeline: language, line dedup, near duplicates, decontamination, tokens.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and
returns a DataFrame; ``run`` writes it to the shared checkpoint folder and rereads it as
the next stage's input. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cabstar.llm import stages
from cabstar.llm.common import stored, table

STAGES = stages.STAGES

#: Line edit distances, language centroids and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
