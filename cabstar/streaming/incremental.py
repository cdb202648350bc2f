"""Incremental curated loads: each newly landed raw file is cleansed once.

Raw trip files land month by month. A file-source stream with an ``availableNow`` trigger
picks up the files not yet processed and loads each batch like ``load_curated``: a file's
rows replace what is stored of that file. So a batch that is replayed, and a stream whose
state was lost, write the same table again instead of adding to it. The state lies inside
the target (in a folder that readers skip), so every application continues it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstar.plans.warehouse import load_curated
from cabstar.sources.sinks import scratch_scope


def incremental_curated_load(
    spark: SparkSession, raw_path: str, raw_schema: T.StructType, base_path: str, stream_state: str | None = None
) -> None:
    """Load every raw file not yet loaded into ``base_path/silver``, then stop."""
    raw = (
        spark.readStream.schema(raw_schema)
        .option("maxFilesPerTrigger", 64)
        .parquet(raw_path)
        .withColumn("source_file_name", F.col("_metadata.file_path"))
    )

    def load(batch: DataFrame, _batch_id: int) -> None:
        with scratch_scope(spark):
            load_curated(batch, base_path)

    query = (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", stream_state or f"{base_path.rstrip('/')}/_stream_state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
