"""Parquet sinks and catalog registration."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstar.session import checkpoint_dir


#: A partition by its values, in the order of the partition columns.
Partition = tuple


def _first_files(spark: SparkSession, path: str, partition_cols: list[str]) -> dict[Partition, str]:
    """The first file of each stored partition (a row a partition); none if nothing is stored."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return {}
        raise
    rows = stored.groupBy(*partition_cols).agg(F.min("_metadata.file_path").alias("first")).collect()
    return {tuple(r[c] for c in partition_cols): r["first"] for r in rows}


def write_table(
    df: DataFrame,
    path: str,
    partition_cols: list[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool = True,
    replaces: Collection[Partition] | None = (),
) -> None:
    """Write snappy Parquet; partitioned tables overwrite only the partitions present.

    Partitioned output goes through a REBALANCE on the partition columns: adaptive
    execution then splits hot partitions (a month holding a third of the rows is
    written by many tasks) and merges small ones, instead of one task per partition.

    ``replaces`` are the partitions that ``df`` stands for (None: all that are stored).
    Those of them for which ``df`` has no row are removed once the others are committed;
    a write that fails in between removes them when it is repeated.
    """
    spark = df.sparkSession
    writer_df = df
    if partition_cols and rebalance:
        writer_df = df.hint("rebalance", *partition_cols)
    writer = writer_df.write.mode(mode).format("parquet").option("compression", "snappy")
    before: dict[Partition, str] = {}
    if partition_cols:
        # Dynamic overwrite: other partitions survive; new files have names of their own.
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
        if replaces is None or replaces:
            before = _first_files(spark, path, partition_cols)
    writer.save(path)
    before = {p: f for p, f in before.items() if replaces is None or p in set(replaces)}
    after = _first_files(spark, path, partition_cols) if before else {}
    for partition, first in before.items():
        if after.get(partition) == first:  # not written, so left without rows
            _delete(spark, first.rsplit("/", 1)[0])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The stored table; with ``schema`` also one whose partitions are all gone."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if schema is None or e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(schema).parquet(path)


#: Folders that materialize() has written inside each open scratch_scope(), the innermost last.
_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the intermediates written inside; their frames must not outlive it.

    Those written as ``lasting`` stay until the scope around this one ends, if there is one.
    """
    token = _scratch.set((*_scratch.get(), []))
    try:
        yield
    finally:
        for folder in _scratch.get()[-1]:
            _delete(spark, folder)
        _scratch.reset(token)


def materialize(df: DataFrame, label: str = "stage", lasting: bool = False) -> DataFrame:
    """Write an intermediate to the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but in one job (a reliable RDD checkpoint
    recomputes its input unless it was cached first), and the read-back frame carries
    real file-size statistics for the optimizer.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cabstar-{label}-{uuid.uuid4().hex}"
    scopes = _scratch.get()[: -1 if lasting else None]
    if scopes:
        scopes[-1].append(path)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def write_tables(jobs: list[tuple], parallel: int = 4) -> None:
    """Write independent small tables concurrently: (df, path, partition_cols, mode, replaces).

    Each write is its own Spark job; submitting them from several driver threads lets
    the scheduler overlap their (mostly fixed-cost) stages instead of running them back
    to back.
    """
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = [pool.submit(write_table, df, path, parts, mode, True, gone) for df, path, parts, mode, gone in jobs]
        for f in futures:
            f.result()


def register_table(
    spark: SparkSession,
    database: str,
    name: str,
    path: str,
    partition_cols: list[str] | None = None,
    schema: T.StructType | None = None,
) -> None:
    """External table over an existing Parquet folder; partitions are discovered.

    With a declared ``schema`` files of other types or columns are refused.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    full = f"`{database}`.`{name}`"
    spark.sql(f"DROP TABLE IF EXISTS {full}")  # external: files are kept
    found = spark.read.parquet(path).schema
    if schema is not None:
        declared = {f.name: f.dataType for f in schema.fields}
        written = {f.name: f.dataType for f in found.fields}
        if declared != written:
            odd = sorted(n for n in declared.keys() | written.keys() if declared.get(n) != written.get(n))
            raise ValueError(f"{name} at {path} differs from its declared schema in: {', '.join(odd)}")
    schema = schema or found
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE {full} ({cols}) USING parquet{partitioned} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {full}")


def show_partitions(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS `{database}`.`{name}`")


def partition_values(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Partitions a table holds (what SHOW PARTITIONS lists), with row counts."""
    return df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("row_count"))
