"""Scans of the landed raw files, the curated table and the taxi-zone lookup CSV."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstar.operators.cleanse import align_schema, cast_to_contract
from cabstar.sources.sinks import read_table

# The public zone lookup's header.
ZONE_LOOKUP_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.StringType(), True),
        T.StructField("Borough", T.StringType(), True),
        T.StructField("Zone", T.StringType(), True),
        T.StructField("service_zone", T.StringType(), True),
    ]
)


def with_provenance(df: DataFrame) -> DataFrame:
    """Stamp each row with the file it was read from (file sources only)."""
    return df.withColumn("source_file_name", F.col("_metadata.file_path"))


def _common_schema(spark: SparkSession, names: Sequence[str]) -> T.StructType | None:
    """The merged schema of files, read in one parallel job; None if their types don't merge."""
    try:
        schema = spark.read.option("mergeSchema", True).parquet(*names).schema
    except Exception as e:  # noqa: BLE001 - a SparkException or an AnalysisException, by where it merges
        if len(names) > 1 and "CANNOT_MERGE" in str(e):
            return None
        raise
    different = {f.name.lower() for f in schema.fields}
    return schema if len(different) == len(schema.fields) or len(names) == 1 else None


def schema_groups(spark: SparkSession, names: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files by schemas that can be read together.

    Spark merges the schemas of a whole list of files in one job; only a list whose types
    clash is halved. Files in the order of their months change seldom, so the number of jobs
    grows with the changes of schema and the logarithm of the number of files.
    """
    schema = _common_schema(spark, names)
    if schema is None:
        half = len(names) // 2
        parts = [*schema_groups(spark, names[:half]), *schema_groups(spark, names[half:])]
    else:
        parts = [(schema, list(names))]
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for own, files in parts:
        groups.setdefault(own.json(), (own, []))[1].extend(files)
    return list(groups.values())


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw trip Parquet under ``path`` (``year=YYYY/month=MM`` folders become columns).

    Files drift: fee columns come and go, names change case, and a column is int, bigint or
    double by file, which one read schema cannot hold. Files whose schemas merge are read
    together (``schema_groups``), cast to the contract and united by name. The lineage
    column records each row's file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).drop("content")
    names = [r["path"] for r in files.select("path").orderBy("path").collect()]
    if not names:
        return with_provenance(spark.read.parquet(path))  # raises as Spark does
    root = path.split("*", 1)[0].rstrip("/")
    frames = [
        cast_to_contract(
            align_schema(with_provenance(spark.read.schema(schema).option("basePath", root).parquet(*own)))
        )
        for schema, own in schema_groups(spark, names)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_curated(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """Curated trips from a catalog table name (``db.table``) or a storage path.

    With ``schema`` a path can also be read that holds no row any more.
    """
    if "/" in source or ":" in source:
        return read_table(spark, source, schema)
    return spark.table(source)


def read_zone_lookup(spark: SparkSession, csv_path: str) -> DataFrame:
    """Zone lookup CSV (header row) as location_id INT, borough, zone, service_zone."""
    raw = spark.read.schema(ZONE_LOOKUP_SCHEMA).option("header", True).csv(csv_path)
    return raw.select(
        F.col("LocationID").try_cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone").alias("service_zone"),
    )
