"""Trip-shaped feed over the TPC-H-like test tables.

The warehouse consumes raw taxi trips. The test data has none, so a trip row is derived
from each ``lineitem ⋈ orders ⋈ customer ⋈ supplier`` row. The expressions are plain SQL
that Spark and DuckDB evaluate identically; the DuckDB oracle reuses this exact text.
They deliberately produce the dirty cases the pipeline must handle: NULL ids, unknown
codes, zero distance, negative fares, reversed pickup/dropoff, trips over four hours,
amounts over 500, and whole-row duplicates (every row whose part key is a multiple of
97 is delivered twice, as a feed re-sending records would). Every row of every table is
read; the duplicate rule only adds rows.

Files: one raw file per pickup month, named like the public monthly trip files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SECOND_OF_DAY = "CAST((l_orderkey * 7919 + l_partkey * 31) % 86400 AS INT)"
_SIGN = "(CASE WHEN l_partkey % 41 = 0 THEN -1 ELSE 1 END)"

# (column, SQL expression valid in both Spark and DuckDB), in raw-file column order.
TRIP_COLUMNS: list[tuple[str, str]] = [
    ("vendorid", "CAST(NULLIF(l_suppkey % 9, 8) AS INT)"),
    ("tpep_pickup_datetime", f"o_orderdate + INTERVAL '1' SECOND * {_SECOND_OF_DAY}"),
    (
        "tpep_dropoff_datetime",
        "o_orderdate + INTERVAL '1' SECOND * CAST((l_orderkey * 7919 + l_partkey * 31) % 86400"
        " + (CASE WHEN l_partkey % 50 = 0 THEN -1 ELSE 1 END) * CAST(l_quantity AS INT) * 360 AS INT)",
    ),
    ("passenger_count", "CAST(CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE l_linenumber - 1 END AS INT)"),
    ("trip_distance", "(l_quantity - 1) / 2"),
    ("ratecodeid", "CAST(NULLIF(l_partkey % 8, 7) AS INT)"),
    ("store_and_fwd_flag", "CASE l_returnflag WHEN 'N' THEN 'N' WHEN 'R' THEN 'Y' END"),
    ("pulocationid", "c_nationkey"),
    ("dolocationid", "NULLIF(s_nationkey, 24)"),
    ("payment_type", "CAST(l_linenumber AS INT)"),
    ("fare_amount", f"{_SIGN} * CAST(FLOOR(l_extendedprice / 2) AS BIGINT) / 1e2"),
    ("extra", "CAST(1.0 AS DOUBLE)"),
    ("mta_tax", "CAST(0.5 AS DOUBLE)"),
    ("tip_amount", "CAST(FLOOR(l_extendedprice / 2 * l_discount) AS BIGINT) / 1e2"),
    ("tolls_amount", "CAST(0.0 AS DOUBLE)"),
    ("improvement_surcharge", "CAST(1.0 AS DOUBLE)"),
    (
        "total_amount",
        f"{_SIGN} * (CAST(FLOOR(l_extendedprice / 2) AS BIGINT)"
        " + CAST(FLOOR(l_extendedprice / 2 * l_discount) AS BIGINT) + 50) / 1e2",
    ),
]

# The file-name column is the only one whose text differs between the two engines.
SOURCE_FILE_SPARK = "concat('yellow_tripdata_', date_format(o_orderdate, 'yyyy-MM'), '.parquet')"
SOURCE_FILE_DUCKDB = "'yellow_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.parquet'"
DUPLICATE_RULE = "l_partkey % 97 = 0"

_NEEDED = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_returnflag"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
    "customer": ["c_custkey", "c_nationkey"],
    "supplier": ["s_suppkey", "s_nationkey"],
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ("bronze") trips with a ``source_file_name`` lineage column.

    Orders meet their customers first, so that at scale (customer and supplier are broadcast
    while they are small) the many line items are shuffled once, by the order key.
    """
    li, o, c, s = (read_table(spark, sf_dir, t).select(*cols) for t, cols in _NEEDED.items())
    placed = o.join(c, o.o_custkey == c.c_custkey)
    joined = li.join(placed, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
    # Re-sent records: one generator pass instead of a second scan + join for a UNION ALL.
    copies = F.explode(F.when(F.expr(DUPLICATE_RULE), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    projected = [F.expr(expr).alias(name) for name, expr in TRIP_COLUMNS]
    return joined.select(*projected, F.expr(SOURCE_FILE_SPARK).alias("source_file_name"), copies.alias("_copy")).drop(
        "_copy"
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the public taxi-zone CSV: nation as zone, region as borough."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.lit("Boro Zone").alias("service_zone"),
    )
