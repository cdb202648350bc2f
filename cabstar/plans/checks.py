"""Post-load validation suite: reconciliation, key integrity, uniqueness, partitions.

Scale notes:
  * totals are combined with scalar subqueries, never cross joins;
  * foreign-key checks never join the fact with a dimension: the fact's keys are rolled
    up once into (relationship, key, rows) — one scan for all relationships, combined
    map-side — and only those small key sets meet the dimension keys;
  * duplicate ids come from one group-by on the id: one scan, one shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstar.functions.money import exact_sum
from cabstar.plans.warehouse import SUMMARY_TABLES, TABLE_PARTITIONS, Warehouse
from cabstar.sources.sinks import partition_values

# The relationships of the star schema.
# (fact key, dimension table, dimension key)
FACT_FOREIGN_KEYS = [
    ("pickup_date_key", "dim_date", "date_key"),
    ("dropoff_date_key", "dim_date", "date_key"),
    ("pickup_time_key", "dim_time", "time_key"),
    ("dropoff_time_key", "dim_time", "time_key"),
    ("vendor_key", "dim_vendor", "vendor_key"),
    ("payment_type_key", "dim_payment_type", "payment_type_key"),
    ("rate_code_key", "dim_rate_code", "rate_code_key"),
    ("pu_location_key", "dim_location", "location_key"),
    ("do_location_key", "dim_location", "location_key"),
    ("passenger_count_key", "dim_passenger_count", "passenger_count_key"),
    ("trip_flags_key", "dim_trip_flags", "trip_flags_key"),
    ("trip_quality_key", "dim_trip_quality", "trip_quality_key"),
    ("ingestion_batch_key", "dim_ingestion_batch", "ingestion_batch_key"),
]
# (summary table, key, dimension table, dimension key)
SUMMARY_FOREIGN_KEYS = [
    ("fact_daily_trip_summary", "pickup_date_key", "dim_date", "date_key"),
    ("fact_vendor_daily_summary", "pickup_date_key", "dim_date", "date_key"),
    ("fact_vendor_daily_summary", "vendor_key", "dim_vendor", "vendor_key"),
    ("fact_payment_daily_summary", "pickup_date_key", "dim_date", "date_key"),
    ("fact_payment_daily_summary", "payment_type_key", "dim_payment_type", "payment_type_key"),
    ("fact_location_daily_summary", "pickup_date_key", "dim_date", "date_key"),
    ("fact_location_daily_summary", "pu_location_key", "dim_location", "location_key"),
    ("fact_location_daily_summary", "do_location_key", "dim_location", "location_key"),
]
# (label, table, key)
DATE_JOINS = [
    ("pickup_date_key", "fact_trip", "pickup_date_key"),
    ("dropoff_date_key", "fact_trip", "dropoff_date_key"),
    ("daily_summary_pickup_date_key", "fact_daily_trip_summary", "pickup_date_key"),
    ("vendor_summary_pickup_date_key", "fact_vendor_daily_summary", "pickup_date_key"),
    ("payment_summary_pickup_date_key", "fact_payment_daily_summary", "pickup_date_key"),
    ("location_summary_pickup_date_key", "fact_location_daily_summary", "pickup_date_key"),
]
DIMENSION_KEYS = {
    "dim_date": "date_key",
    "dim_time": "time_key",
    "dim_vendor": "vendor_key",
    "dim_payment_type": "payment_type_key",
    "dim_rate_code": "rate_code_key",
    "dim_location": "location_key",
    "dim_passenger_count": "passenger_count_key",
    "dim_trip_flags": "trip_flags_key",
    "dim_trip_quality": "trip_quality_key",
    "dim_ingestion_batch": "ingestion_batch_key",
}
PRIMARY_KEYS = [
    ("fact_trip", "trip_id"),
    ("fact_daily_trip_summary", "pickup_date_key"),
    ("fact_vendor_daily_summary", "pickup_date_key"),
    ("fact_vendor_daily_summary", "vendor_key"),
    ("fact_payment_daily_summary", "pickup_date_key"),
    ("fact_payment_daily_summary", "payment_type_key"),
    ("fact_location_daily_summary", "pickup_date_key"),
    ("fact_location_daily_summary", "pu_location_key"),
    ("fact_location_daily_summary", "do_location_key"),
    *DIMENSION_KEYS.items(),
]
STAR_PARTITIONED = ["fact_trip", *SUMMARY_TABLES.values()]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _silver_valid(silver: DataFrame) -> Column:
    """The star job's validity rules, on the curated columns as stored (SQL semantics)."""
    c = F.col
    return (
        c("tpep_pickup_datetime").isNotNull()
        & c("tpep_dropoff_datetime").isNotNull()
        & (c("tpep_dropoff_datetime") >= c("tpep_pickup_datetime"))
        & (c("trip_distance") >= 0)
        & (c("total_amount") >= 0)
    )


# -- V1 ---------------------------------------------------------------------------------
def row_counts(w: Warehouse) -> DataFrame:
    return _union(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
         for name, df in w.tables().items()]
    )


# -- V2 / V3 / V4 -----------------------------------------------------------------------
def reconcile_rows(w: Warehouse) -> DataFrame:
    valid = w.silver.where(_silver_valid(w.silver)).agg(F.count(F.lit(1))).scalar()
    return w.fact.agg(F.count(F.lit(1)).alias("fact_rows")).select(
        valid.alias("valid_silver_rows"), "fact_rows", (F.col("fact_rows") - valid).alias("difference")
    )


def reconcile_coalesced(w: Warehouse) -> DataFrame:
    """Rows and revenue as the star job counts them: absent distances and totals are 0.0."""
    c = F.col
    zero = lambda name: F.coalesce(c(name), F.lit(0.0))
    ordered = c("tpep_dropoff_datetime") >= c("tpep_pickup_datetime")
    kept = w.silver.where(ordered & (zero("trip_distance") >= 0) & (zero("total_amount") >= 0))
    kept = kept.agg(F.struct(F.count(F.lit(1)).alias("n"), F.round(exact_sum(zero("total_amount")), 2).alias("r")).alias("k"))
    k = kept.scalar()
    fact = w.fact.agg(F.count(F.lit(1)).alias("fact_rows"), F.round(exact_sum("total_amount"), 2).alias("fact_total_revenue"))
    return fact.select(
        k["n"].alias("valid_silver_rows"), "fact_rows", (F.col("fact_rows") - k["n"]).alias("row_difference"),
        k["r"].alias("silver_total_revenue"), "fact_total_revenue",
        F.round(F.col("fact_total_revenue") - k["r"], 2).alias("revenue_difference"),
    )


def reconcile_revenue(w: Warehouse) -> DataFrame:
    silver_total = w.silver.where(_silver_valid(w.silver)).agg(F.round(exact_sum("total_amount"), 2)).scalar()
    return w.fact.agg(F.round(exact_sum("total_amount"), 2).alias("fact_total_revenue")).select(
        silver_total.alias("silver_total_revenue"),
        "fact_total_revenue",
        F.round(F.col("fact_total_revenue") - silver_total, 2).alias("difference"),
    )


def reconcile_summaries(w: Warehouse) -> DataFrame:
    fact_total = w.fact.agg(F.round(exact_sum("total_amount"), 2)).scalar()
    rows = [
        df.agg(F.round(exact_sum("total_revenue"), 2).alias("aggregate_total_revenue")).select(
            F.lit(SUMMARY_TABLES[name]).alias("aggregate_table"),
            fact_total.alias("fact_total_revenue"),
            "aggregate_total_revenue",
            F.round(F.col("aggregate_total_revenue") - fact_total, 2).alias("difference"),
        )
        for name, df in w.summaries.items()
    ]
    return _union(rows)


# -- V5 ---------------------------------------------------------------------------------
def duplicate_ids(w: Warehouse, top: int = 20) -> DataFrame:
    """Top ``top`` duplicated trip ids (the limit is the report's size)."""
    return (
        w.fact.groupBy("trip_id")
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .where(F.col("duplicate_count") > 1)
        .orderBy(F.col("duplicate_count").desc(), F.col("trip_id"))
        .limit(top)
    )


# -- V6 / V7 ----------------------------------------------------------------------------
def null_primary_keys(w: Warehouse) -> DataFrame:
    tables = w.tables()
    return _union(
        [tables[t].agg(F.count_if(F.col(k).isNull()).alias("null_count"))
         .select(F.lit(f"{t}.{k}").alias("primary_key"), "null_count") for t, k in PRIMARY_KEYS]
    )


def null_foreign_keys(w: Warehouse) -> DataFrame:
    return w.fact.agg(
        *[F.sum(F.when(F.col(k).isNull(), 1).otherwise(0)).alias(f"null_{k}") for k, _, _ in
          sorted(FACT_FOREIGN_KEYS, key=lambda r: r[0] != "ingestion_batch_key")]
    )


# -- V8 / V9 / V10 ----------------------------------------------------------------------
def _key_counts(source: DataFrame, rels: list[tuple[str, str]]) -> DataFrame:
    """(rel, key, rows) for every (relationship name, key column) of one table, one scan."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rel"), F.col(k).cast("bigint").alias("key")) for r, k in rels])
    return source.select(F.inline(pairs)).groupBy("rel", "key").agg(F.count(F.lit(1)).alias("rows"))


def _dim_keys(tables: dict[str, DataFrame], rels: list[tuple[str, str, str]]) -> DataFrame:
    """(rel, key, matches): how many dimension rows carry each key, per relationship."""
    return _union(
        [tables[d].groupBy(F.col(k).cast("bigint").alias("key")).agg(F.count(F.lit(1)).alias("matches"))
         .select(F.lit(r).alias("rel"), "key", "matches") for r, d, k in rels]
    )


def _orphans(w: Warehouse, groups: list[tuple[str, list[tuple[str, str, str, str]]]]) -> DataFrame:
    """missing_rows per relationship: keyed source rows without a dimension row."""
    tables = w.tables()
    keys = _union([_key_counts(tables[src], [(r, k) for r, k, _, _ in rels]) for src, rels in groups])
    dims = _dim_keys(tables, [(r, d, dk) for _, rels in groups for r, _, d, dk in rels])
    missing = (
        keys.where(F.col("key").isNotNull())
        .join(dims, ["rel", "key"], "left_anti")
        .groupBy("rel")
        .agg(F.sum("rows").alias("missing"))
    )
    names = w.spark.createDataFrame([(r,) for _, rels in groups for r, _, _, _ in rels], "rel string")
    return names.join(missing, "rel", "left").select(
        F.col("rel").alias("relationship_name"), F.coalesce("missing", F.lit(0)).cast("bigint").alias("missing_rows")
    )


def fact_orphans(w: Warehouse) -> DataFrame:
    rels = [(f"{k} -> {d}", k, d, dk) for k, d, dk in FACT_FOREIGN_KEYS]
    return _orphans(w, [("fact_trip", rels)])


def summary_orphans(w: Warehouse) -> DataFrame:
    groups: dict[str, list] = {}
    for t, k, d, dk in SUMMARY_FOREIGN_KEYS:
        groups.setdefault(t, []).append((f"{t}.{k} -> {d}", k, d, dk))
    return _orphans(w, list(groups.items()))


def date_joins(w: Warehouse) -> DataFrame:
    """Rows of ``table LEFT JOIN dim_date`` and how many found no date (pre-aggregated)."""
    tables = w.tables()
    by_table: dict[str, list[tuple[str, str]]] = {}
    for label, t, k in DATE_JOINS:
        by_table.setdefault(t, []).append((label, k))
    keys = _union([_key_counts(tables[t], rels) for t, rels in by_table.items()])
    dates = tables["dim_date"].groupBy(F.col("date_key").cast("bigint").alias("key")).agg(
        F.count(F.lit(1)).alias("matches")
    )
    joined = keys.join(dates, "key", "left")
    out = joined.groupBy("rel").agg(
        F.sum(F.col("rows") * F.coalesce(F.col("matches"), F.lit(1))).alias("joined_rows"),
        F.sum(F.when(F.col("matches").isNull(), F.col("rows")).otherwise(0)).alias("missing_date_rows"),
    )
    names = w.spark.createDataFrame([(label,) for label, _, _ in DATE_JOINS], "rel string")
    return names.join(out, "rel", "left").select(
        F.col("rel").alias("date_join"),
        F.coalesce("joined_rows", F.lit(0)).cast("bigint").alias("joined_rows"),
        F.coalesce("missing_date_rows", F.lit(0)).cast("bigint").alias("missing_date_rows"),
    )


# -- V11 / V12 / V13 --------------------------------------------------------------------
def unknown_members(w: Warehouse) -> DataFrame:
    dims = w.dims
    return _union(
        [dims[d].agg(F.count_if(F.col(k) == -1).alias("unknown_member_count"))
         .select(F.lit(d).alias("dimension_name"), "unknown_member_count")
         for d, k in DIMENSION_KEYS.items() if d != "dim_ingestion_batch"]
    )


def dimension_uniqueness(w: Warehouse) -> DataFrame:
    dims = w.dims
    return _union(
        [dims[d].agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(k).alias("distinct_keys"))
         .select(F.lit(d).alias("table_name"), "rows", "distinct_keys") for d, k in DIMENSION_KEYS.items()]
    )


def partitions(w: Warehouse) -> DataFrame:
    """The partitions each partitioned star table holds, as SHOW PARTITIONS prints them."""
    tables = w.tables()
    frames = []
    for t in STAR_PARTITIONED:
        cols = TABLE_PARTITIONS[t]
        spec = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in cols])
        frames.append(partition_values(tables[t], cols).select(F.lit(t).alias("table_name"), spec.alias("partition")))
    return _union(frames)
