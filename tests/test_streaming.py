from pyspark.sql import functions as F

from cabstar.operators.cleanse import cleanse
from cabstar.sources.trips import raw_trips
from cabstar.streaming.incremental import incremental_curated_load
from tests.conftest import SF_SMALL


def test_incremental_load_equals_batch_cleanse(spark, scratch):
    raw = raw_trips(spark, SF_SMALL).drop("source_file_name")
    landing, base = f"{scratch}/landing", f"{scratch}/wh"
    months = raw.withColumn("m", F.date_format("tpep_pickup_datetime", "yyyy"))
    years = sorted(r[0] for r in months.select("m").distinct().collect())
    first, rest = years[: len(years) // 2], years[len(years) // 2:]
    months.where(F.col("m").isin(first)).drop("m").coalesce(2).write.parquet(f"{landing}/part1")
    incremental_curated_load(spark, f"{landing}/*", raw.schema, base)
    months.where(F.col("m").isin(rest)).drop("m").coalesce(2).write.parquet(f"{landing}/part2")
    incremental_curated_load(spark, f"{landing}/*", raw.schema, base)
    incremental_curated_load(spark, f"{landing}/*", raw.schema, base)  # nothing new: no-op
    batch = cleanse(spark.read.parquet(f"{landing}/*").withColumn("source_file_name", F.col("_metadata.file_path")))
    cols = sorted(batch.columns)

    def same_as_batch():
        loaded = spark.read.parquet(f"{base}/silver")
        assert loaded.count() == batch.count() > 0
        assert loaded.select(*cols).exceptAll(batch.select(*cols)).count() == 0

    same_as_batch()
    # an application whose stream state was lost sees every file again
    incremental_curated_load(spark, f"{landing}/*", raw.schema, base, f"{scratch}/other-state")
    same_as_batch()
