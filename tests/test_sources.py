from pyspark.sql import functions as F

from cabstar.operators.cleanse import cleanse
from cabstar.sources.raw import read_zone_lookup, scan_curated, scan_raw, schema_groups
from cabstar.sources.trips import raw_trips
from tests.conftest import SF_SMALL


def test_scan_raw_discovers_partitions_merges_schemas_and_stamps_files(spark, scratch):
    trips = raw_trips(spark, SF_SMALL).drop("source_file_name").limit(1)
    old = trips.withColumns({"vendorid": F.lit(1), "fare_amount": F.lit(10.0)}).withColumnRenamed("vendorid", "VendorID")
    new = old.withColumns({"VendorID": F.lit(2), "fare_amount": F.lit(12.0), "congestion_surcharge": F.lit(2.5)})
    old.write.parquet(f"{scratch}/raw/year=2019/month=01")
    new.write.parquet(f"{scratch}/raw/year=2025/month=01")
    df = scan_raw(spark, f"{scratch}/raw")
    assert {"year", "month", "congestion_surcharge", "source_file_name"} <= set(df.columns)
    rows = {r["vendorid"]: r for r in df.collect()}
    assert rows[1]["congestion_surcharge"] is None and rows[2]["congestion_surcharge"] == 2.5
    assert rows[1]["source_file_name"].endswith(".parquet") and "year=2019" in rows[1]["source_file_name"]


def test_many_files_of_few_schemas_take_few_jobs(spark, scratch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = [pa.int32(), pa.int64(), pa.float64()]
    for i in range(200):  # the type changes twice, at places that no halving meets early
        table = pa.table({"VendorID" if i < 90 else "vendorid": pa.array([i], kinds[(i >= 61) + (i >= 147)])})
        pq.write_table(table, f"{scratch}/{i:03d}.parquet")
    names = [f"{scratch}/{i:03d}.parquet" for i in range(200)]
    spark.sparkContext.setJobGroup("schemas", "schemas")
    groups = schema_groups(spark, names)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("schemas")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert sorted(f for _, files in groups for f in files) == names
    assert sorted(s.fields[0].dataType.simpleString() for s, _ in groups)[0] == "bigint" and len(groups) <= 6
    assert len(jobs) <= 40, len(jobs)
    assert sum(spark.read.schema(s).parquet(*files).count() for s, files in groups) == 200


def test_scan_curated_by_path_or_table(spark, scratch):
    spark.range(3).write.parquet(f"{scratch}/cur")
    assert scan_curated(spark, f"{scratch}/cur").count() == 3
    spark.range(2).createOrReplaceTempView("curated_view")
    assert scan_curated(spark, "curated_view").count() == 2


def test_zone_lookup_csv(spark, scratch):
    path = f"{scratch}/zones.csv"
    with open(path, "w") as fh:
        fh.write('LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\nx,Queens,Bad,Boro Zone\n')
    rows = read_zone_lookup(spark, path).collect()
    assert rows[0]["location_id"] == 1 and rows[0]["zone"] == "Newark Airport"
    assert rows[1]["location_id"] is None


def test_raw_scan_feeds_cleanse(spark, scratch):
    df = spark.createDataFrame(
        [("1", "2025-01-01 10:00:00", "2025-01-01 10:20:00", "1", "3.5", "1", "N", "100", "200", "1", "18.5",
          "1.0", "0.5", "3.0", "0.0", "1.0", "24.0")],
        "VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count string, "
        "trip_distance string, RatecodeID string, store_and_fwd_flag string, PULocationID string, "
        "DOLocationID string, payment_type string, fare_amount string, extra string, mta_tax string, "
        "tip_amount string, tolls_amount string, improvement_surcharge string, total_amount string")
    df.write.parquet(f"{scratch}/raw2/year=2025/month=01")
    out = cleanse(scan_raw(spark, f"{scratch}/raw2"))
    r = out.first()
    assert r["vendorid"] == 1 and r["pulocationid"] == 100 and r["year"] == 2025
    assert out.where(F.col("source_file_name").contains("year=2025")).count() == 1
