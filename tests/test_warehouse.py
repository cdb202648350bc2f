import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstar.operators.audit import LoadInfo
from cabstar.plans import bi, checks
from cabstar.plans.contract import DECLARED
from cabstar.plans.registry import DASHBOARD_FILTERS, warehouse
from cabstar.plans.star import star_view
from cabstar.plans.warehouse import TABLE_PARTITIONS, build_warehouse, load_marts, load_star
from cabstar.session import checkpoint_dir
from cabstar.sources.sinks import register_table, show_partitions, write_table
from cabstar.sources.trips import raw_trips, zone_lookup
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("wh"))
    w = build_warehouse(raw_trips(spark, SF_SMALL), base, LoadInfo(batch_id="20250101000000"),
                        zones=zone_lookup(spark, SF_SMALL))
    return base, w


def test_all_tables_loaded(built):
    _, w = built
    counts = {r["table_name"]: r["row_count"] for r in checks.row_counts(w).collect()}
    assert len(counts) == 21
    assert counts["dim_time"] == 86401 and counts["dim_trip_quality"] == 5
    assert counts["fact_trip"] > 0 and counts["silver"] >= counts["fact_trip"]


def test_integrity_suite_clean(built):
    _, w = built
    assert all(r["missing_rows"] == 0 for r in checks.fact_orphans(w).collect())
    assert all(r["missing_rows"] == 0 for r in checks.summary_orphans(w).collect())
    assert all(r["missing_date_rows"] == 0 for r in checks.date_joins(w).collect())
    assert checks.duplicate_ids(w).count() == 0
    assert all(v == 0 for v in checks.null_foreign_keys(w).first())
    assert all(r["null_count"] == 0 for r in checks.null_primary_keys(w).collect())
    assert all(r["unknown_member_count"] == 1 for r in checks.unknown_members(w).collect())
    assert all(r["rows"] == r["distinct_keys"] for r in checks.dimension_uniqueness(w).collect())
    assert checks.reconcile_rows(w).first()["difference"] == 0
    assert checks.reconcile_revenue(w).first()["difference"] == 0.0
    assert all(r["difference"] == 0.0 for r in checks.reconcile_summaries(w).collect())


def test_row_numbers_are_contiguous_per_file(built):
    _, w = built
    per_file = w.fact.groupBy("source_file_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("source_row_number").alias("lo"), F.max("source_row_number").alias("hi"),
        F.countDistinct("source_row_number").alias("d"))
    for r in per_file.collect():
        assert r["lo"] == 1 and r["hi"] == r["n"] == r["d"]


def test_catalog_registration_lists_partitions(spark, built):
    base, _ = built
    for name, parts in TABLE_PARTITIONS.items():
        register_table(spark, "cabstar_test", name, f"{base}/{name}", parts or None)
    listed = {r[0] for r in show_partitions(spark, "cabstar_test", "fact_trip").collect()}
    assert listed and all(p.startswith("pickup_year=") for p in listed)
    assert spark.table("cabstar_test.fact_trip").count() == spark.read.parquet(f"{base}/fact_trip").count()


def _files(base):
    return {(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(base) for f in names}


def test_refused_batches_change_no_file(spark, built):
    base, _ = built
    before = _files(base)
    for batch in ("20250101000000", "abc", ""):
        with pytest.raises(ValueError):
            build_warehouse(raw_trips(spark, SF_SMALL), base, LoadInfo(batch_id=batch))
    assert _files(base) == before


def test_audit_row_has_true_times_and_path(built):
    base, w = built
    (row,) = w.dims["dim_ingestion_batch"].collect()
    assert row["load_started_utc"] < row["load_completed_utc"] and row["target_base_path"] == base


def test_load_leaves_no_scratch(spark, built):
    folder = checkpoint_dir(spark).removeprefix("file:")
    labels = ("curated", "curated-kept", "marts", "codes", "summaries")
    assert not [f for f in os.listdir(folder) if f.rsplit("-", 1)[0] in {f"cabstar-{x}" for x in labels}]


def test_declared_tables_match_the_files(spark, built):
    base, w = built
    for name in ("silver", "fact_trip", "dim_vendor", "fact_daily_trip_summary"):
        register_table(spark, "cabstar_declared", name, f"{base}/{name}", TABLE_PARTITIONS[name] or None, DECLARED[name])
        assert spark.table(f"cabstar_declared.{name}").count() == w.tables()[name].count()
    with pytest.raises(ValueError, match="vendor_name"):
        wrong = T.StructType([f for f in DECLARED["dim_vendor"].fields if f.name != "vendor_name"])
        register_table(spark, "cabstar_declared", "dim_vendor", f"{base}/dim_vendor", None, wrong)


def test_marts_and_star_load_from_a_catalog_table(spark, built, tmp_path_factory):
    base, w = built
    register_table(spark, "cabstar_split", "trips", f"{base}/silver", TABLE_PARTITIONS["silver"])
    other = str(tmp_path_factory.mktemp("split"))
    marts = load_marts(spark, other, "cabstar_split.trips")
    star = load_star(spark, other, LoadInfo(batch_id="20250101000000"), "cabstar_split.trips",
                     zones=zone_lookup(spark, SF_SMALL))
    assert sorted(marts["gold_vendor_revenue"].collect(), key=str) == sorted(w.marts["vendor_revenue"].collect(), key=str)
    assert sorted(star["fact_trip"].collect(), key=str) == sorted(w.fact.collect(), key=str)


def test_non_numeric_batch_refused_before_any_job(spark):
    with pytest.raises(ValueError):
        warehouse(spark, SF_SMALL).__class__(raw_trips(spark, SF_SMALL), LoadInfo(batch_id="abc")).fact


def test_same_batch_gives_same_trip_ids(spark):
    a = {r[0] for r in warehouse(spark, SF_SMALL).fact.select("trip_id").collect()}
    b = {r[0] for r in warehouse(spark, SF_SMALL).fact.select("trip_id").collect()}
    assert a == b and len(a) > 0


def test_files_sent_again_without_a_month_leave_nothing_behind(spark, tmp_path_factory):
    raw = raw_trips(spark, SF_SMALL).withColumn("source_file_name", F.date_format("tpep_pickup_datetime", "yyyy"))
    zones = zone_lookup(spark, SF_SMALL)
    month, file = F.month("tpep_pickup_datetime"), F.col("source_file_name")
    gone = ((file == "1997") & month.isin(3, 4)) | (file == "2000")
    base = str(tmp_path_factory.mktemp("again"))
    build_warehouse(raw, base, LoadInfo(batch_id="1"), zones=zones)
    # 1997 without two months; of 2000 only rows that are refused
    refused = raw.where(file == "2000").withColumn("trip_distance", F.lit(-1.0))
    feed = raw.where((file == "1997") & ~gone).unionByName(refused)
    w = build_warehouse(feed, base, LoadInfo(batch_id="2"), zones=zones, scope_months=[])
    full = build_warehouse(raw.where(~gone), str(tmp_path_factory.mktemp("full")), LoadInfo(batch_id="1"), zones=zones)
    assert w.silver.where("pickup_year = 2000 or (pickup_year = 1997 and pickup_month in (3, 4))").count() == 0
    skip = {"trip_id", "ingestion_batch_key"}
    same = {name for name in full.tables() if name not in ("bronze", "dim_ingestion_batch", "dim_date")}
    for name in sorted(same):
        ours, want = w.tables()[name], full.tables()[name]
        order = sorted(set(want.columns) - skip)
        if name.startswith("dim_"):  # members of earlier loads stay
            assert {tuple(r) for r in want.select(*order).collect()} <= {tuple(r) for r in ours.select(*order).collect()}, name
            continue
        assert sorted(ours.select(*order).collect(), key=str) == sorted(want.select(*order).collect(), key=str), name
    # all rows of all files are refused: every partition goes, and the tables can still be read
    w = build_warehouse(raw.withColumn("trip_distance", F.lit(-1.0)), base, LoadInfo(batch_id="3"), zones=zones)
    assert w.silver.count() == w.fact.count() == w.marts["daily_revenue"].count() == 0


def test_dynamic_overwrite_keeps_absent_partitions(spark, scratch):
    df = spark.createDataFrame([(2025, 1, "a"), (2025, 2, "b")], "pickup_year int, pickup_month int, v string")
    write_table(df, scratch, ["pickup_year", "pickup_month"])
    write_table(df.where("pickup_month = 2").withColumn("v", F.lit("c")), scratch, ["pickup_year", "pickup_month"])
    got = sorted((r["pickup_month"], r["v"]) for r in spark.read.parquet(scratch).collect())
    assert got == [(1, "a"), (2, "c")]


def test_building_queries_runs_nothing_and_leaves_nothing(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    w = warehouse(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("build-only", "build")
    _ = [w.fact, star_view(w.fact, w.dims), bi.filtered_kpis_by_vendor(w, DASHBOARD_FILTERS), w.marts["daily_revenue"]]
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build-only")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert not jobs and (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before


def test_one_dimension_plans_one_dimension(spark):
    w = warehouse(spark, SF_SMALL)
    plan = _plan(w.dims["dim_ingestion_batch"])
    assert "Window" not in plan and list(w.dims._built) == ["dim_ingestion_batch"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_python_udf_or_cartesian(spark):
    w = warehouse(spark, SF_SMALL)
    for df in [w.fact, checks.fact_orphans(w), checks.reconcile_summaries(w), w.summaries["daily"]]:
        plan = _plan(df)
        for bad in ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]:
            assert bad not in plan, bad


def test_fk_check_never_joins_the_fact(spark):
    w = warehouse(spark, SF_SMALL)
    plan = _plan(checks.fact_orphans(w))
    # the fact is rolled up (Generate + partial aggregate) before any join
    assert "Generate inline" in plan and "partial_count" in plan


def test_input_order_and_partitioning_change_nothing(spark):
    from cabstar.plans.registry import FIXED_LOAD
    from cabstar.plans.warehouse import Warehouse

    base = warehouse(spark, SF_SMALL)
    shuffled = Warehouse(raw_trips(spark, SF_SMALL).repartition(7, "vendorid")
                         .sortWithinPartitions(F.rand(3)), FIXED_LOAD, zones=zone_lookup(spark, SF_SMALL))
    cols = ["trip_id", "source_row_number", "total_amount", "tip_pct"]
    assert sorted(base.fact.select(*cols).collect()) == sorted(shuffled.fact.select(*cols).collect())
    assert sorted(base.summaries["payment"].collect()) == sorted(shuffled.summaries["payment"].collect())


def test_period_loads_equal_one_full_load(spark, tmp_path_factory):
    raw = raw_trips(spark, SF_SMALL)
    zones = zone_lookup(spark, SF_SMALL)
    full = build_warehouse(raw, str(tmp_path_factory.mktemp("full")), LoadInfo(batch_id="7"), zones=zones)
    base = str(tmp_path_factory.mktemp("periods"))
    early = [1995, 1996, 1997]
    late = [1998, 1999, 2000, 2001, 2002]
    year = F.year("tpep_pickup_datetime")
    build_warehouse(raw.where(year.isin(early)), base, LoadInfo(batch_id="7"), zones=zones, scope_years=early)
    w = build_warehouse(raw.where(year.isin(late)), base, LoadInfo(batch_id="8"), zones=zones, scope_years=late)
    drop_batch = ["trip_id", "ingestion_batch_key"]
    assert sorted(w.fact.drop(*drop_batch).collect(), key=str) == sorted(full.fact.drop(*drop_batch).collect(), key=str)
    for name in ["daily", "location"]:
        assert sorted(w.summaries[name].collect(), key=str) == sorted(full.summaries[name].collect(), key=str)
    assert sorted(w.marts["daily_revenue"].collect(), key=str) == sorted(full.marts["daily_revenue"].collect(), key=str)
    assert all(r["missing_rows"] == 0 for r in checks.fact_orphans(w).collect())
    assert w.dims["dim_ingestion_batch"].count() == 2


def test_month_load_with_stray_dates_equals_a_full_load(spark, tmp_path_factory):
    raw = raw_trips(spark, SF_SMALL).withColumn("source_file_name", F.date_format("tpep_pickup_datetime", "yyyy"))
    stray = (F.col("source_file_name") == "1999") & (F.col("payment_type") == 3) & (F.col("vendorid") == 2)
    early = F.col("tpep_pickup_datetime") - F.expr("INTERVAL 4 YEARS")
    late = F.col("tpep_dropoff_datetime") - F.expr("INTERVAL 4 YEARS")
    raw = raw.withColumns({"tpep_pickup_datetime": F.when(stray, early).otherwise(F.col("tpep_pickup_datetime")),
                           "tpep_dropoff_datetime": F.when(stray, late).otherwise(F.col("tpep_dropoff_datetime"))})
    zones = zone_lookup(spark, SF_SMALL)
    full = build_warehouse(raw, str(tmp_path_factory.mktemp("full")), LoadInfo(batch_id="1"), zones=zones)
    base = str(tmp_path_factory.mktemp("months"))
    build_warehouse(raw.where("source_file_name <> '1999'"), base, LoadInfo(batch_id="1"), zones=zones)
    feed = raw.where("source_file_name = '1999'")  # holds rows of 1995 as well
    w = build_warehouse(feed, base, LoadInfo(batch_id="2"), zones=zones, scope_months=[(1999, 3)])
    assert full.silver.where("source_file_name = '1999' and pickup_year = 1995").count() > 0
    no_batch = ["trip_id", "ingestion_batch_key"]
    order = sorted(w.fact.columns)
    for ours, want in ((w.silver, full.silver), (w.fact.drop(*no_batch), full.fact.drop(*no_batch)),
                       *((w.summaries[n], full.summaries[n]) for n in w.summaries), *((w.marts[n], full.marts[n]) for n in w.marts)):
        order = sorted(want.columns)
        assert sorted(ours.select(*order).collect(), key=str) == sorted(want.select(*order).collect(), key=str)
    assert checks.reconcile_rows(w).first()["difference"] == 0
    # the same file once more changes nothing
    again = build_warehouse(feed, base, LoadInfo(batch_id="3"), zones=zones, scope_months=[])
    assert again.silver.count() == full.silver.count() and again.fact.count() == full.fact.count()
