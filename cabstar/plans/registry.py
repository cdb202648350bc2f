"""Named queries over the test tables: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the raw tables in full and builds the warehouse lazily on top, so the
whole chain (cleanse -> fact -> ... -> query) is one Spark plan per query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cabstar.operators.audit import LoadInfo
from cabstar.oracle import BATCH_ID, LOAD_COMPLETED, LOAD_STARTED
from cabstar.operators.cleanse import align_schema, cast_to_contract
from cabstar.plans import analysis, bi, checks, reports
from cabstar.plans.defects import defective
from cabstar.plans.star import star_view
from cabstar.plans.warehouse import Warehouse
from cabstar.sources.trips import raw_trips, zone_lookup

# Fixed filter set of the registered dashboard-filter query.
DASHBOARD_FILTERS = bi.FilterSet(
    date_from="1996-01-01",
    date_to="1997-12-31",
    payment_types=("No charge", "Dispute"),
    passenger_groups=("Small Group",),
    dayparts=("Evening", "Night"),
)

# The other filters of the dashboard.
PLACE_FILTERS = bi.FilterSet(
    vendors=("Creative Mobile Technologies", "VeriFone Inc", "Unknown Vendor 3"),
    rate_codes=("Standard rate", "JFK", "Newark"),
    pickup_zones=tuple(f"NATION_{i}" for i in range(12)),
    dropoff_zones=("Unknown Location", *(f"NATION_{i}" for i in range(6, 16))),
    weekend=False,
)

Query = Callable[[SparkSession, str], DataFrame]

FIXED_LOAD = LoadInfo(batch_id=BATCH_ID, load_started_utc=LOAD_STARTED, load_completed_utc=LOAD_COMPLETED)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(raw_trips(spark, sf_dir), FIXED_LOAD, zones=zone_lookup(spark, sf_dir))


def uncleansed_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star built straight from raw trips: the warehouse rules meet nulls, zero
    distances, negative totals and reversed times, and copies are kept."""
    raw = cast_to_contract(align_schema(raw_trips(spark, sf_dir)))
    return Warehouse(raw, FIXED_LOAD, zones=zone_lookup(spark, sf_dir), overrides={"silver": raw})


def _u(fn: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(uncleansed_warehouse(spark, sf_dir))


def _d(fn: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(defective(warehouse(spark, sf_dir)))


def _w(fn: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(warehouse(spark, sf_dir))


QUERIES: dict[str, Query] = {
    # curated layer and marts
    "silver_clean": _w(lambda w: w.silver),
    "mart_daily": _w(lambda w: w.marts["daily_revenue"]),
    "mart_vendor": _w(lambda w: w.marts["vendor_revenue"]),
    "mart_payment": _w(lambda w: w.marts["payment_type_analysis"]),
    "mart_passenger": _w(lambda w: w.marts["passenger_analysis"]),
    # dimensions derived from the data
    "dim_date": _w(lambda w: w.dims["dim_date"]),
    "dim_vendor": _w(lambda w: w.dims["dim_vendor"]),
    "dim_payment_type": _w(lambda w: w.dims["dim_payment_type"]),
    "dim_rate_code": _w(lambda w: w.dims["dim_rate_code"]),
    "dim_location": _w(lambda w: w.dims["dim_location"]),
    "dim_passenger_count": _w(lambda w: w.dims["dim_passenger_count"]),
    "dim_ingestion_batch": _w(lambda w: w.dims["dim_ingestion_batch"]),
    # atomic fact and summary facts
    "fact_trip": _w(lambda w: w.fact),
    "summary_daily": _w(lambda w: w.summaries["daily"]),
    "summary_vendor": _w(lambda w: w.summaries["vendor"]),
    "summary_payment": _w(lambda w: w.summaries["payment"]),
    "summary_location": _w(lambda w: w.summaries["location"]),
    # validation suite
    "check_row_counts": _w(checks.row_counts),
    "reconcile_rows": _w(checks.reconcile_rows),
    "reconcile_revenue": _w(checks.reconcile_revenue),
    "reconcile_summaries": _w(checks.reconcile_summaries),
    "check_duplicate_ids": _w(checks.duplicate_ids),
    "check_null_pk": _w(checks.null_primary_keys),
    "check_null_fk": _w(checks.null_foreign_keys),
    "check_fact_fk": _w(checks.fact_orphans),
    "check_summary_fk": _w(checks.summary_orphans),
    "check_date_join": _w(checks.date_joins),
    "check_unknown_members": _w(checks.unknown_members),
    "check_dim_unique": _w(checks.dimension_uniqueness),
    "check_partitions": _w(checks.partitions),
    "reconcile_coalesced": _w(checks.reconcile_coalesced),
    # the same checks over a warehouse with injected defects
    "defect_duplicate_ids": _d(checks.duplicate_ids),
    "defect_null_fk": _d(checks.null_foreign_keys),
    "defect_fact_fk": _d(checks.fact_orphans),
    "defect_summary_fk": _d(checks.summary_orphans),
    "defect_date_join": _d(checks.date_joins),
    "defect_unknown_members": _d(checks.unknown_members),
    "defect_dim_unique": _d(checks.dimension_uniqueness),
    "defect_reconcile_rows": _d(checks.reconcile_rows),
    "defect_reconcile_revenue": _d(checks.reconcile_revenue),
    # the star over raw trips that were not cleansed
    "fact_trip_uncleansed": _u(lambda w: w.fact),
    "dim_ingestion_batch_uncleansed": _u(lambda w: w.dims["dim_ingestion_batch"]),
    "dim_passenger_count_uncleansed": _u(lambda w: w.dims["dim_passenger_count"]),
    "report_quality_uncleansed": _u(reports.quality_distribution),
    "reconcile_rows_uncleansed": _u(checks.reconcile_rows),
    "reconcile_coalesced_uncleansed": _u(checks.reconcile_coalesced),
    "bi_passenger_group_uncleansed": _u(bi.passenger_groups),
    # reports
    "report_quality": _w(reports.quality_distribution),
    "report_batches": _w(reports.batch_audit),
    "report_daily": _w(reports.daily_revenue),
    "report_vendor": _w(reports.vendor_performance),
    "report_payment": _w(reports.payment_behaviour),
    # dashboard queries
    "bi_kpi": _w(bi.kpis),
    "bi_monthly_metrics": _w(bi.monthly_metrics),
    "bi_revenue_by_date": _w(bi.revenue_by_date),
    "bi_revenue_by_month": _w(bi.revenue_by_month),
    "bi_revenue_by_quarter": _w(bi.revenue_by_quarter),
    "bi_weekend": _w(bi.weekend_vs_weekday),
    "bi_vendor_revenue": _w(bi.revenue_by_vendor),
    "bi_payment_share": _w(bi.payment_share),
    "bi_heatmap": _w(bi.weekday_hour_heatmap),
    "bi_daypart": _w(bi.revenue_by_daypart),
    "bi_vendor_table": _w(bi.vendor_table),
    "bi_payment_table": _w(bi.payment_table),
    "bi_top_pickup_zones": _w(bi.top_pickup_zones),
    "bi_top_dropoff_zones": _w(bi.top_dropoff_zones),
    "bi_routes": _w(bi.routes),
    "bi_filtered": _w(lambda w: bi.filtered_kpis_by_vendor(w, DASHBOARD_FILTERS)),
    "bi_filtered_places": _w(lambda w: bi.filtered_kpis_by_vendor(w, PLACE_FILTERS)),
    "bi_peak_days": _w(bi.peak_days),
    "bi_store_fwd": _w(bi.store_and_forward),
    "bi_rate_code": _w(bi.rate_code_revenue),
    "bi_passenger_group": _w(bi.passenger_groups),
    "star_view": _w(lambda w: star_view(w.fact, w.dims)),
    # as-of and interval joins, changes, bags, running totals, sketches, sessions
    "asof_last_dropoff": _w(analysis.last_dropoff),
    "asof_event_order": analysis.events_with_order,
    "asof_purchase_view": analysis.purchase_after_view,
    "overlapping_trips": _w(analysis.overlapping_trips),
    "changes_fact": _w(analysis.fact_changes),
    "changes_vendor": _w(analysis.vendor_changes),
    "bag_raw_not_curated": _w(analysis.rows_not_curated),
    "bag_raw_and_curated": _w(analysis.rows_curated),
    "running_vendor": _w(analysis.vendor_running),
    "sketch_months": _w(analysis.monthly_estimates),
    "sessions_events": analysis.user_sessions,
}
