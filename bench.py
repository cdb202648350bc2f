"""Benchmark: full warehouse load, then the validation/report/dashboard queries on it.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Per-layer load times are reported as ``load_<layer>``; every query afterwards runs on
the written tables (as the validation SQL and dashboards do) and is fully executed
(small results collected, fact-sized results written to the no-op sink).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cabstar.operators.audit import LoadInfo  # noqa: E402
from cabstar.plans import bi, checks, reports  # noqa: E402
from cabstar.plans.registry import DASHBOARD_FILTERS  # noqa: E402
from cabstar.plans.star import star_view  # noqa: E402
from cabstar.plans.warehouse import build_warehouse  # noqa: E402
from cabstar.session import get_session  # noqa: E402
from cabstar.sources.trips import raw_trips, zone_lookup  # noqa: E402

QUERIES = {
    "check_row_counts": checks.row_counts,
    "reconcile_rows": checks.reconcile_rows,
    "reconcile_summaries": checks.reconcile_summaries,
    "check_duplicate_ids": checks.duplicate_ids,
    "check_null_fk": checks.null_foreign_keys,
    "check_fact_fk": checks.fact_orphans,
    "check_summary_fk": checks.summary_orphans,
    "check_date_join": checks.date_joins,
    "check_dim_unique": checks.dimension_uniqueness,
    "report_quality": reports.quality_distribution,
    "report_daily": reports.daily_revenue,
    "report_vendor": reports.vendor_performance,
    "report_payment": reports.payment_behaviour,
    "bi_kpi": bi.kpis,
    "bi_monthly_metrics": bi.monthly_metrics,
    "bi_heatmap": bi.weekday_hour_heatmap,
    "bi_routes": bi.routes,
    "bi_top_pickup_zones": bi.top_pickup_zones,
    "bi_filtered": lambda w: bi.filtered_kpis_by_vendor(w, DASHBOARD_FILTERS),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    match = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(match.group(1)) if match else None
    # Output files and shuffle partitions sized for this data volume (on a cluster the
    # advisory size would be 128-256 MB).
    spark = get_session(
        f"local[{cpus}]", app_name="cabstar-bench", shuffle_partitions=max(8, 2 * cpus),
        extra_conf={"spark.sql.adaptive.advisoryPartitionSizeInBytes": os.environ.get("BENCH_ADVISORY", "16m")},
    )
    out = tempfile.mkdtemp(prefix="cabstar-bench-")

    # warm-up: JVM, codegen and file listing on the smallest data
    warm = tempfile.mkdtemp(prefix="cabstar-warm-")
    smoke = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    build_warehouse(raw_trips(spark, smoke), warm, LoadInfo(batch_id="1"), zones=zone_lookup(spark, smoke))

    times: dict[str, float] = {}
    layers: dict[str, float] = {}
    t0 = time.perf_counter()
    w = build_warehouse(
        raw_trips(spark, sf_dir), out, LoadInfo(batch_id="20250201000000"), zones=zone_lookup(spark, sf_dir),
        timings=layers,
    )
    times["warehouse_build"] = time.perf_counter() - t0
    times.update({f"load_{k}": v for k, v in layers.items()})

    for name, fn in QUERIES.items():
        t = time.perf_counter()
        fn(w).collect()
        times[name] = time.perf_counter() - t
    t = time.perf_counter()
    star_view(w.fact, w.dims).write.format("noop").mode("overwrite").save()
    times["star_view"] = time.perf_counter() - t

    total = times["warehouse_build"] + sum(v for k, v in times.items() if k in QUERIES or k == "star_view")
    print(json.dumps({
        "metric": "warehouse_load_plus_queries_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
