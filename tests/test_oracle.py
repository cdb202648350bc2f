"""A sample of registered queries against their DuckDB oracle at sf0.001 (exact values)."""

import duckdb
import pytest

import __spark_entry__ as entry
from cabstar.plans.oracle_queries import ORACLE
from cabstar.plans.registry import QUERIES
from tests.conftest import SF_SMALL

SAMPLE = ["silver_clean", "mart_payment", "dim_date", "fact_trip", "summary_payment", "check_fact_fk",
          "check_date_join", "report_vendor", "bi_heatmap", "bi_routes", "bi_filtered",
          "bi_filtered_places", "bi_passenger_group_uncleansed", "report_quality_uncleansed",
          "reconcile_coalesced_uncleansed", "defect_duplicate_ids", "defect_fact_fk", "defect_date_join",
          "defect_dim_unique", "asof_purchase_view", "sessions_events", "bag_raw_not_curated", "changes_vendor",
          "running_vendor", "overlapping_trips"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rows):
    return sorted(tuple("<null>" if v is None else (repr(v) if isinstance(v, float) else str(v)) for v in r)
                  for r in rows)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    ours = _norm(df.select(*cols).collect())
    rel = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    theirs = _norm([tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()])
    assert ours == theirs


def test_every_warehouse_query_is_registered_and_has_an_oracle():
    assert set(QUERIES) - {"sketch_months"} == set(ORACLE)  # its quantile sketches draw at random
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["defect_null_fk", "defect_fact_fk", "defect_date_join", "defect_duplicate_ids"])
def test_the_injected_defects_show(con, name):
    numbers = [v for row in con.execute(entry.oracle_sql()[name]).fetchall() for v in row if isinstance(v, int)]
    assert any(numbers)


def test_monthly_sketches_are_near_the_exact_values(spark, con):
    sql = entry.oracle_sql()["fact_trip"]
    exact = con.execute(f"SELECT pickup_year, pickup_month, COUNT(DISTINCT trip_id), list_sort(list(total_amount)) FROM ({sql}) GROUP BY 1, 2")
    exact = {(y, m): (n, amounts) for y, m, n, amounts in exact.fetchall()}
    rows = {(r.pickup_year, r.pickup_month): r for r in entry.queries()["sketch_months"](spark, SF_SMALL).collect()}
    assert rows.keys() == exact.keys()
    for month, (n, amounts) in exact.items():
        assert abs(rows[month].trips - n) <= max(1, 0.05 * n)
        assert abs(sum(a <= rows[month].revenue_p50 for a in amounts) / n - 0.5) <= 0.05 + 1 / n


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns
