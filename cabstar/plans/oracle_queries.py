"""DuckDB oracle SQL for every registered query (see ``cabstar.oracle``)."""

from __future__ import annotations

from cabstar.oracle import rnd, table_sql, uncleansed, with_ctes, with_defects, xsum
from cabstar.plans.oracle_analysis import ANALYSIS

# The star's relationships and partitions, written out here again so that a
# relationship dropped from the code under test shows up as a difference.
_DIM_OF = {
    "date_key": "dim_date", "time_key": "dim_time", "vendor_key": "dim_vendor", "payment_type_key": "dim_payment_type",
    "rate_code_key": "dim_rate_code", "location_key": "dim_location", "passenger_count_key": "dim_passenger_count",
    "trip_flags_key": "dim_trip_flags", "trip_quality_key": "dim_trip_quality",
    "ingestion_batch_key": "dim_ingestion_batch",
}
DIMENSION_KEYS = {dim: key for key, dim in _DIM_OF.items()}


def _relation(key: str) -> tuple[str, str, str]:
    """A foreign key, its dimension and the key there; four keys have a role before the name."""
    own = next(k for k in _DIM_OF if key == k or key in (f"pickup_{k}", f"dropoff_{k}", f"pu_{k}", f"do_{k}"))
    return key, _DIM_OF[own], own


FACT_FOREIGN_KEYS = [
    _relation(k)
    for k in (
        "pickup_date_key", "dropoff_date_key", "pickup_time_key", "dropoff_time_key", "vendor_key",
        "payment_type_key", "rate_code_key", "pu_location_key", "do_location_key", "passenger_count_key",
        "trip_flags_key", "trip_quality_key", "ingestion_batch_key",
    )
]
_SUMMARY_KEYS = {
    "fact_daily_trip_summary": ["pickup_date_key"],
    "fact_vendor_daily_summary": ["pickup_date_key", "vendor_key"],
    "fact_payment_daily_summary": ["pickup_date_key", "payment_type_key"],
    "fact_location_daily_summary": ["pickup_date_key", "pu_location_key", "do_location_key"],
}
SUMMARY_FOREIGN_KEYS = [(t, *_relation(k)) for t, keys in _SUMMARY_KEYS.items() for k in keys]
PRIMARY_KEYS = [("fact_trip", "trip_id"), *((t, k) for t, keys in _SUMMARY_KEYS.items() for k in keys),
                *DIMENSION_KEYS.items()]
DATE_JOINS = [
    ("pickup_date_key", "fact_trip", "pickup_date_key"),
    ("dropoff_date_key", "fact_trip", "dropoff_date_key"),
    *((f"{t.split('_')[1]}_summary_pickup_date_key", t, "pickup_date_key") for t in _SUMMARY_KEYS),
]
SUMMARY_TABLES = {t.split("_")[1]: t for t in _SUMMARY_KEYS}
STAR_PARTITIONED = ["fact_trip", *_SUMMARY_KEYS]
TABLE_PARTITIONS = dict.fromkeys(STAR_PARTITIONED, ["pickup_year", "pickup_month"])
TABLE_PARTITIONS["fact_daily_trip_summary"] = ["pickup_year"]

ALL_TABLES = [
    "bronze", "silver", "gold_daily_revenue", "gold_vendor_revenue", "gold_payment_type_analysis",
    "gold_passenger_analysis", *DIMENSION_KEYS, "fact_trip", *SUMMARY_TABLES.values(),
]
SILVER_VALID = """tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND tpep_dropoff_datetime >= tpep_pickup_datetime AND trip_distance >= 0 AND total_amount >= 0"""

# SQL text of the final measures (same definitions as cabstar.plans.star.measure)
M = {
    "total_trips": "COUNT(*)",
    "total_passengers": "CAST(SUM(f.passenger_count) AS BIGINT)",
    "known_passengers": "CAST(SUM(CASE WHEN f.passenger_count >= 0 THEN f.passenger_count END) AS BIGINT)",
    "total_revenue": xsum("f.total_amount"),
    "total_fare": xsum("f.fare_amount"),
    "total_tips": xsum("f.tip_amount"),
    "avg_revenue": f"{xsum('f.total_amount')} / COUNT(*)",
    "avg_fare": f"{xsum('f.fare_amount')} / COUNT(*)",
    "avg_trip_distance": f"{xsum('f.trip_distance')} / COUNT(*)",
    "avg_trip_duration_minutes": "CAST(SUM(epoch(f.dropoff_ts) - epoch(f.pickup_ts)) AS DOUBLE) / COUNT(*) / 60.0",
    "revenue_per_trip": f"{xsum('f.total_amount')} / CAST(SUM(f.trip_count) AS BIGINT)",
    "revenue_per_mile": f"{xsum('f.total_amount')} / NULLIF({xsum('f.trip_distance')}, 0.0)",
    "tip_pct": f"{xsum('f.tip_amount')} / NULLIF({xsum('f.fare_amount')}, 0.0)",
}


def _m(*names: str) -> str:
    return ", ".join(f"{M[n]} AS {n}" for n in names)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _row_counts() -> str:
    body = _union([f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in ALL_TABLES])
    return with_ctes(body, ALL_TABLES)


def _reconcile_rows() -> str:
    body = f"""SELECT v.n AS valid_silver_rows, f.n AS fact_rows, f.n - v.n AS difference
FROM (SELECT COUNT(*) AS n FROM silver WHERE {SILVER_VALID}) v, (SELECT COUNT(*) AS n FROM fact) f"""
    return with_ctes(body, ["silver", "fact"])


def _reconcile_coalesced() -> str:
    total = rnd(xsum("COALESCE(total_amount, 0.0)"), 2)
    body = f"""SELECT v.n AS valid_silver_rows, f.n AS fact_rows, f.n - v.n AS row_difference,
  v.r AS silver_total_revenue, f.r AS fact_total_revenue, {rnd('f.r - v.r', 2)} AS revenue_difference
FROM (SELECT COUNT(*) AS n, {total} AS r FROM silver
      WHERE tpep_dropoff_datetime >= tpep_pickup_datetime AND COALESCE(trip_distance, 0.0) >= 0
        AND COALESCE(total_amount, 0.0) >= 0) v,
     (SELECT COUNT(*) AS n, {rnd(xsum('total_amount'), 2)} AS r FROM fact) f"""
    return with_ctes(body, ["silver", "fact"])


def _reconcile_revenue() -> str:
    body = f"""SELECT s.r AS silver_total_revenue, f.r AS fact_total_revenue, {rnd('f.r - s.r', 2)} AS difference
FROM (SELECT {rnd(xsum('total_amount'), 2)} AS r FROM silver WHERE {SILVER_VALID}) s,
     (SELECT {rnd(xsum('total_amount'), 2)} AS r FROM fact) f"""
    return with_ctes(body, ["silver", "fact"])


def _reconcile_summaries() -> str:
    parts = [
        f"""SELECT '{t}' AS aggregate_table, f.r AS fact_total_revenue, a.r AS aggregate_total_revenue,
  {rnd('a.r - f.r', 2)} AS difference
FROM (SELECT {rnd(xsum('total_amount'), 2)} AS r FROM fact) f, (SELECT {rnd(xsum('total_revenue'), 2)} AS r FROM {t}) a"""
        for t in SUMMARY_TABLES.values()
    ]
    return with_ctes(_union(parts), ["fact", *SUMMARY_TABLES.values()])


def _duplicates() -> str:
    body = """SELECT trip_id, COUNT(*) AS duplicate_count FROM fact GROUP BY trip_id HAVING COUNT(*) > 1
ORDER BY duplicate_count DESC, trip_id LIMIT 20"""
    return with_ctes(body, ["fact"])


def _null_pk() -> str:
    parts = [f"SELECT '{t}.{k}' AS primary_key, CAST(COUNT_IF({k} IS NULL) AS BIGINT) AS null_count FROM {t}" for t, k in PRIMARY_KEYS]
    return with_ctes(_union(parts), sorted({t for t, _ in PRIMARY_KEYS}))


def _null_fk() -> str:
    cols = ", ".join(f"CAST(SUM(CASE WHEN {k} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_{k}"
                     for k, _, _ in FACT_FOREIGN_KEYS)
    return with_ctes(f"SELECT {cols} FROM fact", ["fact"])


def _orphans(rels: list[tuple[str, str, str, str, str]]) -> str:
    parts = [
        f"""SELECT '{label}' AS relationship_name, COUNT(*) AS missing_rows
FROM {t} f LEFT JOIN {d} d ON f.{k} = d.{dk} WHERE f.{k} IS NOT NULL AND d.{dk} IS NULL"""
        for label, t, k, d, dk in rels
    ]
    return with_ctes(_union(parts), sorted({r[1] for r in rels} | {r[3] for r in rels}))


def _date_joins() -> str:
    parts = [
        f"""SELECT '{label}' AS date_join, COUNT(*) AS joined_rows, CAST(COUNT_IF(d.date_key IS NULL) AS BIGINT) AS missing_date_rows
FROM {t} f LEFT JOIN dim_date d ON f.{k} = d.date_key"""
        for label, t, k in DATE_JOINS
    ]
    return with_ctes(_union(parts), sorted({t for _, t, _ in DATE_JOINS} | {"dim_date"}))


def _unknown_members() -> str:
    dims = [(d, k) for d, k in DIMENSION_KEYS.items() if d != "dim_ingestion_batch"]
    parts = [f"SELECT '{d}' AS dimension_name, CAST(COUNT_IF({k} = -1) AS BIGINT) AS unknown_member_count FROM {d}" for d, k in dims]
    return with_ctes(_union(parts), [d for d, _ in dims])


def _dim_unique() -> str:
    parts = [f'SELECT \'{d}\' AS table_name, COUNT(*) AS "rows", COUNT(DISTINCT {k}) AS distinct_keys FROM {d}'
             for d, k in DIMENSION_KEYS.items()]
    return with_ctes(_union(parts), list(DIMENSION_KEYS))


def _partitions() -> str:
    parts = []
    for t in STAR_PARTITIONED:
        spec = " || '/' || ".join(f"'{c}=' || CAST({c} AS VARCHAR)" for c in TABLE_PARTITIONS[t])
        parts.append(f"SELECT DISTINCT '{t}' AS table_name, {spec} AS partition FROM {t}")
    return with_ctes(_union(parts), STAR_PARTITIONED)


def _by(dim: str, on: str, attrs: list[str], measures: str, extra: str = "", needs: tuple = ()) -> str:
    cols = ", ".join(f"d.{a} AS {a}" for a in attrs)
    body = f"SELECT {cols}, {measures} FROM fact f JOIN {dim} d ON {on} GROUP BY {', '.join('d.' + a for a in attrs)} {extra}"
    return with_ctes(body, ["fact", dim, *needs])


_ON_DATE = "f.pickup_date_key = d.date_key"


def _report_quality() -> str:
    return _by("dim_trip_quality", "f.trip_quality_key = d.trip_quality_key", ["quality_code", "quality_description"],
               f"COUNT(*) AS total_trips, {rnd(M['total_revenue'], 2)} AS total_revenue")


def _report_batches() -> str:
    body = """SELECT batch_id, job_name, source_table, source_record_count, valid_record_count, rejected_record_count,
  target_base_path FROM dim_ingestion_batch ORDER BY ingestion_batch_key DESC"""
    return with_ctes(body, ["dim_ingestion_batch"])


def _report_daily() -> str:
    return _by("dim_date", _ON_DATE, ["calendar_date"],
               f"COUNT(*) AS total_trips, {rnd(M['total_revenue'], 2)} AS total_revenue, "
               f"{rnd(M['avg_revenue'], 2)} AS avg_revenue, {rnd(M['avg_trip_distance'], 2)} AS avg_trip_distance")


def _report_vendor() -> str:
    return _by("dim_vendor", "f.vendor_key = d.vendor_key", ["vendor_name"],
               f"COUNT(*) AS total_trips, {rnd(M['total_revenue'], 2)} AS total_revenue, "
               f"{rnd(M['revenue_per_mile'], 2)} AS revenue_per_mile")


def _report_payment() -> str:
    return _by("dim_payment_type", "f.payment_type_key = d.payment_type_key", ["payment_type_description"],
               f"COUNT(*) AS total_trips, {rnd(M['total_revenue'], 2)} AS total_revenue, "
               f"{rnd(M['total_tips'], 2)} AS total_tips, {rnd(M['tip_pct'], 4)} AS tip_pct")


def _bi_kpi() -> str:
    return with_ctes(f"SELECT {_m('total_trips', 'total_revenue', 'total_fare', 'total_tips', 'revenue_per_trip')} FROM fact f",
                     ["fact"])


def _payment_share() -> str:
    inner = _by("dim_payment_type", "f.payment_type_key = d.payment_type_key", ["payment_type_description"],
                _m("total_trips"))
    return f"""SELECT payment_type_description, total_trips,
  CAST(total_trips AS DOUBLE) / CAST(SUM(total_trips) OVER () AS DOUBLE) AS trip_share FROM ({inner}) t"""


def _heatmap() -> str:
    body = """SELECT d.day_of_week AS day_of_week, d.day_of_week_number AS day_of_week_number, t.hour AS hour,
  COUNT(*) AS total_trips
FROM fact f JOIN dim_date d ON f.pickup_date_key = d.date_key JOIN dim_time t ON f.pickup_time_key = t.time_key
GROUP BY d.day_of_week, d.day_of_week_number, t.hour"""
    return with_ctes(body, ["fact", "dim_date", "dim_time"])


def _top_zone(fk: str, name: str, measure: str) -> str:
    inner = _by("dim_location", f"f.{fk} = d.location_key", ["zone"], _m(measure))
    return f"SELECT zone AS {name}, {measure} FROM ({inner}) t ORDER BY {measure} DESC, {name} LIMIT 10"


def _routes() -> str:
    body = f"""SELECT p.zone AS pickup_zone, o.zone AS dropoff_zone, {_m('total_trips', 'total_revenue', 'avg_trip_distance')}
FROM fact f JOIN dim_location p ON f.pu_location_key = p.location_key
JOIN dim_location o ON f.do_location_key = o.location_key GROUP BY p.zone, o.zone"""
    return with_ctes(body, ["fact", "dim_location"])


# Fixed filter set of the registered filter-set query (see cabstar.plans.registry)
def _filtered() -> str:
    body = f"""SELECT d.vendor_name AS vendor_name, {_m('total_trips', 'total_revenue', 'avg_revenue')}
FROM fact f JOIN dim_vendor d ON f.vendor_key = d.vendor_key
WHERE f.pickup_date_key IN (SELECT date_key FROM dim_date
                            WHERE calendar_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31')
  AND f.payment_type_key IN (SELECT payment_type_key FROM dim_payment_type
                             WHERE payment_type_description IN ('No charge', 'Dispute'))
  AND f.passenger_count_key IN (SELECT passenger_count_key FROM dim_passenger_count
                                WHERE passenger_group IN ('Small Group'))
  AND f.pickup_time_key IN (SELECT time_key FROM dim_time WHERE daypart IN ('Evening', 'Night'))
GROUP BY d.vendor_name"""
    return with_ctes(body, ["fact", "dim_vendor", "dim_date", "dim_payment_type", "dim_passenger_count", "dim_time"])


def _filtered_places() -> str:
    body = f"""SELECT d.vendor_name AS vendor_name, {_m('total_trips', 'total_revenue', 'avg_revenue')}
FROM fact f JOIN dim_vendor d ON f.vendor_key = d.vendor_key
WHERE f.pickup_date_key IN (SELECT date_key FROM dim_date WHERE NOT is_weekend)
  AND d.vendor_name IN ('Creative Mobile Technologies', 'VeriFone Inc', 'Unknown Vendor 3')
  AND f.rate_code_key IN (SELECT rate_code_key FROM dim_rate_code
                          WHERE rate_code_description IN ('Standard rate', 'JFK', 'Newark'))
  AND f.pu_location_key IN (SELECT location_key FROM dim_location WHERE zone IN
    (SELECT 'NATION_' || CAST(i AS VARCHAR) FROM range(0, 12) r(i)))
  AND f.do_location_key IN (SELECT location_key FROM dim_location WHERE zone IN
    (SELECT 'NATION_' || CAST(i AS VARCHAR) FROM range(6, 16) r(i) UNION ALL SELECT 'Unknown Location'))
GROUP BY d.vendor_name"""
    return with_ctes(body, ["fact", "dim_vendor", "dim_date", "dim_rate_code", "dim_location"])


def _peak_days() -> str:
    inner = _by("dim_date", _ON_DATE, ["calendar_date"], _m("total_trips", "total_revenue"))
    return f"SELECT * FROM ({inner}) t ORDER BY total_trips DESC, calendar_date LIMIT 10"


def _star_view() -> str:
    body = """SELECT f.*, d.calendar_date, d.calendar_year, d.calendar_quarter, d.calendar_month, d.year_month,
  d.day_of_week, d.day_of_week_number, d.is_weekend, t.hour, t.daypart, v.vendor_name, p.payment_type_description,
  r.rate_code_description, pu.borough AS pickup_borough, pu.zone AS pickup_zone, pu.service_zone AS pickup_service_zone,
  dl.borough AS dropoff_borough, dl.zone AS dropoff_zone, dl.service_zone AS dropoff_service_zone,
  pc.passenger_group, fl.store_and_fwd_description, q.quality_code, b.batch_id
FROM fact f
LEFT JOIN dim_date d ON f.pickup_date_key = d.date_key
LEFT JOIN dim_time t ON f.pickup_time_key = t.time_key
LEFT JOIN dim_vendor v ON f.vendor_key = v.vendor_key
LEFT JOIN dim_payment_type p ON f.payment_type_key = p.payment_type_key
LEFT JOIN dim_rate_code r ON f.rate_code_key = r.rate_code_key
LEFT JOIN dim_location pu ON f.pu_location_key = pu.location_key
LEFT JOIN dim_location dl ON f.do_location_key = dl.location_key
LEFT JOIN dim_passenger_count pc ON f.passenger_count_key = pc.passenger_count_key
LEFT JOIN dim_trip_flags fl ON f.trip_flags_key = fl.trip_flags_key
LEFT JOIN dim_trip_quality q ON f.trip_quality_key = q.trip_quality_key
LEFT JOIN dim_ingestion_batch b ON f.ingestion_batch_key = b.ingestion_batch_key"""
    return with_ctes(body, ["fact", *DIMENSION_KEYS])


def _passenger_group() -> str:
    return _by("dim_passenger_count", "f.passenger_count_key = d.passenger_count_key", ["passenger_group"],
               _m("total_trips", "total_passengers", "known_passengers", "avg_revenue", "avg_trip_distance",
                  "total_tips", "tip_pct"))


_FACT_RELS = [(f"{k} -> {d}", "fact_trip", k, d, dk) for k, d, dk in FACT_FOREIGN_KEYS]
_SUMMARY_RELS = [(f"{t}.{k} -> {d}", t, k, d, dk) for t, k, d, dk in SUMMARY_FOREIGN_KEYS]

ORACLE: dict[str, str] = {
    "silver_clean": table_sql("silver"),
    "mart_daily": table_sql("gold_daily_revenue"),
    "mart_vendor": table_sql("gold_vendor_revenue"),
    "mart_payment": table_sql("gold_payment_type_analysis"),
    "mart_passenger": table_sql("gold_passenger_analysis"),
    "dim_date": table_sql("dim_date"),
    "dim_vendor": table_sql("dim_vendor"),
    "dim_payment_type": table_sql("dim_payment_type"),
    "dim_rate_code": table_sql("dim_rate_code"),
    "dim_location": table_sql("dim_location"),
    "dim_passenger_count": table_sql("dim_passenger_count"),
    "dim_ingestion_batch": table_sql("dim_ingestion_batch"),
    "fact_trip": table_sql("fact"),
    "summary_daily": table_sql("fact_daily_trip_summary"),
    "summary_vendor": table_sql("fact_vendor_daily_summary"),
    "summary_payment": table_sql("fact_payment_daily_summary"),
    "summary_location": table_sql("fact_location_daily_summary"),
    # validation suite
    "check_row_counts": _row_counts(),
    "reconcile_rows": _reconcile_rows(),
    "reconcile_revenue": _reconcile_revenue(),
    "reconcile_summaries": _reconcile_summaries(),
    "check_duplicate_ids": _duplicates(),
    "check_null_pk": _null_pk(),
    "check_null_fk": _null_fk(),
    "check_fact_fk": _orphans(_FACT_RELS),
    "check_summary_fk": _orphans(_SUMMARY_RELS),
    "check_date_join": _date_joins(),
    "check_unknown_members": _unknown_members(),
    "check_dim_unique": _dim_unique(),
    "check_partitions": _partitions(),
    "reconcile_coalesced": _reconcile_coalesced(),
    # the same checks over a warehouse with injected defects
    "defect_duplicate_ids": with_defects(_duplicates()),
    "defect_null_fk": with_defects(_null_fk()),
    "defect_fact_fk": with_defects(_orphans(_FACT_RELS)),
    "defect_summary_fk": with_defects(_orphans(_SUMMARY_RELS)),
    "defect_date_join": with_defects(_date_joins()),
    "defect_unknown_members": with_defects(_unknown_members()),
    "defect_dim_unique": with_defects(_dim_unique()),
    "defect_reconcile_rows": with_defects(_reconcile_rows()),
    "defect_reconcile_revenue": with_defects(_reconcile_revenue()),
    # the star over raw trips that were not cleansed
    "fact_trip_uncleansed": uncleansed(table_sql("fact")),
    "dim_ingestion_batch_uncleansed": uncleansed(table_sql("dim_ingestion_batch")),
    "dim_passenger_count_uncleansed": uncleansed(table_sql("dim_passenger_count")),
    "report_quality_uncleansed": uncleansed(_report_quality()),
    "reconcile_rows_uncleansed": uncleansed(_reconcile_rows()),
    "reconcile_coalesced_uncleansed": uncleansed(_reconcile_coalesced()),
    "bi_passenger_group_uncleansed": uncleansed(_passenger_group()),
    # reports
    "report_quality": _report_quality(),
    "report_batches": _report_batches(),
    "report_daily": _report_daily(),
    "report_vendor": _report_vendor(),
    "report_payment": _report_payment(),
    # dashboard queries
    "bi_kpi": _bi_kpi(),
    "bi_monthly_metrics": _by("dim_date", _ON_DATE, ["year_month"],
                              _m("total_trips", "revenue_per_trip", "revenue_per_mile", "tip_pct", "avg_fare",
                                 "avg_trip_distance", "avg_trip_duration_minutes")),
    "bi_revenue_by_date": _by("dim_date", _ON_DATE, ["calendar_date"], _m("total_trips", "total_revenue")),
    "bi_revenue_by_month": _by("dim_date", _ON_DATE, ["year_month"], _m("total_trips", "total_revenue")),
    "bi_revenue_by_quarter": _by("dim_date", _ON_DATE, ["calendar_year", "calendar_quarter"],
                                 _m("total_trips", "total_revenue")),
    "bi_weekend": _by("dim_date", _ON_DATE, ["is_weekend"], _m("total_trips", "total_revenue", "avg_revenue")),
    "bi_vendor_revenue": _by("dim_vendor", "f.vendor_key = d.vendor_key", ["vendor_name"], _m("total_revenue")),
    "bi_payment_share": _payment_share(),
    "bi_heatmap": _heatmap(),
    "bi_daypart": _by("dim_time", "f.pickup_time_key = d.time_key", ["daypart"], _m("total_trips", "avg_revenue")),
    "bi_vendor_table": _by("dim_vendor", "f.vendor_key = d.vendor_key", ["vendor_name"],
                           _m("total_trips", "total_revenue", "revenue_per_mile", "tip_pct", "avg_trip_distance",
                              "avg_revenue")),
    "bi_payment_table": _by("dim_payment_type", "f.payment_type_key = d.payment_type_key",
                            ["payment_type_description"],
                            _m("total_trips", "total_revenue", "total_fare", "total_tips", "tip_pct")),
    "bi_top_pickup_zones": _top_zone("pu_location_key", "pickup_zone", "total_trips"),
    "bi_top_dropoff_zones": _top_zone("do_location_key", "dropoff_zone", "total_revenue"),
    "bi_routes": _routes(),
    "bi_filtered": _filtered(),
    "bi_filtered_places": _filtered_places(),
    "bi_peak_days": _peak_days(),
    "bi_store_fwd": _by("dim_trip_flags", "f.trip_flags_key = d.trip_flags_key", ["store_and_fwd_description"],
                        _m("total_trips", "total_revenue", "avg_revenue")),
    "bi_rate_code": _by("dim_rate_code", "f.rate_code_key = d.rate_code_key", ["rate_code_description"],
                        _m("total_trips", "total_revenue", "avg_revenue")),
    "bi_passenger_group": _passenger_group(),
    "star_view": _star_view(),
    **ANALYSIS,
}
