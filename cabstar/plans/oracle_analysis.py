"""DuckDB SQL of the analyses, written independently of the operators."""

from __future__ import annotations

from cabstar.oracle import CTES, DEFECTS, with_ctes

_SECONDS = "CAST(floor((epoch_us({a}) - epoch_us({b})) / 1000000) AS BIGINT)"


def _seconds(a: str, b: str) -> str:
    return _SECONDS.format(a=a, b=b)


LAST_DROPOFF = with_ctes(
    f"""SELECT f.trip_id, f.pu_location_key, f.pickup_ts, e.trip_id AS earlier_trip_id, e.dropoff_ts AS earlier_dropoff_ts,
  {_seconds('f.pickup_ts', 'e.dropoff_ts')} AS idle_seconds
FROM fact f ASOF LEFT JOIN (
  SELECT do_location_key, dropoff_ts, max(trip_id) AS trip_id FROM fact GROUP BY do_location_key, dropoff_ts
) e ON f.pu_location_key = e.do_location_key AND f.pickup_ts >= e.dropoff_ts""",
    ["fact"],
)

EVENTS_WITH_ORDER = """SELECT event_id, user_id, ts, event_type, o.o_orderkey, o.o_orderdate, o.o_totalprice
FROM events e ASOF LEFT JOIN (
  SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
  FROM orders GROUP BY o_custkey, o_orderdate
) o ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate"""

PURCHASE_AFTER_VIEW = """SELECT b.event_id, b.user_id, b.ts, b.value, v.event_id AS view_id, v.ts AS view_ts, v.value AS view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') b ASOF LEFT JOIN (
  SELECT user_id, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value
  FROM events WHERE event_type = 'view' GROUP BY user_id, ts
) v ON b.user_id = v.user_id AND b.ts >= v.ts"""

OVERLAPPING = with_ctes(
    f"""SELECT a.pu_location_key, a.trip_id, b.trip_id AS other_trip_id,
  {_seconds('least(a.dropoff_ts, b.dropoff_ts)', 'greatest(a.pickup_ts, b.pickup_ts)')} AS overlap_seconds
FROM fact a JOIN fact b ON a.pu_location_key = b.pu_location_key
  AND a.pickup_ts <= b.dropoff_ts AND b.pickup_ts <= a.dropoff_ts
WHERE a.trip_id < b.trip_id""",
    ["fact"],
)


def _changes(old: str, new: str, key: str, columns: list[str], needs: list[str]) -> str:
    """Keys whose rows differ as bags; the columns by their ends."""
    differs = [
        f"CASE WHEN min({c}) FILTER (side = 'o') IS DISTINCT FROM min({c}) FILTER (side = 'n')"
        f" OR max({c}) FILTER (side = 'o') IS DISTINCT FROM max({c}) FILTER (side = 'n') THEN '{c}' END"
        for c in columns
    ]
    final = f"""SELECT {key}, CASE WHEN n_old = 0 THEN 'inserted' WHEN n_new = 0 THEN 'deleted' ELSE 'changed' END AS change,
  n_old, n_new, CASE WHEN n_old > 0 AND n_new > 0 THEN names ELSE '' END AS changed_columns
FROM (
  SELECT {key}, COUNT(*) FILTER (side = 'o') AS n_old, COUNT(*) FILTER (side = 'n') AS n_new,
    concat_ws(',', {', '.join(differs)}) AS names
  FROM (SELECT 'o' AS side, * FROM {old} UNION ALL BY NAME SELECT 'n' AS side, * FROM {new})
  GROUP BY {key}
) WHERE {key} IN (
  SELECT {key} FROM ((SELECT * FROM {old} EXCEPT ALL SELECT * FROM {new}) UNION ALL
                     (SELECT * FROM {new} EXCEPT ALL SELECT * FROM {old}))
)"""
    return with_ctes(final, needs)


# The tables' columns besides their key, in order.
_FACT_COLUMNS = [
    "ingestion_batch_key", "pickup_date_key", "dropoff_date_key", "pickup_time_key", "dropoff_time_key", "vendor_key",
    "payment_type_key", "rate_code_key", "pu_location_key", "do_location_key", "passenger_count_key", "trip_flags_key",
    "trip_quality_key", "source_file_name", "source_row_number", "pickup_ts", "dropoff_ts", "trip_count",
    "passenger_count", "trip_distance", "trip_duration_minutes", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    "total_amount", "tip_pct", "pickup_year", "pickup_month", "pickup_day",
]
_VENDOR_COLUMNS = ["vendorid", "vendor_name", "is_current"]

CTES["broken_fact"] = (DEFECTS["fact_trip"], ["fact"])
CTES["broken_vendor"] = (DEFECTS["dim_vendor"], ["dim_vendor"])

_BUSINESS = [
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "ratecodeid",
    "store_and_fwd_flag", "pulocationid", "dolocationid", "payment_type", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "source_file_name",
]


def _bag(operation: str) -> str:
    columns = ", ".join(_BUSINESS)
    return with_ctes(
        f"""SELECT {columns}, COUNT(*) AS n
FROM (SELECT {columns} FROM bronze {operation} ALL SELECT {columns} FROM silver) GROUP BY ALL""",
        ["bronze", "silver"],
    )


RUNNING = with_ctes(
    f"""SELECT trip_id, vendor_key, pickup_ts, total_amount,
  CAST(CAST(SUM(CAST(CAST(total_amount AS VARCHAR) AS DECIMAL(28,10))) OVER w AS VARCHAR) AS DOUBLE) AS running_revenue,
  row_number() OVER (PARTITION BY vendor_key ORDER BY pickup_ts, trip_id) AS running_trips,
  {_seconds('pickup_ts', 'lag(pickup_ts) OVER (PARTITION BY vendor_key ORDER BY pickup_ts, trip_id)')} AS gap_seconds
FROM fact WINDOW w AS (PARTITION BY vendor_key ORDER BY pickup_ts, trip_id ROWS UNBOUNDED PRECEDING)""",
    ["fact"],
)

SESSIONS = """WITH marked AS (
  SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS begins
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), numbered AS (
  SELECT *, SUM(begins) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked
)
SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, COUNT(*) AS n_events,
  CAST(CAST(SUM(CAST(CAST(value AS VARCHAR) AS DECIMAL(28,10))) AS VARCHAR) AS DOUBLE) AS total_value
FROM numbered GROUP BY user_id, s"""

ANALYSIS: dict[str, str] = {
    "asof_last_dropoff": LAST_DROPOFF,
    "asof_event_order": EVENTS_WITH_ORDER,
    "asof_purchase_view": PURCHASE_AFTER_VIEW,
    "overlapping_trips": OVERLAPPING,
    "changes_fact": _changes("fact", "broken_fact", "trip_id", _FACT_COLUMNS, ["fact", "broken_fact"]),
    "changes_vendor": _changes("dim_vendor", "broken_vendor", "vendor_key", _VENDOR_COLUMNS, ["dim_vendor", "broken_vendor"]),
    "bag_raw_not_curated": _bag("EXCEPT"),
    "bag_raw_and_curated": _bag("INTERSECT"),
    "running_vendor": RUNNING,
    "sessions_events": SESSIONS,
}
