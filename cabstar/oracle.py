"""DuckDB SQL that recomputes each registered query independently of Spark.

Used as the correctness oracle at small scale: the same trip expressions, the same
fixed reference values and the same rules, written as plain SQL over the raw tables.

Exactness conventions shared with the Spark side:
  * money sums are DECIMAL(28,10) sums of the values' shortest text; DECIMAL -> DOUBLE goes through VARCHAR, which
    DuckDB parses with correct rounding (a direct cast may round twice);
  * per-trip ratios are summed as DECIMAL(38,18) converted via their shortest text,
    which is how Spark converts a DOUBLE to DECIMAL;
  * ``round`` is half-up on the shortest decimal text of the value (Spark semantics).
"""

from __future__ import annotations

import re

from cabstar.sources.trips import DUPLICATE_RULE, SOURCE_FILE_DUCKDB, TRIP_COLUMNS

BATCH_ID = "20250201000000"
LOAD_STARTED = "2025-02-01 00:00:00"
LOAD_COMPLETED = "2025-02-01 00:30:00"


def xsum(x: str) -> str:
    return f"CAST(CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,10))) AS VARCHAR) AS DOUBLE)"


def ratio_sum(x: str) -> str:
    return f"CAST(CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE)"


def rnd(x: str, d: int) -> str:
    return f"CAST(CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {d}) AS VARCHAR) AS DOUBLE)"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def _values(rows, names: list[str]) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({', '.join(names)})"


# Fixed values of the contract, written out here again so that a wrong label in the code
# under test shows up as a difference.
_CODE_DIMS = {
    # kind: key column, code column, label column, label of unknown codes, extra columns, labels
    "vendor": ("vendor_key", "vendorid", "vendor_name", "Unknown Vendor", {"is_current": True},
               [(1, "Creative Mobile Technologies"), (2, "VeriFone Inc"), (6, "Myle Technologies"), (7, "Helix")]),
    "payment_type": ("payment_type_key", "payment_type", "payment_type_description", "Unknown Payment Type", {},
                     [(1, "Credit card"), (2, "Cash"), (3, "No charge"), (4, "Dispute"), (5, "Unknown"),
                      (6, "Voided trip")]),
    "rate_code": ("rate_code_key", "ratecodeid", "rate_code_description", "Unknown Rate Code", {},
                  [(1, "Standard rate"), (2, "JFK"), (3, "Newark"), (4, "Nassau or Westchester"),
                   (5, "Negotiated fare"), (6, "Group ride")]),
}
_FLAGS = [(-1, "Unknown", "Unknown"), (1, "N", "Not stored before forwarding"), (2, "Y", "Stored before forwarding")]
_QUALITY = [
    (-1, "UNKNOWN", "Unknown quality state", False, False, False),
    (1, "VALID_STANDARD", "Valid standard trip", False, False, False),
    (2, "ZERO_DISTANCE", "Valid trip with zero distance", True, False, False),
    (3, "LONG_DURATION", "Valid trip longer than four hours", False, True, False),
    (4, "HIGH_AMOUNT", "Valid trip with total amount over 500", False, False, True),
]

_TRIP_SELECT = ",\n    ".join(f"{expr} AS {name}" for name, expr in TRIP_COLUMNS)
_MEASURES = ["trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
             "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee"]
_IDS = ["vendorid", "ratecodeid", "payment_type", "pulocationid", "dolocationid", "passenger_count"]
_LINEAGE = ["pickup_ts", "dropoff_ts", "vendorid", "pulocationid", "dolocationid", "payment_type",
            "fare_amount", "total_amount", "trip_distance", "passenger_count", "ratecodeid", "store_and_fwd_flag",
            "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
            "airport_fee", "cbd_congestion_fee"]


def _date_key(d: str) -> str:
    return f"COALESCE(CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER), -1)"


def _time_key(t: str) -> str:
    return f"COALESCE(CAST(hour({t}) * 10000 + minute({t}) * 100 + second({t}) AS INTEGER), -1)"


def _code_dim(kind: str) -> str:
    key, code, label, unknown, extra, names = _CODE_DIMS[kind]
    extra_cols = "".join(f", {_lit(v)} AS {k}" for k, v in extra.items())
    extra_unknown = "".join(f", {_lit(v)}" for v in extra.values())
    return f"""
    SELECT c.code AS {key}, c.code AS {code},
           COALESCE(v.label, '{unknown} ' || CAST(c.code AS VARCHAR)) AS {label}{extra_cols}
    FROM codes c LEFT JOIN {_values(names, ['code', 'label'])} ON c.code = v.code
    WHERE c.kind = '{kind}' AND c.code <> -1
    UNION ALL SELECT -1, -1, '{unknown}'{extra_unknown}"""


CTES: dict[str, tuple[str, list[str]]] = {
    "joined": (
        """SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
        [],
    ),
    "bronze": (
        f"""SELECT {_TRIP_SELECT},
    {SOURCE_FILE_DUCKDB} AS source_file_name
  FROM (SELECT * FROM joined UNION ALL SELECT * FROM joined WHERE {DUPLICATE_RULE}) j""",
        ["joined"],
    ),
    "silver": (
        """SELECT DISTINCT *,
    CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee,
    CAST(NULL AS DOUBLE) AS cbd_congestion_fee,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date, CAST(tpep_dropoff_datetime AS DATE) AS dropoff_date,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day,
    (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60.0 AS trip_duration_minutes
  FROM bronze
  WHERE passenger_count IS NOT NULL AND passenger_count > 0 AND trip_distance > 0 AND fare_amount > 0
    AND total_amount > 0 AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND tpep_dropoff_datetime >= tpep_pickup_datetime""",
        ["bronze"],
    ),
    "norm": (
        "SELECT source_file_name, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,\n    "
        + ", ".join(f"COALESCE({c}, -1) AS {c}" for c in _IDS)
        + ",\n    store_and_fwd_flag,\n    "
        + ", ".join(f"COALESCE({c}, 0.0) AS {c}" for c in _MEASURES)
        + """,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date, CAST(tpep_dropoff_datetime AS DATE) AS dropoff_date,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day,
    (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60.0 AS trip_duration_minutes,
    (pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL AND dropoff_ts >= pickup_ts
     AND COALESCE(trip_distance, 0.0) >= 0 AND COALESCE(total_amount, 0.0) >= 0) AS is_valid
  FROM silver""",
        ["silver"],
    ),
    "numbered": (
        "SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY source_file_name ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in _LINEAGE)
        + ") AS INTEGER) AS source_row_number FROM norm WHERE is_valid",
        ["norm"],
    ),
    "fact": (
        f"""SELECT
    sha256(concat_ws('|', '{BATCH_ID}', COALESCE(source_file_name, ''),
      COALESCE(CAST(source_row_number AS VARCHAR), ''), COALESCE(CAST(pickup_ts AS VARCHAR), ''),
      COALESCE(CAST(dropoff_ts AS VARCHAR), ''), COALESCE(CAST(vendorid AS VARCHAR), ''),
      COALESCE(CAST(pulocationid AS VARCHAR), ''), COALESCE(CAST(dolocationid AS VARCHAR), ''),
      COALESCE(CAST(total_amount AS VARCHAR), ''))) AS trip_id,
    CAST({BATCH_ID} AS BIGINT) AS ingestion_batch_key,
    {_date_key('pickup_date')} AS pickup_date_key,
    {_date_key('dropoff_date')} AS dropoff_date_key,
    {_time_key('pickup_ts')} AS pickup_time_key,
    {_time_key('dropoff_ts')} AS dropoff_time_key,
    vendorid AS vendor_key, payment_type AS payment_type_key, ratecodeid AS rate_code_key,
    pulocationid AS pu_location_key, dolocationid AS do_location_key, passenger_count AS passenger_count_key,
    CASE WHEN store_and_fwd_flag = 'N' THEN 1 WHEN store_and_fwd_flag = 'Y' THEN 2 ELSE -1 END AS trip_flags_key,
    CASE WHEN trip_distance = 0 THEN 2 WHEN trip_duration_minutes > 240 THEN 3
         WHEN total_amount > 500 THEN 4 ELSE 1 END AS trip_quality_key,
    source_file_name, source_row_number, pickup_ts, dropoff_ts, 1 AS trip_count, passenger_count,
    trip_distance, trip_duration_minutes, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, congestion_surcharge, airport_fee, cbd_congestion_fee, total_amount,
    CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount ELSE 0.0 END AS tip_pct,
    pickup_year, pickup_month, pickup_day
  FROM numbered""",
        ["numbered"],
    ),
    "codes": (
        """SELECT DISTINCT kind, code FROM (
    SELECT 'vendor' AS kind, vendor_key AS code FROM fact
    UNION ALL SELECT 'payment_type', payment_type_key FROM fact
    UNION ALL SELECT 'rate_code', rate_code_key FROM fact
    UNION ALL SELECT 'passenger_count', passenger_count_key FROM fact
    UNION ALL SELECT 'location', pu_location_key FROM fact
    UNION ALL SELECT 'location', do_location_key FROM fact)""",
        ["fact"],
    ),
    "dim_vendor": (_code_dim("vendor"), ["codes"]),
    "dim_payment_type": (_code_dim("payment_type"), ["codes"]),
    "dim_rate_code": (_code_dim("rate_code"), ["codes"]),
    "zones": (
        """SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
    'Boro Zone' AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey""",
        [],
    ),
    "dim_location": (
        f"""SELECT c.code AS location_key, c.code AS location_id, COALESCE(z.borough, 'Unknown') AS borough,
    COALESCE(z.zone, 'Location ' || CAST(c.code AS VARCHAR)) AS zone,
    COALESCE(z.service_zone, 'Unknown') AS service_zone
  FROM codes c LEFT JOIN zones z ON c.code = z.location_id
  WHERE c.kind = 'location' AND c.code <> -1
  UNION ALL SELECT -1, -1, 'Unknown', 'Unknown Location', 'Unknown'""",
        ["codes", "zones"],
    ),
    "dim_passenger_count": (
        """SELECT code AS passenger_count_key, code AS passenger_count,
    CASE WHEN code = 1 THEN 'Single' WHEN code BETWEEN 2 AND 4 THEN 'Small Group'
         WHEN code >= 5 THEN 'Large Group' ELSE 'Unknown' END AS passenger_group
  FROM codes WHERE kind = 'passenger_count' AND code <> -1
  UNION ALL SELECT -1, -1, 'Unknown'""",
        ["codes"],
    ),
    "bounds": (
        "SELECT make_date(year(min(pickup_ts)), 1, 1) AS s, make_date(year(max(dropoff_ts)), 12, 31) AS e FROM fact",
        ["fact"],
    ),
    "dim_date": (
        """SELECT -1 AS date_key, CAST(NULL AS DATE) AS calendar_date, -1 AS calendar_year, -1 AS calendar_quarter,
    -1 AS calendar_month, 'Unknown' AS calendar_month_name, 'UNK' AS calendar_month_short_name,
    -1 AS calendar_day, -1 AS day_of_year, -1 AS week_of_year, 'Unknown' AS day_of_week,
    -1 AS day_of_week_number, FALSE AS is_weekend, CAST(NULL AS DATE) AS month_start_date,
    CAST(NULL AS DATE) AS month_end_date, 'Unknown' AS year_month
  UNION ALL
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER), d, CAST(year(d) AS INTEGER),
    CAST(quarter(d) AS INTEGER), CAST(month(d) AS INTEGER), monthname(d), strftime(d, '%b'),
    CAST(day(d) AS INTEGER), CAST(dayofyear(d) AS INTEGER), CAST(weekofyear(d) AS INTEGER), dayname(d),
    CAST(isodow(d) AS INTEGER), isodow(d) IN (6, 7), CAST(date_trunc('month', d) AS DATE), last_day(d),
    strftime(d, '%Y-%m')
  FROM (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
        FROM bounds)""",
        ["bounds"],
    ),
    "dim_time": (
        """SELECT -1 AS time_key, -1 AS hour, -1 AS minute, -1 AS second, 'Unknown' AS daypart
  UNION ALL
  SELECT CAST(h * 10000 + m * 100 + s AS INTEGER), CAST(h AS INTEGER), CAST(m AS INTEGER), CAST(s AS INTEGER),
    CASE WHEN h BETWEEN 5 AND 10 THEN 'Morning' WHEN h BETWEEN 11 AND 15 THEN 'Midday'
         WHEN h BETWEEN 16 AND 20 THEN 'Evening' ELSE 'Night' END
  FROM (SELECT i // 3600 AS h, (i // 60) % 60 AS m, i % 60 AS s FROM range(86400) r(i))""",
        [],
    ),
    "dim_trip_flags": (
        "SELECT * FROM " + _values(_FLAGS, ["trip_flags_key", "store_and_fwd_flag", "store_and_fwd_description"]),
        [],
    ),
    "dim_trip_quality": (
        "SELECT * FROM " + _values(_QUALITY, ["trip_quality_key", "quality_code", "quality_description",
                                                           "is_zero_distance", "is_long_duration", "is_high_amount"]),
        [],
    ),
    "dim_ingestion_batch": (
        f"""SELECT CAST({BATCH_ID} AS BIGINT) AS ingestion_batch_key, '{BATCH_ID}' AS batch_id,
    'cabstar_star_schema' AS job_name, 'not_provided' AS job_run_id, 'NYC TLC Yellow Taxi' AS source_system,
    'yellow_tripdata' AS source_dataset, 'silver' AS source_table, '' AS target_base_path,
    '{LOAD_STARTED}' AS load_started_utc, '{LOAD_COMPLETED}' AS load_completed_utc,
    CAST(COUNT(*) AS BIGINT) AS source_record_count, CAST(COUNT_IF(is_valid) AS BIGINT) AS valid_record_count,
    CAST(COUNT(*) - COUNT_IF(is_valid) AS BIGINT) AS rejected_record_count
  FROM norm""",
        ["norm"],
    ),
}


def _mart(keys: list[str], passengers: bool, tip_ratio: bool) -> str:
    cols = [*keys, "CAST(COUNT(*) AS BIGINT) AS total_trips"]
    if passengers:
        cols.append("CAST(SUM(passenger_count) AS BIGINT) AS total_passengers")
    cols += [
        f"{rnd(xsum('fare_amount'), 2)} AS total_fare",
        f"{rnd(xsum('tip_amount'), 2)} AS total_tips",
        f"{rnd(xsum('total_amount'), 2)} AS total_revenue",
    ]
    if tip_ratio:
        ratio = f"CASE WHEN {xsum('fare_amount')} <> 0 THEN {xsum('tip_amount')} / {xsum('fare_amount')} ELSE 0.0 END"
        cols.append(f"{rnd(ratio, 4)} AS tip_pct")
    else:
        cols += [
            f"{rnd(xsum('trip_distance') + ' / COUNT(trip_distance)', 2)} AS avg_trip_distance",
            f"{rnd(xsum('total_amount') + ' / COUNT(total_amount)', 2)} AS avg_revenue_per_trip",
        ]
    return f"SELECT {', '.join(cols)} FROM silver GROUP BY {', '.join(keys)}"


_PERIOD = ["pickup_year", "pickup_month"]
_SUMMARY_MEASURES = {
    "total_trips": "CAST(SUM(trip_count) AS BIGINT)",
    "total_passengers": "CAST(SUM(passenger_count) AS BIGINT)",
    "total_revenue": xsum("total_amount"),
    "total_fare": xsum("fare_amount"),
    "total_tips": xsum("tip_amount"),
    "avg_trip_distance": f"{xsum('trip_distance')} / COUNT(*)",
    "avg_trip_duration_minutes": "CAST(SUM(epoch(dropoff_ts) - epoch(pickup_ts)) AS DOUBLE) / COUNT(*) / 60.0",
    "avg_revenue": f"{xsum('total_amount')} / COUNT(*)",
    "avg_tip_pct": f"{ratio_sum('tip_pct')} / COUNT(*)",
}


def _summary(keys: list[str], measures: list[str]) -> str:
    cols = [*keys, *[f"{_SUMMARY_MEASURES[m]} AS {m}" for m in measures]]
    return f"SELECT {', '.join(cols)} FROM fact GROUP BY {', '.join(keys)}"


CTES.update(
    {
        "gold_daily_revenue": (_mart(["pickup_date", *_PERIOD], True, False), ["silver"]),
        "gold_vendor_revenue": (_mart(["vendorid", *_PERIOD], False, False), ["silver"]),
        "gold_payment_type_analysis": (_mart(["payment_type", *_PERIOD], False, True), ["silver"]),
        "gold_passenger_analysis": (_mart(["passenger_count", *_PERIOD], False, False), ["silver"]),
        "fact_daily_trip_summary": (
            _summary(["pickup_date_key", "pickup_year"],
                     ["total_trips", "total_passengers", "total_revenue", "total_fare", "total_tips",
                      "avg_trip_distance", "avg_trip_duration_minutes", "avg_revenue"]),
            ["fact"],
        ),
        "fact_vendor_daily_summary": (
            _summary(["pickup_date_key", "vendor_key", *_PERIOD],
                     ["total_trips", "total_revenue", "total_tips", "avg_trip_distance", "avg_revenue"]),
            ["fact"],
        ),
        "fact_payment_daily_summary": (
            _summary(["pickup_date_key", "payment_type_key", *_PERIOD],
                     ["total_trips", "total_revenue", "total_fare", "total_tips", "avg_tip_pct"]),
            ["fact"],
        ),
        "fact_location_daily_summary": (
            _summary(["pickup_date_key", "pu_location_key", "do_location_key", *_PERIOD],
                     ["total_trips", "total_revenue", "total_tips", "avg_trip_distance", "avg_trip_duration_minutes"]),
            ["fact"],
        ),
    }
)


def with_ctes(final_select: str, needs: list[str]) -> str:
    """Prefix ``final_select`` with every CTE it (transitively) needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][1]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} AS (\n  {CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final_select}"


def uncleansed(sql: str) -> str:
    """The same query with the curated trips replaced by the raw ones."""
    raw = """SELECT *, CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee,
    CAST(NULL AS DOUBLE) AS cbd_congestion_fee FROM bronze"""
    assert CTES["silver"][0] in sql
    return sql.replace(CTES["silver"][0], raw)


#: The injected defects, written out independently of the code under test.
DEFECTS = {
    "fact_trip": """SELECT * REPLACE (
      CASE WHEN source_row_number % 41 = 0 THEN NULL ELSE vendor_key END AS vendor_key,
      CASE WHEN source_row_number % 47 = 0 THEN NULL ELSE rate_code_key END AS rate_code_key,
      CASE WHEN source_row_number % 43 = 0 THEN 99 ELSE payment_type_key END AS payment_type_key,
      CASE WHEN source_row_number % 59 = 0 THEN 99 ELSE pickup_date_key END AS pickup_date_key)
    FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE source_row_number % 53 = 0)""",
    "dim_date": "SELECT * FROM dim_date WHERE calendar_day <> 13",
    "dim_vendor": "SELECT * FROM dim_vendor UNION ALL SELECT * FROM dim_vendor WHERE vendor_key = 1",
    "dim_location": "SELECT * FROM dim_location WHERE location_key <> -1",
}


def with_defects(sql: str) -> str:
    """The same query over the defective tables."""
    head, final = sql.rsplit("\n)\n", 1)
    final = re.sub(r"\b(FROM|JOIN) fact\b", r"\1 fact_trip", final)
    used = [t for t in DEFECTS if re.search(rf"\b(FROM|JOIN) {t}\b", final)]
    for t in used:
        final = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 bad_{t}", final)
    bad = ",\n".join(f"bad_{t} AS (\n  {DEFECTS[t]}\n)" for t in used)
    return f"{head}\n),\n{bad}\n{final}"


def table_sql(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}", [name])


CTES["fact_trip"] = ("SELECT * FROM fact", ["fact"])
