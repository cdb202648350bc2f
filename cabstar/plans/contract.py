"""Declared schemas of the warehouse's tables (column types; keys are INT).

Fixed values of the table contract. ``register_table`` refuses files that differ.
"""

from __future__ import annotations

from pyspark.sql import types as T

from cabstar.operators.cleanse import TRIP_CONTRACT


def _columns(kind: str, names: str) -> list[tuple[str, str]]:
    return [(name, kind) for name in names.split()]


_PERIOD = _columns("int", "pickup_year pickup_month")
_MEASURES = "trip_distance fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge total_amount"
_FEES = "congestion_surcharge airport_fee cbd_congestion_fee"

_TABLES: dict[str, list[tuple[str, str]]] = {
    "silver": [
        *TRIP_CONTRACT,
        ("source_file_name", "string"),
        *_columns("date", "pickup_date dropoff_date"),
        *_PERIOD,
        ("pickup_day", "int"),
        ("trip_duration_minutes", "double"),
    ],
    "fact_trip": [
        ("trip_id", "string"),
        ("ingestion_batch_key", "bigint"),
        *_columns("int", "pickup_date_key dropoff_date_key pickup_time_key dropoff_time_key vendor_key"),
        *_columns("int", "payment_type_key rate_code_key pu_location_key do_location_key passenger_count_key"),
        *_columns("int", "trip_flags_key trip_quality_key source_row_number trip_count passenger_count"),
        ("source_file_name", "string"),
        *_columns("timestamp_ntz", "pickup_ts dropoff_ts"),
        *_columns("double", f"{_MEASURES} {_FEES} trip_duration_minutes tip_pct"),
        *_PERIOD,
        ("pickup_day", "int"),
    ],
    "dim_date": [
        ("calendar_date", "date"),
        *_columns("int", "date_key calendar_year calendar_quarter calendar_month calendar_day day_of_year"),
        *_columns("int", "week_of_year day_of_week_number"),
        *_columns("string", "calendar_month_name calendar_month_short_name day_of_week year_month"),
        ("is_weekend", "boolean"),
        *_columns("date", "month_start_date month_end_date"),
    ],
    "dim_time": [*_columns("int", "time_key hour minute second"), ("daypart", "string")],
    "dim_vendor": [*_columns("int", "vendor_key vendorid"), ("vendor_name", "string"), ("is_current", "boolean")],
    "dim_payment_type": [*_columns("int", "payment_type_key payment_type"), ("payment_type_description", "string")],
    "dim_rate_code": [*_columns("int", "rate_code_key ratecodeid"), ("rate_code_description", "string")],
    "dim_location": [*_columns("int", "location_key location_id"), *_columns("string", "borough zone service_zone")],
    "dim_passenger_count": [*_columns("int", "passenger_count_key passenger_count"), ("passenger_group", "string")],
    "fact_daily_trip_summary": [
        *_columns("int", "pickup_date_key pickup_year"),
        *_columns("bigint", "total_trips total_passengers"),
        *_columns("double", "total_revenue total_fare total_tips avg_trip_distance avg_trip_duration_minutes"),
        ("avg_revenue", "double"),
    ],
    "fact_vendor_daily_summary": [
        *_columns("int", "pickup_date_key vendor_key"),
        *_PERIOD,
        ("total_trips", "bigint"),
        *_columns("double", "total_revenue total_tips avg_trip_distance avg_revenue"),
    ],
    "fact_payment_daily_summary": [
        *_columns("int", "pickup_date_key payment_type_key"),
        *_PERIOD,
        ("total_trips", "bigint"),
        *_columns("double", "total_revenue total_fare total_tips avg_tip_pct"),
    ],
    "fact_location_daily_summary": [
        *_columns("int", "pickup_date_key pu_location_key do_location_key"),
        *_PERIOD,
        ("total_trips", "bigint"),
        *_columns("double", "total_revenue total_tips avg_trip_distance avg_trip_duration_minutes"),
    ],
}

_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
    "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "boolean": T.BooleanType(),
}
DECLARED = {
    name: T.StructType([T.StructField(column, _TYPES[kind]) for column, kind in columns])
    for name, columns in _TABLES.items()
}
