"""Raw -> curated trips: align drifting schemas, cast to the contract, derive calendar
columns and duration, apply the curated validity rules, drop exact duplicates.

Everything is one projection + one filter + one distinct aggregate, so the plan is a
single scan stage (partial distinct aggregate map-side, which also collapses hot groups
of re-sent copies before the shuffle) and one shuffle for the final distinct. Only the
feed's own columns are shuffled and compared; the derived ones follow from them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstar.functions.casts import lenient_cast
from cabstar.functions.keys import duration_minutes

# The raw trip contract (column, type) in file order.
TRIP_CONTRACT: list[tuple[str, str]] = [
    ("vendorid", "int"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "int"),
    ("trip_distance", "double"),
    ("ratecodeid", "int"),
    ("store_and_fwd_flag", "string"),
    ("pulocationid", "int"),
    ("dolocationid", "int"),
    ("payment_type", "int"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("airport_fee", "double"),
    ("cbd_congestion_fee", "double"),
]

# Fee columns introduced in later years of the feed; older files lack them.
OPTIONAL_FEES = ["congestion_surcharge", "airport_fee", "cbd_congestion_fee"]

DERIVED_COLUMNS = ["pickup_date", "dropoff_date", "pickup_year", "pickup_month", "pickup_day", "trip_duration_minutes"]


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


def curated_rules() -> list[Rule]:
    """A curated trip has passengers, a positive distance/fare/total and ordered times."""
    c = F.col
    return [
        Rule("passenger_count_present", c("passenger_count").isNotNull()),
        Rule("passenger_count_positive", c("passenger_count") > 0),
        Rule("trip_distance_positive", c("trip_distance") > 0),
        Rule("fare_amount_positive", c("fare_amount") > 0),
        Rule("total_amount_positive", c("total_amount") > 0),
        Rule("pickup_present", c("tpep_pickup_datetime").isNotNull()),
        Rule("dropoff_present", c("tpep_dropoff_datetime").isNotNull()),
        Rule("dropoff_not_before_pickup", c("tpep_dropoff_datetime") >= c("tpep_pickup_datetime")),
    ]


def all_of(rules: list[Rule]) -> Column:
    pred = F.lit(True)
    for rule in rules:
        pred = pred & rule.predicate
    return pred


def align_schema(df: DataFrame) -> DataFrame:
    """Add every missing optional fee column as NULL DOUBLE (names matched case-insensitively)."""
    present = {name.lower() for name in df.columns}
    missing = [F.lit(None).cast("double").alias(fee) for fee in OPTIONAL_FEES if fee not in present]
    return df.select("*", *missing) if missing else df


def cast_to_contract(df: DataFrame) -> DataFrame:
    """One projection: contract columns cast (and renamed to lower case), others kept as they are.

    A feed without one of the required columns (all but the optional fees) is refused.
    """
    contract = dict(TRIP_CONTRACT)
    present = {name.lower() for name in df.columns}
    if missing := [c for c in contract if c not in present and c not in OPTIONAL_FEES]:
        raise ValueError(f"the raw trips lack required columns: {', '.join(missing)}")
    out = []
    for name in df.columns:
        lowered = name.lower()
        if lowered in contract:
            out.append(lenient_cast(df, name, contract[lowered]).alias(lowered))
        else:
            out.append(F.col(name))
    return df.select(*out)


def with_trip_calendar(df: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    """Pickup/dropoff dates, pickup year/month/day and whole-second duration in minutes."""
    return df.withColumns(
        {
            "pickup_date": F.to_date(pickup),
            "dropoff_date": F.to_date(dropoff),
            "pickup_year": F.year(pickup).cast("int"),
            "pickup_month": F.month(pickup).cast("int"),
            "pickup_day": F.dayofmonth(pickup).cast("int"),
            "trip_duration_minutes": duration_minutes(pickup, dropoff),
        }
    )


def cleanse(raw: DataFrame, ignore_lineage: bool = False, placed_by: Mapping[str, Column] | None = None) -> DataFrame:
    """Curated trips from raw trips.

    Duplicates are whole rows, lineage included: the same trip delivered in two files is
    kept twice unless ``ignore_lineage`` is set (then one arbitrary file name survives).

    ``placed_by`` names expressions of a row's own columns; they are appended, and the rows are
    shuffled by them instead of by the whole row. What then groups by these columns needs no
    shuffle of its own.
    """
    typed = cast_to_contract(align_schema(raw))
    curated = typed.where(all_of(curated_rules()))
    if placed_by:
        curated = curated.withColumns(dict(placed_by)).repartition(*placed_by)
    if ignore_lineage and "source_file_name" in curated.columns:
        curated = curated.dropDuplicates([c for c in curated.columns if c != "source_file_name"])
    else:
        curated = curated.dropDuplicates()
    return with_trip_calendar(curated, "tpep_pickup_datetime", "tpep_dropoff_datetime")
