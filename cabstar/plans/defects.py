"""A warehouse with known defects, so that every check has something to find.

From a sound warehouse: some fact rows twice (one trip id each), some without a vendor or
rate code, some with a payment type or pickup date that no dimension has, one day of each
month missing from the calendar, one vendor listed twice, and no unknown location. The
rules below count on data that any load has; they choose by row number and key.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.plans.warehouse import Warehouse

#: Fixed values of the injected defects.
TWICE, NO_VENDOR, NO_RATE, LOST_PAYMENT, LOST_DATE = 53, 41, 47, 43, 59
MISSING_DAY, DOUBLE_VENDOR = 13, 1
NO_SUCH_KEY = 99


def _defective_fact(fact: DataFrame) -> DataFrame:
    def every(n: int):
        return F.col("source_row_number") % n == 0

    broken = fact.withColumns(
        {
            "vendor_key": F.when(~every(NO_VENDOR), F.col("vendor_key")),
            "rate_code_key": F.when(~every(NO_RATE), F.col("rate_code_key")),
            "payment_type_key": F.when(every(LOST_PAYMENT), F.lit(NO_SUCH_KEY)).otherwise(F.col("payment_type_key")),
            "pickup_date_key": F.when(every(LOST_DATE), F.lit(NO_SUCH_KEY)).otherwise(F.col("pickup_date_key")),
        }
    )
    copies = F.explode(F.when(every(TWICE), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return broken.withColumn("_copy", copies).drop("_copy")


def defective(w: Warehouse) -> Warehouse:
    """``w`` with the defects in its fact and dimensions; the summaries are those of ``w``."""
    dims = w.dims
    vendors = dims["dim_vendor"]
    given = {
        "fact_trip": _defective_fact(w.fact),
        "dim_date": dims["dim_date"].where(F.col("calendar_day") != MISSING_DAY),
        "dim_vendor": vendors.unionByName(vendors.where(F.col("vendor_key") == DOUBLE_VENDOR)),
        "dim_location": dims["dim_location"].where(F.col("location_key") != -1),
        **{name: dims[name] for name in ("dim_payment_type", "dim_rate_code", "dim_passenger_count")},
        **{table: w.tables()[table] for table in w.tables() if table.endswith("_summary")},
    }
    return replace(w, overrides={**w.overrides, **given})
