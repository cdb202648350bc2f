"""Reproducible sums of money and distances.

A SUM over DOUBLE depends on the order rows arrive in, so the same data can give a
different last bit (and, after rounding, a different cent) from run to run. Three sums
that are free of order, or as good as empty, take its place:

* values below 1e5 with two decimals, the feed's own form, are summed as whole hundredths
  in a BIGINT, which holds 9e11 such values at their largest and costs little more than
  the DOUBLE sum;
* other values (three-decimal distances, large totals) are summed as DECIMAL with ten
  decimals;
* NaN, infinities and magnitudes of 1e18 or more fit neither and are summed as DOUBLE: a
  NaN makes the total NaN, as it does in a plain sum.

The first two are added as DECIMAL and converted to DOUBLE once. Averages are that total
divided by the count, and rounding is half-up on the value's shortest decimal form (Spark
``round``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT = T.DecimalType(28, 10)
_LIMIT = 1e18
#: Below it a sum of hundredths takes 9e11 values before a BIGINT is full.
_SMALL = 1e5
#: Room for a carry, so that adding the hundredths keeps all ten decimals.
_ADDEND = T.DecimalType(37, 10)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def exact_parts(col: str | Column) -> tuple[Column, Column, Column]:
    """Three aggregates: hundredths (BIGINT), other common values (DECIMAL), all others (DOUBLE)."""
    x = _c(col).cast("double")
    hundredths = F.rint(x * 100)
    # NaN, which Spark orders above all numbers, is neither; n / 100 is x only if x has two decimals
    plain = (F.abs(x) < _SMALL) & (hundredths / 100 == x)
    common = F.abs(x) < _LIMIT
    return (
        F.sum(F.when(plain, hundredths.cast("long"))),
        F.sum(F.when(common & ~plain, x).try_cast(EXACT)),
        F.sum(F.when(~common, x)),
    )


def exact_total(hundredths: Column, exact: Column, others: Column) -> Column:
    """The DOUBLE total of (sums of) the three parts; NULL if there was no value."""
    small = hundredths.cast("decimal(19,0)") * F.lit(Decimal("0.01"))
    total = F.coalesce((small + exact.cast(_ADDEND)).cast("double"), small.cast("double"), exact.cast("double"))
    return F.when(others.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + others)


def exact_sum(col: str | Column) -> Column:
    """Order-independent SUM returned as DOUBLE."""
    return exact_total(*exact_parts(col))


def exact_avg(col: str | Column) -> Column:
    """AVG as exact total / non-null count (DOUBLE)."""
    return exact_sum(col) / F.count(_c(col))


def round_half_up(col: str | Column, digits: int) -> Column:
    return F.round(_c(col), digits)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, NULL when the denominator is 0 (SQL ``NULLIF`` guard)."""
    return numerator / F.nullif(denominator, F.lit(0.0))
