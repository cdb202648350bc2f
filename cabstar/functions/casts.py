"""Schema-aware lenient casts.

Spark 4 runs with ANSI semantics, where ``CAST('x' AS INT)`` raises. The trip feeds
rely on the lenient behaviour (bad text becomes NULL and is filtered later), so every
cast goes through these helpers. They look at the *input* type, which is plan
metadata, not data: when the physical type already matches the contract the column is
passed through untouched, so Catalyst can still push predicates into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _input_type(df: DataFrame, name: str) -> T.DataType:
    lowered = name.lower()
    for field in df.schema.fields:
        if field.name.lower() == lowered:
            return field.dataType
    raise KeyError(name)


def lenient_cast(df: DataFrame, name: str, target: str) -> Column:
    """Cast ``df[name]`` to ``target`` ('int', 'double', 'string', 'timestamp_ntz').

    Text is parsed leniently: '1.7' -> 1 for int (via double, like a non-ANSI cast),
    'x' -> NULL. Numeric overflow gives NULL instead of wrapping.
    """
    source = _input_type(df, name)
    col = F.col(name)
    if target == "int":
        if isinstance(source, T.IntegerType):
            return col
        if isinstance(source, (T.ByteType, T.ShortType)):
            return col.cast("int")
        if isinstance(source, _NUMERIC):
            return col.try_cast("int")
        return col.try_cast("double").try_cast("int")
    if target == "double":
        if isinstance(source, T.DoubleType):
            return col
        if isinstance(source, _NUMERIC):
            return col.cast("double")
        return col.try_cast("double")
    if target == "string":
        return col if isinstance(source, T.StringType) else col.cast("string")
    if target == "timestamp_ntz":
        if isinstance(source, T.TimestampNTZType):
            return col
        if isinstance(source, (T.TimestampType, T.DateType)):
            return col.cast("timestamp_ntz")
        return col.try_cast("timestamp_ntz")
    raise ValueError(f"unsupported contract type {target!r}")
