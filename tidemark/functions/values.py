"""Values on their way to a sink, as Column expressions by type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def as_text(c: Column, kind: T.DataType) -> Column:
    """The text form of the bulk format: t/f, \\x hex, ISO with a blank."""
    if isinstance(kind, T.BooleanType):
        return F.when(c, F.lit("t")).when(~c, F.lit("f"))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(c)))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite(c).cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return c.cast("string")


def normalized(df: DataFrame) -> DataFrame:
    """``df`` with non-finite floats as null; other values are native in every Spark sink."""
    floats = (T.DoubleType, T.FloatType)
    return df.select([finite(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, floats) else F.col(f"`{f.name}`") for f in df.schema.fields])


def exported(df: DataFrame) -> DataFrame:
    """All columns as the bulk format's text."""
    return df.select([as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
