"""Ranges of a key: which one a key falls in, and where to cut balanced ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEPARATOR = "\u0001"


def range_of(key: Column, edges: list, kind: T.DataType) -> Column:
    """The number of the range that a key falls in: how many edges it reaches; nulls are in the first.

    Beyond a few edges a binary search in one array literal: a chain of conditions would grow with the ranges.
    """
    if len(edges) <= 8:
        return sum(((F.coalesce(key >= F.lit(e).cast(kind), F.lit(False))).cast("int") for e in edges), F.lit(0))
    listed = F.split(F.lit(_SEPARATOR.join(str(e) for e in edges)), _SEPARATOR).cast(T.ArrayType(kind))
    n, steps = len(edges), [1 << k for k in reversed(range(len(edges).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        to = at + step
        reached = (to <= n) & (F.get(listed, F.least(to, F.lit(n)) - 1) <= key)
        return F.when(reached, to).otherwise(at)

    return F.aggregate(F.array(*(F.lit(x) for x in steps)), F.lit(0), further)


def sketchable(kind: T.DataType) -> bool:
    """Whether a key of the kind has quantile sketches."""
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def sketch_edges(df: DataFrame, key: str, n: int, error: float = 0.01) -> list:
    """The lows of all of n balanced ranges but the first, from a quantile sketch of one pass; each is off by ``error`` of a range at most."""
    cuts = [i / n for i in range(1, n)]
    found = df.agg(F.percentile_approx(key, cuts, int(2 * n / error))).first()[0] if cuts else []
    return sorted(set(found or []))
