"""Pages and ranges of a table. Each is one declarative filter that reaches the scan, never a loop."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import sanitize_all
from tidemark.operators.ranges import range_of, sketch_edges, sketchable
from tidemark.sources.shared import written

#: ranges of a key index, and rows that one task may number
INDEX_RANGES = 256
MOST_IN_ONE_TASK = 500_000


def project(df: DataFrame, columns: list[str] | None = None, renamed: bool = False) -> DataFrame:
    """Columns in source order or as given; optionally under their sanitised names. Names match exactly."""
    chosen = columns or df.columns
    if missing := [c for c in chosen if c not in df.columns]:
        raise ValueError(f"no such columns: {missing}")
    out = df.select([F.col(f"`{c}`") for c in chosen])
    return out.toDF(*sanitize_all(chosen)) if renamed else out


def key_struct(df: DataFrame, key: list[str], values: tuple | None = None) -> Column:
    """The key as a struct; with values, literals cast to the key columns' types."""
    if values is None:
        return F.struct(*key)
    return F.struct(*(F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(key, values)))


def in_range(df: DataFrame, key: list[str], low: tuple | None = None, high: tuple | None = None, open_low: bool = False, open_high: bool = False) -> Column:
    """Lexicographic low <= key <= high; an end that is None is open, 0 is a value.

    Of a composite key the first column is compared by itself too: that comparison reaches the files.
    """
    out = F.lit(True)
    first = lambda v: F.lit(v[0]).cast(df.schema[key[0]].dataType)
    if len(key) == 1:
        own, edge = F.col(key[0]), first
    else:
        own, edge = key_struct(df, key), lambda v: key_struct(df, key, v)
        out = reduce(lambda a, b: a & b, ([F.col(key[0]) >= first(low)] if low is not None else []) + ([F.col(key[0]) <= first(high)] if high is not None else []), out)
    if low is not None:
        out = out & ((own > edge(low)) if open_low else (own >= edge(low)))
    if high is not None:
        out = out & ((own < edge(high)) if open_high else (own <= edge(high)))
    return out


def keyset_page(df: DataFrame, key: str, after: Any = None, limit: int | None = None, where: Column | None = None) -> DataFrame:
    """Up to ``limit`` rows behind a key value, in key order."""
    if where is not None:
        df = df.where(where)
    if after is not None:
        df = df.where(F.col(key) > F.lit(after))
    df = df.orderBy(key)
    return df if limit is None else df.limit(limit)


@dataclass(frozen=True)
class KeyIndex:
    """How many rows each range of the first order column holds: row numbers lead to ranges, and ranges to files."""

    edges: list
    counts: list[int]

    @property
    def even(self) -> bool:
        """Whether no range is so crowded that one task should not number it."""
        return max(self.counts) <= max(4 * sum(self.counts) / len(self.counts), 100_000)

    def before(self, r: int) -> int:
        return sum(self.counts[:r])

    def holding(self, number: int) -> int:
        """The range that holds the row of a number from 1; the last one beyond the end."""
        return min(bisect_left(list(accumulate(self.counts)), number), len(self.counts) - 1)

    def rows(self, df: DataFrame, column: str, first: int, last: int) -> DataFrame:
        """The rows of ranges first..last; of the first range those with null keys too."""
        low = (self.edges[first - 1],) if first else None
        high = (self.edges[last],) if last < len(self.edges) else None
        inside = in_range(df, [column], low, high, open_high=True)
        return df.where(inside if first else inside | F.col(column).isNull())


def key_index(df: DataFrame, column: str, ranges: int = INDEX_RANGES) -> KeyIndex | None:
    """Two passes over one column, nothing sorted or written; None for a kind of key that has no quantile sketch."""
    if not sketchable(df.schema[column].dataType):
        return None
    edges = sketch_edges(df, column, ranges, 0.1)
    counts = dict(df.groupBy(range_of(F.col(column), edges, df.schema[column].dataType).alias("r")).count().collect())
    return KeyIndex(edges, [counts.get(i, 0) for i in range(len(edges) + 1)])


def _nulls_first(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def row_number_page(df: DataFrame, order: list[str], first: int, last: int, index: KeyIndex | None = None) -> DataFrame:
    """Rows first..last, from 1, in the order of ``order``, with their number as ``rn``.

    An ``index`` of the first column (made here if none is given; pages of one table share it) says in which ranges of it the page
    lies; only these are read and numbered. Where the index is of no use (texts, or one value in very many rows), the keys are
    numbered as a whole, and the page's first and last key cut the rows out. ``order`` must be total (a key) for a stable result.
    """
    index = index or key_index(df, order[0])
    if index and index.even:
        if first > sum(index.counts) or last < first:
            return df.withColumn("rn", F.lit(0).cast("long")).limit(0)
        a, b = index.holding(first), index.holding(last)
        if sum(index.counts[a : b + 1]) <= max(4 * (last - first + 1), MOST_IN_ONE_TASK):
            page = index.rows(df, order[0], a, b)
            numbered = page.withColumn("rn", (F.row_number().over(Window.orderBy(*_nulls_first(order))) + F.lit(index.before(a))).cast("long"))
            return numbered.where(F.col("rn").between(first, last))
    numbered = with_row_number(df.select(*order), order, "rn").where(F.col("rn").between(first, last))
    edge = numbered.agg(F.min("rn").alias("first"), F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high")).first()
    if edge["first"] is None:
        return df.withColumn("rn", F.lit(0).cast("long")).limit(0)
    low, high = (tuple(edge[x]) for x in ("low", "high"))
    if any(v is None for v in (*low, *high)):  # a null has no place in a comparison
        return with_row_number(df, order, "rn").where(F.col("rn").between(first, last))
    page = df.where(in_range(df, order, low, high))
    by = Window.orderBy(*_nulls_first(order))  # over no more rows than the page has
    return page.withColumn("rn", (F.row_number().over(by) + F.lit(edge["first"] - 1)).cast("long"))


def with_row_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Exact row numbers from 1 by ``order``, in parallel; the order must be total for a stable result.

    The rows are range-partitioned and numbered per partition, and only the partitions' counts meet in one
    place, so that no task gets the whole table as it would under an unpartitioned window.
    """
    # written once: both branches below must see the same ranges
    ranged = written(df.repartitionByRange(*_nulls_first(order)).withColumn("__part", F.spark_partition_id()))
    local = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(*_nulls_first(order))))
    counts = ranged.groupBy("__part").count()
    base = counts.select("__part", (F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).alias("__base"))
    out = local.join(F.broadcast(base), "__part")  # a row for each partition
    return out.withColumn(name, F.col("__n") + F.coalesce("__base", F.lit(0))).drop("__part", "__n", "__base")
