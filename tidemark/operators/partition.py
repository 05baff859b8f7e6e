"""Range planning: balanced tiles, arithmetic ranges, bounds."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import quote_double
from tidemark.functions.sizing import key_ranges
from tidemark.operators.ranges import range_of, sketch_edges, sketchable
from tidemark.operators.scan import INDEX_RANGES, key_index, with_row_number
from tidemark.sources.spec import literal


def tile_of(rank: Column, total: int, n: int) -> Column:
    """NTILE of a row number from 1: the first total % n tiles have one row more."""
    small, larger = divmod(total, n)
    if not small:
        return rank.cast("int")
    edge = larger * (small + 1)
    return F.when(rank <= edge, F.ceil(rank / (small + 1))).otherwise(larger + F.ceil((rank - edge) / small)).cast("int")


def tile_sizes(total: int, n: int) -> list[int]:
    """The rows of each tile of NTILE(n), without empty ones."""
    small, larger = divmod(total, n)
    return [x for i in range(n) if (x := small + (i < larger))]


def ntile_bounds(df: DataFrame, key: str, n: int) -> DataFrame:
    """(tile, min_pk, max_pk, row_count), exactly as NTILE(n) cuts, without sorting in one task.

    A tile's first and last row lie in known ranges of an index of the key; only these ranges are numbered. Keys that have no
    index (texts, or a value in very many rows) are numbered as a whole.
    """
    index = key_index(df, key, max(INDEX_RANGES, 16 * n))
    if index is None or not index.even:
        return _ntile_of_all(df, key, n)
    sizes = tile_sizes(sum(index.counts), n)
    ends = list(accumulate(sizes))
    tiles = [(t + 1, end - size + 1, end, size) for t, (end, size) in enumerate(zip(ends, sizes))]
    wanted = sorted({x for _, a, b, _ in tiles for x in (a, b)})
    held = sorted({index.holding(x) for x in wanted})
    if not wanted:
        return _ntile_of_all(df, key, n)
    before = F.element_at(F.create_map(*(F.lit(x) for r in held for x in (r, index.before(r)))), F.col("__r"))
    spans = [index.rows(df.select(key), key, a, b) for a, b in _spans(held)]
    read = reduce(DataFrame.unionByName, spans).withColumn("__r", range_of(F.col(key), index.edges, df.schema[key].dataType))
    number = F.row_number().over(Window.partitionBy("__r").orderBy(F.col(key).asc_nulls_first())) + before
    at = dict(read.select(number.alias("n"), key).where(F.col("n").isin(wanted)).collect())  # two keys a tile
    schema = T.StructType([T.StructField("tile", T.IntegerType()), T.StructField("min_pk", df.schema[key].dataType), T.StructField("max_pk", df.schema[key].dataType), T.StructField("row_count", T.LongType())])
    if any(at[a] is None and at[b] is not None for _, a, b, _ in tiles):  # MIN is the first key behind the nulls: not at hand
        return _ntile_of_all(df, key, n)
    return df.sparkSession.createDataFrame([(t, at[a], at[b], size) for t, a, b, size in tiles], schema)


def _spans(ranges: list[int]) -> list[tuple[int, int]]:
    """Runs of neighbouring ranges."""
    out: list[tuple[int, int]] = []
    for r in ranges:
        if out and out[-1][1] == r - 1:
            out[-1] = (out[-1][0], r)
        else:
            out.append((r, r))
    return out


def _ntile_of_all(df: DataFrame, key: str, n: int) -> DataFrame:
    ranked = with_row_number(df.select(key), [key], "__rank")
    total = ranked.agg(F.max("__rank")).first()[0] or 0
    tiles = ranked.withColumn("tile", tile_of(F.col("__rank"), total, n))
    return tiles.groupBy("tile").agg(F.min(key).alias("min_pk"), F.max(key).alias("max_pk"), F.count("*").alias("row_count"))


def sketch_bounds(df: DataFrame, key: str, n: int, error: float = 0.01) -> DataFrame:
    """(tile, min_pk, max_pk, row_count) of ranges as NTILE would cut them, within ``error``; two passes, no sort, nothing written.

    A key that repeats stays in one range, however often. Null keys are in the first.
    """
    edges = sketch_edges(df, key, n, error)
    tiles = df.select(key, (range_of(F.col(key), edges, df.schema[key].dataType) + 1).alias("tile"))
    return tiles.groupBy("tile").agg(F.min(key).alias("min_pk"), F.max(key).alias("max_pk"), F.count("*").alias("row_count"))


def range_edges(df: DataFrame, key: str, n: int) -> list:
    """The lows of n ranges but the first: by a sketch, or of keys without one (texts) by exact tiles."""
    if n < 2:
        return []
    if sketchable(df.schema[key].dataType):
        return sketch_edges(df, key, n)
    lows = sorted(r.min_pk for r in ntile_bounds(df.where(F.col(key).isNotNull()), key, n).collect())
    return sorted(set(lows[1:]))


def footer_bounds(spark: SparkSession, path: str, key: str) -> tuple[int, Any, Any]:
    """(rows, smallest, largest key) of Parquet files from their footers: no column is read."""
    return footer_aggregate(spark, path, key).first()


def footer_aggregate(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(n, low, high), in a session of its own whose reader answers aggregates from footers."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))


def half_open(bounds: list[tuple]) -> list[tuple]:
    """(low, next low) of inclusive bounds; repeated boundary keys fall to one range; the last is open."""
    lows = sorted({b[0] for b in bounds})
    return [(None if i == 0 else low, lows[i + 1] if i + 1 < len(lows) else None) for i, low in enumerate(lows)]


def arithmetic_bounds(df: DataFrame, key: str, n: int) -> list[tuple[int, int]]:
    low, high = df.agg(F.min(key), F.max(key)).first()
    return [] if low is None else key_ranges(low, high, n)


def key_bounds(df: DataFrame, key: list[str], where: Column | None = None) -> DataFrame:
    """Smallest and largest key as whole tuples, so that a composite range is not widened."""
    if where is not None:
        df = df.where(where)
    return df.agg(F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high"))


def jdbc_predicates(key: str, ranges: list[tuple], quote: Callable[[str], str] = quote_double) -> list[str]:
    """Disjoint predicates that cover all rows, null keys included in the first; ``quote`` is the source's way to quote a name."""
    key = quote(key)
    out = []
    for low, high in ranges:
        parts = ([f"{key} >= {literal(low)}"] if low is not None else []) + ([f"{key} < {literal(high)}"] if high is not None else [])
        text = " AND ".join(parts) or "1 = 1"
        out.append(f"({text} OR {key} IS NULL)" if low is None else text)
    return out


def parallel(readers: int, rows: int, page: int) -> bool:
    """Whether a table is worth several readers: more than one asked for, and two pages at least."""
    return readers > 1 and rows >= 2 * page
