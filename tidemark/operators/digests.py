"""Digests of key ranges: where two tables differ, found without joining what is equal.

Rows are hashed and summed by leaf: a range of the key and, inside it, one of ``FAN`` buckets of the key's hash. Leaves
of a range add up to the range's digest, and ranges to the table's, so a comparison goes from the top down: equal tables end at the first
sum, equal ranges are not looked into, and only rows of leaves that differ are read again and joined. Digests of a target can be kept
beside it, with the version that they are of; then a full comparison with its source reads the target in those ranges only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.load import Store, range_of
from tidemark.operators.scan import in_range
from tidemark.sources.shared import written

FAN = 64
#: leaves that are told apart inside their ranges; of more, whole ranges are compared
MOST_LISTED = 5_000


def encoded(columns: list[str]) -> Column:
    """The values as one text that no other values have: each with its length before it, null as a mark of its own."""
    value = lambda c: F.col(f"`{c}`").cast("string")
    return F.concat(*(F.coalesce(F.concat(F.length(value(c)).cast("string"), F.lit(":"), value(c)), F.lit("~")) for c in columns))


def leaf_digests(df: DataFrame, key: list[str], edges: list, columns: list[str] | None = None, fan: int = FAN) -> DataFrame:
    """(range, bucket, n, high, low): of each leaf its rows and the sums of two 64-bit hashes of the rows. One pass, ranges x fan rows."""
    kind = df.schema[key[0]].dataType
    others = [c for c in columns or sorted(df.columns) if c not in key]
    values = _hashable([*key, *others])
    leaf = df.select(range_of(F.col(key[0]), edges, kind).alias("range"), bucket_of(key, fan).alias("bucket"), F.xxhash64(*values).alias("h"), F.xxhash64(F.lit(1), *values).alias("g"))
    whole = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)")
    return leaf.groupBy("range", "bucket").agg(F.count("*").alias("n"), whole("h").alias("high"), whole("g").alias("low"))


def _hashable(columns: list[str]) -> list[Column]:
    """The columns, each with whether it is null: a hash alone passes nulls over. Columns of other types have other hashes, and are compared then."""
    return [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]


def bucket_of(key: list[str], fan: int) -> Column:
    return F.pmod(F.xxhash64(*_hashable(key)), F.lit(fan)).cast("int")


def upper(leaves: DataFrame) -> DataFrame:
    """The digests of ranges."""
    return leaves.groupBy("range").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")))


def unequal(a: DataFrame, b: DataFrame, at: list[str]) -> DataFrame:
    """The places whose digests differ or that one side lacks."""
    sums = lambda df, s: df.select(*at, F.struct("n", F.col("high").cast("decimal(38,0)"), F.col("low").cast("decimal(38,0)")).alias(s))
    return sums(a, "a").join(sums(b, "b"), at, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(*at)


@dataclass
class Leaves:
    """Leaves that differ: [(range, bucket)], at most ranges x fan of them."""

    found: list[tuple[int, int]]
    edges: list
    fan: int

    @property
    def ranges(self) -> list[int]:
        return sorted({r for r, _ in self.found})

    def rows(self, df: DataFrame, key: list[str]) -> DataFrame:
        """The rows of these leaves. Their ranges are conditions that reach the files."""
        if not self.found:
            return df.limit(0)
        spans: list[list[int]] = []
        for r in self.ranges:
            if spans and spans[-1][1] == r - 1:
                spans[-1][1] = r
            else:
                spans.append([r, r])
        low = lambda r: None if r == 0 else (self.edges[r - 1],)
        high = lambda r: None if r == len(self.edges) else (self.edges[r],)
        first = [key[0]]
        inside = [in_range(df, first, low(a), high(b), open_high=True) | (F.col(key[0]).isNull() if a == 0 else F.lit(False)) for a, b in spans]
        rows = df.where(reduce(lambda x, y: x | y, inside))
        if len(self.found) > MOST_LISTED:  # most of these ranges differ: all of their rows are compared
            return rows
        leaf = range_of(F.col(key[0]), self.edges, df.schema[key[0]].dataType) * self.fan + bucket_of(key, self.fan)
        return rows.where(leaf.isin([r * self.fan + b for r, b in self.found]))


def differing_leaves(a: DataFrame, b: DataFrame, edges: list, fan: int = FAN) -> Leaves:
    """From the ranges down to their leaves; leaves are digests of two tables cut alike."""
    ranges = [r[0] for r in unequal(upper(a), upper(b), ["range"]).collect()]
    if not ranges:
        return Leaves([], edges, fan)
    below = lambda df: df.where(F.col("range").isin(ranges))
    return Leaves([tuple(r) for r in unequal(below(a), below(b), ["range", "bucket"]).orderBy("range", "bucket").collect()], edges, fan)


def digest_diff(source: DataFrame, target: DataFrame, key: list[str], edges: list, columns: list[str] | None = None, fan: int = FAN, stored: DataFrame | None = None) -> DataFrame:
    """(key..., difference): keys that only one side has, or whose rows differ: ``source``, ``target``, ``changed``.

    ``stored``: the target's leaves, if they are known. Null keys are compared as one key, of which both sides have all rows or differ.
    """
    columns = columns or sorted(set(source.columns) | set(target.columns))
    digests = lambda df: written(leaf_digests(df, key, edges, columns, fan))
    leaves = differing_leaves(digests(source), stored if stored is not None else digests(target), edges, fan)
    others = [c for c in columns if c not in key]
    side = lambda df, name: leaves.rows(df, key).groupBy(*key).agg(F.sort_array(F.collect_list(encoded(others or key))).alias(name))
    a, b = side(source, "__a").alias("a"), side(target, "__b").alias("b")
    same = reduce(lambda x, y: x & y, (F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key))
    both = a.join(b, same, "full_outer").select(*(F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in key), "__a", "__b")
    what = F.when(F.col("__b").isNull(), "source").when(F.col("__a").isNull(), "target").otherwise("changed")
    return both.where(~F.col("__a").eqNullSafe(F.col("__b"))).select(*key, what.alias("difference"))


def keep_digests(store: Store, table: str, key: list[str], edges: list | None = None, fan: int = FAN) -> None:
    """Store the digests of the table's present version beside it, by default in the ranges that it is stored in."""
    made, version = store.manifest(table), store.version(table)
    edges = made["edges"] if edges is None else edges
    leaves = leaf_digests(store.read(table), key, edges, fan=fan)
    store.publish(f"{table}__digests", leaves.coalesce(1), notes={"of": version, "edges": edges, "fan": fan, "key": key})


def kept_digests(store: Store, table: str, key: list[str]) -> tuple[DataFrame, dict[str, Any]] | None:
    """The stored digests and how they were cut, if they are of the table's present version."""
    notes = store.notes(f"{table}__digests")
    if notes.get("of") != store.version(table) or notes.get("key") != key:
        return None
    return store.read(f"{table}__digests"), notes
