"""The merge: staged rows into a target by key, with null-safe change detection.

One full outer join; presence is a marker and never inferred from values, so a staged null overwrites.
Rows that only the target has are kept. An increment that is counted and small is broadcast instead, and
the target stays where it is: a left join for its rows, a semi join of its keys for those that are there
already, and an anti join of the two small sides for new ones. A larger increment of a target in ranges goes the same way,
group of ranges by group, while a few groups do; beyond that, and of a range that is crowded by itself, both sides are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: rows of an increment that may be broadcast
SMALL_ROWS = 500_000
#: groups of an increment that are broadcast, each to its own ranges of the target
MOST_GROUPS = 8


class DuplicateKeys(ValueError):
    pass


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """(key..., n) of keys that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, key: list[str]) -> int:
    """The rows of ``df``; a key that repeats or has a null is an error. One job."""
    if missing := [k for k in key if k not in df.columns]:
        raise ValueError(f"key columns not in the table: {missing}")
    empty = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))
    per_key = df.groupBy(*key).agg(F.count("*").alias("n")).select("n", empty.alias("empty"))
    rows, most, nulls = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("n"), F.max("empty")).first()
    if nulls:
        raise DuplicateKeys(f"staged rows have a null in {key}")
    if rows and most > 1:
        raise DuplicateKeys(f"staged rows repeat a key of {key}")
    return rows


def is_small(staged: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """Whether the increment has at most so many rows; no more than these are counted."""
    return staged.select(F.lit(1)).limit(rows + 1).count() <= rows


def diff(target: DataFrame, staged: DataFrame, key: list[str], detect_changes: bool = True, small: bool = False, counted: int | None = None, order: str | None = None) -> DataFrame:
    """All columns of the target's schema and ``op``: inserted, updated, unchanged, kept.

    ``small`` asks for the increment to be broadcast; it is, if its rows (``counted``, where they are known) are found to be few.
    With ``order`` a staged row that is older by that column than the target's, or undated beside a dated one, changes nothing.
    """
    values = [c for c in target.columns if c not in key]
    t = target.select(*key, F.struct(*values).alias("__t") if values else F.struct(F.lit(1).alias("x")).alias("__t"))
    s = staged.select(*key, F.struct(*values).alias("__s") if values else F.struct(F.lit(1).alias("x")).alias("__s"))
    if small and (is_small(staged) if counted is None else counted <= SMALL_ROWS):
        there_already = target.select(*key).join(F.broadcast(s.select(*key)), key, "left_semi").distinct()
        new = s.join(F.broadcast(there_already), key, "left_anti").select(*key, F.lit(None).cast(t.schema["__t"].dataType).alias("__t"), "__s")
        joined = t.join(F.broadcast(s), key, "left").unionByName(new)
    else:
        joined = t.join(s, key, "full_outer")
    here, there = F.col("__s").isNotNull(), F.col("__t").isNotNull()
    late = F.lit(False)
    if order is not None:
        was, now = F.col(f"__t.{order}"), F.col(f"__s.{order}")
        late = here & there & F.coalesce(now < was, now.isNull() & was.isNotNull())
    changed: Column = F.lit(bool(values)) if not detect_changes else reduce(lambda a, b: a | b, (~F.col(f"__s.{c}").eqNullSafe(F.col(f"__t.{c}")) for c in values), F.lit(False))
    changed, taken = changed & ~late, here & ~late
    op = F.when(~here, "kept").when(~there, "inserted").when(changed, "updated").otherwise("unchanged")
    return joined.select(*key, *(F.when(taken, F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}")).alias(c) for c in values), op.alias("op")).select(*target.columns, "op")


def broadcast_groups(counts: dict[int, int], most: int | None = None, groups: int = MOST_GROUPS) -> list[list[int]] | None:
    """Ranges with their staged rows in groups that may be broadcast, each in one; None if that isn't possible."""
    most = SMALL_ROWS if most is None else most
    out: list[list[int]] = []
    room = 0
    for r in sorted(counts):
        if counts[r] > most:
            return None
        if not out or counts[r] > room:
            out.append([])
            room = most
        out[-1].append(r)
        room -= counts[r]
    return out if len(out) <= groups else None


def diff_by_ranges(read: Callable[[list[int]], DataFrame], staged: DataFrame, place: Column, groups: list[list[int]], counts: dict[int, int], key: list[str], order: str | None = None) -> DataFrame:
    """:func:`diff` of a target stored in ranges: each group of ranges meets its own staged rows, broadcast, and no row of the target is shuffled."""
    parts = [diff(read(g), staged.where(place.isin(g)), key, small=True, counted=sum(counts[r] for r in g), order=order) for g in groups]
    return reduce(DataFrame.unionByName, parts)


def merge(target: DataFrame, staged: DataFrame, key: list[str], detect_changes: bool = True, small: bool = False) -> DataFrame:
    """The target after the merge."""
    return diff(target, staged, key, detect_changes, small).drop("op")


def op_counts() -> dict[str, Column]:
    """The rows of each op as aggregates, to be observed while the result is written."""
    return {op: F.count(F.when(F.col("op") == op, 1)) for op in ("inserted", "updated", "unchanged", "kept")}


def counts(diffed: DataFrame) -> DataFrame:
    return diffed.groupBy("op").agg(F.count("*").alias("n"))


def insert_missing(target: DataFrame, staged: DataFrame, key: list[str]) -> DataFrame:
    """Do nothing on a match: the target and the staged rows whose key it lacks."""
    return target.unionByName(staged.join(target.select(*key), key, "left_anti").select(target.columns))


def deleted_keys(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Opt-in: keys that the source no longer has."""
    return target.select(*key).join(source.select(*key), key, "left_anti")
