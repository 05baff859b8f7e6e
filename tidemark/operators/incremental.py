"""Incremental load: choose the watermark column, filter, merge, advance the watermark."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge
from tidemark.operators.load import Store, range_of
from tidemark.sources.shared import temporary_tables, written

_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def candidates(text: str | None) -> list[str]:
    return [x.strip() for x in (text or "").split(",") if x.strip()]


def watermark_column(df: DataFrame, names: list[str]) -> str | None:
    """The first candidate that exists under exactly this name and is temporal."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return next((n for n in names if isinstance(kinds.get(n), _TEMPORAL)), None)


def newer(column: str, since: dt.datetime | str | None, zone: str = "UTC") -> Column:
    """Strictly newer than the watermark, or undated; without a watermark all rows."""
    if since is None:
        return F.lit(True)
    if isinstance(since, dt.datetime) and since.tzinfo:
        from zoneinfo import ZoneInfo

        since = since.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    return (F.col(column) > F.lit(str(since)).cast("timestamp_ntz")) | F.col(column).isNull()


@dataclass
class Sync:
    table: str
    inserted: int
    updated: int
    unchanged: int
    kept: int  # of the ranges that were read
    watermark: dt.datetime

    @property
    def staged(self) -> int:
        return self.inserted + self.updated + self.unchanged


def staged_rows(source: DataFrame, column: str | None, since: dt.datetime | str | None, inside: Column | None = None) -> DataFrame:
    staged = source if column is None else source.where(newer(column, since))
    return staged if inside is None else staged.where(inside)


def sync(store: Store, table: str, source: DataFrame, key: list[str], column: str | None, since: dt.datetime | None, now: dt.datetime, inside: Column | None = None) -> Sync:
    """Merge and publish. The returned watermark is the clock before the first read; store it after success.

    The source is read once, into a staging table that goes when the merge is published.
    """
    with temporary_tables(store.spark):
        return merge_staged(store, table, written(staged_rows(source, column, since, inside)), key, now)


def merge_staged(store: Store, table: str, staged: DataFrame, key: list[str], now: dt.datetime, order: str | None = None) -> Sync:
    """Merge a staging table into a stored one; the counts come from the job that publishes.

    Of a table in ranges only those that staged keys fall in are read, merged and written. With ``order`` rows that
    are older than the target's change nothing.
    """
    version, made = store.version(table), store.manifest(table)
    rows = merge.require_unique(staged, key)
    if not rows:
        return Sync(table, 0, 0, 0, 0, watermark=now)
    if not made["edges"]:
        diffed = merge.diff(store.read(table), staged, key, small=True, counted=rows, order=order)
        seen = store.publish(table, diffed, metrics=merge.op_counts(), unwritten=("op",), expect=version)
    else:
        place = range_of(F.col(made["key"]), made["edges"], staged.schema[made["key"]].dataType)
        counts = {r[0]: r[1] for r in staged.groupBy(place.alias("r")).count().collect()}  # no more than the table has ranges
        ranges, groups = sorted(counts), merge.broadcast_groups(counts)
        if groups:
            diffed = merge.diff_by_ranges(lambda g: store.read(table, g), staged, place, groups, counts, key, order)
        else:
            diffed = merge.diff(store.read(table, ranges), staged, key, order=order)
        # rows of a range come from its own files: they are written where they were read
        seen = store.publish_ranges(table, diffed, ranges, merge.op_counts(), ("op",), version, gather=not groups)
    return Sync(table, *(seen[k] for k in ("inserted", "updated", "unchanged", "kept")), watermark=now)
