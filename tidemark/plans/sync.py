"""The incremental run: discover, cut into ranges or resume, sync, and keep the state around it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import sanitize
from tidemark.functions.sizing import incremental_partition_count, key_ranges
from tidemark.operators import incremental
from tidemark.operators.load import Store
from tidemark.operators.scan import in_range
from tidemark.operators.state import Key, SyncState
from tidemark.plans.transfer import Task, run_all

THRESHOLD = 1_000_000
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Source:
    """A source table: its rows under target names, and its key in target names."""

    name: str
    rows: DataFrame
    key: tuple[str, ...]

    @property
    def target(self) -> str:
        return sanitize(self.name)


@dataclass(frozen=True)
class Found:
    source: Source
    column: str | None  # of the watermark; None: all rows are compared
    skipped: str | None = None


@dataclass(frozen=True)
class SyncTask:
    table: str
    index: int = 0
    total: int = 1
    low: int | None = None
    high: int | None = None


def discover(store: Store, sources: list[Source], dates: str | list[str] | None) -> list[Found]:
    """What can be synced: tables with a key whose target exists and has rows, and their watermark column."""
    names = incremental.candidates(dates) if isinstance(dates, str) or dates is None else list(dates)
    out = []
    for s in sources:
        reason = "no key" if not s.key else "no target" if not store.exists(s.target) else "target is empty" if not store.has_data(s.target) else None
        out.append(Found(s, None if reason else incremental.watermark_column(s.rows, names), reason))
    return out


def state_key(table: str, schemas: tuple[str, str]) -> Key:
    return ("incremental", table, *schemas)


def measured(found: Found) -> tuple[int, int | None, int | None]:
    """Rows of the source, and the ends of its key if that is one integer column: one pass."""
    own = found.source.key
    if len(own) == 1 and isinstance(found.source.rows.schema[own[0]].dataType, _INTEGERS):
        r = found.source.rows.agg(F.count("*"), F.min(own[0]), F.max(own[0])).first()
        return r[0], r[1], r[2]
    return found.source.rows.count(), None, None


def tasks_for(found: Found, state: SyncState, key: Key, now: dt.datetime, run_id: str, rows: int, threshold: int = THRESHOLD, most: int = 6, ends: tuple[int | None, int | None] | None = None) -> list[SyncTask]:
    """The ranges to sync, noted in the state; of an unfinished run those that are left.

    A completed run is followed by a whole new one. Large tables with one integer key are cut by arithmetic between its ``ends``.
    """
    old = state.rows.get(key)
    name = found.source.target
    if old and old["sync_status"] in ("failed", "running") and old["partition_info"]:
        parts = old["partition_info"]
        left = [p for p in parts if p["status"] != "completed"]
        state.resume(key, now, run_id)
        if left:
            return [SyncTask(name, p["id"], len(parts), int(p["min_pk"]), int(p["max_pk"])) for p in left]
    state.start(key, now, run_id, rows)
    state.rows[key]["partition_info"] = []
    low, high = (ends or measured(found)[1:]) if rows >= threshold else (None, None)
    if low is not None and high is not None:
        ranges = key_ranges(low, high, incremental_partition_count(rows, most))
        for i, (a, b) in enumerate(ranges):
            state.set_partition(key, now, i, status="pending", pk_type="integer", min_pk=str(a), max_pk=str(b))
        return [SyncTask(name, i, len(ranges), a, b) for i, (a, b) in enumerate(ranges)]
    return [SyncTask(name)]


def sync_table(store: Store, found: Found, schemas: tuple[str, str], run_id: str, clock: Callable[[], dt.datetime], threshold: int = THRESHOLD, most: int = 6) -> dict[str, Any]:
    """Sync one table and keep its state; a failure is a result. Every range is merged at once, so that no checkpoint runs ahead of the target.

    The watermark that a success leaves is the clock before the first read of the run, also of one that was resumed. Other tables may be
    synced at the same time: states are changed by :meth:`SyncState.update`.
    """
    source, key = found.source, state_key(found.source.target, schemas)
    now = clock()
    since = SyncState.load(store).watermark(key)
    total = dict.fromkeys(("rows_inserted", "rows_updated", "rows_unchanged"), 0)
    change = lambda f: SyncState.update(store, f)
    try:
        rows, *ends = measured(found)
        tasks = change(lambda s: tasks_for(found, s, key, now, run_id, rows, threshold, most, tuple(ends)))
        for task in tasks:
            inside = None if task.low is None else in_range(source.rows, list(source.key), (task.low,), (task.high,))
            try:
                done = incremental.sync(store, source.target, source.rows, list(source.key), found.column, since, now, inside)
            except Exception as e:
                if task.low is not None:
                    error = str(e)
                    change(lambda s, task=task, error=error: s.set_partition(key, clock(), task.index, status="failed", error=error))
                raise
            for name, n in zip(total, (done.inserted, done.updated, done.unchanged)):
                total[name] += n
            if task.low is not None:
                change(lambda s, task=task, n=done.staged: s.set_partition(key, clock(), task.index, status="completed", rows=n))
        there = store.read(source.target).count()
        change(lambda s: s.complete(key, clock(), s.rows[key]["last_sync_start"], target_row_count=there, **total))
    except Exception as e:  # noqa: BLE001 - a table's failure is a value, other tables go on
        error = str(e)
        change(lambda s: (key in s.rows or s.start(key, now, run_id)) and s.fail(key, clock(), error))
        return {"table": source.target, "success": False, "rows": 0, "error": error[:4000]} | total
    return {"table": source.target, "success": True, "rows": sum(total.values())} | total


def sync_all(store: Store, sources: list[Source], dates: str | list[str] | None, schemas: tuple[str, str], run_id: str, clock: Callable[[], dt.datetime], parallel: int = 8, threshold: int = THRESHOLD, most: int = 6) -> list[dict[str, Any]]:
    """The incremental run over a list of tables, several at once; tables that can't be synced come back as skipped, with the reason."""
    found = {f.source.target: f for f in discover(store, sources, dates)}
    tasks = [Task(name, "regular", schemas=schemas) for name, f in found.items() if not f.skipped]
    done = run_all(tasks, lambda t: sync_table(store, found[t.table], schemas, run_id, clock, threshold, most), parallel, spark=store.spark)
    return done + [{"table": name, "success": True, "rows": 0, "skipped": f.skipped} for name, f in found.items() if f.skipped]
