"""What to run: fresh or recovery, one task per table or per range; and running it, several tasks at once."""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import is_safe
from tidemark.functions.sizing import partition_count, row_ranges
from tidemark.operators.state import Key, SyncState

THRESHOLD = 1_000_000
FULL = "full"


@dataclass(frozen=True)
class Task:
    table: str
    kind: str  # regular, keys, rows
    index: int = 0
    total: int = 1
    low: Any = None
    high: Any = None
    resume_after: Any = None
    schemas: tuple[str, str] = ("dbo", "public")

    @property
    def key(self) -> Key:
        """Of the table's state in full runs."""
        return (FULL, self.table, *self.schemas)


@dataclass
class Plan:
    mode: str
    tasks: list[Task] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)


def mode_of(state: SyncState, run_id: str, kind: str = FULL) -> str:
    """RECOVERY if another run of the kind left failures; runs that are still marked as running are not yet that."""
    return "RECOVERY" if any(r["sync_status"] == "failed" and r["run_id"] != run_id and r["migration_type"] == kind for r in state.rows.values()) else "FRESH"


def begin(state: SyncState, run_id: str, now: dt.datetime, kind: str = FULL) -> str:
    """The mode of a run, judged by real failures, before runs that were left running are marked as failed.

    A fresh run after a completed one starts over: the states of its kind are reset, those of another kind aren't touched.
    """
    mode = mode_of(state, run_id, kind)
    state.reset_stale(now, run_id, kind)
    if mode == "FRESH" and any(r["sync_status"] == "completed" and r["migration_type"] == kind for r in state.rows.values()):
        state.reset(now, kind=kind)
    return mode


def plan(tables: list[dict[str, Any]], state: SyncState, run_id: str, bounds: Callable[[str, str, int], list[tuple]], threshold: int = THRESHOLD, most: int = 8, mode: str | None = None, kind: str = FULL, cut: Callable[[int, int], int] = partition_count) -> Plan:
    """tables: name, rows, key, and schemas (of source and target) if those aren't dbo and public. bounds(table, key, n): half-open
    key ranges, [] where they can't be had. mode: of :func:`begin`. A state counts for its own kind, table and schemas only."""
    out = Plan(mode or mode_of(state, run_id, kind))
    for t in tables:
        name, rows, key = t["name"], t["rows"], t.get("key") or []
        schemas = tuple(t.get("schemas") or Task.schemas)
        old = state.rows.get((kind, name, *schemas))
        if out.mode == "RECOVERY" and old:
            if old["sync_status"] == "completed":
                out.skipped.append(name)
                continue
            parts = old["partition_info"] or []
            left = [p for p in parts if p["status"] != "completed"]
            if left:
                ends = lambda p: ("rows", p["start_row"], p["end_row"]) if p["start_row"] is not None else ("keys", p["min_pk"], p["max_pk"])
                out.tasks += [Task(name, how, p["id"], len(parts), low, high, p["last_pk_synced"], schemas) for p in left for how, low, high in [ends(p)]]
                continue
        n = cut(rows, most)
        ranges: list[tuple] = []
        how = "regular"
        if rows >= threshold and key and all(map(is_safe, key)):
            how, ranges = ("keys", bounds(name, key[0], n)) if len(key) == 1 else ("rows", row_ranges(rows, n))
        out.tasks += [Task(name, how, i, len(ranges), *r, schemas=schemas) for i, r in enumerate(ranges)] or [Task(name, "regular", schemas=schemas)]
    return out


def page_mode(key: list[str]) -> str:
    """How a table is paged: by key if that is one column, by row number if it is several, whole without a key."""
    return "keyset" if len(key) == 1 else "row_number" if key else "whole"


def run_all(
    tasks: list[Task], run: Callable[[Task], dict[str, Any]], parallel: int = 8, retries: int = 0, delay: float = 30.0,
    sleep: Callable[[float], None] = time.sleep, spark: SparkSession | None = None, cancel_on_error: bool = False,
) -> list[dict[str, Any]]:
    """Spark jobs from a bounded pool, tried again after a pause; the last failure is a result.

    With ``spark`` the jobs of a table run in a fair pool of its own (under ``spark.scheduler.mode=FAIR``) and carry a tag of this
    run. ``cancel_on_error``: the first task that fails for good stops the others; their running jobs are cancelled, and
    they come back as ``pending``, as do those that had not begun.
    """
    tag, stop = f"tidemark-{uuid.uuid4().hex}", threading.Event()
    context = spark.sparkContext if spark else None

    def failed(task: Task, error: str, attempts: int, pending: bool = False) -> dict[str, Any]:
        return {"table": task.table, "success": False, "rows": 0, "error": error, "attempts": attempts} | ({"pending": True} if pending else {})

    def one(task: Task) -> dict[str, Any]:
        error, attempt = "", 0
        for attempt in range(1, retries + 2):
            if stop.is_set():
                break
            try:
                return {"table": task.table, "success": True, "attempts": attempt} | run(task)
            except Exception as e:  # noqa: BLE001
                error = str(e)[:4000]
            if attempt <= retries and not stop.is_set():
                sleep(delay)
        if stop.is_set():
            return failed(task, error or "not begun", attempt, pending=True)
        if cancel_on_error:
            stop.set()
        return failed(task, error, attempt)

    def tagged(task: Task) -> dict[str, Any]:
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", task.table)
        try:
            return one(task)
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)
            context.removeJobTag(tag)

    with ThreadPoolExecutor(parallel) as pool:
        work = inheritable_thread_target(spark)(tagged) if spark else one
        running = [pool.submit(work, t) for t in tasks]
        while wait(running, timeout=0.2 if cancel_on_error else None).not_done:
            if context and stop.is_set():  # again and again: a task may have been between two jobs
                context.cancelJobsWithTag(tag)
        return [x.result() for x in running]


def outcome(results: list[dict[str, Any]]) -> dict[str, Any]:
    """Totals by table: a table succeeds if all of its tasks do."""
    tables: dict[str, bool] = {}
    for r in results:
        tables[r["table"]] = tables.get(r["table"], True) and r["success"]
    failed = sorted(t for t, ok in tables.items() if not ok)
    status = "success" if not failed else "failed" if len(failed) == len(tables) else "partial_failure"
    return {"status": status, "tables": len(tables), "failed": failed, "rows": sum(r.get("rows", 0) for r in results)}


def outcomes(results: DataFrame) -> DataFrame:
    """(status, tables, failed, rows) of results (table, success, rows): :func:`outcome` as a query."""
    tables = results.groupBy("table").agg(F.bool_and("success").alias("ok"), F.sum("rows").alias("rows"))
    status = F.when(F.bool_and("ok"), "success").when(~F.bool_or("ok"), "failed").otherwise("partial_failure")
    failed = F.array_join(F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("table")))), ",")
    return tables.agg(status.alias("status"), F.count("*").cast("int").alias("tables"), failed.alias("failed"), F.sum("rows").alias("rows"))
