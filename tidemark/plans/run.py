"""The full run: describe a source schema, plan, load tables and ranges at once, keep states, set sequences, validate, notify.

Tables with many rows are cut into key ranges in the source; each range is a task that reads by one connection and publishes its
range of the stored table. A run behind one that failed skips tables that are complete and loads the ranges that are left.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import quote_double, sanitize, sanitize_all
from tidemark.functions.sizing import page_size, partition_count
from tidemark.functions.values import normalized
from tidemark.operators import validate
from tidemark.operators.chunked import load_in_chunks
from tidemark.operators.load import Store, full_refresh, next_values
from tidemark.operators.partition import jdbc_predicates, parallel
from tidemark.operators.quarantine import load_checked
from tidemark.operators.state import SyncState
from tidemark.plans import ddl, transfer
from tidemark.plans.config import Settings, table_list
from tidemark.plans.notify import Notifier
from tidemark.sources import database
from tidemark.sources.spec import JdbcSession, choose_tables, read_jdbc

SEQUENCES = "_sequences"


@dataclass
class Outcome:
    mode: str
    status: str
    message: str
    results: list[dict[str, Any]]
    skipped: list[str]
    checks: list[dict[str, Any]]
    report: str
    ddl: list[str] = field(default_factory=list)


@dataclass
class FullRun:
    spark: SparkSession
    url: str
    schema: str
    store: Store
    settings: Settings = field(default_factory=Settings)
    target_schema: str = "public"
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.UTC).replace(tzinfo=None)
    notifier: Notifier = field(default_factory=Notifier)
    check_constraints: bool = False
    before: Callable[[transfer.Task], None] | None = None  # called before each task; what it raises is the task's failure
    properties: dict[str, str] = field(default_factory=dict)
    cut: Callable[[int, int], int] = partition_count  # of a table's rows and the most ranges, how many it gets
    source_counts: dict[str, int] = field(default_factory=dict)  # of the last run
    execute_ddl: Callable[[str], Any] | None = None  # runs the target's statements, where the target has a database's tables

    @classmethod
    def configured(cls, spark: SparkSession, url: str, database_name: str, schema: str, store: Store, folder: str | None = None, environment: Mapping[str, str] | None = None, **more: Any) -> FullRun:
        """A run as the environment and the table list of the database's folder say."""
        listed = table_list(database_name, folder, None, environment)
        return cls(spark, url, schema, store, Settings.read(environment), include=tuple(t for s, t in listed if s.lower() == schema.lower()), **more)

    def source(self, table: dict[str, Any], predicates: list[str] | None = None) -> DataFrame:
        """The table's rows under target names."""
        fetch = page_size(table["row_count"] or 0, self.settings.default_chunk_size)
        df = read_jdbc(self.spark, self.url, self._name(table), predicates, fetch, **self.properties)
        return df.toDF(*sanitize_all(df.columns))

    def _name(self, table: dict[str, Any]) -> str:
        return f"{quote_double(table['schema_name'])}.{quote_double(table['table_name'])}"

    def _key(self, table: dict[str, Any]) -> list[str]:
        return table["primary_key"]["columns"] if table["primary_key"] else []

    def run(self, run_id: str) -> Outcome:
        with JdbcSession(self.spark, self.url) as session:
            listed = database.described(session, self.schema)
            kept, missing = choose_tables([t["table_name"] for t in listed], list(self.include), list(self.exclude))
            if missing:
                raise LookupError(f"no such tables in {self.schema}: {', '.join(missing)}")
            tables = {sanitize(t["table_name"]): t for t in listed if t["table_name"] in kept}
            self.source_counts = {n: t["row_count"] for n, t in tables.items()}
            mode = SyncState.update(self.store, lambda s: transfer.begin(s, run_id, self.clock()))
            bounds = lambda name, key, n: database.tile_ranges(database.source_tiles(session, self._name(tables[name]), key, n))
            # of a key of several columns ranges are cut by the first: equal values stay together
            wanted = [{"name": n, "rows": t["row_count"], "key": self._key(t)[:1], "schemas": (self.schema, self.target_schema)} for n, t in tables.items()]
            made = transfer.plan(wanted, SyncState.load(self.store), run_id, bounds, self.settings.partition_threshold, self.settings.max_partitions, mode, cut=self.cut)
        statements = ddl.schema_run([t | {"target_schema": self.target_schema} for t in tables.values()], mode, self.target_schema)
        if self.execute_ddl:
            ddl.execute(statements, self.execute_ddl)
        self._begin(made, tables, run_id)
        results = transfer.run_all(made.tasks, lambda t: self._load(t, tables[t.table]), self.settings.max_parallel_transfers, spark=self.spark)
        self._end(made, results)
        loaded = [n for n in tables if self.store.exists(n)]
        self._set_sequences({n: tables[n] for n in loaded})
        checks = self._validated({n: tables[n] for n in loaded}) if loaded else []
        status, message = validate.run_message(checks, [n for n in tables if n not in loaded])
        if status == "success" and any(not r["success"] for r in results):
            status, message = "failed", f"tables failed: {', '.join(transfer.outcome(results)['failed'])}"
        self.notifier.send(status, f"full run {run_id}", message)
        moved = [{"rows_transferred": r.get("rows", 0), "elapsed_time_seconds": r.get("seconds", 0.0)} for r in results]
        return Outcome(mode, status, message, results, made.skipped, checks, validate.report(checks, moved), statements)

    def _begin(self, made: transfer.Plan, tables: dict[str, dict[str, Any]], run_id: str) -> None:
        """States of the tables to be loaded, and empty tables for those in ranges that don't go on where they were."""
        now = self.clock()
        first = {t.table: t for t in made.tasks}

        def change(s: SyncState) -> list[str]:
            fresh = []
            for name, task in first.items():
                old = s.rows.get(task.key)
                if task.kind == "keys" and made.mode == "RECOVERY" and old and old["partition_info"]:
                    s.resume(task.key, now, run_id)
                    continue
                s.start(task.key, now, run_id, tables[name]["row_count"])
                s.rows[task.key]["partition_info"] = []
                fresh.append(name)
                for t in (t for t in made.tasks if t.table == name and t.kind == "keys"):
                    s.set_partition(t.key, now, t.index, status="pending", min_pk=None if t.low is None else str(t.low), max_pk=None if t.high is None else str(t.high))
            return fresh

        for name in SyncState.update(self.store, change):
            ranges = [t for t in made.tasks if t.table == name and t.kind == "keys"]
            if ranges:
                key = sanitize(self._key(tables[name])[0])
                self.store.publish(name, normalized(self.source(tables[name], ["1 = 0"])), key, [t.low for t in ranges if t.low is not None])

    def _load(self, task: transfer.Task, table: dict[str, Any]) -> dict[str, Any]:
        began = time.time()
        try:
            if task.table in {sanitize(x.split(".")[-1]) for x in self.settings.failing_tables}:
                raise RuntimeError("simulated failure")
            if self.before:
                self.before(task)
            rows = self._regular(task, table) if task.kind == "regular" else self._range(task, table)
        except Exception as e:
            if task.kind == "keys":
                error = str(e)
                SyncState.update(self.store, lambda s: s.set_partition(task.key, self.clock(), task.index, status="failed", error=error))
            raise
        if task.kind == "keys":
            SyncState.update(self.store, lambda s: s.set_partition(task.key, self.clock(), task.index, status="completed", rows=rows))
        return {"rows": rows, "seconds": time.time() - began}

    def _range(self, task: transfer.Task, table: dict[str, Any]) -> int:
        column = next(c for c in table["columns"] if c["column_name"] == self._key(table)[0])
        typed = lambda v: int(v) if isinstance(v, str) and column["data_type"] in ("tinyint", "smallint", "int", "bigint") else v  # noqa: E731 - states keep ends as text
        predicate = jdbc_predicates(column["column_name"], [(typed(task.low), typed(task.high))])
        return self.store.publish_ranges(task.table, normalized(self.source(table, predicate)), [task.index])["rows"]

    def _regular(self, task: transfer.Task, table: dict[str, Any]) -> int:
        key = self._key(table)
        if transfer.page_mode(key) != "whole" and parallel(self.settings.parallel_readers, table["row_count"], self.settings.default_chunk_size):
            read = database.read_tiles(self.spark, self.url, self._name(table), key[0], self.settings.parallel_readers, **self.properties)
            source = read.toDF(*sanitize_all(read.columns))
        else:
            source = self.source(table)
        if self.check_constraints and table["check_constraints"]:
            done = load_checked(self.store, task.table, normalized(source), table["check_constraints"])
            return done.good + done.rejected
        chunks = -(-(table["row_count"] or 0) // self.settings.default_chunk_size)
        if chunks > 1 and transfer.page_mode(key) == "keyset":
            shown = lambda last, chunk, n: SyncState.update(self.store, lambda s: s.checkpoint(task.key, self.clock(), last, chunk))
            done = load_in_chunks(self.store, task.table, source, sanitize(key[0]), chunks, f"{self.schema}.{task.table}", shown)
            if not done.success:
                raise RuntimeError("; ".join(done.errors))
            return done.rows_read
        loaded = full_refresh(self.store, source, task.table)
        if not loaded.success:
            raise RuntimeError("; ".join(loaded.errors) or f"{loaded.rows} rows written, {loaded.target_rows} read")
        return loaded.rows

    def _end(self, made: transfer.Plan, results: list[dict[str, Any]]) -> None:
        now = self.clock()
        errors: dict[str, str] = {}
        for r in results:
            if not r["success"]:
                errors.setdefault(r["table"], r["error"])
        counts = {t: self.store.read(t).count() for t in {x.table for x in made.tasks} if t not in errors}

        def change(s: SyncState) -> None:
            for key in {t.key for t in made.tasks}:
                if key[1] in errors:
                    s.fail(key, now, errors[key[1]])
                else:
                    s.complete(key, now, target_row_count=counts[key[1]])

        SyncState.update(self.store, change)

    def _set_sequences(self, tables: dict[str, dict[str, Any]]) -> None:
        """(table_name, column_name, next_value) of identity columns, as a stored table: what comes next in the target."""
        found = [(n, sanitize(c["column_name"])) for n, t in tables.items() for c in t["columns"] if c["is_identity"]]
        if not found:
            return
        rows = [next_values(self.store.read(n), c).select(F.lit(n).alias("table_name"), F.lit(c).alias("column_name"), "next_value") for n, c in found]
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        self.store.publish(SEQUENCES, out.coalesce(1))

    def _validated(self, tables: dict[str, dict[str, Any]]) -> list[dict[str, Any]]:
        """Counts of the source now, by the database, against those of the stored tables, from one job; rejected rows count as loaded."""
        with JdbcSession(self.spark, self.url) as session:
            counts = [(n, session.rows(f"SELECT COUNT(*) FROM {self._name(t)}")[0][0]) for n, t in tables.items()]
        pairs = {}
        for name, n in counts:
            target = self.store.read(name).select(F.lit(1))
            if self.store.exists(f"{name}__rejected"):
                target = target.unionByName(self.store.read(f"{name}__rejected").select(F.lit(1)))
            pairs[name] = (self.spark.range(n), target)
        return sorted((r.asDict() for r in validate.batch_check(pairs).collect()), key=lambda c: c["table_name"])
