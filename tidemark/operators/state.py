"""Sync state: one row per (migration type, table, source schema, target schema), pure transitions.

The table is small and driver-owned; transitions take rows and give rows, and a store publishes them
as a new version, which must follow the one they were made from: :meth:`SyncState.update` loads, changes and saves again
until no other writer came between. The last good watermark is kept apart from the status.
"""

from __future__ import annotations

import datetime as dt
import random
import threading
import time
from collections import defaultdict
from collections.abc import Callable
from typing import Any, TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.load import ABSENT, Conflict, Store

PARTITION = "struct<id: int, status: string, rows: bigint, pk_type: string, min_pk: string, max_pk: string, start_row: bigint, end_row: bigint, last_pk_synced: string, error: string>"
SCHEMA = (
    "migration_type string, table_name string, source_schema string, target_schema string, sync_status string, last_sync_start timestamp_ntz, "
    "last_sync_end timestamp_ntz, sync_duration_seconds double, source_row_count bigint, target_row_count bigint, rows_inserted bigint, rows_updated bigint, "
    "rows_unchanged bigint, last_good_watermark timestamp_ntz, last_pk_synced string, checkpoint_batch_num int, error_message string, retry_count int, "
    f"run_id string, partition_info array<{PARTITION}>, created_at timestamp_ntz, updated_at timestamp_ntz"
)
TABLE = "_sync_state"
COLUMNS = [c.strip().split(" ")[0] for c in SCHEMA.split("partition_info")[0].rstrip(", ").split(",")] + ["partition_info", "created_at", "updated_at"]
STATUSES = ("completed", "failed", "pending", "running")
Key = tuple[str, str, str, str]
Row = dict[str, Any]
Out = TypeVar("Out")

# writers of one process take turns; those of others are met by versions
_turns: defaultdict[tuple[str, str], threading.RLock] = defaultdict(threading.RLock)


def conformed(old: DataFrame) -> DataFrame:
    """A state table of any version under the present schema."""
    wanted = T.StructType.fromDDL(SCHEMA)
    names = {c.lower(): c for c in old.columns}
    known = lambda f: F.col(names[f.name]).cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType)
    return old.select(*(known(f).alias(f.name) for f in wanted.fields))


class SyncState:
    def __init__(self, rows: list[Row] | None = None, version: str | None = None) -> None:
        self.rows: dict[Key, Row] = {}
        self.version = version  # of the store that this was read from
        for r in rows or []:
            full = dict.fromkeys(COLUMNS) | {"retry_count": 0, "partition_info": []} | r
            self.rows[self._key(full)] = full

    @staticmethod
    def _key(r: Row) -> Key:
        return r["migration_type"], r["table_name"], r["source_schema"], r["target_schema"]

    @classmethod
    def from_frame(cls, df: DataFrame) -> SyncState:
        return cls([r.asDict(recursive=True) for r in df.collect()])

    def to_frame(self, spark: SparkSession) -> DataFrame:
        kinds = T.StructType.fromDDL(SCHEMA)
        return spark.createDataFrame(pa.Table.from_pylist(list(self.rows.values()), to_arrow_schema(kinds)), kinds)  # a local relation, no Python task

    @classmethod
    def load(cls, store: Store, table: str = TABLE) -> SyncState:
        """The stored state; columns that an older version lacks are null, others than ours are dropped."""
        while (version := store.version(table)) is not None:
            out = cls.from_frame(conformed(store.read(table)))
            if store.version(table) == version:  # else another version may have been read
                out.version = version
                return out
        return cls()

    def save(self, store: Store, table: str = TABLE) -> None:
        """Publish as the version behind the one that this was loaded from; another writer in between is a Conflict."""
        self.version = store.publish(table, self.to_frame(store.spark).coalesce(1), expect=self.version or ABSENT)["version"]
        if int(self.version) % 100 == 0:
            store.vacuum(table)

    @classmethod
    def update(cls, store: Store, change: Callable[[SyncState], Out], table: str = TABLE, tries: int = 100) -> Out:
        """Load, apply ``change``, save; from the start if another writer was faster, so no one's change is lost. Returns what ``change`` does."""
        with _turns[store.root, table]:
            for left in reversed(range(tries)):
                now = cls.load(store, table)
                out = change(now)
                try:
                    now.save(store, table)
                    return out
                except Conflict:
                    if not left:
                        raise
                    time.sleep(random.uniform(0.01, 0.2))
        raise ValueError("no tries")

    def _set(self, key: Key, now: dt.datetime, **values: Any) -> Row:
        self.rows[key] |= values | {"updated_at": now}
        return self.rows[key]

    def start(self, key: Key, now: dt.datetime, run_id: str, source_rows: int | None = None) -> Row:
        old = self.rows.get(key)
        if old is None:
            old = self.rows[key] = dict.fromkeys(COLUMNS) | dict(zip(COLUMNS, key)) | {"created_at": now, "retry_count": 0, "partition_info": []}
        again = old["sync_status"] in ("failed", "running")
        return self._set(key, now, sync_status="running", last_sync_start=now, last_sync_end=None, source_row_count=source_rows, rows_inserted=0, rows_updated=0, rows_unchanged=0,
                         last_pk_synced=None, checkpoint_batch_num=0, run_id=run_id, error_message=None, retry_count=(old["retry_count"] or 0) + again)

    def resume(self, key: Key, now: dt.datetime, run_id: str) -> Row:
        """Running again with what is done kept: the start, and with it the watermark, stays that of the first attempt."""
        old = self.rows[key]
        return self._set(key, now, sync_status="running", last_sync_end=None, run_id=run_id, error_message=None, retry_count=(old["retry_count"] or 0) + 1)

    def checkpoint(self, key: Key, now: dt.datetime, last_pk: Any, batch: int) -> Row:
        """Only for what is committed in the target."""
        return self._set(key, now, last_pk_synced=None if last_pk is None else str(last_pk), checkpoint_batch_num=batch)

    def resume_point(self, key: Key) -> str | None:
        r = self.rows.get(key)
        return r["last_pk_synced"] if r and r["sync_status"] in ("running", "failed") else None

    def complete(self, key: Key, now: dt.datetime, watermark: dt.datetime | None = None, **counters: int) -> Row:
        values: Row = {"sync_status": "completed", "last_sync_end": now, "sync_duration_seconds": self._seconds(key, now), "error_message": None} | counters
        return self._set(key, now, **values | ({"last_good_watermark": watermark} if watermark else {}))

    def fail(self, key: Key, now: dt.datetime, error: str) -> Row:
        return self._set(key, now, sync_status="failed", last_sync_end=now, sync_duration_seconds=self._seconds(key, now), error_message=error[:4000])

    def _seconds(self, key: Key, now: dt.datetime) -> float | None:
        start = self.rows[key]["last_sync_start"]
        return None if start is None else (now - start).total_seconds()

    def watermark(self, key: Key) -> dt.datetime | None:
        r = self.rows.get(key)
        return r["last_good_watermark"] if r else None

    def reset(self, now: dt.datetime, key: Key | None = None, kind: str | None = None) -> None:
        """One state, or all of a migration type, or all."""
        for k in [key] if key else [k for k in self.rows if kind in (None, k[0])]:
            self._set(k, now, sync_status="pending", last_pk_synced=None, checkpoint_batch_num=0, error_message=None, partition_info=[], retry_count=0)

    def reset_stale(self, now: dt.datetime, run_id: str, kind: str | None = None) -> int:
        """Runs that another run left running have failed."""
        stale = [k for k, r in self.rows.items() if r["sync_status"] == "running" and r["run_id"] != run_id and kind in (None, k[0])]
        for k in stale:
            self._set(k, now, sync_status="failed", error_message="left running by another run")
        return len(stale)

    def set_partition(self, key: Key, now: dt.datetime, index: int, **values: Any) -> None:
        parts = list(self.rows[key]["partition_info"] or [])
        empty = dict.fromkeys(("status", "rows", "pk_type", "min_pk", "max_pk", "start_row", "end_row", "last_pk_synced", "error"))
        while len(parts) <= index:
            parts.append({"id": len(parts)} | empty | {"status": "pending"})
        if values.get("error"):
            values["error"] = values["error"][:500]
        parts[index] = parts[index] | values
        self._set(key, now, partition_info=parts)

    def by_status(self, *statuses: str) -> list[Row]:
        """Rows of these statuses, of all if none is given, the latest change first."""
        found = [r for r in self.rows.values() if not statuses or r["sync_status"] in statuses]
        return sorted(found, key=lambda r: (r["updated_at"] is not None, r["updated_at"]), reverse=True)

    def last_sync(self, key: Key) -> Row | None:
        """When the table was last synced, how that ended, and its counters."""
        r = self.rows.get(key)
        wanted = ("sync_status", "last_sync_start", "last_sync_end", "sync_duration_seconds", "rows_inserted", "rows_updated", "rows_unchanged", "last_good_watermark", "error_message", "retry_count")
        return {c: r[c] for c in wanted} if r else None

    def incomplete_partitions(self, key: Key) -> list[Row]:
        return [p for p in self.rows[key]["partition_info"] or [] if p["status"] != "completed"]

    def summary(self) -> dict[str, tuple[int, list[str]]]:
        return {s: (len(names), names) for s in STATUSES for names in [sorted(r["table_name"] for r in self.rows.values() if r["sync_status"] == s)]}


def status_summary(state: DataFrame) -> DataFrame:
    """(sync_status, n, tables): the summary as a query."""
    return state.groupBy("sync_status").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("table_name")), ",").alias("tables"))


def open_partitions(state: DataFrame) -> DataFrame:
    """(table_name, id, status, rows): partitions that aren't complete."""
    parts = state.select("table_name", F.explode("partition_info").alias("p"))
    return parts.where(F.col("p.status").isin("pending", "running", "failed")).select("table_name", "p.id", "p.status", "p.rows")


def partition_json(state: DataFrame) -> DataFrame:
    """(table_name, partition_info) as the text that a JSON column holds; nulls are left out."""
    return state.select("table_name", F.to_json("partition_info").alias("partition_info"))


def from_partition_json(texts: DataFrame) -> DataFrame:
    """(table_name, partition_info) of such texts; what isn't JSON is null."""
    return texts.select("table_name", F.from_json("partition_info", f"array<{PARTITION}>").alias("partition_info"))
