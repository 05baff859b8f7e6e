"""Full refresh, range replacement and publishing by versions.

A table's version is a manifest: the key ranges and the data folders of each, and notes of its writer. A new version's
files are written beside the old ones; it is there once its manifest is renamed to the next number, which only one writer
can do. So a failed or killed load leaves the table as it was and nothing that another writer would have to clear, and of two
writers that started from one version the second fails and loses nothing. A publish that touches some ranges writes these
and refers to the old folders for the others: a change of one percent costs what it touches.

The file system must rename in one step (HDFS does; on a local disk the writers of one process are kept apart by a lock).
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import normalized
from tidemark.operators.ranges import range_of
from tidemark.operators.scan import in_range

MANIFEST = "_V-"
#: ``expect`` of a writer that found no table
ABSENT = ""
#: seconds for which files that no version refers to may belong to a writer that is still at work
GRACE = 24 * 3600.0

#: what a writer notes in its version, or how that follows from the rows and metrics of the version
Notes = dict[str, Any] | Callable[[dict[str, Any]], dict[str, Any]] | None

_RENAMES = threading.Lock()


@dataclass
class Transfer:
    table: str
    rows: int = 0
    target_rows: int = 0
    seconds: float = 0.0
    errors: list[str] = field(default_factory=list)

    @property
    def success(self) -> bool:
        """No errors and equal counts; an empty partition is a success."""
        return not self.errors and self.rows == self.target_rows


class Conflict(RuntimeError):
    """Another writer has published a successor of the same version."""


class Store:
    """A folder of versioned tables on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _get(self, *parts: str) -> str:
        stream = self._fs().open(self._path(*parts))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, text: str, *parts: str) -> None:
        stream = self._fs().create(self._path(*parts), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []

    def version(self, table: str) -> str | None:
        """The last version's number as text that sorts, None if there is no table."""
        return max((n.removeprefix(MANIFEST) for n in self._names(table) if n.startswith(MANIFEST)), default=None)

    def exists(self, table: str) -> bool:
        return self.version(table) is not None

    def manifest(self, table: str) -> dict[str, Any]:
        """schema (JSON), key, edges (the lows of all ranges but the first), parts (of each range its folders), notes."""
        version = self.version(table)
        if version is None:
            raise FileNotFoundError(f"{self.root}/{table} has no published version")
        return json.loads(self._get(table, f"{MANIFEST}{version}"))

    def notes(self, table: str) -> dict[str, Any]:
        """What the writer of the last version noted in it; none of a table that isn't there."""
        return self.manifest(table).get("notes") or {} if self.exists(table) else {}

    def _read(self, table: str, made: dict[str, Any], folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(made["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{table}/{x}" for x in folders))

    def read(self, table: str, ranges: list[int] | None = None) -> DataFrame:
        """The table, or the rows of some of its ranges."""
        made = self.manifest(table)
        chosen = made["parts"] if ranges is None else [made["parts"][i] for i in ranges]
        return self._read(table, made, [x for folders in chosen for x in folders])

    def has_data(self, table: str) -> bool:
        return self.exists(table) and not self.read(table).isEmpty()

    def publish(self, table: str, df: DataFrame, key: str | None = None, edges: list = (), metrics: dict[str, Column] | None = None, unwritten: tuple[str, ...] = (), expect: str | None = None, notes: Notes = None) -> dict[str, Any]:
        """Write a new version of the whole table, in the ranges of ``key`` that ``edges`` cut.

        Returns the rows written and the ``metrics`` (aggregates over ``df``), all from the job that writes, and the version. The columns
        ``unwritten`` are for metrics only. ``expect``: the version it must follow, by default the last one of now.
        """
        made = {"schema": None, "key": key, "edges": list(edges), "parts": [[] for _ in range(len(edges) + 1)], "notes": notes}
        return self._write(table, df, made, metrics, unwritten, expect)

    def publish_ranges(self, table: str, df: DataFrame, ranges: list[int], metrics: dict[str, Column] | None = None, unwritten: tuple[str, ...] = (), expect: str | None = None, notes: Notes = None, gather: bool = True) -> dict[str, Any]:
        """A version in which the given ranges hold the rows of ``df`` and the others what they held.

        Without ``expect`` writers of different ranges don't hinder each other: one that comes second takes the other's ranges from
        its version. Of two that write the same range one fails. ``gather``: rows are brought together by range before they are
        written, which needs no doing if they come from the ranges' own files.
        """
        made = self.manifest(table)
        touched = set(ranges)
        base = {i: made["parts"][i] for i in touched}
        made["parts"] = [[] if i in touched else folders for i, folders in enumerate(made["parts"])]
        return self._write(table, df, made | {"notes": notes}, metrics, unwritten, expect, base if expect is None else None, gather)

    def append(self, table: str, df: DataFrame, expect: str | None = None, notes: Notes = None) -> dict[str, Any]:
        """A version with the rows of ``df`` beside those that are there."""
        return self._write(table, df, self.manifest(table) | {"notes": notes}, None, (), expect)

    def _write(self, table: str, df: DataFrame, made: dict[str, Any], metrics: dict[str, Column] | None, unwritten: tuple[str, ...], expect: str | None, base: dict[int, list[str]] | None = None, gather: bool = True) -> dict[str, Any]:
        before = self.version(table)
        if expect is not None and (before or ABSENT) != expect:
            raise Conflict(f"{table} is at {before}, not at {expect or 'no version'}")
        folder = f"d{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        made["schema"] = df.drop(*unwritten).schema.jsonValue()
        rows = df
        if made["edges"]:
            place = range_of(F.col(made["key"]), made["edges"], df.schema[made["key"]].dataType)
            # each range in one place first: a file for each task and range would be tasks times ranges files
            rows = df.withColumn("__range", place)
            rows = rows.hint("rebalance", F.col("__range")) if gather else rows
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in (metrics or {}).items())).drop(*unwritten)
        if made["edges"]:
            rows.write.partitionBy("__range").parquet(f"{self.root}/{table}/{folder}")
        else:
            rows.write.parquet(f"{self.root}/{table}/{folder}/__range=0")
        found = {n.removeprefix("__range=") for n in self._names(table, folder) if n.startswith("__range=")}
        made["parts"] = [[*folders, f"{folder}/__range={i}"] if str(i) in found else folders for i, folders in enumerate(made["parts"])]
        if seen.get["rows"] and not found:
            raise Conflict(f"{table}: the files of a version were deleted while it was written")
        if callable(made.get("notes")):
            made["notes"] = made["notes"](dict(seen.get))
        while True:
            try:
                return dict(seen.get) | {"version": self._commit(table, made, before)}
            except Conflict:
                before = self.version(table)
                now = self.manifest(table) if base is not None else {}
                if base is None or (now["edges"], now["schema"]) != (made["edges"], made["schema"]) or any(now["parts"][i] != x for i, x in base.items()):
                    raise
                made["parts"] = [made["parts"][i] if i in base else folders for i, folders in enumerate(now["parts"])]

    def _commit(self, table: str, made: dict[str, Any], before: str | None) -> str:
        """The manifest under the number behind ``before``, unless another one is there."""
        fresh, place = f"_NEW-{uuid.uuid4().hex}", f"{MANIFEST}{int(before or 0) + 1:020d}"
        self._put(json.dumps(made, default=str), table, fresh)
        fs, hadoop = self._fs(), self.spark._jvm.org.apache.hadoop.fs
        how = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        how[0] = getattr(hadoop, "Options$Rename").NONE
        try:
            with _RENAMES:
                hadoop.FileContext.getFileContext(fs.getUri(), fs.getConf()).rename(self._path(table, fresh), self._path(table, place), how)
        except Exception as e:
            fs.delete(self._path(table, fresh), False)
            if fs.exists(self._path(table, place)):
                raise Conflict(f"{table}: another writer has published {int(before or 0) + 1}") from e
            raise
        return place.removeprefix(MANIFEST)

    def vacuum(self, table: str, grace: float = GRACE) -> list[str]:
        """Delete manifests before the last one and folders that it doesn't refer to, if older than ``grace`` seconds.

        Readers of older versions lose them; a writer that is still at work after so long fails and publishes nothing.
        """
        fs, version, oldest = self._fs(), self.version(table), time.time() - grace
        used = {x.split("/")[0] for folders in self.manifest(table)["parts"] for x in folders}
        old = []
        for x in fs.listStatus(self._path(table)):
            name, since = x.getPath().getName(), x.getModificationTime() / 1000
            if x.isDirectory():
                since = int(name[1:].split("-")[0]) / 1e9
                if name in used or since > oldest:
                    continue
                old.append(name)
            elif name == f"{MANIFEST}{version}" or since > oldest or not name.startswith((MANIFEST, "_NEW-")):
                continue
            fs.delete(x.getPath(), True)
        return sorted(old)

    def truncate(self, table: str) -> None:
        made = self.manifest(table)
        self.publish(table, self.read(table).limit(0), made["key"], made["edges"])

    def drop(self, table: str) -> None:
        self._fs().delete(self._path(table), True)


def met_ranges(made: dict[str, Any], key: str, low: Any = None, high: Any = None) -> list[int]:
    """The ranges of a stored table that keys from low to high can fall in; an end that is None is open."""
    edges = made["edges"]
    if made["key"] != key or not edges:
        return list(range(len(edges) + 1))
    plain = lambda v: str(v) if isinstance(edges[0], str) else v
    first = 0 if low is None else bisect_right(edges, plain(low))
    last = len(edges) if high is None else bisect_right(edges, plain(high))
    return list(range(first, last + 1))


def full_refresh(store: Store, source: DataFrame, table: str, fail_tables: tuple[str, ...] = ()) -> Transfer:
    """Replace the table. Failures are reported, not raised; ``fail_tables`` injects them in tests."""
    out, began = Transfer(table), time.time()
    try:
        if table in fail_tables:
            raise RuntimeError("simulated failure")
        out.rows = store.publish(table, normalized(source))["rows"]
        out.target_rows = store.read(table).count()
    except Exception as e:  # noqa: BLE001 - a table's failure is a value, other tables go on
        out.errors.append(str(e)[:4000])
    out.seconds = time.time() - began
    return out


def replaced_range(target: DataFrame, source: DataFrame, inside: Column) -> DataFrame:
    """The target with its rows of the range replaced by the source's. A null range test counts as outside."""
    return target.where(~F.coalesce(inside, F.lit(False))).unionByName(source.where(inside))


def transfer_range(store: Store, table: str, source: DataFrame, key: list[str], low: tuple | None, high: tuple | None, resume_after: tuple | None = None, open_high: bool = False, notes: Notes = None) -> Transfer:
    """Load one range, again if need be: the target's rows of the range are replaced by the source's.

    After a checkpoint only (resume, high] is: what is committed up to the checkpoint stays. The source is read once, and of a
    stored table in ranges only those that the keys can fall in are read and written.
    """
    out, began = Transfer(table), time.time()
    try:
        version, made = store.version(table), store.manifest(table)
        low = low if resume_after is None else resume_after
        inside = in_range(source, key, low, high, open_low=resume_after is not None, open_high=open_high)
        ranges = met_ranges(made, key[0], low and low[0], high and high[0])
        seen = Observation()
        fresh = normalized(source).where(inside).observe(seen, F.count(F.lit(1)).alias("rows"))
        kept = store.read(table, ranges).where(~F.coalesce(inside, F.lit(False)))
        store.publish_ranges(table, kept.unionByName(fresh), ranges, expect=version, notes=notes)
        out.rows = seen.get["rows"]
        out.target_rows = store.read(table, ranges).where(inside).count()
    except Exception as e:  # noqa: BLE001 - a range's failure is a value, others go on
        out.errors.append(str(e)[:4000])
    out.seconds = time.time() - began
    return out


def next_values(df: DataFrame, column: str) -> DataFrame:
    """(max_value, next_value) of an identity column; an empty table restarts behind 1."""
    top = F.coalesce(F.max(column), F.lit(1)).cast("long")
    return df.agg(top.alias("max_value"), (top + 1).alias("next_value"))
