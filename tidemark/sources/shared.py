"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where that is unset, a local master (tests) gets a folder of its own; on a cluster it is an error, as
    every executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not getattr(spark, "_tidemark_folder", None):
        spark._tidemark_folder = tempfile.mkdtemp(prefix="tidemark-")
    return spark._tidemark_folder


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder where nothing is yet; what is put there goes with :func:`temporary_tables`."""
    path = f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
    for paths in _scopes.get()[-1:]:
        paths.append(path)
    return path


def mounted(path: str) -> str:
    """A path of the shared folder as processes on this machine open it."""
    place = urlparse(path)
    if place.scheme not in ("", "file"):
        raise RuntimeError(f"a database in the driver's JVM needs a shared folder that is mounted, not {path}")
    return place.path


def deleted(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, compressed, and there if executors are lost. A ``path`` of an outer scope outlives the inner."""
    path = path or new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`written` makes inside, in this thread, are deleted at the end, also after a failure."""
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for x in paths:
            deleted(spark, x)
