"""Where intermediate tables go, and how columns that operators add keep out of the caller's way."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared import shared_folder


def checkpoint_root(spark: SparkSession) -> str:
    return shared_folder(spark)


def own_prefix(*frames: DataFrame) -> str:
    """A prefix that no column of the frames has, in any case."""
    names = [c.lower() for df in frames for c in df.columns]
    prefix = "__"
    while any(c.startswith(prefix) for c in names):
        prefix += "_"
    return prefix


BATCH_ROWS = 1000


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, for Python functions over Arrow batches of at most BATCH_ROWS rows.

    Spark bounds batches by rows only: 10,000 rows of long texts are more than the rest of a task needs. The
    setting is the session's, as Spark has no other; a smaller one stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(name))
    if not 0 < now <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def measured_table(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict[str, Any]]:
    """:func:`materialize` with aggregates that the writing job observes."""
    seen = Observation()
    out = materialize(df.observe(seen, *(c.alias(k) for k, c in metrics.items())))
    return out, seen.get


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends at replicated files.

    ``checkpoint()`` keeps rows uncompressed; a Parquet table is smaller, prunes columns and gives
    the planner true sizes, so it is what every operator here uses. The result is lazy and reads these
    files, so they stay until the folder is cleared, as checkpoints do.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_bucket(df: DataFrame, n: int, bucket: Column, *order: str) -> DataFrame:
    """Rows of a bucket in one partition, buckets dealt evenly: by a hash of so few numbers some partitions would get several and others none."""
    return df.repartitionById(n, F.pmod(bucket, F.lit(n)).cast("int")).sortWithinPartitions(*order)
