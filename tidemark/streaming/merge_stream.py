"""Continuous merge: each micro-batch is merged into a published table."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import incremental
from tidemark.operators.load import Store
from tidemark.sources.shared import temporary_tables, written


def newest(batch: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key by ``order`` (undated first); of equal ones the greatest by its other columns, so that a replay takes the same."""
    others = [F.col(c).desc_nulls_last() for c in batch.columns if c not in (*key, order)]
    w = Window.partitionBy(*key).orderBy(F.col(order).desc_nulls_last(), *others)
    return batch.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def merge_batch(store: Store, table: str, batch: DataFrame, key: list[str], order: str) -> incremental.Sync:
    """Merge a batch; a null in the key is an error, since it would be inserted again with each replay. Rows that come late, older by ``order`` than the target's, change nothing."""
    if not batch.where(reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))).isEmpty():
        raise ValueError(f"rows for {table} have a null in {key}")
    with temporary_tables(store.spark):
        staged = written(newest(batch, key, order))
        return incremental.merge_staged(store, table, staged, key, dt.datetime.now(dt.UTC).replace(tzinfo=None), order)


def start(source: DataFrame, store: Store, table: str, key: list[str], order: str, checkpoint: str, once: bool = True):
    """Start the query; a batch that is replayed after a failure merges to the same table. Of a table in ranges a batch writes those it touches."""

    def into_table(batch: DataFrame, batch_id: int) -> None:
        merge_batch(store, table, batch, key, order)

    writer = source.writeStream.foreachBatch(into_table).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
