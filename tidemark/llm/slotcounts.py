"""Counts in a fixed number of slots: an array in each task, summed in parts, a few MB on the driver whatever the input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PARTS = 16


def count_columns(seen: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The columns part and seen (the bytes of int32 counts) of PARTS rows."""
    return pa.array(range(PARTS), pa.int32()), pa.array([x.astype(np.int32).tobytes() for x in np.split(seen, PARTS)], pa.binary())


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, seen in zip(batch.column("part").to_pylist(), batch.column("seen")):
            total[part] = total.get(part, 0) + np.frombuffer(seen.as_buffer(), np.int32).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["part", "seen"])


def total_counts(rows: DataFrame, bits: int) -> np.ndarray:
    """The sums of (part, seen) rows of all tasks, for 2**bits slots."""
    out = np.zeros((PARTS, (1 << bits) // PARTS), dtype=np.int64)
    for r in rows.select("part", "seen").repartitionById(PARTS, "part").mapInArrow(_summed, "part int, seen binary").collect():
        out[r.part] = np.frombuffer(r.seen, np.int64)
    return out.ravel()
