"""A load in chunks of the key whose checkpoints can't run ahead of the data or stay behind them.

The key is cut once; every chunk is a range of the stored table and is published together with the note that it is there, in
one version. A load that was killed goes on behind the last chunk of the table's own notes.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import normalized
from tidemark.operators.load import Store
from tidemark.operators.partition import range_edges
from tidemark.operators.scan import in_range


@dataclass
class ChunkedLoad:
    table: str
    chunks: int = 0  # of the whole load
    first: int = 0  # the chunk that this call began with
    rows_read: int = 0  # by this call
    rows: int = 0  # in the table
    seconds: float = 0.0
    errors: list[str] = field(default_factory=list)

    @property
    def success(self) -> bool:
        return not self.errors


def load_in_chunks(
    store: Store, table: str, source: DataFrame, key: str, chunks: int, load_id: str = "load",
    committed: Callable[[Any, int, int], None] | None = None, edges: list | None = None,
) -> ChunkedLoad:
    """Replace the table by the source, a chunk of the key at a time, or finish the load of that name that was begun.

    ``committed(last key, chunk, rows in the table)`` is called behind every version, to show the state elsewhere; what counts is in
    the version. A failure is a result: it leaves the chunks before it, and the next call with the same ``load_id`` reads only the rest. Null
    keys are in the first chunk.
    """
    out, began = ChunkedLoad(table), time.time()
    try:
        rows = normalized(source)
        notes = store.notes(table)
        if notes.get("load_id") == load_id and not notes.get("done"):
            made = store.manifest(table)
            edges, version = made["edges"], store.version(table)
            out.first, out.rows = notes["chunk"] + 1, notes["rows"]
        else:
            edges = range_edges(source, key, chunks) if edges is None else edges
            notes = {"load_id": load_id, "chunk": -1, "last_key": None, "rows": 0, "done": False}
            version = store.publish(table, rows.limit(0), key, edges, notes=notes)["version"]
        out.chunks = len(edges) + 1
        for i in range(out.first, out.chunks):
            low, high = (edges[i - 1],) if i else None, (edges[i],) if i < len(edges) else None
            inside = in_range(rows, [key], low, high, open_high=True)
            chunk = rows.where(inside if i else inside | F.col(key).isNull())
            # the last key is noted as the upper edge of the chunk: all keys below it are in the table
            notes = {"load_id": load_id, "chunk": i, "last_key": edges[i] if i < len(edges) else None, "done": i + 1 == out.chunks}
            before = out.rows
            seen = store.publish_ranges(table, chunk, [i], expect=version, notes=lambda seen, notes=notes, before=before: notes | {"rows": before + seen["rows"]})
            version = seen["version"]
            out.rows_read += seen["rows"]
            out.rows += seen["rows"]
            if committed:
                committed(notes["last_key"], i, out.rows)
    except Exception as e:  # noqa: BLE001 - a table's failure is a value, others go on
        out.errors.append(str(e)[:4000])
    out.seconds = time.time() - began
    return out
