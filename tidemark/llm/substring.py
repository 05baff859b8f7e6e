"""Substring dedup with difference-cover anchors.

Every word covered by a window of ``WINDOW`` words whose word sequence also starts earlier
(smaller doc_id, or same document and earlier start) is removed; windows are judged on the input.

How: D = {0, 1, 3, 9} is a difference cover modulo 13: for any two positions i and j some shift
s < 13 puts both i + s and j + s on D. Only windows of 8 words at cover positions are hashed, so
two equal 20-word windows always share an aligned anchor (12 + 8 = 20). Anchors seen once prove
that none of the windows around them repeats. Anchors seen more often are extended: each 20-word
window that holds one gets a 128-bit hash, and the earliest holder of each hash keeps its words.

Scale: neither step pairs documents. Hashes travel in sorted binary blocks, one for each map slice
and bucket. A slice sends one entry per distinct hash, so a passage that a third of all documents
share costs one entry per slice of text and not one per document. The number of buckets follows
the size of the input. Anchors are spread by their hash. Windows go by the least hash of their 4-word
runs, so that the answers for a repeated passage are runs too; runs of words so common that they would make a
bucket too large are known from a count in fixed slots, and windows that go by one of these are spread by
their own hash. A bucket is reduced to one entry per distinct hash while it is read, every BUCKET_BYTES or
at twice its reduced size, so a hot passage doesn't fill a task's memory. Partitions take several buckets
each beyond MOST_PARTITIONS. Texts are shuffled once, by key, and the same partitioning serves both joins.

Edge cases: null text has no words; null doc_id sorts before all others; rows with the same doc_id
and text count as one document (equal starts do not remove each other), rows with the same doc_id
and different texts, null ids included, are documents of their own, the one with the smaller text hash
earlier; extra columns pass through :func:`without_repeats` untouched, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import slotcounts
from tidemark.llm import textkernel as tk
from tidemark.llm.workspace import bound_batches, by_bucket, materialize, own_prefix

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
GRAM = 4
NO_KEY = -(1 << 63)
BUCKET_BYTES = 32 << 20
MOST_PARTITIONS = 20_000
ROUTES = 18  # bits of a slot in which windows are counted by their least 4-word run
ENTRY_BYTES = 28  # of a window

_HITS = "key long, starts array<int>"
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def bucket_count(docs: DataFrame, text: str = "text") -> int:
    """Buckets for the hash exchange, so that each gets about BUCKET_BYTES at any input size."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(8, int(size // BUCKET_BYTES) + 1)


def _blocks(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row per bucket with the columns' bytes; rows must already be in the wanted order."""
    order = np.argsort(bucket, kind="stable")
    found, at = np.unique(bucket[order], return_index=True)
    cuts = [*at.tolist(), len(order)]
    data = [[c[order[a:b]].tobytes() for c in columns] for a, b in zip(cuts, cuts[1:])]
    arrays = [pa.array(found, pa.int32())] + [pa.array([d[i] for d in data], pa.binary()) for i in range(len(columns))]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", *(f"c{i}" for i in range(len(columns)))])


def _hit_rows(key: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((start, key))
    key, start = key[order], start[order]
    found, at = np.unique(key, return_index=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(found, pa.int64()), tk.ragged(start, np.append(at, len(key)), pa.int32())], ["key", "starts"]
    )


def _group_starts(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _least_gram(t: tk.Texts, at: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Of the windows of ``size`` words that start at words ``at`` the least hash of their runs of GRAM words.

    Equal windows have equal ones, and so do most neighbours, so that a repeated passage meets its
    copies in a few buckets: the answers are runs of starts and not one row for each window.
    """
    grams = np.full(len(t.start), np.iinfo(np.uint64).max)
    begin, (h,) = tk.windows(t, GRAM)
    grams[begin] = tk.mix(h)
    width, n = 1, size - GRAM + 1
    while width * 2 <= n:
        grams[:-width] = np.minimum(grams[:-width], grams[width:])
        width *= 2
    return np.minimum(grams[at], grams[at + n - width])


def _route_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many windows of a task go by the runs of each slot."""
    seen = np.zeros(1 << ROUTES, dtype=np.int64)
    for batch in tk.gathered(batches):
        t = tk.read_texts(batch.column("text"))
        at = np.flatnonzero(t.position() + WINDOW <= np.repeat(t.n_words, t.n_words))
        if len(at):
            seen += np.bincount((_least_gram(t, at) >> np.uint64(64 - ROUTES)).astype(np.int64), minlength=1 << ROUTES)
    yield pa.RecordBatch.from_arrays(list(slotcounts.count_columns(seen)), ["part", "seen"])


def crowded_routes(docs: DataFrame) -> np.ndarray:
    """Slots of runs by which too many windows for a bucket would go."""
    load = slotcounts.total_counts(docs.select("text").mapInArrow(_route_counts, "part int, seen binary"), ROUTES) * ENTRY_BYTES
    return load > max(BUCKET_BYTES / 4, 8 * load.mean())


def _reply_blocks(key: np.ndarray, start: np.ndarray, n: int) -> pa.RecordBatch:
    """Hits in blocks by key."""
    blocks = _blocks((tk.mix(key.view(np.uint64)) % np.uint64(n)).astype(np.int32), [key, start])
    return pa.RecordBatch.from_arrays(blocks.columns, ["part", "keys", "starts"])


_ANCHOR_BLOCKS = "bucket int, c0 binary, c1 binary, c2 binary, part int, keys binary, starts binary"


def _anchor_blocks(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _ANCHOR_BLOCKS.split(", ")]
        for batch in tk.gathered(batches):
            t = tk.read_texts(batch.column("text"))
            at, (h,) = tk.windows(t, ANCHOR)
            position = t.position()
            keep = _IN_COVER[position[at] % PERIOD]
            at, h = at[keep], h[keep]
            if not len(at):
                continue
            key = batch.column("__key").to_numpy()[t.doc[at]]
            start = position[at].astype(np.int32)
            order = np.argsort(h, kind="stable")
            h, key, start = h[order], key[order], start[order]
            head = np.flatnonzero(_group_starts(h))
            size = np.diff(np.append(head, len(h)))
            # a hash that repeats inside the slice needs no answer: all of its members are hits
            out = _blocks((tk.mix(h[head]) % np.uint64(n)).astype(np.int32), [h[head], key[head], np.where(size > 1, -1, start[head]).astype(np.int32)])
            none = pa.nulls(len(out), pa.binary())
            yield pa.RecordBatch.from_arrays([*out.columns, pa.nulls(len(out), pa.int32()), none, none], names)
            many = np.repeat(size > 1, size)
            if many.any():
                hits = _reply_blocks(key[many], start[many], n)
                none = pa.nulls(len(hits), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.nulls(len(hits), pa.int32()), none, none, none, *hits.columns], names)

    return run


def _key_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, starts) of the blocks of one part after the other."""
    now, held = None, []

    def solved() -> pa.RecordBatch:
        return _hit_rows(*(np.concatenate([x[i] for x in held]) for i in range(2)))

    for batch in batches:
        for row, part in enumerate(batch.column("part").to_pylist()):
            if part != now and held:
                yield solved()
                held = []
            now = part
            held.append([np.frombuffer(batch.column(c)[row].as_buffer(), kind).copy() for c, kind in (("keys", np.int64), ("starts", np.int32))])
    if held:
        yield solved()


def _per_bucket(solve, kinds: tuple[type, ...], reply=_hit_rows, ready_columns: tuple[str, ...] = ("key", "starts")):
    """Solve the blocks of one bucket after the other, and forward rows that are hits already.

    The partition is sorted by bucket, so that only one bucket is held at a time. ``solve`` gives the
    hits among entries, and the entries, one per hash, that later ones have to be held against.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, most = None, [], 0, BUCKET_BYTES

        def solved(more: bool = False) -> Iterator[pa.RecordBatch]:
            nonlocal size, most
            if held:
                key, start, rest = solve(*(np.concatenate([p[i] for p in held]) for i in range(len(kinds))))
                held.clear()
                size, most = 0, BUCKET_BYTES
                if more:
                    held.append(rest)
                    size = sum(c.nbytes for c in rest)
                    most = size + max(size, BUCKET_BYTES)
                if len(key):
                    yield reply(key, start)

        for batch in batches:
            bucket = batch.column("bucket")
            ready = pc.is_null(bucket)
            if pc.any(ready).as_py():
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(ready) for c in ready_columns], list(ready_columns))
            for row, b in enumerate(bucket.to_pylist()):
                if b is None:
                    continue
                if b != now:
                    yield from solved()
                    now = b
                # copied: a view would keep the whole batch
                held.append([np.frombuffer(batch.column(f"c{i}")[row].as_buffer(), kind).copy() for i, kind in enumerate(kinds)])
                size += sum(c.nbytes for c in held[-1])
                if size > most:
                    yield from solved(more=True)
        yield from solved()

    return run


def _repeated_anchors(h: np.ndarray, key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    order = np.argsort(h)
    h, key, start = h[order], key[order], start[order]
    head = np.flatnonzero(_group_starts(h))
    size = np.diff(np.append(head, len(h)))
    hit = np.repeat(size > 1, size) & (start >= 0)  # those below are reported already
    return key[hit], start[hit], [h[head], key[head], np.where(size > 1, -1, start[head]).astype(np.int32)]


def _later_windows(h: np.ndarray, g: np.ndarray, key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    order = np.lexsort((start, key, g, h))
    h, g, key, start = h[order], g[order], key[order], start[order]
    head = np.flatnonzero(_group_starts(h, g))
    size = np.diff(np.append(head, len(h)))
    later = (key != np.repeat(key[head], size)) | (start != np.repeat(start[head], size))
    return key[later], start[later], [h[head], g[head], key[head], start[head]]


def _flat_positions(t: tk.Texts, lists: pa.Array) -> np.ndarray:
    """Word indices of per-text start lists (null: none)."""
    lists = pc.fill_null(lists, pa.scalar([], lists.type))
    count = pc.list_value_length(lists).to_numpy()
    flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return flat + np.repeat(t.first[:-1], count)


def _within(mask_from: np.ndarray, t: tk.Texts, before: int, after: int) -> np.ndarray:
    """A mask over all words: inside [p - before, p + after) of the same text."""
    n = len(t.start)
    doc = np.searchsorted(t.first, mask_from, side="right") - 1
    delta = np.zeros(n + 1, dtype=np.int32)
    np.add.at(delta, np.maximum(mask_from - before, t.first[doc]), 1)
    np.add.at(delta, np.minimum(mask_from + after, t.first[doc + 1]), -1)
    return np.cumsum(delta[:-1]) > 0


def _window_blocks(n: int, text: str, own: str, crowded: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.gathered(batches, text):
            t = tk.read_texts(batch.column(text))
            near = _within(_flat_positions(t, batch.column(f"{own}anchors")), t, PERIOD - 1, 1)
            at, (h, g) = tk.windows(t, WINDOW, (0, 1))
            keep = near[at]
            at, h, g = at[keep], h[keep], g[keep]
            key = batch.column(f"{own}key").to_numpy()[t.doc[at]]
            start = t.position()[at].astype(np.int32)
            route = _least_gram(t, at)
            route = np.where(crowded[route >> np.uint64(64 - ROUTES)], tk.mix(h), route)
            order = np.lexsort((start, key, g, h))
            h, g, key, start, route = h[order], g[order], key[order], start[order], route[order]
            head = np.flatnonzero(_group_starts(h, g)) if len(h) else np.zeros(0, int)
            blocks = _blocks((route[head] % np.uint64(n)).astype(np.int32), [h[head], g[head], key[head], start[head]])
            yield pa.RecordBatch.from_arrays([*blocks.columns, pa.nulls(len(blocks), pa.int64()), pa.nulls(len(blocks), pa.list_(pa.int32()))], ["bucket", "c0", "c1", "c2", "c3", "key", "starts"])
            size = np.diff(np.append(head, len(h)))
            later = (key != np.repeat(key[head], size)) | (start != np.repeat(start[head], size))
            if later.any():
                hits = _hit_rows(key[later], start[later])
                none = pa.nulls(len(hits), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.nulls(len(hits), pa.int32()), none, none, none, none, hits[0], hits[1]], ["bucket", "c0", "c1", "c2", "c3", "key", "starts"])

    return run


def _kept(batch: pa.RecordBatch, text: str, own: str) -> tuple[tk.Texts, np.ndarray, list[bytes]]:
    """The words, how many of each text are kept, and the kept ones joined by one space."""
    t = tk.read_texts(batch.column(text))
    kept = ~_within(_flat_positions(t, batch.column(f"{own}removed")), t, 0, WINDOW)
    start, end, doc = t.start[kept], t.end[kept], t.doc[kept]
    size = end - start + 1
    to = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(to[-1]) + np.repeat(start - to[:-1], size)
    raw = np.append(t.bytes, np.uint8(0x20))
    out = raw[np.minimum(source, len(raw) - 1)]
    out[to[1:] - 1] = 0x20
    count = np.bincount(doc, minlength=batch.num_rows)
    last = np.concatenate([[0], np.cumsum(count)])
    begin, stop = to[last[:-1]], np.maximum(to[last[1:]] - 1, to[last[:-1]])
    data = out.tobytes()
    return t, count, [data[a:b] for a, b in zip(begin.tolist(), stop.tolist())]


def _rewrite(text: str, own: str, rows: bool):
    """rows: add the kept text and counts to the row; else give the id and the digest of the kept words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.slices(batches, text):
            t, count, texts = _kept(batch, text, own)
            n_words, n_removed = pa.array(t.n_words, pa.int64()), pa.array(t.n_words - count, pa.int64())
            kept = pa.array([x.decode() for x in texts], pa.string())
            if rows:
                names = [c for c in batch.schema.names if c != f"{own}removed"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), kept, n_removed, n_words], [*names, f"{own}kept", f"{own}n_removed", f"{own}n_words"])
                continue
            digests = pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(f"{own}id"), n_words, n_removed, kept, digests], ["__key", "n_words", "n_removed", "kept_text", "kept_sha256"])

    return run


def repeated_anchors(keyed: DataFrame, n: int) -> DataFrame:
    """(__key, __anchors): cover positions whose 8 words occur more than once in the corpus."""
    solve = _per_bucket(_repeated_anchors, (np.uint64, np.int64, np.int32), lambda key, start: _reply_blocks(key, start, n), ("part", "keys", "starts"))
    hits = _spread(keyed.mapInArrow(_anchor_blocks(n), _ANCHOR_BLOCKS), n, F.col("part")).mapInArrow(solve, "part int, keys binary, starts binary")
    found = by_bucket(hits, min(n, MOST_PARTITIONS), F.col("part"), "part").mapInArrow(_key_starts, _HITS)
    return found.select(F.col("key").alias("__key"), F.col("starts").alias("__anchors"))


def _spread(blocks: DataFrame, n: int, other) -> DataFrame:
    """Blocks by bucket, buckets in order; rows that are hits already go anywhere."""
    return by_bucket(blocks, min(n, MOST_PARTITIONS), F.coalesce("bucket", other), "bucket")


def _keyed(docs: DataFrame, doc_id: str, text: str, own: str = "__") -> DataFrame:
    """``docs`` with __id, the doc_id with null as NO_KEY, and __key, which tells documents apart and orders them.

    ``own`` stands in the place of "__". Where no id has different texts, __key is __id. Else it numbers the
    pairs of __id and text hash in order: partitions of a sorted table follow each other, and so do their ids.
    """
    docs = bound_batches(docs).withColumn(f"{own}id", F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_KEY)))
    of = docs.select(f"{own}id", F.xxhash64(text).alias(f"{own}th"))
    shared = of.groupBy(f"{own}id").agg(F.min(f"{own}th").alias("x"), F.max(f"{own}th").alias("y")).where("x < y")
    if shared.isEmpty():
        return docs.withColumn(f"{own}key", F.col(f"{own}id"))
    number = materialize(of.distinct().orderBy(f"{own}id", f"{own}th").withColumn(f"{own}key", F.monotonically_increasing_id()))
    return docs.withColumn(f"{own}th", F.xxhash64(text)).join(number, [f"{own}id", f"{own}th"]).drop(f"{own}th")


def removals(keyed: DataFrame, text: str, own: str = "__") -> DataFrame:
    """(__key, __removed): starts of the windows that also start earlier, of documents that have such.

    ``keyed`` goes into the join with all its columns, as it will in the caller's join with the result,
    so that Spark shuffles it once for both.
    """
    slim = keyed.select(F.col(f"{own}key").alias("__key"), F.col(text).alias("text"))
    n = bucket_count(slim)
    anchors = materialize(repeated_anchors(slim, n)).toDF(f"{own}key", f"{own}anchors")
    crowded = crowded_routes(slim)
    blocks = keyed.join(anchors, f"{own}key").mapInArrow(_window_blocks(n, text, own, crowded), "bucket int, c0 binary, c1 binary, c2 binary, c3 binary, key long, starts array<int>")
    spread = _spread(blocks, n, F.pmod(F.xxhash64("key"), F.lit(n)).cast("int"))
    later = spread.mapInArrow(_per_bucket(_later_windows, (np.uint64, np.uint64, np.int64, np.int32)), _HITS)
    return later.groupBy(F.col("key").alias(f"{own}key")).agg(F.flatten(F.collect_list("starts")).alias(f"{own}removed"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(__key, n_words, n_removed, kept_text, kept_sha256) for each row; __key: doc_id, null as NO_KEY."""
    keyed = _keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text").select("__key", "__id", "text")
    joined = keyed.join(removals(keyed, "text"), "__key", "left")
    return joined.mapInArrow(_rewrite("text", "__", False), "__key long, n_words long, n_removed long, kept_text string, kept_sha256 string")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with its columns; texts that lose words become their kept words, joined by one space.

    Texts that lose nothing stay as they are, to the byte; a document that loses all its words goes.
    """
    own = own_prefix(docs)
    keyed = _keyed(docs, doc_id, text, own)
    joined = keyed.join(removals(keyed, text, own), f"{own}key", "left")
    added = [T.StructField(f"{own}kept", T.StringType()), T.StructField(f"{own}n_removed", T.LongType()), T.StructField(f"{own}n_words", T.LongType())]
    done = joined.select(*docs.columns, f"{own}removed").mapInArrow(_rewrite(text, own, True), T.StructType([*docs.schema.fields, *added]))
    changed = F.col(f"{own}n_removed") > 0
    new = {text: F.col(f"{own}kept"), n_chars: F.length(f"{own}kept")}
    columns = [F.when(changed, new[c]).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c in new else F.col(c) for c in docs.columns]
    return done.where(~changed | (F.col(f"{own}n_removed") < F.col(f"{own}n_words"))).select(columns)


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.nullif("__key", F.lit(NO_KEY)).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


# DuckDB: every window as a string, the first holder of each kept.
ORACLE = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents
), g as (
  select doc_id, unnest(list_transform(range(1, greatest(len(ws) - 18, 1)), lambda i: {'i': i, 'g': array_to_string(ws[i : i + 19], ' ')})) x from w where len(ws) >= 20
), later as (
  select doc_id, x.i i from g qualify row_number() over (partition by x.g order by doc_id, x.i) > 1
), gone as (
  select distinct doc_id, unnest(range(i, i + 20)) p from later
), words as (
  select doc_id, unnest(list_transform(range(1, len(ws) + 1), lambda i: {'p': i, 'w': ws[i]})) x from w
), kept as (
  select words.doc_id, count(*) n, string_agg(x.w, ' ' order by x.p) t from words anti join gone on words.doc_id = gone.doc_id and words.x.p = gone.p group by words.doc_id
)
select w.doc_id, len(ws)::bigint n_words, (len(ws) - coalesce(n, 0))::bigint n_removed, sha256(coalesce(t, '')) kept_sha256 from w left join kept using (doc_id)
"""
