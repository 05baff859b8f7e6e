"""SimHash near-dedup with BK-trees.

Fingerprint: words of the text with A-Z lower-cased, shingles of 3 words (repeats count; fewer
words: the whole sequence), XXH64 with seed 42, and a bit for each position that over half of the
hashes set. No words: zero. Fingerprints link at ``RADIUS`` or fewer differing bits; a component is
what links connect, named by its smallest doc_id.

Search: equal fingerprints collapse first. 64 bits in four blocks: of two fingerprints at distance 2
at least two blocks agree, so each fingerprint goes to six shards keyed by two blocks. Each shard's
BK-tree is built in the task that owns the shard, children keyed by their distance to the parent,
and a search follows only edges within the radius. Shards over ``SHARD_LIMIT`` are dealt again by a
third and then a fourth part of the remaining bits (pigeonhole again, so no link is lost); at the
last level a shard can't hold more than 2**15 fingerprints. Trees travel to tasks by shuffle and
not by broadcast: a broadcast would need all fingerprints on the driver, 80 GB for 10**10 documents.

A shard reports its local components as trees of fan-out 64, so neither pairs nor hubs are emitted.
Components come from alternating large-star and small-star steps over those links. Fingerprints of more
than a ``HEAVY``th of all rows, of which there are fewer than ``HEAVY``, are broadcast to their rows; the
others meet theirs by shuffle.

Edge cases: null or empty text has fingerprint zero and links to other such; null doc_id sorts
before all others; repeated rows share fingerprint and component; rows of one id, null ids included,
don't join their components; an empty table gives an empty result; extra columns are kept by
:func:`keep_one`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkernel as tk
from tidemark.llm.workspace import bound_batches, materialize, measured_table, own_prefix

RADIUS = 2
SHINGLE = 3
SEED = 42
SHARD_LIMIT = 4096
FAN_OUT = 64
HEAVY = 10_000
BROADCAST_ROWS = 200_000
NO_KEY = -(1 << 63)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def fingerprints(t: tk.Texts) -> np.ndarray:
    size = t.end - t.start + 1
    to = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(to[-1]) + np.repeat(t.start - to[:-1], size)
    raw = _LOWER[np.append(t.bytes, np.uint8(0x20))]
    joined = raw[np.minimum(source, len(raw) - 1)]
    joined[to[1:] - 1] = 0x20
    data = joined.tobytes()
    n = t.n_words
    shingles = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), shingles)
    begin = np.arange(len(doc)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + np.repeat(t.first[:-1], shingles)
    last = begin + np.minimum(np.repeat(n, shingles), SHINGLE)
    digest = xxhash.xxh64_intdigest
    votes = np.zeros((len(n), 64), dtype=np.int64)
    for a in range(0, len(doc), 1 << 18):
        part = slice(a, min(a + (1 << 18), len(doc)))
        h = np.fromiter((digest(data[x:y], SEED) for x, y in zip(to[begin[part]].tolist(), (to[last[part]] - 1).tolist())), np.uint64, part.stop - a)
        add_votes(votes, h, doc[part])
    return over_half(votes, shingles)


def add_votes(votes: np.ndarray, h: np.ndarray, doc: np.ndarray) -> None:
    """Add to the votes of each text how many of the hashes of its shingles set each bit; doc ascends."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    found, at = np.unique(doc, return_index=True)
    votes[found] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)


def over_half(votes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The fingerprints of texts with these votes and numbers of shingles."""
    bits = (2 * votes > shingles[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tk.slices(batches):
        fp = fingerprints(tk.read_texts(batch.column("text")))
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(fp, pa.int64())], [*names, "fp"])


class BKTree:
    """Nodes are (value, children by distance)."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def near(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            node, children = todo.pop()
            d = (node ^ value).bit_count()
            if d <= radius:
                found.append(node)
            if len(children) <= 2 * radius:
                todo.extend(child for edge, child in children.items() if abs(edge - d) <= radius)
            else:
                for edge in range(d - radius, d + radius + 1):
                    child = children.get(edge)
                    if child is not None:
                        todo.append(child)
        return found

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        at = self.root
        while True:
            d = (at[0] ^ value).bit_count()
            if d not in at[1]:
                at[1][d] = (value, {})
                return
            at = at[1][d]


def _local_links(values: list[int], ids: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links, by id, that connect what is connected among distinct values."""
    parent = {v: v for v in values}

    def root(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    tree = BKTree()
    for v in values:
        for near in tree.near(v, radius):
            a, b = root(v), root(near)
            if a != b:
                parent[a] = b
        tree.add(v)
    members: dict[int, list[int]] = {}
    for v, i in zip(values, ids):
        members.setdefault(root(v), []).append(i)
    for group in members.values():
        group.sort()
        for k in range(1, len(group)):
            yield group[(k - 1) // FAN_OUT], group[k]


def _shard_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        out: list[tuple[int, int]] = []

        def flush(rows: np.ndarray) -> None:
            # rows: mask, value, fp, id, sorted by mask and value
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(rows)))
            unsigned = rows[:, 2].view(np.uint64)
            for a, n in zip(head[size > 1].tolist(), size[size > 1].tolist()):
                out.extend(_local_links(unsigned[a : a + n].tolist(), rows[a : a + n, 3].tolist(), radius))

        def emitted() -> pa.RecordBatch:
            a = np.array(out, dtype=np.int64).reshape(-1, 2)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.ascontiguousarray(np.stack([c.to_numpy() for c in batch.columns], axis=1)))
            rows = np.concatenate(held)
            last = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
            cut = last[-1] + 1 if len(last) else 0  # the last shard may go on in the next batch
            if cut:
                flush(np.ascontiguousarray(rows[:cut]))
                if out:
                    yield emitted()
            held = [rows[cut:]]
        if held and len(held[0]):
            flush(np.ascontiguousarray(np.concatenate(held)))
            if out:
                yield emitted()

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _parts(free: int, sizes: tuple[int, ...]) -> list[int]:
    """Masks of consecutive free bits."""
    bits = [1 << i for i in range(64) if free >> i & 1]
    out = []
    for n in sizes:
        out.append(sum(bits[:n]))
        bits = bits[n:]
    return out


def shard_masks() -> list[dict[int | None, list[int]]]:
    """Of each level the fixed-bit masks that refine a mask of the level before."""
    full = (1 << 64) - 1
    first = [a | b for a, b in combinations([0xFFFF << (16 * i) for i in range(4)], 2)]
    second = {m: [m | p for p in _parts(full & ~m, (11, 11, 10))] for m in first}
    third = {m: [m | p for p in _parts(full & ~m, (7, 7, 7 + (full & ~m).bit_count() - 21))] for ms in second.values() for m in ms}
    return [{None: first}, second, third]


def links(fps: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """(a, b): ids of distinct fingerprints (fp, id) that connect all within the radius (at most 2)."""
    spark = fps.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    levels = shard_masks()
    array = lambda masks: F.array(*(F.lit(_signed(m)) for m in masks))
    dealt = fps.select("fp", "id", F.explode(array(levels[0][None])).alias("mask"))
    found = None
    for depth in range(len(levels)):
        dealt = dealt.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        large = None
        if depth + 1 < len(levels):
            counts = dealt.groupBy("mask", "value").count().where(F.col("count") > limit).drop("count")
            large = materialize(counts)
            if large.isEmpty():
                large = None
        small = dealt if large is None else dealt.join(large, ["mask", "value"], "left_anti")
        part = small.select("mask", "value", "fp", "id").repartition(n, "mask", "value").sortWithinPartitions("mask", "value").mapInArrow(_shard_links(radius), "a long, b long")
        found = part if found is None else found.unionByName(part)
        if large is None:
            break
        refine = F.create_map(*(x for m, finer in levels[depth + 1].items() for x in (F.lit(_signed(m)), array(finer))))
        dealt = dealt.join(large, ["mask", "value"], "left_semi").select("fp", "id", F.explode(refine[F.col("mask")]).alias("mask"))
    return found


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction step over edges (a, b), a > b: neighbours are hung on the smallest of them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")) if large else both.groupBy("a").agg(F.min("b").alias("m"))
    hung = both.join(low, "a")
    if large:
        out = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each id of ``edges`` that is not the smallest of its component, with the smallest."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    seal = {"n": F.count(F.lit(1)), "h": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}
    edges, before = measured_table(edges, **seal)
    while before["n"]:
        edges = materialize(_star(edges, True))
        edges, now = measured_table(_star(edges, False), **seal)
        if now == before:
            break
        before = now
    return edges


def grouped(rows: DataFrame) -> DataFrame:
    """``rows`` (key, text and other numbers) without text, with fp, group (a fingerprint) and component (the least key of the group)."""
    kept = [c for c in rows.columns if c != "text"]
    marked = materialize(bound_batches(rows).select(*kept, "text").mapInArrow(_fingerprinted, ", ".join(f"{c} long" for c in (*kept, "fp"))))
    fps = materialize(marked.groupBy("fp").agg(F.min("key").alias("id"), F.count("*").alias("n")))
    stars = components(links(fps.select("fp", F.col("fp").alias("id"))))
    found = materialize(fps.join(stars, fps["fp"] == stars["a"], "left").select("fp", "id", "n", F.coalesce("b", "fp").alias("group")))
    named = materialize(found.join(found.groupBy("group").agg(F.min("id").alias("component")), "group").select("fp", "n", "group", "component"))
    total = named.agg(F.sum("n")).first()[0] or 0
    heavy = F.broadcast(named.where(F.col("n") > total / HEAVY).drop("n"))
    light = marked.join(heavy.select("fp"), "fp", "left_anti").join(named.drop("n"), "fp")
    return marked.join(heavy, "fp").unionByName(light).select(*kept, "fp", "group", "component")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component) for each row; key: doc_id with null as NO_KEY.

    What links are fingerprints and not ids: rows without id, or of one id, do not join their components.
    """
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_KEY)).alias("key"), F.col(text).alias("text"))
    return grouped(keyed).select("key", "fp", "component")


def take_one(docs: DataFrame, doc_id: str, text: str, group) -> DataFrame:
    """Of each group one row, all columns kept: that of the smallest doc_id (null first), then of the least row hash.

    ``group`` gives (key, th, rh, group) for rows (key, th, rh, text). What goes is found among a few numbers a
    row; documents are only read, and of rows that are there several times one is taken.
    """
    own = own_prefix(docs)
    plain = ("key", "th", "rh")
    by = [f"{own}{c}" for c in plain]
    key = F.coalesce(docs[doc_id].cast("long"), F.lit(NO_KEY))
    named = docs.withColumns(dict(zip(by, (key, F.xxhash64(docs[text]), F.xxhash64(*(docs[c] for c in docs.columns))))))
    found = materialize(group(named.select(*(F.col(c).alias(x) for c, x in zip(by, plain)), F.col(text).alias("text"))))
    rows = found.groupBy("group", *plain).agg(F.count("*").alias("times"))
    chosen = materialize(rows.groupBy("group").agg(F.min(F.struct(*plain, "times")).alias("r")).select("r.*"))
    several = materialize(chosen.where("times > 1").select(*plain).toDF(*by))
    others = materialize(found.select(*plain).distinct().join(chosen.where("times = 1"), list(plain), "left_anti").toDF(*by))
    single = named.join(small(others), by, "left_anti")
    first = named.join(small(several), by, "left_semi").dropDuplicates(by)
    return single.unionByName(first).select(docs.columns)


def small(df: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component of fingerprints one row."""
    return take_one(docs, doc_id, text, lambda rows: grouped(rows).select("key", "th", "rh", "group"))


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    null = lambda c: F.nullif(c, F.lit(NO_KEY))
    return found.select(null("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), null("component").alias("component_id"))
