"""Near-copy groups by SimHash and BK-trees, with the exact Jaccard coefficient as the check that follows.

Words have A-Z lower-cased; the set of a text is that of its runs of ``width`` words (fewer words: the
whole sequence; none: the empty set). Texts link if the coefficient of their sets is ``similarity`` or
more, and what links connect is a group.

Search: equal sets collapse first. A set's fingerprint is its SimHash, ``FP_WORDS`` words of 64 bits. Fingerprints
go to shards, and a shard's BK-tree is built in the task that owns it; pairs within :func:`wide_radius`, which
a pair that reaches the similarity exceeds with a chance of ``MISSED`` at most, are checked. Shards are keyed by rare
shingles: of two sets that reach the coefficient, the first n - ceil(similarity * n) + 1 shingles of each, in any one
order of all shingles, share one. Order: by the number of texts (counted in :func:`slot_bits` slots), rare ones first.
Blocks of bits, as in simhash.py, don't split fingerprints at so wide a radius; nor does it spare branches of a tree, so that a
shard has trees by classes of set sizes, of which at most three are walked, and leaves are compared as arrays.

Scale: shingles travel as binary blocks, one for each map slice and bucket, and only those that sets of compatible
sizes share leave a bucket. A shard's tree first holds a few hubs only (stars, so a group of m near copies costs
a few m comparisons); what that connects is not compared again. Further stars follow while they connect much and the
pairs left outnumber the shared shingles; then trees hold all that is left, so none is left out. All pairs leave a shard
only if it has ``FEW`` sets at most. The other shards are joined to families (of shingles that much the same texts share), to
which the sets themselves go: pairs are checked where they are found and not at all if links connect them already, and
a forest of links leaves, of fewer rows than there are sets. Comparisons there stay quadratic in what no link
connects; families over ``SHARD_LIMIT`` are dealt to tasks by pairs of parts. Before other sets are compared their sketches are: counts of a set's hashes in
about as many cells as it has shingles. The sum of the lesser counts bounds the shingles in common from above,
so that texts that only share a passage cost a byte for each word and not their sets; the last pairs are held
against a coarser one, of 512 bits, before. Sets travel as hashes of 32 bits, in which equal shingles are equal too.

Edge cases: null text counts as empty; rows are told apart by doc_id, text and the other columns, so
null or repeated ids lose no group; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace
from fractions import Fraction
from functools import lru_cache, reduce
from math import acos, comb, log, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import slotcounts
from tidemark.llm import textkernel as tk
from tidemark.llm.simhash import _LOWER, add_votes, components, over_half, small, take_one
from tidemark.llm.substring import BUCKET_BYTES, MOST_PARTITIONS, _blocks, bucket_count
from tidemark.llm.workspace import bound_batches, by_bucket, materialize

WIDTH = 5
SIMILARITY = 0.8
SLOT_BITS = 20, 22  # of corpora up to SLOT_BYTES a slot, and at most
SLOT_BYTES = 2048
LEAF, ONE_BY_ONE = 1024, 12  # fingerprints of a tree's leaf, and up to how many are compared one by one
FP_WORDS = 4  # of 64 bits, in a fingerprint
MISSED = 1e-9
STARS, HUBS = 6, 3
SHARD_LIMIT = 2048
SHARD_SHINGLES = 1 << 24  # 64 MB, of the sets that are dealt to one part of a shard
FEW = 8  # texts of a shingle, of which all pairs may leave the shard
CHECKED = 64  # sets at once
BOTH, PLANT, SEEK = range(3)
WORDS = 8  # a power of two
_KNOWN = "sid long, n int, sketch binary, shingles binary, fp binary, " + ", ".join(f"b{i} long" for i in range(WORDS))
WORTHWHILE = 0.002  # links that stars have to find, for each shared shingle of a text, for others to follow


def shingle_sets(t: tk.Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and of each text where its own begin (one more)."""
    words = replace(t, bytes=_LOWER[t.bytes]).hashes()
    n = t.n_words
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    begin = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(t.first[:-1], count)
    h = tk.segment_hashes(words, begin, begin + np.minimum(n[doc], width), 0)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(n) + 1))


def set_ids(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit id for each set, the same for equal sets."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk.mix(h + np.uint64(0x9E3779B97F4A7C15)))])
    size = np.diff(first).astype(np.uint64)
    return tk.mix(total[first[1:]] - total[first[:-1]] + size * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)


def _least(similarity: Fraction, n: np.ndarray) -> np.ndarray:
    """ceil(similarity * n), in integers."""
    return -((-similarity.numerator * n) // similarity.denominator)


def _cells(n: np.ndarray) -> np.ndarray:
    """Bits of the number of cells for sets of n shingles: the least power of two that is not below n, 16 to 2**20."""
    return np.clip(np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), 4, 20)


def sketches(h: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Of each set how many of its hashes fall in each cell."""
    out = []
    for a, b, bits in zip(first[:-1].tolist(), first[1:].tolist(), _cells(np.diff(first)).tolist()):
        out.append(np.minimum(np.bincount((h[a:b] >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes())
    return out


def most_shared(x: np.ndarray, y: np.ndarray) -> int:
    """No two sets of these sketches have more shingles in common. A full cell holds any number."""
    while len(x) > len(y):
        x = np.minimum(x[0::2].astype(np.uint16) + x[1::2], 255)
    while len(y) > len(x):
        y = np.minimum(y[0::2].astype(np.uint16) + y[1::2], 255)
    least = np.minimum(x, y).astype(np.int64)
    return int(np.where(least == 255, 1 << 30, least).sum())


_MARKED = "key long, th long, rh long, sid long, part int, seen binary"


def slot_bits(size: int) -> int:
    """Bits of the number of slots in which the shingles of texts of so many bytes are counted: a task's counts are 16 MB at most."""
    least, most = SLOT_BITS
    return min(max(least, (size // SLOT_BYTES).bit_length()), most)


def _marked(width: int, bits: int):
    """Of each row its identity and set, and at the end of a task how many texts have shingles of each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, dtype=np.int32)
        names = [x.split()[0] for x in _MARKED.split(", ")]
        for batch in tk.gathered(batches):
            h, first = shingle_sets(tk.read_texts(batch.column("text")), width)
            np.add.at(seen, (h >> np.uint64(64 - bits)).astype(np.int64), np.int32(1))
            m = batch.num_rows
            own = [batch.column(c) for c in ("key", "th", "rh")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(set_ids(h, first)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        none = pa.nulls(slotcounts.PARTS, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, *slotcounts.count_columns(seen)], names)

    return run


def _prefix_blocks(width: int, similarity: Fraction, common: np.ndarray, buckets: int):
    """Of each slice and bucket the prefix shingles with set id, set size and place, in four columns of bytes."""
    shift = np.uint64(64 - (len(common).bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.gathered(batches):
            h, first = shingle_sets(tk.read_texts(batch.column("text")), width)
            n, sid = np.diff(first), set_ids(h, first)
            doc = np.repeat(np.arange(len(n)), n)
            h = h[np.lexsort((h, common[h >> shift], doc))]
            place = np.arange(len(h)) - first[doc]
            once = np.zeros(len(n), dtype=bool)
            once[np.unique(sid, return_index=True)[1]] = True
            keep = (place < n[doc] - _least(similarity, n[doc]) + 1) & once[doc]
            h, doc, place = h[keep], doc[keep], place[keep]
            yield _blocks((h % np.uint64(buckets)).astype(np.int32), [h, sid[doc], n[doc].astype(np.int32), place.astype(np.int32)])

    return run


def _shared(similarity: Fraction):
    """(token, sid, n, pos) of the shingles that sets of compatible sizes share; one bucket is held at a time."""

    def solved(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        h, sid, n, pos = (np.concatenate([x[i] for x in held]) for i in range(4))
        order = np.lexsort((sid, n, h))
        h, sid, n, pos = h[order], sid[order], n[order].astype(np.int64), pos[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (sid[1:] != sid[:-1])  # equal sets of other slices
        h, sid, n, pos = h[new], sid[new], n[new], pos[new]
        # by size within a shingle, so that a set has a compatible one if a neighbour is
        near = (h[1:] == h[:-1]) & (n[:-1] >= _least(similarity, n[1:]))
        keep = np.append(near, False) | np.append(False, near)
        return pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(sid[keep]), pa.array(n[keep], pa.int32()), pa.array(pos[keep])], ["token", "sid", "n", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row, b in enumerate(batch.column("bucket").to_pylist()):
                if b != now and held:
                    yield solved(held)
                    held = []
                now = b
                # copied: a view would keep the whole batch
                held.append([np.frombuffer(batch.column(f"c{i}")[row].as_buffer(), kind).copy() for i, kind in enumerate((np.uint64, np.int64, np.int32, np.int32))])
        if held:
            yield solved(held)

    return run


def cell_bits(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each set which of 64 * WORDS cells hold one of its hashes, as WORDS numbers."""
    bits = np.zeros((len(first) - 1, WORDS), np.uint64)
    cell = (h >> np.uint64(64 - 6 - WORDS.bit_length() + 1)).astype(np.int64)
    np.bitwise_or.at(bits, (np.repeat(np.arange(len(first) - 1), np.diff(first)), cell >> 6), np.uint64(1) << (cell & 63).astype(np.uint64))
    return bits.view(np.int64)


def _whole(width: int):
    names = [x.split()[0] for x in _KNOWN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.gathered(batches):
            h, first = shingle_sets(tk.read_texts(batch.column("text")), width)
            short = (h >> np.uint64(32)).astype(np.uint32)
            sets = [short[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array(np.diff(first), pa.int32()), pa.array(sketches(h, first), pa.binary()), pa.array(sets, pa.binary()), pa.array(fingerprints(h, first), pa.binary()), *(pa.array(x) for x in cell_bits(h, first).T)], names)

    return run


def fingerprints(h: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Of each set its SimHash of FP_WORDS times 64 bits, a bit being set if over half of the shingles' hashes set it."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    out = np.zeros((len(n), FP_WORDS), np.int64)
    for word in range(FP_WORDS):
        votes = np.zeros((len(n), 64), np.int64)
        for a in range(0, len(h), 1 << 16):
            own = h[a : a + (1 << 16)]
            add_votes(votes, tk.mix(own + np.uint64(word * 0x9E3779B97F4A7C15 % (1 << 64))) if word else own, doc[a : a + (1 << 16)])
        out[:, word] = over_half(votes, n)
    return [x.tobytes() for x in out]


def _differs(shared: int, a: int, b: int) -> float:
    """How likely a bit differs in the fingerprints of two sets with so many shingles in common and alone."""

    def most(alone: int) -> np.ndarray:
        ways = np.array([comb(alone, i) for i in range(alone + 1)]) / 2.0**alone
        return np.array([ways[2 * (v + np.arange(alone + 1)) > shared + alone].sum() for v in range(shared + 1)])

    x, y = most(a), most(b)
    return float((np.array([comb(shared, i) for i in range(shared + 1)]) / 2.0**shared * (x * (1 - y) + y * (1 - x))).sum())


@lru_cache
def wide_radius(similarity: Fraction) -> int:
    """The radius beyond which a pair that reaches the similarity lies with a chance of MISSED at most.

    Hashes are independent of the texts, so that the number of differing bits is binomial whatever the texts are. The
    chance of a bit is arccos(2s / (1 + s)) / pi for large sets, and more for some small ones because of ties.
    """
    s, bits = float(similarity), 64 * FP_WORDS
    p = acos(2 * s / (1 + s)) / pi
    for union in range(1, 41):
        shared = int(_least(similarity, np.int64(union)))
        p = max(p, *(_differs(shared, a, union - shared - a) for a in range(union - shared + 1)))
    tail, r = 1.0, -1
    while tail > MISSED and r < bits:
        r += 1
        tail = sum(comb(bits, k) * p**k * (1 - p) ** (bits - k) for k in range(r + 1, bits + 1))
    return r


class FingerprintTree:
    """A BK-tree: children by their distance to the parent. Up to LEAF fingerprints stay in one leaf, whose distances are taken at once."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.words = np.empty((4, FP_WORDS), np.uint64)
        self.children: dict[int, FingerprintTree] | None = None

    def add(self, value: int) -> None:
        node = self
        while node.children is not None:
            node = node.children.setdefault((node.values[0] ^ value).bit_count(), FingerprintTree())
        m = len(node.values)
        if m == len(node.words):
            node.words = np.concatenate([node.words, np.empty_like(node.words)])
        node.words[m] = _words(value)
        node.values.append(value)
        if m + 1 == LEAF:
            first, *others = node.values
            node.values, node.words, node.children = [first], node.words[:1].copy(), {}
            for v in others:
                node.children.setdefault((first ^ v).bit_count(), FingerprintTree()).add(v)

    def near(self, value: int, radius: int) -> list[tuple[int, int]]:
        """(distance, fingerprint) of all within the radius."""
        found, todo, own = [], [self], _words(value)
        while todo:
            node = todo.pop()
            m = len(node.values)
            if m <= ONE_BY_ONE:
                found += [(d, v) for v in node.values if (d := (v ^ value).bit_count()) <= radius]
            else:
                d = np.bitwise_count(node.words[:m] ^ own).sum(axis=1)
                found += [(int(d[i]), node.values[i]) for i in np.flatnonzero(d <= radius).tolist()]
            if node.children:
                at = (node.values[0] ^ value).bit_count()
                todo += [child for edge, child in node.children.items() if abs(edge - at) <= radius]
        return found


def _words(value: int) -> np.ndarray:
    return np.frombuffer(value.to_bytes(8 * FP_WORDS, "little"), np.uint64)


class _Shards:
    """The BK-trees of each shard of rows that come by shard and, in it, in an order in which each seeks among those before it
    that are planted: ``most`` at most, None for all. Those of one group in a row are planted after the last of them.

    A shard has a tree for each class of set sizes, in steps of the similarity: a pair that reaches it is of one class or of
    neighbouring ones, so that no other tree of the shard is walked."""

    def __init__(self, similarity: Fraction, radius: int, most: int | None) -> None:
        self.similarity, self.radius, self.most, self.now = similarity, radius, most, None

    def _class(self, n: int) -> int:
        return int(log(n) / -log(self.similarity)) if 0 < self.similarity < 1 else 0

    def _classes(self, n: int) -> range:
        """The classes of all sizes with which a set of n shingles can reach the similarity."""
        up, down = self.similarity.numerator, self.similarity.denominator
        return range(self._class(-(-up * n // down)), self._class(down * n // up) + 1) if up else range(1)

    def near(self, shard: tuple, side: int, group: int, fp: bytes, n: int, own: tuple) -> list[tuple]:
        """What is planted of sizes that reach the similarity, within the radius of this row, nearest first; then the row is planted, if it is of that side."""
        if shard != self.now:
            self.now, self.trees, self.waiting, self.planted = shard, {}, [], 0
        elif group != self.group and self.waiting:
            for size, value, one in self.waiting:
                tree, nodes = self.trees.setdefault(size, (FingerprintTree(), {}))
                if value not in nodes:
                    tree.add(value)
                nodes.setdefault(value, []).append(one)
            self.waiting = []
        self.group = group
        value = int.from_bytes(fp, "little")
        found = []
        if side != PLANT:
            for size in self._classes(n):
                if size in self.trees:
                    tree, nodes = self.trees[size]
                    found += [(d, one) for d, v in tree.near(value, self.radius) for one in nodes[v]]
            found = [one for _, one in sorted(found, key=lambda x: x[0])]
        if side != SEEK and (self.most is None or self.planted < self.most):
            self.waiting.append((self._class(n), value, own))
            self.planted += 1
        return found


def _room(similarity: Fraction, n: int, pos: int, n_: int, pos_: int) -> bool:
    """A pair is sought at the first shingle of its common order that it shares: behind it there is room for all others."""
    return min(n - pos, n_ - pos_) * (similarity.numerator + similarity.denominator) >= similarity.numerator * (n + n_)


def _pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    out = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])


def _tree_pairs(similarity: Fraction, radius: int, most: int | None):
    """Pairs of sets of one shard and different groups whose fingerprints lie within the radius, found in a BK-tree of the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(similarity, radius, most)
        for batch in batches:
            found: set[tuple[int, int]] = set()
            names = ("token", "x", "y", "side", "sid", "n", "pos", "group", "fp")
            for token, x, y, side, sid, n, pos, group, fp in zip(*(batch.column(c).to_pylist() for c in names)):
                for sid_, n_, pos_, group_ in shards.near((token, x, y), side, group, fp, n, (sid, n, pos, group)):
                    if group_ != group and _room(similarity, n, pos, n_, pos_):
                        found.add((sid, sid_) if sid > sid_ else (sid_, sid))
            yield _pairs_batch(list(found))

    return run


def in_common(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many hashes of each of the others, none empty, are in x."""
    all_ = np.concatenate(others)
    hit = x[np.minimum(np.searchsorted(x, all_), len(x) - 1)] == all_
    return np.add.reduceat(hit, np.cumsum([0, *map(len, others[:-1])]), dtype=np.int64)


def _tree_links(similarity: Fraction, radius: int):
    """Links that connect what is connected in a shard, fewer than it has sets: the pairs of its BK-tree are checked by the
    exact coefficient where they are found, unless links or groups connect them already."""
    up, down = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, now = _Shards(similarity, radius, None), None
        parent: dict[int, int] = {}

        def root(g: int) -> int:
            while (to := parent.get(g, g)) != g:
                parent[g] = parent.get(to, to)
                g = to
            return g

        for batch in batches:
            found = []
            names = ("family", "x", "y", "side", "sid", "n", "pos", "group", "fp", "shingles")
            for family, x, y, side, sid, n, pos, group, fp, shingles in zip(*(batch.column(c).to_pylist() for c in names)):
                if (family, x, y) != now:
                    now, parent = (family, x, y), {}
                own = np.frombuffer(shingles, np.uint32)
                near = [r for r in shards.near(now, side, group, fp, n, (sid, n, pos, group, own)) if r[3] != group and _room(similarity, n, pos, r[1], r[2])]
                for a in range(0, len(near), CHECKED):
                    to = root(group)
                    some = [r for r in near[a : a + CHECKED] if root(r[3]) != to]
                    if not some:
                        continue
                    shared = in_common(own, [r[4] for r in some])
                    for i in np.flatnonzero(shared * down >= up * (n + np.array([r[1] for r in some]) - shared)).tolist():
                        if (other := root(some[i][3])) != root(group):
                            parent[other] = root(group)
                            found.append((max(sid, some[i][0]), min(sid, some[i][0])))
            yield _pairs_batch(found)

    return run


def _possible(similarity: Fraction):
    """Pairs whose sketches allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y, n) in enumerate(zip(batch.column("va"), batch.column("vb"), batch.column("both").to_pylist())):
                shared = most_shared(*(np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y)))
                good[i] = shared * (similarity.numerator + similarity.denominator) >= similarity.numerator * n
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("a", "b")], ["a", "b"])

    return run


def _similar(similarity: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column("va"), batch.column("vb"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint32) for v in (x, y))
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                good[i] = shared * similarity.denominator >= similarity.numerator * (len(both) - shared)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("a", "b")], ["a", "b"])

    return run


def groups(rows: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """(key, th, rh, group) for each of ``rows`` (key, th, rh, text); group: the least set id."""
    share = Fraction(str(similarity))
    spark = rows.sparkSession
    slim = rows.select("text")
    buckets = bucket_count(slim)
    bits = slot_bits(buckets * BUCKET_BYTES)
    both = materialize(bound_batches(rows).mapInArrow(_marked(width, bits), _MARKED))
    marked = both.where("part is null").select("key", "th", "rh", "sid")
    counts = slotcounts.total_counts(both.where("part is not null"), bits)
    common = (4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)

    blocks = slim.mapInArrow(_prefix_blocks(width, share, common, buckets), "bucket int, c0 binary, c1 binary, c2 binary, c3 binary")
    blocks = by_bucket(blocks, min(buckets, MOST_PARTITIONS), F.col("bucket"), "bucket")
    entries = materialize(blocks.mapInArrow(_shared(share), "token long, sid long, n int, pos int"))

    some = materialize(entries.select("sid").distinct())
    chosen = marked.join(small(some), "sid", "left_semi").groupBy("sid").agg(F.min(F.struct("key", "th", "rh")).alias("r"))
    chosen = materialize(chosen.select("sid", "r.*"))
    known = rows.join(small(chosen), ["key", "th", "rh"]).dropDuplicates(["sid"]).select("sid", "text").mapInArrow(_whole(width), _KNOWN)
    known = materialize(known)

    def linked(pairs: DataFrame) -> DataFrame:
        def with_values(pairs: DataFrame, value: str, *more: str) -> DataFrame:
            for x in ("a", "b"):
                pairs = pairs.join(known.select(F.col("sid").alias(x), F.col(value).alias(f"v{x}"), *(F.col(c).alias(f"{c}{x}") for c in more)), x)
            return pairs

        rough = with_values(pairs, "sketch", "n").withColumn("both", F.col("na") + F.col("nb"))
        possible = materialize(rough.select("a", "b", "va", "vb", "both").mapInArrow(_possible(share), "a long, b long"))
        return materialize(with_values(possible, "shingles").select("a", "b", "va", "vb").mapInArrow(_similar(share), "a long, b long"))

    def near(left: DataFrame, k: int | None) -> DataFrame:
        """Pairs of the shards by the BK-trees: all of them, or with the ``k``th choice of hubs."""
        dealt = left.withColumns({"x": F.lit(0), "y": F.lit(0), "o": F.col("group") if k is None else F.xxhash64("sid", F.lit(k)), "side": F.lit(BOTH)})
        dealt = dealt.select("token", "x", "y", "side", "o", "sid", "n", "pos", "group", "fp")
        dealt = dealt.repartition(n_tasks, "token").sortWithinPartitions("token", "x", "y", "side", "o")
        return dealt.mapInArrow(_tree_pairs(share, wide_radius(share), None if k is None else HUBS), "a long, b long").distinct()

    def within_families(left: DataFrame) -> DataFrame:
        """Links of shards that hold the sets themselves, one for each family of shingles."""
        own = materialize(left.groupBy("family", "sid").agg(F.min("pos").alias("pos"), *(F.first(c).alias(c) for c in ("n", "group", "fp"))))
        parts = F.ceil(F.greatest(F.count("*") / SHARD_LIMIT, F.sum("n") / SHARD_SHINGLES)).cast("int")
        parts = materialize(own.groupBy("family").agg(parts.alias("parts")).where("parts > 1"))
        own = own.join(small(parts), "family", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        own = own.join(known.select("sid", "shingles"), "sid").withColumn("own", F.pmod(F.xxhash64("sid"), "parts").cast("int"))
        own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = own.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")})
        dealt = dealt.withColumn("side", F.when(F.col("x") == F.col("y"), BOTH).when(F.col("own") == F.col("x"), PLANT).otherwise(SEEK))
        dealt = dealt.select("family", "x", "y", "side", "group", "sid", "n", "pos", "fp", "shingles")
        dealt = dealt.repartition(n_tasks, "family", "x", "y").sortWithinPartitions("family", "x", "y", "side", "group")
        return materialize(dealt.mapInArrow(_tree_links(share, wide_radius(share)), "a long, b long"))

    def all_left(left: DataFrame) -> DataFrame:
        """Links that connect what is connected in the shards. Pairs leave the shards of few sets only; shingles of more sets
        are a family if the least of these, in one order of all, is the same, as it mostly is if texts share many of them."""
        often = left.groupBy("token").agg(F.count("*").alias("c"), F.min_by("sid", F.xxhash64("sid")).alias("family"))
        often = small(materialize(often.where(F.col("c") > FEW).select("token", "family")))
        return linked(without_many_alone(near(left.join(often, "token", "left_anti"), None))).unionByName(within_families(left.join(often, "token")))

    def without_many_alone(pairs: DataFrame) -> DataFrame:
        words = [f"b{i}" for i in range(WORDS)]
        for x in ("a", "b"):
            pairs = pairs.join(known.select(F.col("sid").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", *words))), x)
        # in a cell that only one of two sets has there is a shingle that they don't share
        alone = lambda one, other: reduce(lambda a, b: a + b, (F.bit_count(F.col(f"{w}_{one}").bitwiseAND(F.bitwise_not(F.col(f"{w}_{other}")))) for w in words))
        both = F.least(F.col("n_a") - alone("a", "b"), F.col("n_b") - alone("b", "a")) * (share.numerator + share.denominator)
        return pairs.where(both >= F.lit(share.numerator) * (F.col("n_a") + F.col("n_b"))).select("a", "b")

    n_tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    found = stars = spark.createDataFrame([], "a long, b long")
    left = entries.join(known.select("sid", "fp"), "sid").withColumn("group", F.col("sid"))
    left = materialize(left)
    links = None
    for k in range(STARS + 1):
        cost = left.groupBy("token").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2), F.sum("count")).first()
        if not cost[1]:
            break
        last = k == STARS or cost[0] <= 2 * cost[1] or (links is not None and links < WORTHWHILE * cost[1])
        more = all_left(left) if last else linked(near(left, k))
        links = more.count()
        found = found.unionByName(more)
        stars = components(found)
        if last:
            break
        named = left.drop("group").join(stars.select(F.col("a").alias("sid"), F.col("b").alias("group")), "sid", "left").withColumn("group", F.coalesce("group", "sid"))
        open_ = named.groupBy("token").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x < y").select("token")
        left = materialize(named.join(open_, "token", "left_semi"))
    return marked.join(stars.select(F.col("a").alias("sid"), F.col("b").alias("group")), "sid", "left").select("key", "th", "rh", F.coalesce("group", "sid").alias("group"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """Of each group one row, all columns kept: that of the smallest doc_id (null first), then of the least row hash."""
    return take_one(docs, doc_id, text, lambda rows: groups(rows, width, similarity))
