"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids plus a closing id 0; longer ones are cut into full pieces of ``CAPACITY``
and a rest. Pieces are dealt at random into blocks of about ``BLOCK`` pieces. Each block is evolved by
``ISLANDS`` islands, each a task with a population of packings of its own: at first a greedy one, which fills
bins whole by up to three pieces, best fit decreasing, and best fits in orders near to that. Crossover injects
well-filled bins of one parent into the other, keeps that one's bins but those that would hold a piece twice and a few of the
worst filled, and best-fits the displaced pieces, largest first, after a local step that exchanges them with one or
two smaller pieces of a bin which they fill whole. After each epoch every island's elite migrates to the next island
of the block; in the end the best packing of each block wins. A block is done at the lower bound,
ceil(tokens / capacity), which of many short pieces the first parent often has; where it hasn't, crossovers find
packings with fewer bins.

Ids are those of the plain call ``encode(text, add_special_tokens=False)``: where a text holds the string of
one of the tokenizer's special tokens, that token's id.

Scale: texts are tokenised once, on the executors, each distinct word once per slice of text; what is
shuffled later is a few numbers per piece. A block is bounded, so memory is too, and more input means
more blocks. Blocks cost at most one badly filled bin each, about 1 in ``BLOCK``.

Edge cases: a null or empty text is the single id 0; repeated rows and repeated doc_ids are packed
row by row; ties are broken by length and order; an empty table gives an empty result; extra columns
are not carried (the result has a row per piece, not per document).
"""

from __future__ import annotations

import os
import random
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkernel as tk
from tidemark.llm.workspace import bound_batches, materialize

CAPACITY = 2048
BLOCK = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
GENERATIONS = 60
#: pieces of a bin of which two may be exchanged
EXCHANGED = 24
VOCABULARY = "word_bpe_49k.json"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_POINT = np.isin(np.arange(256), list(b".,;:!?"))
_ALNUM = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])

_ITEMS = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"


def _without_points(t: tk.Texts) -> tk.Texts:
    """A point behind an ASCII letter or digit at a word's end becomes a word: the pre-tokenizer parts them too."""
    last = t.end - 1
    cut = (last > t.start) & _POINT[t.bytes[last]] & _ALNUM[t.bytes[np.maximum(last - 1, 0)]]
    at = np.flatnonzero(cut)
    end = np.where(cut, last, t.end)
    return tk.Texts(
        t.bytes, t.offsets, np.insert(t.start, at + 1, last[at]), np.insert(end, at + 1, t.end[at]), t.first + np.concatenate([[0], np.cumsum(cut)])[t.first]
    )


class WordIds:
    """Token ids of words, each distinct word encoded once; forgets all beyond ``limit`` words."""

    def __init__(self, path: str, limit: int = 600_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _store(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        length = np.array([len(x) for x in found], np.int64)
        at = self.used + np.cumsum(length) - length
        end = self.used + int(length.sum())
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(2 * end - self.used, np.uint32)])
        self.ids[self.used : end] = np.fromiter(chain.from_iterable(found), np.uint32, end - self.used)
        self.used = end
        return at, length

    def of(self, t: tk.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the number of ids of each text.

        The plain call reads the string of a special token as that token, also inside of words: such texts are encoded whole.
        """
        ids, count = self._of_words(t)
        data = t.bytes.tobytes()
        if not any(x in data for x in self.special):
            return ids, count
        parts = np.split(ids, np.cumsum(count)[:-1])
        for k, (a, b) in enumerate(zip(t.offsets[:-1].tolist(), t.offsets[1:].tolist())):
            if any(x in data[a:b] for x in self.special):
                parts[k] = np.array(self.tokenizer.encode(data[a:b].decode(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def _of_words(self, t: tk.Texts) -> tuple[np.ndarray, np.ndarray]:
        # the vocabulary knows lower case only, so words that differ in A-Z against a-z have the same ids
        t = _without_points(t)
        hashes = tk.segment_hashes(_LOWER[t.bytes], t.start, t.end, 0)
        words, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.limit:
            self.clear()
        slot = np.searchsorted(self.known, words)
        new = np.ones(len(words), bool)
        inside = slot < len(self.known)
        new[inside] = self.known[slot[inside]] != words[inside]
        if new.any():
            data = t.bytes.tobytes()
            texts = [data[a:b].decode() for a, b in zip(t.start[first[new]].tolist(), t.end[first[new]].tolist())]
            found = [e.ids for a in range(0, len(texts), 4096) for e in self.encode(texts[a : a + 4096], add_special_tokens=False)]
            at, length = self._store(found)
            self.at = np.insert(self.at, slot[new], at)
            self.length = np.insert(self.length, slot[new], length)
            self.known = np.insert(self.known, slot[new], words[new])
            slot = np.searchsorted(self.known, words)
        length = self.length[slot]
        at, length = self.at[slot][inverse], length[inverse]
        source = np.arange(int(length.sum())) + np.repeat(at - (np.cumsum(length) - length), length)
        return self.ids[source], np.diff(np.concatenate([[0], np.cumsum(length)])[t.first])


@cache
def _word_ids(path: str) -> WordIds:
    """One for each worker process, kept between its tasks."""
    return WordIds(path)


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _word_ids(path)
        rows = 0
        for batch in tk.gathered(batches):
            t = tk.read_texts(batch.column("text"))
            ids, length = known.of(t)
            cuts = np.concatenate([[0], np.cumsum(length)])  # ids before each text
            texts = len(cuts) - 1
            out = np.zeros(len(ids) + texts, "<u4")
            out[np.arange(len(ids)) + np.repeat(np.arange(texts), np.diff(cuts))] = ids
            begin = cuts[:-1] + np.arange(texts)
            size = np.diff(cuts) + 1
            n = -(-size // capacity)
            doc = np.repeat(np.arange(texts), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            long = np.minimum(size[doc] - start, capacity)
            view = memoryview(out.tobytes())
            at = (begin[doc] + start) * 4
            crc = [zlib.crc32(view[a:b]) for a, b in zip(at.tolist(), (at + long * 4).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(long, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(np.arange(rows, rows + len(doc)), pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "salt"],
            )
            rows += len(doc)

    return run


class Bins:
    """Open bins by free space; the fullest bin that takes a piece is found in a bit set."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.bits = capacity, 0
        self.free: dict[int, list[int]] = {}
        self.content: list[list[int]] = []
        self.used: list[int] = []

    def open(self, pieces: list[int], used: int) -> None:
        self.content.append(pieces)
        self.used.append(used)
        self._file(len(self.content) - 1)

    def _file(self, b: int) -> None:
        free = self.capacity - self.used[b]
        self.free.setdefault(free, []).append(b)
        self.bits |= 1 << free

    def best_fit(self, piece: int, size: int) -> None:
        fitting = self.bits >> size
        if not fitting:
            self.open([piece], size)
            return
        free = size + (fitting & -fitting).bit_length() - 1
        b = self.free[free].pop()
        if not self.free[free]:
            del self.free[free]
            self.bits ^= 1 << free
        self.content[b].append(piece)
        self.used[b] += size
        self._file(b)


def best_fit(sizes: list[int], capacity: int, order: list[int], kept: list[list[int]] = ()) -> list[list[int]]:
    bins = Bins(capacity)
    for pieces in kept:
        bins.open(list(pieces), sum(sizes[p] for p in pieces))
    for p in order:
        bins.best_fit(p, sizes[p])
    return bins.content


class Loose:
    """Displaced pieces by size; sizes at hand are bits of one number, and of its mirror image."""

    def __init__(self, sizes: list[int], capacity: int, pieces: list[int]) -> None:
        self.capacity = capacity
        self.by_size: dict[int, list[int]] = {}
        for p in pieces:
            self.by_size.setdefault(sizes[p], []).append(p)
        self.bits = sum(1 << x for x in self.by_size)
        self.mirror = sum(1 << (capacity - x) for x in self.by_size)

    def take(self, size: int) -> int:
        own = self.by_size[size]
        piece = own.pop()
        if not own:
            del self.by_size[size]
            self.bits ^= 1 << size
            self.mirror ^= 1 << (self.capacity - size)
        return piece

    def put(self, piece: int, size: int) -> None:
        if size not in self.by_size:
            self.by_size[size] = []
            self.bits |= 1 << size
            self.mirror |= 1 << (self.capacity - size)
        self.by_size[size].append(piece)

    def filling(self, free: int) -> list[int]:
        """One or two pieces of together ``free``, taken out; none if there are no such."""
        if self.bits >> free & 1:
            return [self.take(free)]
        half = free // 2
        pairs = self.bits & (self.mirror >> (self.capacity - free)) & ((2 << half) - 2)  # sizes x up to half with free - x at hand
        if 2 * half == free and len(self.by_size.get(half, ())) < 2:
            pairs &= ~(1 << half)
        if not pairs:
            return []
        x = pairs.bit_length() - 1
        return [self.take(free - x), self.take(x)]


def filled_whole(sizes: list[int], capacity: int, pieces: list[int], bins: list[list[int]]) -> tuple[list[list[int]], list[list[int]]]:
    """The local step of a crossover: bins, then each largest piece left, are filled whole where one or two pieces do it."""
    loose, done, rest = Loose(sizes, capacity, pieces), [], []

    def close(content: list[int], free: int) -> None:
        found = loose.filling(free) if free else []
        (done if found or not free else rest).append(content + found)

    for x in bins:
        close(list(x), capacity - sum(sizes[p] for p in x))
    while loose.bits:
        largest = loose.bits.bit_length() - 1
        close([loose.take(largest)], capacity - largest)
    return done, rest


def quality(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the more uneven fill (some full, some nearly empty)."""
    return len(bins), -sum((sum(sizes[p] for p in b) / capacity) ** 2 for b in bins)


def greedy(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins filled whole by one to three pieces, the rest best fit, largest first."""
    done, rest = filled_whole(sizes, capacity, list(range(len(sizes))), [])
    return best_fit(sizes, capacity, _largest_first(sizes, (p for x in rest for p in x)), done)


def _largest_first(sizes: list[int], pieces) -> list[int]:
    return sorted(pieces, key=lambda p: (-sizes[p], p))


def exchanged(sizes: list[int], capacity: int, bins: list[list[int]], displaced: list[int]) -> tuple[list[list[int]], list[int]]:
    """Displaced pieces take the place of one or two smaller ones of a bin where that fills it whole; what is displaced then."""
    loose, out = Loose(sizes, capacity, displaced), []
    for x in bins:
        free = capacity - sum(sizes[p] for p in x)
        if not free:
            out.append(x)
            continue
        done = None
        for going in ((), *combinations(x, 1), *(combinations(x, 2) if len(x) <= EXCHANGED else ())):
            leaves = sum(sizes[p] for p in going)
            found = loose.filling(free + leaves) if loose.bits else []
            if found:
                for p in going:
                    loose.put(p, sizes[p])
                done = [p for p in x if p not in going] + found
                break
        out.append(done or x)
    return out, [p for own in loose.by_size.values() for p in own]


def crossover(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Inject well-filled bins of ``b`` into ``a``, drop the bins that would hold a piece twice, and best-fit the displaced pieces.

    All other bins of ``a`` stay, but for a few of the worst filled: their pieces are displaced too, else nothing would be at hand for the
    gaps. Before they are best-fitted, largest first, displaced pieces are exchanged with smaller ones of bins that they fill.
    """
    fill = sorted(((sum(sizes[p] for p in x), i) for i, x in enumerate(b)), reverse=True)
    well = [i for _, i in fill[: max(1, len(fill) // 2)]]
    injected = [b[i] for i in rng.sample(well, max(1, len(well) // rng.choice((2, 4, 8))))]
    inside = {p for x in injected for p in x}
    kept = [x for x in a if inside.isdisjoint(x)]
    displaced = [p for x in a if not inside.isdisjoint(x) for p in x if p not in inside]
    kept.sort(key=lambda x: sum(sizes[p] for p in x))
    worst = sum(sum(sizes[p] for p in x) < capacity for x in kept)
    opened = min(worst, rng.randint(1, 2 + len(kept) // 20))
    displaced += [p for x in kept[:opened] for p in x]
    bins = injected + kept[opened:]
    rng.shuffle(bins)
    bins, displaced = exchanged(sizes, capacity, bins, displaced)
    return best_fit(sizes, capacity, _largest_first(sizes, displaced), bins)


def evolve(sizes: list[int], capacity: int, seed: int, elites: list[list[list[int]]], generations: int = GENERATIONS, population: int = POPULATION) -> tuple[list[list[int]], int]:
    """The best packing and the number of crossovers that were made.

    The first parents are the greedy packing and best fit decreasing, the others best fits in orders near to that.
    It ends at the lower bound of the number of bins, which the first parents may have, or after ``generations``.
    """
    rng = random.Random(seed)
    bound = lower_bound(sizes, capacity)
    pool = [*elites] or [greedy(sizes, capacity)]
    if len(pool[0]) > bound:
        pool.append(best_fit(sizes, capacity, _largest_first(sizes, range(len(sizes)))))
        while len(pool) < population:
            pool.append(best_fit(sizes, capacity, sorted(range(len(sizes)), key=lambda p: -sizes[p] * rng.uniform(0.8, 1.2))))
    scored = sorted(((quality(x, sizes, capacity), k, x) for k, x in enumerate(pool)), key=lambda s: s[:2])
    crossed = 0
    while scored[0][0][0] > bound and crossed < generations:
        one, two = rng.sample(range(len(scored)), 2)
        one = rng.choice((0, one)) if two else one  # the best one is a parent half of the time
        child = crossover(scored[one][2], scored[two][2], sizes, capacity, rng)
        crossed += 1
        score = quality(child, sizes, capacity)
        if score < scored[-1][0] and score not in [x[0] for x in scored]:
            scored[-1] = (score, len(pool) + crossed, child)
            scored.sort(key=lambda s: s[:2])
    return scored[0][2], crossed


def lower_bound(sizes: list[int], capacity: int) -> int:
    return -(-sum(sizes) // capacity)


def _encode(bins: list[list[int]], n: int) -> bytes:
    of = np.zeros(n, np.int32)
    for k, x in enumerate(bins):
        of[x] = k
    return of.tobytes()


def _decode(data: bytes) -> list[list[int]]:
    of = np.frombuffer(data, np.int32)
    order = np.argsort(of, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)]


def _in_order(block: pd.DataFrame) -> pd.DataFrame:
    return block.sort_values("place", kind="stable")


def _island(capacity: int, epoch: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block, island = int(pdf["block"].iloc[0]), int(pdf["island"].iloc[0])
        elites = [_decode(x) for x in pdf["elite"] if x is not None]
        sizes = _in_order(pdf[pdf["length"].notna()])["length"].astype(int).tolist()
        best, crossed = evolve(sizes, capacity, hash((block, island, epoch)), elites)
        spare = len(best) - lower_bound(sizes, capacity)
        return pd.DataFrame({"block": [block], "island": [island], "bins": [len(best)], "spare": [spare], "crossovers": [crossed], "elite": [_encode(best, len(sizes))]})

    return run


def _placed(items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
    items = _in_order(items).reset_index(drop=True)
    of = np.frombuffer(best["elite"].iloc[0], np.int32).astype(np.int64)
    order = np.argsort(of, kind="stable")
    size = items["length"].to_numpy()[order]
    before = np.cumsum(size) - size
    head = np.flatnonzero(np.diff(of[order], prepend=-1))
    offset = np.empty(len(of), np.int64)
    offset[order] = before - np.repeat(before[head], np.diff(np.append(head, len(of))))
    items["sequence_id"] = items["block"].astype("int64") * (1 << 24) + of
    items["offset"] = offset
    return items[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]


def tokenized_pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return bound_batches(slim).mapInArrow(_pieces(path, capacity), _ITEMS)


def _dealt(items: DataFrame, block: int) -> DataFrame:
    items = materialize(items)
    blocks = max(1, -(-items.count() // block))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("salt", "ids_crc32", "doc_id", "piece"), F.lit(blocks)))
    # a piece's place in its block: equal places only for equal pieces, which are interchangeable
    return materialize(dealt.withColumn("place", F.xxhash64("doc_id", "piece", "ids_crc32", "salt")))


def evolved(dealt: DataFrame, capacity: int = CAPACITY, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """(block, island, bins, spare, crossovers, elite) of the last epoch; ``crossovers`` are those of all epochs."""
    slim = dealt.select("block", "place", "length", F.lit(None).cast("binary").alias("elite"))
    spread = slim.withColumn("island", F.explode(F.array(*(F.lit(i) for i in range(islands)))))
    found = before = None
    for epoch in range(epochs):
        rows = spread
        if found is not None:
            moved = found.withColumn("island", ((F.col("island") + 1) % islands).cast("int"))
            elites = found.unionByName(moved).select("block", "island", "elite").distinct()
            rows = spread.unionByName(elites, allowMissingColumns=True)
        now = rows.groupBy("block", "island").applyInPandas(_island(capacity, epoch), "block long, island int, bins int, spare int, crossovers int, elite binary")
        if before is not None:
            now = now.join(before, ["block", "island"]).withColumn("crossovers", F.col("crossovers") + F.col("earlier")).drop("earlier")
        found = materialize(now)
        before = found.select("block", "island", F.col("crossovers").alias("earlier"))
        open_blocks = found.groupBy("block").agg(F.min("spare").alias("spare")).where("spare > 0")
        if epoch + 1 < epochs and open_blocks.isEmpty():
            break  # every block is at its lower bound
    return found


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32, salt) into sequences."""
    dealt = _dealt(items, block)
    best = evolved(dealt, capacity, islands, epochs).groupBy("block").agg(F.min_by("elite", F.struct("bins", "island")).alias("elite"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(_placed, schema)


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(tokenized_pieces(docs, tokenizer_path()))
