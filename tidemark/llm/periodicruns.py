"""Periodic runs of words by a suffix tree of each text.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbour extends, of at least
``LENGTH`` words and ``TIMES`` periods. Runs are found as Stoye and Gusfield do: in the suffix tree two suffixes that
start d apart and part at an inner node of depth d are a branching tandem repeat, a square whose period breaks behind it.
At each inner node the leaves of its smaller half are asked for partners d before and d behind them in the other half,
O(n log n) questions in all. Every run holds one such repeat of its smallest period, at its end; rotating the repeat to the left,
word by word, gives the whole run, and repeats of multiples of the period end as the same stretch and are merged into it.

The tree is the interval tree of the common prefixes of neighbouring suffixes, made for all texts of a slice at once: ranks by
prefix doubling, whose levels then answer how far two places agree in either direction, and one pass with a stack for the
intervals. Nodes of more than two children are split in two step by step, so that each pair parts at one of them.

Only stretches that can hold a run enter the tree: in a run of four periods, and of six words if the period is one,
each three consecutive words occur three times. Words that no such triple covers are cut out, and again in what is left while
that removes much. So most texts never get that far; no run is lost.

Scale: one pass over the texts without a shuffle; memory is bounded by the slice or the longest text, a text of periodic
words alone taking about 100 bytes a word and doubling level.

Edge cases: a null or empty text has no words and no runs, and an empty collapsed text; repeated rows and ids are judged row by
row; a null id stays null; ties are as stated at :func:`op12_periodic_runs`; further columns aren't read; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkernel as tk
from tidemark.llm.workspace import bound_batches

LENGTH, TIMES = 6, 4
CHUNK = 1 << 19

RUN = "struct<start: bigint, length: bigint, period: bigint>"
#: of a slice's ids and word counts, which of its words stands at each place; None: each its own
Order = Callable[[list, np.ndarray], np.ndarray]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns changes."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _cut(words: np.ndarray, place: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries covered by triples that occur three times in their stretch, and the stretches that these form."""
    first = _starts(stretch)
    end = np.repeat(np.append(first[1:], len(place)), np.diff(np.append(first, len(place))))
    at = np.arange(len(place))
    at = at[at + 3 <= end]
    triple = tk.mix(tk.segment_hashes(words, at, at + 3, 0) + tk.mix(stretch[at].astype(np.uint64)))
    order = np.argsort(triple, kind="stable")
    head = _starts(triple[order])
    often = np.zeros(len(at), bool)
    size = np.diff(np.append(head, len(at)))
    often[order] = np.repeat(size >= 3, size)
    at = at[often]
    covered = np.zeros(len(place), bool)
    for k in range(3):
        covered[at + k] = True
    # triples that don't begin at neighbouring places are of different stretches, though they may share words
    keep = np.flatnonzero(covered)
    new = np.ones(len(keep), bool)
    new[1:] = (np.diff(keep) > 1) | (stretch[keep[1:]] != stretch[keep[:-1]])
    return keep, np.cumsum(new) - 1


def candidates(words: np.ndarray, owner: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places that runs can cover and the stretch that each belongs to. ``words``: their hashes; ``owner``: their texts."""
    place, stretch = np.arange(len(words)), owner
    while len(place):
        before = len(place)
        keep, stretch = _cut(words[place], place, stretch)
        place = place[keep]
        size = np.bincount(stretch) if len(stretch) else np.zeros(0, np.int64)
        wide = size[stretch] >= length
        place, stretch = place[wide], stretch[wide]
        if before - len(place) <= before // 8:
            break
    return place, stretch


class Suffixes:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, for stretches laid one behind the other."""

    def __init__(self, words: np.ndarray, stretch: np.ndarray) -> None:
        n = self.n = len(words)
        first = _starts(stretch)
        size = np.diff(np.append(first, n))
        self.begin, self.end = np.repeat(first, size), np.repeat(first + size, size)
        # equal words of different stretches are different symbols: no comparison leaves a stretch
        word = np.unique(words, return_inverse=True)[1]
        rank = np.unique(stretch * np.int64(n) + word, return_inverse=True)[1].astype(np.int32)
        self.levels, step, place = [], 1, np.arange(n)
        while rank.max() + 1 < n:
            self.levels.append(rank)
            inside = place + step < self.end
            behind = np.zeros(n, np.int64)
            behind[inside] = rank[place[inside] + step] + 1
            rank = np.unique(rank.astype(np.int64) * (n + 1) + behind, return_inverse=True)[1].astype(np.int32)
            step *= 2
        self.rank, self.order = rank, np.argsort(rank, kind="stable")

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from a and b on (a, b different, of one stretch)."""
        out = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.levels))):
            level, i, j = self.levels[k], a + out, b + out
            inside = np.flatnonzero(np.maximum(i, j) < self.n)
            out[inside[level[i[inside]] == level[j[inside]]]] += 1 << k
        return out

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree before a and before b (a < b, of one stretch)."""
        out = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.levels))):
            level, i, j = self.levels[k], a - out - (1 << k), b - out - (1 << k)
            inside = np.flatnonzero(i >= self.begin[a])
            out[inside[level[i[inside]] == level[j[inside]]]] += 1 << k
        return out


def inner_nodes(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each entry the last one before it that isn't greater, and the next one that is smaller: the halves that part there."""
    n = len(common)
    left, right = [0] * n, [n] * n
    stack: list[int] = []
    values = common.tolist()
    for p, depth in enumerate(values):
        while stack and values[stack[-1]] > depth:
            right[stack.pop()] = p
        left[p] = stack[-1] if stack else -1
        stack.append(p)
    return np.array(left, np.int64), np.array(right, np.int64)


def branching_repeats(s: Suffixes, chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and periods of squares whose period breaks behind them, in parts."""
    common = s.ahead(s.order[:-1], s.order[1:])
    left, right = inner_nodes(common)
    node = np.flatnonzero(common)
    low, mid, high = left[node] + 1, node + 1, right[node] + 1  # suffixes low..mid-1 and mid..high-1 part at this depth
    smaller_left = mid - low <= high - mid
    size = np.where(smaller_left, mid - low, high - mid)
    own = np.where(smaller_left, low, mid)
    other = np.where(smaller_left, mid, low)
    other_end = np.where(smaller_left, high, mid)
    total = np.cumsum(size)
    for part in np.split(np.arange(len(node)), np.searchsorted(total, np.arange(chunk, int(total[-1]) if len(total) else 0, chunk))):
        if not len(part):
            continue
        n = size[part]
        of = np.repeat(part, n)
        leaf = s.order[own[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)]
        depth = common[node[of]]
        for sign in (1, -1):
            partner = leaf + sign * depth
            there = np.flatnonzero((partner >= 0) & (partner < s.n))
            r = s.rank[partner[there]]
            hit = there[(r >= other[of[there]]) & (r < other_end[of[there]])]
            yield np.minimum(leaf[hit], partner[hit]), depth[hit]


def runs_of(words: np.ndarray, owner: np.ndarray, length: int = LENGTH, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run, by start and period; ``owner`` parts the texts, as places do the runs."""
    none = np.zeros(0, np.int64)
    place, stretch = candidates(words, owner, length)
    if not len(place):
        return none, none, none
    s = Suffixes(words[place], stretch)
    start, end, period = [], [], []
    for a, d in branching_repeats(s):
        whole = a - s.behind(a, a + d)  # rotated to the left as far as it goes
        long = a + 2 * d - whole >= np.maximum(length, times * d)
        start.append(whole[long])
        end.append((a + 2 * d)[long])
        period.append(d[long])
    start, end, period = (np.concatenate([none, *x]) for x in (start, end, period))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        one = _starts(start, end)  # the smallest period of a stretch comes first
        start, end, period = start[one], end[one], period[one]
    begin = place[start]
    order = np.lexsort((period, begin))
    return begin[order], (begin + end - start)[order], period[order]


def _found(doc_id: str, text: str, order: Order | None, length: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.gathered(batches, text):
            t = tk.read_texts(batch.column(text))
            word = np.arange(len(t.start)) if order is None else order(batch.column(doc_id).to_pylist(), t.n_words)
            start, end, period = runs_of(t.hashes()[word], t.doc, length, times)
            depth = np.zeros(len(word) + 1, np.int64)
            np.add.at(depth, start + period, 1)
            np.add.at(depth, end, -1)
            kept = np.cumsum(depth)[:-1] == 0
            texts = tk.joined_words(t.bytes, t.start[word][kept], t.end[word][kept], np.bincount(t.doc[kept], minlength=batch.num_rows))
            owner = t.doc[start] if len(start) else np.zeros(0, np.int64)
            fields = [pa.array(x, pa.int64()) for x in (start - t.first[owner], end - start, period)]
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            runs = pa.ListArray.from_arrays(pa.array(first), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column(doc_id), runs, pa.array(t.n_words, pa.int64()), pa.array([x.decode() for x in texts], pa.string())], ["doc_id", "runs", "n_words", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: Order | None = None, length: int = LENGTH, times: int = TIMES) -> DataFrame:
    """(doc_id, runs, n_words, collapsed) of each row: runs by start and period, and the words that no run repeats, joined by one space."""
    if length < LENGTH or times < TIMES:
        raise ValueError(f"runs have at least {LENGTH} words and {TIMES} periods: shorter ones need not repeat triples of words")
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return bound_batches(slim).mapInArrow(_found("doc_id", "text", order, length, times), f"doc_id long, runs array<{RUN}>, n_words long, collapsed string")


def periodic_tails(ids: list, n_words: np.ndarray) -> np.ndarray:
    """The query's planted tails: in a text whose id's checksum h is divisible by 10 the words from a = g % n on repeat with period
    1 + (n - a) // (3 + g % 8), g = h // 10. A null id has no checksum and no such tail."""
    first = np.cumsum(n_words) - n_words
    out = np.arange(int(n_words.sum()))
    for key, begin, n in zip(ids, first.tolist(), n_words.tolist()):
        h = None if key is None else zlib.crc32(str(key).encode())
        if h is None or h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        out[begin + a : begin + n] = begin + a + np.arange(n - a) % period
    return out


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """The greatest run (the smallest start, then period, of equal ones) and digests of all runs and of the collapsed text."""
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), order=periodic_tails)
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.back")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.short")).alias("period"),
        F.expr("1000 * top.length div -top.short").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
