"""Vectorised text primitives for Arrow batches: words, rolling hashes, hash exchange.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. All separators are ASCII, so the
work is done on UTF-8 bytes and offsets never split a character. Texts are handled in slices of
about ``SLICE_BYTES``; a single longer text forms a slice of its own, so memory is bounded by the
slice size or by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 512 << 10

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Odd multipliers of two independent polynomial hashes modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power_table(base: int, inverse: bool, n: int) -> np.ndarray:
    """base**i (or its inverse's powers) modulo 2**64 for i < n, by doubling; kept between calls."""
    table = _powers.get((base, inverse))
    if table is None or len(table) < n:
        b = pow(base, -1, 1 << 64) if inverse else base
        size = 1 << max(12, (n - 1).bit_length())
        table = np.ones(1, dtype=np.uint64)
        while len(table) < size:
            table = np.concatenate([table, table * np.uint64(pow(b, len(table), 1 << 64))])
        _powers[base, inverse] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64) that spreads entropy over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segment_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Mixed polynomial hashes of ``values[start:end]``, from one prefix sum."""
    base, n = _BASES[which], len(values)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power_table(base, False, n), out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * _power_table(base, True, n + 1)[start])


@dataclass
class Texts:
    """Words of some texts. Word i belongs to text doc[i] and is bytes[start[i]:end[i]]."""

    bytes: np.ndarray
    offsets: np.ndarray  # of the texts, one more than texts
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each text its first word's index, one more than texts

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def position(self) -> np.ndarray:
        """Of each word its index within its text."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], np.diff(self.first))

    def hashes(self, which: int = 0) -> np.ndarray:
        return segment_hashes(self.bytes, self.start, self.end, which)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column one after the other, and the offsets of its texts; a null text counts as an empty one."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def read_texts(column: pa.Array) -> Texts:
    """Split a string column into words; a null text counts as an empty one."""
    return split_words(*text_bytes(column))


def split_words(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR) -> Texts:
    """``separator``: a mask of 256 bytes, of which no part of a character outside ASCII may be one alone."""
    word = ~separator[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(raw), dtype=bool)
    before[1:] = word[:-1]
    after = np.zeros(len(raw), dtype=bool)
    after[:-1] = word[1:]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    return Texts(raw, offsets, start, end, np.searchsorted(start, offsets))


def trimmed(t: Texts, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word without the bytes ``outside`` (a mask of 256) at its ends, and which words have others.

    In one pass, however long a run of such bytes is; begins and ends are of the words that have others.
    """
    inner = np.flatnonzero(~outside[t.bytes])
    a, b = np.searchsorted(inner, t.start), np.searchsorted(inner, t.end)
    some = a < b
    return inner[a[some]], inner[b[some] - 1] + 1, some


def joined_words(raw: np.ndarray, start: np.ndarray, end: np.ndarray, count: np.ndarray) -> list[bytes]:
    """The words ``raw[start:end]`` joined by one space, as texts of ``count`` words each."""
    size = end - start + 1
    to = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(to[-1]) + np.repeat(start - to[:-1], size)
    out = np.append(raw, np.uint8(0x20))[source] if len(source) else np.zeros(0, np.uint8)
    out[to[1:] - 1] = 0x20
    last = np.concatenate([[0], np.cumsum(count)])
    begin, stop = to[last[:-1]], np.maximum(to[last[1:]] - 1, to[last[:-1]])
    data = out.tobytes()
    return [data[a:b] for a, b in zip(begin.tolist(), stop.tolist())]


def windows(t: Texts, width: int, which: tuple[int, ...] = (0,)) -> tuple[np.ndarray, list[np.ndarray]]:
    """Indices of the words that start a window of ``width`` words of one text, and the hashes."""
    position, room = t.position(), np.repeat(t.n_words, t.n_words)
    at = np.flatnonzero(position + width <= room)
    out = []
    for k in which:
        words = t.hashes(k)
        out.append(segment_hashes(words, at, at + width, k))
    return at, out


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def gathered(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 2 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Merge slices up to ``limit`` bytes, so that per-slice work is shared by more rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for piece in slices(batches, text):
        held.append(piece)
        size += piece.nbytes
        if size >= limit:
            yield _merged(held)
            held, size = [], 0
    if held:
        yield _merged(held)


def _merged(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def ragged(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and boundaries."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, type=kind))
