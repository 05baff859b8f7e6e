"""Token counts by rank-synchronous merging of arrays.

A byte-level BPE vocabulary is read from its file; its library isn't called on texts. A slice of texts is cut
into pre-tokens by array operations on the kinds of its characters (letter, number, white space, other). The
distinct ones that were not met before are held as one ragged array of symbols, at first their bytes. In each
round every pre-token finds the lowest rank among its adjacent pairs and applies that merge wherever it occurs,
all pre-tokens at once; one without a mergeable pair leaves, and what it has left is its count. Rounds
are as many as the longest pre-token has merges. A pre-token of over ``LONG`` bytes goes through the same rounds
by an index from ranks to places, as scanning it anew in each round would be quadratic.

The kind of a character is asked once from the file's own pre-tokenizer, so that both follow the same version of
Unicode. The strings of added tokens are cut out first, as the library does by default, and count as one token.

Scale: one pass over the texts without a shuffle. Memory is bounded by the slice or the longest text, and by
``KNOWN`` remembered pre-tokens in each Python worker.

Edge cases: a null or empty text has 0 bytes and 0 tokens; repeated rows and ids are counted row by row; null ids
pass; further columns are not read; an empty table gives an empty result; a vocabulary of another kind is an error.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkernel as tk
from tidemark.llm.workspace import bound_batches

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
LONG = 512
KNOWN = 600_000

_NONE = np.int32(2**31 - 1)
SPACE, LETTER, NUMBER, OTHER, _UNKNOWN = range(5)
# Endings that a preceding apostrophe makes a pre-token of their own.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


class Vocabulary:
    """Merges of a byte-level BPE file: bytes to symbols, pairs to ranks, ranks to merged symbols."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, cut = made["model"], made["pre_tokenizer"]
        plain = cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and made["normalizer"] is None
        added = made["added_tokens"]
        if not plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.special = re.compile(b"|".join(re.escape(x["content"].encode()) for x in added)) if added else None
        ids = model["vocab"]
        # the alphabet: printable bytes stand for themselves, the others in order for the characters from 256
        shown = {ord(c) for c in ByteLevel.alphabet() if ord(c) < 256}
        hidden = [b for b in range(256) if b not in shown]
        self.of_byte = np.array([ids[chr(b) if b in shown else chr(256 + hidden.index(b))] for b in range(256)], np.int32)
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        left, right, self.merged = (np.array([ids[w(p)] for p in pairs], np.int64) for w in (lambda p: p[0], lambda p: p[1], lambda p: p[0] + p[1]))
        rank = np.arange(len(pairs))
        made_at = np.full(max(ids.values()) + 1, -1)
        made_at[self.merged[::-1]] = rank[::-1]
        if (np.maximum(made_at[left], made_at[right]) >= rank).any():
            raise ValueError(f"{path} has merges of symbols that only later merges make")
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank_of_key = key[order], rank[order].astype(np.int32)
        self.parts = list(zip(left.tolist(), right.tolist(), self.merged.tolist()))
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(self.parts)}
        self.kind = np.full(0x110000, _UNKNOWN, np.uint8)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` if it has none."""
        pair = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
        return np.where(self.key[at] == pair, self.rank_of_key[at], _NONE)

    def kinds(self, codes: np.ndarray) -> np.ndarray:
        out = self.kind[codes]
        unknown = out == _UNKNOWN
        if unknown.any():
            for code in np.unique(codes[unknown]).tolist():
                # a character is of the kind of that with which it stays together
                together = (k for k, beside in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.split(beside + chr(code))) == 1)
                self.kind[code] = next(together, SPACE)
            out = self.kind[codes]
        return out


def characters(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places at which characters of UTF-8 begin, and their code points."""
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    code = raw[at].astype(np.int32)
    wide = np.flatnonzero(code >= 0x80)
    if len(wide):
        begin, lead = at[wide], code[wide]
        size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        found = lead & (0x7F >> size)
        for k in (1, 2, 3):
            more = size > k
            found[more] = found[more] << 6 | (raw[begin[more] + k] & 0x3F)
        code[wide] = found
    return at, code


def pretokens(raw: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the pre-tokens of the texts ``raw[offsets[i]:offsets[i + 1]]``, in no order.

    A run of letters, numbers or others takes a blank before it; of white space before something else the last character stays
    for that, alone if it is no blank; an apostrophe takes an ending behind it.
    """
    at, code = characters(raw)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = vocabulary.kinds(code)
    border = np.zeros(len(at) + 1, bool)
    border[np.searchsorted(at, offsets)] = True
    head = border[:-1].copy()
    head[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(head)
    end = np.append(start[1:], len(at))
    kinds, last = kind[start], border[end]
    blank_before = np.zeros(len(start), bool)
    blank_before[1:] = (code[start[1:] - 1] == 0x20) & ~border[start[1:]]

    space = kinds == SPACE
    whole, open_end = space & last, space & ~last
    several = open_end & (end - start > 1)
    alone = open_end & (code[end - 1] != 0x20)
    begins, ends = [start[whole], start[several], end[alone] - 1], [end[whole], end[several] - 1, end[alone]]

    first, stop = start - blank_before, end.copy()
    quote = np.flatnonzero((kinds == OTHER) & (end - start == 1) & (code[start] == 0x27) & ~blank_before & ~last)
    quote = quote[kinds[quote + 1] == LETTER]
    behind = start[quote + 1]
    one = code[behind]
    two = np.where(end[quote + 1] - behind > 1, code[np.minimum(behind + 1, len(code) - 1)], 0)
    taken = np.zeros(len(quote), np.int64)
    for x in ENDINGS:
        same = one == ord(x[0])
        taken[same & (two == ord(x[1])) if len(x) == 2 else same] = len(x)
    stop[quote] += taken
    first[quote + 1] += taken
    full = ~space & (first < stop)
    at = np.append(at, len(raw))
    return at[np.concatenate([*begins, first[full]])], at[np.concatenate([*ends, stop[full]])]


def _long_count(symbols: np.ndarray, vocabulary: Vocabulary) -> int:
    """The rounds of one long pre-token: the lowest rank at hand is applied at all of its places."""
    ids, n = symbols.tolist(), len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[int, list[int]] = {}
    for i, r in enumerate(vocabulary.ranks(symbols[:-1], symbols[1:]).tolist()):
        if r != _NONE:
            places.setdefault(r, []).append(i)
    open_ranks = list(places)
    heapq.heapify(open_ranks)
    left = n
    while open_ranks:
        r = heapq.heappop(open_ranks)
        a, b, new = vocabulary.parts[r]
        for i in sorted(places.pop(r)):
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # merged since
            ids[i], ids[j] = new, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                found = vocabulary.rank.get((ids[x], ids[y])) if x >= 0 and y < n else None
                if found is None:
                    continue
                if found not in places:
                    places[found] = []
                    heapq.heappush(open_ranks, found)
                places[found].append(x)
    return left


def merged_counts(symbols: np.ndarray, first: np.ndarray, vocabulary: Vocabulary, long: int = LONG) -> np.ndarray:
    """How many symbols are left of each sequence ``symbols[first[i]:first[i + 1]]``; none may be empty."""
    out = np.diff(first)
    for i in np.flatnonzero(out > long).tolist():
        out[i] = _long_count(symbols[first[i] : first[i + 1]], vocabulary)
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    short = np.repeat(size <= long, size)
    symbols, owner = symbols[short], owner[short]
    while len(symbols):
        head = np.flatnonzero(np.diff(owner, prepend=-1))
        rank = np.full(len(symbols), _NONE, np.int32)
        rank[:-1] = np.where(owner[1:] == owner[:-1], vocabulary.ranks(symbols[:-1], symbols[1:]), _NONE)
        least, size = np.minimum.reduceat(rank, head), np.diff(np.append(head, len(symbols)))
        going = least != _NONE
        out[owner[head[~going]]] = size[~going]
        stays = np.repeat(going, size)
        symbols, owner, rank = symbols[stays], owner[stays], rank[stays]
        at = np.flatnonzero(rank == np.repeat(least[going], size[going]))
        # of places that overlap (a pair of one symbol in a row of it) every other one
        fresh = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        at = at[(at - np.repeat(at[fresh], np.diff(np.append(fresh, len(at))))) % 2 == 0]
        symbols[at] = vocabulary.merged[rank[at]]
        kept = np.ones(len(symbols), bool)
        kept[at + 1] = False
        symbols, owner = symbols[kept], owner[kept]
    return out


class Counter:
    """Token counts of texts; the counts of pre-tokens are kept, all are forgotten beyond ``known`` of them."""

    def __init__(self, path: str, known: int = KNOWN) -> None:
        self.vocabulary, self.limit = Vocabulary(path), known
        self.clear()

    def clear(self) -> None:
        self.known, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _special(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Begin and end of each added token's string, those inside one text."""
        data = raw.tobytes()
        if self.vocabulary.special is None or not self.vocabulary.special.search(data):
            return np.zeros((0, 2), np.int64)
        spans = [(a + m.start(), a + m.end()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) for m in self.vocabulary.special.finditer(data[a:b])]
        return np.array(spans, np.int64).reshape(-1, 2)

    def of(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        special = self._special(raw, offsets)
        begin, end = pretokens(raw, np.unique(np.concatenate([offsets, special.ravel()])), self.vocabulary)
        if len(special):
            inside = np.searchsorted(special[:, 0], begin, side="right") - 1
            ordinary = (inside < 0) | (begin >= special[np.maximum(inside, 0), 1])
            begin, end = begin[ordinary], end[ordinary]
        words, where, inverse = np.unique(tk.segment_hashes(raw, begin, end, 0), return_index=True, return_inverse=True)
        if len(self.known) > self.limit:
            self.clear()
        slot = np.searchsorted(self.known, words)
        new = np.ones(len(words), bool)
        met = slot < len(self.known)
        new[met] = self.known[slot[met]] != words[met]
        if new.any():
            a, size = begin[where[new]], (end - begin)[where[new]]
            first = np.concatenate([[0], np.cumsum(size)])
            letters = raw[np.arange(first[-1]) + np.repeat(a - first[:-1], size)]
            found = merged_counts(self.vocabulary.of_byte[letters], first, self.vocabulary)
            self.known, self.count = np.insert(self.known, slot[new], words[new]), np.insert(self.count, slot[new], found)
            slot = np.searchsorted(self.known, words)
        texts = len(offsets) - 1
        total = np.zeros(texts + 1, np.int64)
        for at, n in ((begin, self.count[slot][inverse]), (special[:, 0], 1)):
            np.add.at(total, np.searchsorted(offsets, at, side="right") - 1, n)
        return total[:texts]


@cache
def _counter(path: str) -> Counter:
    """One for each worker process, kept between its tasks."""
    return Counter(path)


def _counted(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.gathered(batches):
            raw, offsets = tk.text_bytes(batch.column("text"))
            n = _counter(path).of(raw, offsets)
            columns = [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return bound_batches(slim).mapInArrow(_counted(path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(VOCABULARY))
