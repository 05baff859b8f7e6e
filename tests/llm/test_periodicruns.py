"""Periodic runs against a comparison of all places and periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import periodicruns as pr
from tidemark.llm import textkernel as tk

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    dropped = {i for a, length, q in runs for i in range(a + q, a + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda r: (r[0], r[2])))
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def make_rows():
    rng = random.Random(4)
    rows = []
    for i in range(400):
        w = []
        for _ in range(rng.randint(0, 6)):
            unit = rng.choices(["a", "b", "c", "é", "d,"], k=rng.randint(1, 7))
            w += rng.choice([rng.choices("abcdefgh", k=12), rng.choices("ab", k=25), (unit * 12)[: rng.randint(0, 50)]])
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(w), "x"))
    rows += [(None, "a " * 50, "x"), (700, None, "x"), (701, "", "x"), (702, " \n", "x"), (703, "one", "x")]
    long = " ".join(f"w{k % 3000}" for k in range(13_000))
    return rows + [(704, long, "x"), (704, long, "y"), (704, "z " * 5, "x"), (705, "z " * 6, "x")] + [(i, " ".join(f"u{k}" for k in range(40 + i)), "x") for i in range(800, 840)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("runs"))
    spark.createDataFrame(make_rows(), "doc_id long, text string, runs string").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_query_equals_brute_force(spark, folder):
    got = [tuple(r) for r in pr.op12_periodic_runs(spark, folder).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    want = [brute_row(r[0], r[1]) for r in make_rows()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] for r in want) > 300 and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in want)


def test_empty_table(spark):
    assert pr.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_shorter_runs_are_refused(spark):
    with pytest.raises(ValueError):
        pr.periodic_runs(spark.createDataFrame([], "doc_id long, text string"), times=2)


def test_branching_repeats_by_definition():
    rng = random.Random(2)
    for _ in range(150):
        w = rng.choices("ab" if rng.random() < 0.5 else "abc", k=rng.randint(1, 40))
        s = pr.Suffixes(tk.mix(np.array([ord(c) for c in w], np.uint64)), np.zeros(len(w), np.int64))
        got = sorted((int(a), int(d)) for x, y in pr.branching_repeats(s, 7) for a, d in zip(x, y))
        square = lambda a, d: a + 2 * d <= len(w) and w[a : a + d] == w[a + d : a + 2 * d]
        assert got == sorted((a, d) for a in range(len(w)) for d in range(1, len(w)) if square(a, d) and not (a + 2 * d < len(w) and w[a] == w[a + 2 * d]))


def test_long_texts_of_few_words():
    words = tk.mix(np.zeros(300_000, np.uint64))
    start, end, period = pr.runs_of(words, np.zeros(len(words), np.int64))
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [300_000], [1])
