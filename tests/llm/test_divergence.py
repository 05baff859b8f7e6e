"""The source divergence audit against a count of everything in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=200):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source, *_ in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, ts in own for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= 3)
        count = {s: Counter(t for _, s2, ts in own if s2 == s for t in ts) for s in {d[1] for d in own}}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        whole = share(Counter(t for _, _, ts in own for t in ts))
        p = {s: share(c) for s, c in count.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in p:
            pairs = [(r, sum(f(p[s][t], p[r][t]) for t in kept)) for r in p if r != s]
            told = [(t, f(p[s][t], whole[t])) for t in kept if count[s][t] and p[s][t] > whole[t]]
            for part, found in (("pair", pairs), ("term", told)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked, 1) if part == "pair" or k <= top}
    return out


def make_rows():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdÉéß漢", k=rng.randint(1, 4))) for _ in range(150)]
    rows = []
    for i in range(260):
        source = rng.choice(["hot"] * 4 + [f"s{k}" for k in range(9)] + [None])
        rows.append((i, rng.choice([" ", ",", "9", "\n"]).join(rng.choices(words, k=rng.randint(0, 60))).title(), rng.choice(["en", "en", "de", None]), source, "x", "y"))
    rows += [(900, None, "en", "silent", "", ""), (901, "12 34 !", "en", "numbers", "", ""), (902, "lonely words", "xx", "a", "", ""), (903, "", "xx", "b", "", ""), (904, None, "zz", None, "", "")]
    rows += [(905, "copied text copied", "en", "copies", "", "")] * 5 + [(906, "tie one tie two", "tt", s, "", "") for s in "abc"]
    return rows + [(907, "word " * 20_000, "en", "long", "", "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_rows(), "doc_id long, text string, lang string, source string, term string, n string").repartition(3)


def collected(df):
    return [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]


def test_audit_equals_the_count_of_everything(docs):
    got = collected(divergence.divergences(docs))
    assert len(got) == len(set(got)) and set(got) == brute(make_rows())


def test_crowded_sketch_and_many_blocks_change_nothing(docs, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 2)
    assert set(collected(divergence.divergences(docs, cells=512, top=3))) == brute(make_rows(), 3)


def test_empty_table(docs):
    assert collected(divergence.divergences(docs.limit(0))) == []


def test_sketch_never_underestimates():
    rng = np.random.default_rng(1)
    key, sketch = rng.integers(0, 2**63, 3000).astype(np.uint64), np.zeros(2 * 1024, np.uint8)
    seen = np.minimum(rng.integers(0, 9, 3000), 9)
    for n in (seen // 2, seen - seen // 2):
        for place in divergence.cells_of(key, 1024):
            divergence._add(sketch, place, n)
    for place in divergence.cells_of(key, 1024):
        assert (sketch[place] >= np.minimum(seen, divergence.LEAST)).all()


def test_sketch_discards_rare_terms(docs):
    rows = divergence.counted(docs.select("lang", "source", "text").na.fill(""), 1 << 16)
    per_term = rows.groupBy("lang", "term").sum("docs").collect()
    assert per_term and all(r[2] >= 3 for r in per_term)  # so few terms collide in no cell of so many
