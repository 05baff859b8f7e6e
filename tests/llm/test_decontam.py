"""Decontamination against an alignment of every item with every place of every document, without seeds."""

import itertools
import random

import pytest
from tidemark.llm import decontam

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def best_stretch(same):
    """(matches, share) of the stretch with the most of matches - 4 * others; of equal ones the later and longer."""
    best, found = 0, (0, 0.0)
    for b in range(len(same)):
        score = hit = 0
        for e in range(b, len(same)):
            score += 1 if same[e] else -4
            hit += same[e]
            if score < 0:
                break
            if score > best or (score == best > 0 and hit / (e - b + 1) <= found[1]):
                best, found = score, (hit, hit / (e - b + 1))
    return found


def aligned(doc, item):
    need = min(10, len(item))
    found = []
    for begin in range(-len(item) + 1, len(doc)):
        same = [0 <= begin + i < len(doc) and doc[begin + i] == w for i, w in enumerate(item)]
        if sum(same) >= need:
            m, share = best_stretch(same)
            if m >= need and share >= 0.8:
                found.append(m)
    return max(found, default=0)


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=4)) for _ in range(n)]


def test_random_substitutions(spark):
    """Every stretch that the law allows is found: 11 to 59 tokens, up to every fifth substituted anywhere."""
    rng = random.Random(21)
    items, docs = [], []
    for i, n in enumerate([11, 12, 12, 13, 14, 15, 15, 16, 18, 20, 24, 25, 30, 40, 59]):
        item = words(rng, n)
        items.append((i, item))
        for _ in range(40):
            copy = list(item)
            for p in rng.sample(range(n), rng.randint(0, n // 5 + 1)):
                copy[p] = "x" + copy[p]
            docs.append((len(docs), words(rng, rng.randint(0, 20)) + copy + words(rng, rng.randint(0, 20))))
    want = {(d, i): m for d, doc in docs for i, item in items if set(doc) & set(item) and (m := aligned(doc, item))}
    got = decontam.contaminated(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], DOCS), spark.createDataFrame([(i, " ".join(w)) for i, w in items], ITEMS))
    assert {(r.doc_id, r.item_id): r.matches for r in got.collect()} == want and len(want) > 350


@pytest.mark.parametrize("length, substituted", [(10, 0), (11, 1), (12, 2), (13, 2), (14, 2), (15, 3), (16, 3), (17, 3)])
def test_masks_meet_every_pattern(length, substituted):
    for gone in itertools.combinations(range(length), substituted):
        assert any(all(a + p not in gone for p in places) for places in decontam.PLACES for a in range(length - places[-1]))


def test_short_items_and_shared_ids(spark):
    rng = random.Random(22)
    short, clean, item = words(rng, 7), words(rng, 30), words(rng, 20)
    docs = spark.createDataFrame([(1, " ".join(words(rng, 9) + short)), (2, " ".join(short[:6])), (None, " ".join(item)), (None, " ".join(clean)), (5, " ".join(clean)), (5, " ".join(item + clean)), (6, None)], DOCS)
    items = spark.createDataFrame([(1, " ".join(short)), (2, " ".join(item)), (2, " ".join(reversed(item))), (3, "five words are too few"), (4, None)], ITEMS)
    got = {(r.doc_id, r.item_id): (r.matches, r.share) for r in decontam.contaminated(docs, items).collect()}
    assert got == {(1, 1): (7, 1.0), (None, 2): (20, 1.0), (5, 2): (20, 1.0)}
    left = sorted((r.doc_id or 0, r.text) for r in decontam.drop_contaminated(docs, items).collect() if r.text)
    assert left == sorted([(2, " ".join(short[:6])), (0, " ".join(clean)), (5, " ".join(clean))])


def test_blocks_and_long_items(spark, monkeypatch):
    """A benchmark beyond the broadcast size goes in parts; an item of thousands of words is compared a few times only."""
    rng = random.Random(23)
    long = words(rng, 4000)
    items = [(i, words(rng, 15)) for i in range(30)] + [(99, long)]
    docs = spark.createDataFrame([(i, " ".join(words(rng, 5) + w)) for i, w in items], DOCS)
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], ITEMS)
    whole = {(r.doc_id, r.item_id, r.matches) for r in decontam.contaminated(docs, benchmark).collect()}
    assert whole == {(i, i, len(w)) for i, w in items}
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 200_000)
    assert decontam._blocks(decontam.benchmark_items(benchmark)) > 3
    assert {(r.doc_id, r.item_id, r.matches) for r in decontam.contaminated(docs, benchmark).collect()} == whole
    slim = docs.selectExpr("doc_id", "xxhash64(text) th", "text")
    assert decontam.places(slim, decontam.benchmark_items(benchmark)).where("doc_id = 99").count() == 1
    monkeypatch.setattr(decontam, "BROADCAST_PLACES", 0)
    assert {(r.doc_id, r.item_id, r.matches) for r in decontam.contaminated(docs, benchmark).collect()} == whole


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "some text", 1, 2, 3)], "doc_id long, text string, __bad long, __th long, tokens long")
    out = decontam.drop_contaminated(docs, spark.createDataFrame([(1, "a b c d e f g h")], ITEMS))
    assert out.columns == docs.columns and out.count() == 1
