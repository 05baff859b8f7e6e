"""Near copies of the pipeline are found by SimHash and BK-trees, and the exact check follows."""

import random
from fractions import Fraction

import corpus_pipeline
import numpy as np
import pyarrow as pa
from tidemark.llm import nearcopies
from tidemark.llm import textkernel as tk

from tests.llm.test_advice import brute_kept, edited_copies, frame, prose


def number(fp):
    return int.from_bytes(fp, "little")


def test_fingerprint_is_the_majority_of_the_shingles():
    texts = ["", "one", "a b c d e f g", "a b c d e f g h", "a b c d e a b c d e a b c d e", " ".join(prose(random.Random(3), 400))]
    h, first = nearcopies.shingle_sets(tk.read_texts(pa.array(texts)), 5)
    got = [number(x) for x in nearcopies.fingerprints(h, first)]
    for value, a, b in zip(got, first[:-1].tolist(), first[1:].tolist()):
        votes = [sum(int(x) >> i & 1 for x in h[a:b]) for i in range(64)]
        assert value % (1 << 64) == sum(1 << i for i, v in enumerate(votes) if 2 * v > b - a)
    assert got[0] == 0 and len({x >> 64 * i & (1 << 64) - 1 for i in range(nearcopies.FP_WORDS) for x in got[1:]}) == nearcopies.FP_WORDS * (len(got) - 1)


def test_wide_radius_holds_pairs_at_the_similarity():
    rng = np.random.default_rng(5)
    for similarity in ("0.8", "0.9"):
        share = Fraction(similarity)
        radius = nearcopies.wide_radius(share)
        for union in [5, 9, 10, 11, 20, 45, 100, 1000]:
            shared = int(nearcopies._least(share, np.int64(union)))
            for _ in range(40):
                pool = rng.integers(0, 1 << 63, union, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, union, dtype=np.uint64)
                cut = int(rng.integers(shared, union + 1))
                a, b = np.sort(pool[:cut]), np.sort(np.append(pool[:shared], pool[cut:]))
                x, y = (number(v) for v in nearcopies.fingerprints(np.append(a, b), np.array([0, len(a), len(a) + len(b)])))
                assert (x ^ y).bit_count() <= radius
        unlike = [number(v) for v in nearcopies.fingerprints(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2), np.arange(0, 20_001, 200))]
        assert radius < 64 * nearcopies.FP_WORDS // 2 and all((x ^ y).bit_count() > radius for i, x in enumerate(unlike) for y in unlike[:i])


def test_pairs_of_a_shard():
    """All pairs of a shard within the radius, of different groups and with room; across two parts of a shard only those between them."""
    rng = random.Random(8)
    rows = []
    for sid in range(120):
        base = number(nearcopies.fingerprints(np.array([sid // 12 + 1], np.uint64) << np.uint64(40), np.array([0, 1]))[0])
        fp = base ^ sum(1 << rng.randrange(256) for _ in range(rng.randint(0, 12)))
        n = rng.randint(40, 50)
        rows.append({"token": sid % 3, "sid": sid, "n": n, "pos": rng.randint(0, 6), "group": rng.choice([sid, sid // 24]), "fp": fp % (1 << 256)})

    def found(dealt, most=None):
        dealt = sorted(dealt, key=lambda r: (r["token"], r["x"], r["y"], r["side"], r["group"]))
        table = pa.Table.from_pylist([r | {"fp": r["fp"].to_bytes(32, "little")} for r in dealt])
        out = nearcopies._tree_pairs(Fraction(4, 5), 20, most)(iter(table.to_batches(max_chunksize=7)))
        return {(a, b) for batch in out for a, b in zip(*(c.to_pylist() for c in batch.columns))}

    near = lambda r, q: (r["fp"] ^ q["fp"]).bit_count() <= 20 and 9 * min(r["n"] - r["pos"], q["n"] - q["pos"]) >= 4 * (r["n"] + q["n"])
    want = {(r["sid"], q["sid"]) for r in rows for q in rows if r["sid"] > q["sid"] and r["token"] == q["token"] and r["group"] != q["group"] and near(r, q)}
    assert len(want) > 50 and found([r | {"x": 0, "y": 0, "side": nearcopies.BOTH} for r in rows]) == want
    parts = []
    for r in rows:
        own = r["sid"] // 3 % 3
        for other in range(3):
            x, y = min(own, other), max(own, other)
            parts.append(r | {"x": x, "y": y, "side": nearcopies.BOTH if x == y else nearcopies.PLANT if own == x else nearcopies.SEEK})
    assert found(parts) == want
    assert found([r | {"x": 0, "y": 0, "side": nearcopies.BOTH} for r in rows], 2) < want


def test_tree_finds_all_within_the_radius(monkeypatch):
    """Leaves of every size, split and whole, and radii from none to all."""
    rng = random.Random(6)
    base = rng.getrandbits(256)
    values = {rng.getrandbits(256) for _ in range(400)} | {base ^ sum(1 << i for i in rng.sample(range(256), rng.randint(0, 90))) for _ in range(300)}
    for leaf in (3, 64, 1024):
        monkeypatch.setattr(nearcopies, "LEAF", leaf)
        tree = nearcopies.FingerprintTree()
        for k, v in enumerate(sorted(values, key=lambda v: v % 1009)):
            if k in (0, 1, 5, 40):
                assert len(tree.near(base, 256)) == k
            tree.add(v)
        for radius in (-1, 0, 7, 60, 89, 256):
            for q in [base, *rng.sample(sorted(values), 10), rng.getrandbits(256)]:
                assert sorted(tree.near(q, radius)) == sorted(((q ^ v).bit_count(), v) for v in values if (q ^ v).bit_count() <= radius)


def test_size_classes_hold_every_compatible_size():
    for similarity in ("0.5", "0.8", "0.95", "1"):
        shards = nearcopies._Shards(Fraction(similarity), 0, None)
        share = Fraction(similarity)
        for n in [*range(1, 400), 4096, 15625, 65536, 78125, 10**6]:
            sizes = {int(nearcopies._least(share, np.int64(n))), n, int(n / share)} | (set(range(int(nearcopies._least(share, np.int64(n))), int(n / share) + 1)) if n < 400 else set())
            assert all(shards._class(m) in shards._classes(n) for m in sizes) and len(shards._classes(n)) <= 3


def test_slots_grow_with_the_corpus():
    assert [nearcopies.slot_bits(x) for x in (0, 10**9, 2 * 10**9, 5 * 10**9, 10**14)] == [20, 20, 20, 22, 22]


def test_any_number_of_slots_gives_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "slot_bits", lambda size: 5)
    rows = edited_copies()
    assert sorted(r.doc_id for r in nearcopies.keep_one(frame(spark, rows)).collect()) == brute_kept(rows, 5, 0.8)


def test_rows_come_through_the_trees(spark, monkeypatch):
    """A search of no radius finds no edited copy: nothing beside the trees does."""
    rows = edited_copies()
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(spark, rows), None).collect()) == brute_kept(rows, 5, 0.8)
    monkeypatch.setattr(nearcopies, "wide_radius", lambda similarity: -1)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(spark, rows), None).collect()) == brute_kept(rows, 5, 1)


def test_large_shards_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "STARS", 0)
    monkeypatch.setattr(nearcopies, "SHARD_LIMIT", 4)
    rows = edited_copies()
    assert sorted(r.doc_id for r in nearcopies.keep_one(frame(spark, rows)).collect()) == brute_kept(rows, 5, 0.8)


def test_links_of_a_shard_are_a_forest():
    """What pairs at the similarity connect is connected by fewer links than there are sets, each of them such a pair."""
    rng = random.Random(4)
    base = [rng.getrandbits(63) << 1 for _ in range(60)]
    sets = [sorted({x for x in base if rng.random() > 0.1} | {rng.getrandbits(63) << 1 for _ in range(2)}) for _ in range(150)]
    sets += [sorted({x for x in sets[i] if rng.random() > 0.01}) for i in range(60)]
    h, first = np.concatenate([np.array(x, np.uint64) for x in sets]), np.append(0, np.cumsum([len(x) for x in sets]))
    short = [(np.array(x, np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for x in sets]
    fps = nearcopies.fingerprints(h, first)
    rows = [{"family": 0, "sid": i, "n": len(x), "pos": 0, "group": 7 if i < 12 else i, "fp": fps[i], "shingles": short[i]} for i, x in enumerate(sets)]
    good = {(i, j) for i in range(len(sets)) for j in range(i) if 10 * len(set(sets[i]) & set(sets[j])) >= 8 * len(set(sets[i]) | set(sets[j]))}

    def labels(links):
        to = list(range(len(sets)))
        for a, b in [*links, *((i, 0) for i in range(12))]:
            to = [to[b] if x == to[a] else x for x in to]
        return [to.index(x) for x in to]

    def found(dealt):
        dealt = sorted(dealt, key=lambda r: (r["x"], r["y"], r["side"], r["group"]))
        out = nearcopies._tree_links(Fraction(4, 5), nearcopies.wide_radius(Fraction(4, 5)))(iter(pa.Table.from_pylist(dealt).to_batches(max_chunksize=7)))
        return [(a, b) for batch in out for a, b in zip(*(c.to_pylist() for c in batch.columns))]

    one = found([r | {"x": 0, "y": 0, "side": nearcopies.BOTH} for r in rows])
    assert len(good) > 3 * len(sets) and set(one) <= good and len(one) < len(sets) and len(set(labels(good))) > 3
    assert labels(one) == labels(good)
    parts = []
    for r in rows:
        own = r["sid"] % 3
        for other in range(3):
            x, y = min(own, other), max(own, other)
            parts.append(r | {"x": x, "y": y, "side": nearcopies.BOTH if x == y else nearcopies.PLANT if own == x else nearcopies.SEEK})
    assert set(found(parts)) <= good and labels(found(parts)) == labels(good)


def test_rows_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    """Copies of one text, most pairs of them a little below the similarity: stars connect few, and few pairs leave the shards."""
    rng = random.Random(9)
    base, rows = prose(rng, 90), []
    for i in range(160):
        w = list(base)
        for k in rng.sample(range(90), 2):
            w[k] = f"own{i}at{k}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, t + " more") for i, t in rows[:20]]
    left_shards = spark.sparkContext.accumulator(0)

    def counted(search):
        def made(*args):
            run = search(*args)

            def counting(batches):
                for batch in run(batches):
                    left_shards.add(batch.num_rows)
                    yield batch

            return counting

        return made

    for name in {"_tree_pairs", "_tree_links"} & set(dir(nearcopies)):
        monkeypatch.setattr(nearcopies, name, counted(getattr(nearcopies, name)))
    want = brute_kept(rows, 5, 0.8)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(spark, rows), None).collect()) == want
    assert 3 < len(want) <= 160 and 0 < left_shards.value < 5 * len(rows)
