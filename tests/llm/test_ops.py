"""Operators against brute force on small fixtures: copies, near copies, passages, nulls, empty and long texts, ties."""

import hashlib
import json
import random
import re
import time
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, extraction, licenses, packing, quality, sharding, simhash, substring, toxicity
from tidemark.llm import textkernel as tk

from tests.llm.test_advice import brute_kept

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) + rng.choice(["", "", ",", "."]) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, other = prose(60), prose(25)
    texts = [prose(rng.randint(1, 120)) for _ in range(60)]
    texts += [f"{prose(20)} {passage} {prose(20)}" for _ in range(12)] + [f"{prose(9)}\n{other}\t{other}  {prose(9)}" for _ in range(6)]
    base = prose(400)
    near = base.split(" ")
    for i in range(5):
        near[7 * i] = vocabulary[i]
        texts.append(" ".join(near))
    texts += [base] * 5 + [None, "", " \t\n", "one", "two words", "Ünï code ©", "a " * 300, prose(5000), "same line\nsame line\n\n \nsame line\nother"]
    texts += ["x" * 30_000, "<|endoftext|> literal", "glued<|startoftext|>Word <|ENDOFTEXT|> and<|endoftext|>", "don't CAN'T 12,345.67!? (end)."]
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


ROWS = make_docs()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows, and columns whose names clash with internal ones."""
    rows = [(None, "alpha beta gamma", 1, 2), (None, None, 1, 2), (7, "alpha beta gamma", 1, 2), (7, "alpha beta gamma", 1, 2), (8, "", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, key long, fp long").withColumn("source", F.lit(None).cast("string"))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# text kernel


def test_words_and_hashes():
    texts = [None, "", " a  b\tc\x0bd", "é x", "end ", "ab", "a b"]
    t = tk.read_texts(pa.array(texts))
    found = [[t.bytes[t.start[i] : t.end[i]].tobytes().decode() for i in range(t.first[k], t.first[k + 1])] for k in range(len(texts))]
    assert found == [WORD.findall(x or "") for x in texts]
    words = [w for x in texts for w in WORD.findall(x or "")]
    h = t.hashes()
    assert all((h[i] == h[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(len(words)))


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (5, 50, 1, 200, 3)]})
    parts = list(tk.slices(iter([batch]), limit=60))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist() and len(parts) > 1


# substring dedup


def brute_substring(rows):
    words = {d: WORD.findall(t or "") for d, t, *_ in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 19):
            first.setdefault(tuple(words[d][i : i + 20]), (d, i))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] != (d, i):
                gone[i : i + 20] = [True] * 20
        out[d] = (len(w), sum(gone), [x for x, g in zip(w, gone) if not g])
    return out


def test_substring_dedup(spark, folder):
    want = {d: (n, r, hashlib.sha256(" ".join(k).encode()).hexdigest()) for d, (n, r, k) in brute_substring(ROWS).items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.op4_substring_dedup(spark, folder).collect()}
    assert got == want and sum(r > 0 for _, r, _ in want.values()) > 15


def test_difference_cover():
    for i in range(13):
        for j in range(13):
            assert any((i + s) % 13 in substring.COVER and (j + s) % 13 in substring.COVER for s in range(13))
    assert substring.ANCHOR + substring.PERIOD - 1 == substring.WINDOW


def test_without_repeats(docs, odd, none):
    want = {}
    for d, (n, r, kept) in brute_substring(ROWS).items():
        original = next(t for i, t, *_ in ROWS if i == d)
        if not r or r < n:
            want[d] = " ".join(kept) if r else original
    out = substring.without_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())
    assert substring.without_repeats(odd).count() == 5 and substring.without_repeats(none).count() == 0
    clash = docs.withColumns({"__key": F.lit("a"), "__removed": F.lit(1), "__kept": F.lit("b"), "__N_WORDS": F.lit(2), "key": F.lit(3)})
    again = substring.without_repeats(clash)
    assert again.columns == clash.columns and {r.doc_id: r.text for r in again.collect()} == want


def test_a_common_phrase_is_spread(spark, monkeypatch):
    """Windows around one phrase of many texts don't share a bucket once there are too many; the result is the same."""
    rng = random.Random(31)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 4)
    run = [word() for _ in range(30)]
    rows = [(i, " ".join([*(word() for _ in range(15)), "as", "we", "all", "know", *(word() for _ in range(15)), *(run if i % 9 == 0 else [])])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(substring, "BUCKET_BYTES", 4_000)
    assert substring.crowded_routes(docs).sum() > 0
    got = {r["__key"]: r.n_removed for r in substring.remove_repeats(docs).collect()}
    assert got == {d: n for d, (_, n, _) in brute_substring(rows).items()}


def _sorted_blocks(batches):
    """The blocks of all tasks as one partition would read them, a few rows at a time."""
    table = pa.Table.from_batches([b for b in batches if len(b)]).sort_by("bucket")
    return table.to_batches(max_chunksize=3)


@pytest.mark.parametrize("held", [64, 2000, 1 << 20])
def test_many_slices_of_a_hot_passage(monkeypatch, held):
    """Buckets that are reduced while they are read lose nothing."""
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    hot = [word() for _ in range(31)]
    rows = []
    for i in rng.sample(range(90), 90):
        w = [word() for _ in range(rng.randint(0, 40))]
        if i % 3 == 0:
            a, b = rng.randint(0, 8), rng.randint(22, 31)
            w[len(w) // 2 : len(w) // 2] = hot[a:b]
        if i % 7 == 0:
            w += w
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(substring, "BUCKET_BYTES", held)
    monkeypatch.setattr(tk, "gathered", lambda batches, text="text", **_: (b.slice(i, 2) for b in batches for i in range(0, len(b), 2)))
    schema = pa.schema([("__key", pa.int64()), ("text", pa.string())])
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], schema=schema)
    tasks = [batch.slice(0, 50), batch.slice(50)]
    hits = defaultdict(list)
    blocks = [b for t in tasks for b in substring._anchor_blocks(2)(iter([t]))]
    solve = substring._per_bucket(substring._repeated_anchors, (np.uint64, np.int64, np.int32), lambda k, s: substring._reply_blocks(k, s, 2), ("part", "keys", "starts"))
    replies = pa.Table.from_batches(solve(iter(_sorted_blocks(blocks)))).sort_by("part").to_batches(max_chunksize=3)
    for out in substring._key_starts(iter(replies)):
        for r in out.to_pylist():
            hits[r["key"]] += r["starts"]
    anchored = [t.filter(pa.array([k in hits for k in t.column("__key").to_pylist()])) for t in tasks]
    anchored = [t.append_column("__anchors", pa.array([hits[k] for k in t.column("__key").to_pylist()], pa.list_(pa.int32()))) for t in anchored]
    crowded = np.arange(1 << substring.ROUTES) % 2 == 0
    blocks = [b for t in anchored for b in substring._window_blocks(2, "text", "__", crowded)(iter([t]))]
    removed = defaultdict(set)
    for out in substring._per_bucket(substring._later_windows, (np.uint64, np.uint64, np.int64, np.int32))(iter(_sorted_blocks(blocks))):
        for r in out.to_pylist():
            removed[r["key"]] |= {p for s in r["starts"] for p in range(s, s + 20)}
    want = brute_substring(rows)
    assert {d: len(removed[d]) for d in want} == {d: r for d, (_, r, _) in want.items()} and sum(r for _, r, _ in want.values()) > 500


# simhash


def brute_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 2 and root(a) != root(b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in prints}


def test_simhash(spark, folder):
    prints = {d: brute_fingerprint(t) for d, t, *_ in ROWS}
    component = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op10_simhash(spark, folder).collect()}
    assert got == {d: (f"{p:016x}", component[d]) for d, p in prints.items()}
    assert len(set(component.values())) < len(prints) - 5


@pytest.mark.parametrize("limit", [4096, 4])
def test_links_of_dense_fingerprints(spark, limit):
    """Chains of fingerprints one or two bits apart, also where shards are over the limit and dealt again."""
    rng = random.Random(3)
    values = set()
    for _ in range(6):
        v = rng.getrandbits(64)
        for _ in range(40):
            values.add(v)
            for _ in range(rng.choice((1, 2, 2, 3))):
                v ^= 1 << rng.randrange(64)
    prints = dict(enumerate(sorted(values)))
    df = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()], "id long, fp long")
    stars = {r.a: r.b for r in simhash.components(simhash.links(df, limit=limit)).collect()}
    assert {i: stars.get(i, i) for i in prints} == brute_components(prints)


def test_bk_tree_finds_what_a_scan_finds():
    rng = random.Random(1)
    values = [rng.getrandbits(10) for _ in range(200)]
    tree = simhash.BKTree()
    for v in dict.fromkeys(values):
        tree.add(v)
    for q in range(0, 1024, 7):
        assert sorted(tree.near(q, 2)) == sorted(v for v in set(values) if (v ^ q).bit_count() <= 2)


A, B = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")


def test_keep_one(spark, docs, odd, none):
    component = brute_components({d: brute_fingerprint(t) for d, t, *_ in ROWS})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(component.values())
    assert sorted(((r.doc_id, r.text) for r in simhash.keep_one(odd).collect()), key=str) == [(None, "alpha beta gamma"), (None, None)]
    clash = docs.withColumns({"__key": F.lit("a"), "__TH": F.lit(1), "fp": F.lit(2), "group": F.lit(3)})
    again = simhash.keep_one(clash)
    assert again.columns == clash.columns and {r.doc_id for r in again.collect()} == set(component.values())
    unrelated = spark.createDataFrame([(None, A), (None, B), (5, B), (9, A)], "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in simhash.keep_one(unrelated).collect()} == {(None, A), (None, B)}
    assert simhash.keep_one(none).count() == 0


# quality rules


def brute_measures(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, folder, duck):
    got = {r.doc_id: r for r in quality.op5_quality_rules(spark, folder).collect()}
    for d, t, *_ in ROWS:
        r, m = got[d], brute_measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0])
    rows = duck.sql(quality.ORACLE)
    assert sorted(rows.select(*map(str, ["doc_id", "n_words", "kept"])).fetchall()) == sorted((r.doc_id, r.n_words, r.kept) for r in got.values())


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    return con


def bad_hosts():
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, good if i % 20 else bad, "en", f"fine{i % 4}", 1) for i in range(400)] + [(1000 + i, bad if i < 70 else good, "en", "spam", 1) for i in range(100)]
    return rows + [(2000 + i, good, "en", None, 1) for i in range(30)] + [(3000, bad, "en", "one bad page", 1), (3001, good, "en", "one bad page", 1), (3002, None, "en", "fine0", 0)]


def test_bad_host_goes(spark, none, odd):
    """The good pages of a host that mostly fails go with it; a host of two pages, one of them bad, stays."""
    rows = bad_hosts()
    kept = quality.keep_good(spark.createDataFrame(rows, SCHEMA))
    want = {d for d, t, _, host, _ in rows if host != "spam" and t and len(t) > 20}
    assert {r.doc_id for r in kept.collect()} == want and kept.count() == len(want) and len(want) == 411
    assert quality.keep_good(none).count() == 0 and quality.keep_good(odd).count() == 0
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({"__n_words": F.lit("a"), "__host": F.lit("b"), "__BASE_FAILED": F.lit(True)})
    again = quality.keep_good(clash)
    assert again.columns == clash.columns and {r.doc_id for r in again.collect()} == want


def test_bad_host_in_the_query(spark, tmp_path):
    spark.createDataFrame(bad_hosts(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted((r.doc_id, r.base_failed, r.kept) for r in quality.op5_quality_rules(spark, str(tmp_path)).collect())
    assert got == sorted(con.sql(quality.ORACLE).select("doc_id", "base_failed", "kept").fetchall())
    assert sum(not failed and not kept for _, failed, kept in got) == 30


# decontamination


def test_decontamination(spark, none, tmp_path):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    item = [word() for _ in range(40)]
    noise = lambda n: [word() for _ in range(n)]
    every = lambda k: [w if i % k else word() for i, w in enumerate(item, 1)]
    cases = {0: noise(30) + item + noise(30), 1: item, 2: item[20:] + noise(20), 3: noise(20) + item[:15], 10: item[:7] + noise(50), 11: noise(100), 12: noise(3)}
    cases |= {20 + k: noise(11) + every(k) + noise(9) for k in range(5, 11)} | {15: every(2), 16: every(3)}
    rows = [(i, " ".join(w), "en", "s", 1) for i, w in cases.items()] + [(50, " ".join(item).upper().replace(" ", ",\n"), "en", "s", 1), (51, None, "en", "s", 1), (None, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(noise(25))), (3, "too short"), (4, None)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.matches for r in decontam.contaminated(docs, benchmark).collect()}
    assert set(found) == {(d, 1) for d in (0, 1, 2, 3, 50, *range(25, 31))}
    assert found[0, 1] == 40 and found[2, 1] == 20 and found[25, 1] >= 31
    assert {r.doc_id for r in decontam.drop_contaminated(docs, benchmark).collect()} == {10, 11, 12, 15, 16, 51, None}
    docs.write.parquet(str(tmp_path / "d"))
    benchmark.write.parquet(str(tmp_path / "b"))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    con.sql(f"create view benchmark as select * from '{tmp_path}/b/*.parquet'")
    want = {(d, i): (m, round(x, 6)) for d, i, m, x in con.sql(decontam.ORACLE).select("doc_id", "item_id", "matches", "share").fetchall()}
    assert {(r.doc_id, r.item_id): (r.matches, round(r.share, 6)) for r in decontam.contaminated(docs, benchmark).collect()} == want
    assert decontam.contaminated(none, benchmark).count() == 0 and decontam.contaminated(docs, benchmark.limit(0)).count() == 0


# packing


def test_packing(spark, folder, none, odd):
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.op8_packing(spark, folder).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for d, t, *_ in ROWS:
        ids = [*reader.encode(t or "", add_special_tokens=False).ids, 0]
        cut = [ids[a : a + 2048] for a in range(0, len(ids), 2048)]
        want = [(k, 2048 * k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in enumerate(cut)]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[d]) == want
    for own in by_sequence.values():
        end = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 2048
    assert len(by_sequence) == -(-sum(r.length for r in rows) // 2048)
    pieces = lambda df: packing.pack(packing.tokenized_pieces(df, packing.tokenizer_path()), block=2)
    assert pieces(none).count() == 0 and pieces(odd).count() == 5


def test_crossover_keeps_every_piece():
    rng = random.Random(4)
    sizes = [rng.randint(1, 60) for _ in range(300)]
    a, b = (packing.best_fit(sizes, 100, rng.sample(range(300), 300)) for _ in range(2))
    for _ in range(10):
        a = packing.crossover(a, b, sizes, 100, rng)
        assert sorted(p for x in a for p in x) == list(range(300)) and all(sum(sizes[p] for p in x) <= 100 for x in a)
    best, _ = packing.evolve(sizes, 100, 1, [])
    assert len(best) <= len(packing.best_fit(sizes, 100, sorted(range(300), key=lambda p: -sizes[p])))
    assert packing._decode(packing._encode(best, 300)) == [sorted(x) for x in best]


@pytest.mark.parametrize("size, most", [("sf0.001", 88), ("sf0.01", 442)])
def test_tables_are_packed_at_the_bound(spark, size, most):
    """The least number of sequences (tokens / 2048, rounded up)."""
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    dealt = packing._dealt(packing.tokenized_pieces(docs, packing.tokenizer_path()), packing.BLOCK)
    assert min(r.bins for r in packing.evolved(dealt).collect()) == most


def _cut_bins(rng, bins, capacity, pieces, least):
    """Sizes of ``bins`` full bins of so many pieces each, in random order: no piece or pair is known to fill another bin."""
    out = []
    while len(out) < bins * pieces:
        own = [rng.randint(least, 2 * capacity // pieces - least) for _ in range(pieces - 1)]
        if least <= capacity - sum(own) <= 2 * capacity // pieces - least:
            out += [*own, capacity - sum(own)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("bins, capacity, pieces, least, gain", [(60, 1000, 4, 180, 3), (1000, 2048, 4, 380, 60), (60, 1000, 3, 250, 0)])
def test_crossovers_beat_the_greedy_parent(bins, capacity, pieces, least, gain):
    for seed in range(3):
        sizes = _cut_bins(random.Random(seed), bins, capacity, pieces, least)
        first = packing.greedy(sizes, capacity)
        best, crossed = packing.evolve(sizes, capacity, seed, [])
        assert crossed and len(first) > bins and len(best) <= len(first) - max(gain, len(first) > bins + 1)
        assert sorted(p for x in best for p in x) == list(range(len(sizes))) and all(sum(sizes[p] for p in x) <= capacity for x in best)
        again, _ = packing.evolve(sizes, capacity, seed + 9, [best])
        assert len(again) <= len(best)


def test_islands_carry_on_what_crossovers_found(spark):
    sizes = _cut_bins(random.Random(5), 300, 2048, 4, 380)
    items = spark.createDataFrame([(i, 0, 0, x, i, i) for i, x in enumerate(sizes)], packing._ITEMS)
    found = packing.evolved(packing._dealt(items, 4096)).collect()
    assert len(packing.greedy(sizes, 2048)) > 315 and min(r.bins for r in found) < 306 and all(r.crossovers == 2 * packing.GENERATIONS for r in found)
    placed = packing.pack(items).collect()
    assert len(placed) == 1200 and len({r.sequence_id for r in placed}) == min(r.bins for r in found)


def test_filling_takes_what_is_there():
    loose = packing.Loose([5, 5, 3, 9], 20, [0, 1, 2, 3])
    assert loose.filling(10) == [1, 0] and loose.filling(6) == [] and loose.filling(12) == [3, 2] and loose.filling(1) == [] and not loose.bits


# sharding


def test_sharding(spark, folder):
    rows = sharding.op3_sharding(spark, folder).collect()
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        text = (next(t for d, t, *_ in ROWS if d == r.doc_id) or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "bytes", None)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert len(rows) == len(ROWS) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(40))


def test_hot_and_null_ids_are_spread(spark, tmp_path):
    """Ids that a third of the rows share fill no shard: bytes are even and slots have no gaps."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "x" * (i % 40 + 50)) for i in range(9000)] + [(5, None), (6, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sharding.op3_sharding(spark, str(tmp_path)).collect()
    load, slots = defaultdict(int), defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == len(rows) and max(load.values()) < 1.01 * min(load.values()) and len(load) == 40
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_no_records(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sharding.op3_sharding(spark, str(tmp_path)).count() == 0


def test_even_bytes_and_growth(spark):
    records = spark.range(20_000).select("id", (F.col("id") * 37 % 1000 + 16).alias("size"), sharding.virtual_slot(F.col("id")).alias("vslot"))
    first = sharding.first_map(sharding.slot_sizes(records), 40)
    load = [r[1] for r in first.groupBy("shard").agg(F.sum("bytes")).collect()]
    assert len(load) == 40 and max(load) < 1.005 * min(load)
    grown = sharding.add_shard(first, 40)
    moved = first.alias("a").join(grown.alias("b"), "vslot").where("a.shard <> b.shard")
    assert {r.s for r in moved.select(F.col("b.shard").alias("s")).distinct().collect()} == {40}
    load = {r.shard: r.b for r in grown.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    assert max(load.values()) < 1.1 * sum(load.values()) / 41 and load[40] > 0.5 * sum(load.values()) / 41


def test_map_versions(spark, tmp_path):
    sizes = sharding.slot_sizes(spark.createDataFrame([], "vslot int, size long"), 8)
    one = sharding.first_map(sizes, 2)
    sharding.store_map(one, str(tmp_path), 1)
    assert sharding.load_map(spark, str(tmp_path), 1).count() == 8
    with pytest.raises(Exception, match="(?i)exist"):
        sharding.store_map(one, str(tmp_path), 1)


# html


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body class="page">
<header><h2>Site</h2></header><nav><ul><li><a href="/">Home, sweet, home and much more of it</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, really, many, of them, for everything you do.</p></div>
<main><article><h1>Head&amp;line</h1><p>First   paragraph, with commas, and <b>bold</b><i>ness</i> in it&nbsp;too.<p>Second one<br>broken, not closed, fine &#233; &lt;tag&gt;.
<ul><li>point one<li>point two</ul><div class="ad"><p>Buy this, now, it is cheap, and very good for you all.</p></div><p>Short.</p></article></main>
<aside><p>Other, related, articles, that, have many commas, but live in the sidebar.</p></aside>
<section id="comments"><p>I, as a reader, have, so, many, things, to say about this, and more, and more, and more.</p></section>
<form><p>Subscribe, please, to our letter, it is long, and it comes every, single, day.</p></form><footer>&copy; us</footer></body></html>"""


def test_html():
    assert extraction.main_text(PAGE) == "Head&line First paragraph, with commas, and boldness in it too. Second one broken, not closed, fine é <tag>. point one point two Short."
    assert extraction.main_text(None) == "" and extraction.main_text("") == "" and extraction.main_text("<p>a") == "a"
    assert extraction.main_text("<body><article><p>tiny</p></article><footer>foot</footer>") == "tiny"
    assert extraction.main_text("<article><p>A text that is long enough, to count as one.</p><p>cut <b") == "A text that is long enough, to count as one. cut"
    split = "<body><div class='menu'><a href=x>A</a></div><div id='content'>" + "".join(f"<p>Paragraph {i}, which is long enough, to score.</p>" for i in range(3)) + "</div></body>"
    assert extraction.main_text(split) == " ".join(f"Paragraph {i}, which is long enough, to score." for i in range(3))


def _paragraph(i):
    return f"Paragraph number {i} has some words, a few commas, and it is long enough to count."


def _marked(a, b):
    return "".join(f"<p>{_paragraph(i)}</p>" for i in range(a, b))


def _plain(a, b):
    return " ".join(map(_paragraph, range(a, b)))


LAYOUTS = {
    "sections": (f"<div class='w'><section><h2>One</h2>{_marked(0, 4)}</section><section><h2>Two</h2><p>Tiny.</p></section></div><footer>f</footer>", f"One {_plain(0, 4)} Two Tiny."),
    "article of sections": (f"<article><h1>T</h1><section>{_marked(0, 4)}</section><section><p>Tiny.</p></section></article>", f"T {_plain(0, 4)} Tiny."),
    "tail in main": (f"<main><h1>T</h1><div>{_marked(0, 5)}</div><p>Short tail.</p></main>", f"T {_plain(0, 5)} Short tail."),
    "says it has a sidebar": (f"<div class='content has-sidebar'><div class='post-body'>{_marked(0, 3)}</div><div class='sidebar'>{_marked(5, 7)}</div></div>", _plain(0, 3)),
    "humps": (f"<div class='siteHeader'>{_marked(8, 9)}</div><div class='articleBody'>{_marked(0, 3)}</div><div class='userComments'>{_marked(5, 9)}</div>", _plain(0, 3)),
    "headings called header": (f"<article class='header'><h1 class='entry-header'>T</h1>{_marked(0, 2)}<h2 class='section-header'>S</h2>{_marked(2, 3)}</article>", f"T {_plain(0, 2)} S {_plain(2, 3)}"),
    "header of the article": (f"<article><header><h1>Title</h1><p>By someone</p></header>{_marked(0, 3)}</article>", f"Title {_plain(0, 3)}"),
    "notices that say content": (f"<div class='cookie-content'>{_marked(5, 8)}</div><div id='content'>{_marked(0, 3)}<div class='content-notice'>{_marked(5, 6)}</div></div>", _plain(0, 3)),
    "figure": (f"<article>{_marked(0, 3)}<figure><img src=x><figcaption>A caption.</figcaption></figure></article>", f"{_plain(0, 3)} A caption."),
    "title beside the body": (f"<div class='page'><h1>Title</h1><div class='body'>{_marked(0, 4)}</div></div>", f"Title {_plain(0, 4)}"),
    "title of the site": (f"<h1>Site</h1><div id='content'><h1>Title</h1>{_marked(0, 4)}</div>", f"Title {_plain(0, 4)}"),
    "quotes in attributes": (f"<article><p>See <a href=x title=it's>this</a> and <a href='x>that</a>.</p>{_marked(0, 3)}</article>", f"See this and that. {_plain(0, 3)}"),
    "teasers": (f"<main><article><h1>T</h1>{_marked(0, 6)}</article><article class='teaser'><a href=x>Read more of this one, a long link text.</a><p>x</p></article></main>", f"T {_plain(0, 6)}"),
    "table and lists": (f"<article>{_marked(0, 2)}<table><tr><td>a</td><td>1</td></tr></table><dl><dt>Term</dt><dd>Meaning</dd></dl><pre>x  =  1</pre></article>", f"{_plain(0, 2)} a 1 Term Meaning x = 1"),
    "roles": (f"<div role='navigation'>{_marked(9, 12)}</div><div role='main'>{_marked(0, 3)}</div><div role='alert'>{_marked(9, 12)}</div>", _plain(0, 3)),
    "comments inside": (f"<article>{_marked(0, 3)}<div class='comment-list'><div class='comment'>{_marked(4, 9)}</div></div></article><section class='responses'>{_marked(4, 9)}</section>", _plain(0, 3)),
    "all cut by class": (f"<div class='popup-wrap'>{_marked(0, 3)}</div>", _plain(0, 3)),
    "phrases in names": (f"<article>{_marked(0, 2)}<div class='share-of-market'>{_marked(2, 4)}</div><p class='related-work'>{_paragraph(4)}</p><div id='notice-of-meeting'>{_marked(5, 6)}</div></article>", _plain(0, 6)),
    "a section called discussion": (f"<article><section id='results'>{_marked(0, 3)}</section><section id='discussion'><h2>Discussion</h2>{_marked(3, 5)}</section></article>", f"{_plain(0, 3)} Discussion {_plain(3, 5)}"),
    "a discussion of readers": (f"<div id='content'>{_marked(0, 3)}</div><div id='discussion'>{_marked(4, 9)}</div>", _plain(0, 3)),
    "only cookies": ("<div class='cookie-bar'><p>We use cookies, really, many, of them, for everything you do, and you agree, or so we say.</p></div>", ""),
    "only comments": (f"<div class='popup'><div class='comments'>{_marked(0, 6)}</div></div>", ""),
    "related posts": (f"<article>{_marked(0, 3)}<div class='related-posts'><h3>More</h3><p>{_paragraph(8)}</p></div><div class='share-buttons'>Share this now</div></article>", _plain(0, 3)),
    "stray signs": (f"<article><p>If a < b and c<3, then.</p>{_marked(1, 3)}</article>", f"If a < b and c<3, then. {_plain(1, 3)}"),
    "very deep": ("<div>" * 3000 + _marked(0, 3) + "</div>" * 3000, _plain(0, 3)),
}


def generated_page(rng, layout):
    """A page in one of three layouts, and its article's text."""
    words = "stone river light over under, field paper, green house, road seven, quiet".split()
    prose = lambda n: " ".join(rng.choices(words, k=n)).strip(",").capitalize() + "."
    title, parts = prose(5), [prose(rng.randint(20, 90)) for _ in range(rng.randint(3, 9))]
    subheads = {k: prose(3) for k in range(1, len(parts)) if rng.random() < 0.3}
    links = "".join(f"<li><a href='/{i}'>{prose(4)}</a></li>" for i in range(rng.randint(3, 9)))
    noise = [f"<div class='{c}'><p>{prose(rng.randint(10, 60))}</p></div>" for c in ("cookie-banner", "ad-slot", "newsletter-signup", "sidebar widget", "comments-area")]
    body = f"<h1>{title}</h1>" + "".join((f"<h2>{subheads[k]}</h2>" if k in subheads else "") + f"<p>{x}</p>" for k, x in enumerate(parts))
    text = " ".join([title, *(y for k, x in enumerate(parts) for y in ([subheads[k]] if k in subheads else []) + [x])])
    rng.shuffle(noise)
    if layout == "semantic":
        page = f"<header><b>Site</b></header><nav><ul>{links}</ul></nav><main><article>{body}{noise[0]}</article></main><aside>{noise[1]}</aside><footer>{prose(9)}</footer>"
    elif layout == "divs":
        page = f"<div id='top-nav'><ul>{links}</ul></div>{noise[0]}<div class='wrap'><div class='post-body'>{body}</div>{noise[1]}{noise[2]}</div><div class='site-footer'><p>{prose(30)}</p></div>"
    else:
        page = f"<table><tr><td width=150><ul>{links}</ul></td><td><div id='story'>{body}</div></td></tr></table>{noise[0]}<div id=footer>{prose(12)}</div>"
    return f"<!doctype html><html><head><title>x</title></head><body>{page}</body></html>", text


@pytest.mark.parametrize("layout", ["semantic", "divs", "tables"])
def test_generated_pages(layout):
    rng = random.Random(8)
    for _ in range(60):
        page, text = generated_page(rng, layout)
        assert extraction.main_text(page) == text


WRAPPERS = (
    "overflow-hidden", "content overflow-hidden", "article ad-free", "content menu-closed", "hidden md:block", "site footer-dark", "wrapper nav-fixed", "site cookie-accepted",
    "entry-content comments-open", "post comments-disabled", "article-body notice-period", "article cookie-recipes", "post category-promo tag-menu", "sidebar-right-layout",
    "navbar-fixed-top", "page-with-menu is-dark", "layout--ad-supported", "hidden-print", "notice-board-town", "promo-free",
)


@pytest.mark.parametrize("name", WRAPPERS)
def test_names_of_wrappers_lose_no_article(name):
    body = f"<h1>T</h1>{_marked(0, 3)}"
    noise = f"<nav><a href=x>Menu</a></nav><div class='cookie-bar'><p>{_paragraph(7)}</p></div>"
    for page in (f"<div class='{name}'>{body}</div>", f"{noise}<div class='{name}'>{body}</div><footer>f</footer>", f"<div class='{name}'>{noise}<div>{body}</div></div>"):
        assert extraction.main_text(f"<html><body>{page}</body></html>") == f"T {_plain(0, 3)}"


def test_forms_labels_and_buttons():
    body = f"<h1>T</h1>{_marked(0, 3)}"
    assert extraction.main_text(f"<body><form id='aspnetForm' action=x><input type=hidden><div>{body}</div><div class='comments'>{_marked(4, 9)}</div></form></body>") == f"T {_plain(0, 3)}"
    assert extraction.main_text(f"<article>{body}<p>Press the <button>Save</button> key and the <label>name</label> is kept, at once.</p><form><label>Mail</label><p>{_paragraph(9)}</p></form><div><button>Share</button></div></article>") == f"T {_plain(0, 3)} Press the Save key and the name is kept, at once."


# Names of article and noise as CSS frameworks and publishing systems write them.
FRAMEWORKS = {
    "utilities": (["mx-auto max-w-prose overflow-hidden", "prose lg:prose-xl md:block", "flex-1 min-w-0 overflow-x-hidden"], ["ad-slot", "cookie-banner fixed inset-x-0", "newsletter-box", "comments mt-8"]),
    "grid": (["col-md-8 blog-main", "container-fluid p-3 no-ads", "row content-row nav-fixed"], ["alert alert-info", "sidebar col-md-4", "comment-list", "ads-right"]),
    "publishing": (["entry-content comments-open", "post type-post category-promo tag-menu", "hentry site-main has-sidebar"], ["widget-area sidebar", "comments-area", "subscribe-form", "cookie-notice"]),
    "blocks": (["article__body article__body--ad-free", "page-content page-content--menu-closed", "story__text is-sticky"], ["promo-box", "comment-list__item", "newsletter__signup", "cookie-bar__inner"]),
}


@pytest.mark.parametrize("framework", FRAMEWORKS)
def test_pages_of_frameworks(framework):
    """Sixty pages a framework; names of article and noise are drawn for each."""
    rng = random.Random(framework)
    content, noisy = FRAMEWORKS[framework]
    for _ in range(60):
        parts = [_paragraph(rng.randint(0, 999)) for _ in range(rng.randint(3, 9))]
        noise = lambda: f"<div class='{rng.choice(noisy)}'>" + "".join(f"<p>{_paragraph(rng.randint(1000, 2000))}</p>" for _ in range(rng.randint(1, 2))) + "</div>"
        body = "<h1>Title</h1>" + "".join(f"<p>{x}</p>" for x in parts)
        inside = f"{body}{noise()}" if rng.random() < 0.5 else body
        wrapped = f"<div class='{rng.choice(content)}'>{inside}</div>"
        if rng.random() < 0.5:
            wrapped = f"<div class='{rng.choice(content)}'>{wrapped}</div>"
        page = f"<html><body><nav><a href=x>Home</a></nav>{noise()}{wrapped}{noise()}<footer><p>{_paragraph(3)}</p></footer></body></html>"
        assert extraction.main_text(page) == " ".join(["Title", *parts]), page


def test_depth_costs_no_more_than_size():
    page = "<div><b>" * 60_000 + _marked(0, 3)
    began = time.process_time()
    assert extraction.main_text(page) == _plain(0, 3) and time.process_time() - began < 5


@pytest.mark.parametrize("layout", LAYOUTS)
def test_html_layouts(layout):
    body, text = LAYOUTS[layout]
    assert extraction.main_text(f"<html><body class='single sidebar-right'>{body}</body></html>") == text


def test_html_frames(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    got = extraction.extract(pages).collect()
    assert len(got) == 3 and all(r.n_chars == len(r.text) for r in got)
    clash = extraction.extract(pages.withColumns({"__text": F.lit("a"), "text": F.lit("b"), "N_CHARS": F.lit(5)}))
    assert clash.columns == ["page_id", "url", "html", "__text", "text", "n_chars"] and {r.text for r in clash.collect()} == {r.text for r in got}
    assert extraction.extract(pages.limit(0)).count() == 0


# toxicity


def test_toxicity(spark, none, odd):
    rng = random.Random(6)
    clean, rude = [f"w{i}" for i in range(300)], ["scumbag", "moron", "filth"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = rng.choices(clean, k=rng.randint(5, 80))
        if toxic:
            for w in rng.sample(rude, rng.choice((1, 2, 3))):
                words.insert(rng.randrange(len(words)), rng.choice((w, w.upper(), f"{w}!")))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows + [(9000, None, None, None, None), (None, "moron", None, None, None)], SCHEMA)
    known = spark.createDataFrame(labels[:300] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].toxic == bool(t) for i, _, t in labels[300:]) and not got[9000].toxic and got[None].toxic
    assert np.all(np.diff(model.theta) >= 0) and max(r.grade for r in got.values()) == 2
    mild, severe = (np.mean([r.expected_severity for r in got.values() if r.grade == g]) for g in (1, 2))
    assert mild < severe
    untrained = toxicity.fit(docs, known.limit(0))
    assert not any(r.toxic for r in toxicity.score(docs, untrained).collect())
    assert toxicity.score(none, model).count() == 0 and toxicity.score(odd, model).count() == 5


def penalised(rows, columns, grades, beta, theta, ridge=toxicity.RIDGE):
    """The negative log likelihood of a cumulative-link model, document by document."""
    total = 0.5 * ridge * float(beta @ beta)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for i, g in enumerate(grades):
        margin = sum(beta[c] for r, c in zip(rows, columns) if r == i)
        below = [0.0, *(sigmoid(t - margin) for t in theta), 1.0]
        total -= np.log(below[g + 1] - below[g])
    return total


def test_fit_is_the_best_fit():
    """No small step from the fitted weights and ordered thresholds has a better likelihood."""
    rng = np.random.default_rng(61)
    n, k = 120, 6
    x = rng.random((n, k)) < 0.3
    margin = x @ np.array([2.0, 1.0, -1.0, 0.5, 0.0, 3.0])
    grades = (margin + rng.logistic(size=n) > 1.5).astype(int) + (margin + rng.logistic(size=n) > 3.5)
    rows, columns = np.nonzero(x)
    beta, theta = toxicity.fit_ordinal(rows, columns, grades, k, steps=1500)
    best = penalised(rows, columns, grades, beta, theta)
    assert np.all(np.diff(theta) > 0) and best < penalised(rows, columns, grades, np.zeros(k), theta)
    for _ in range(40):
        step = rng.normal(size=k + len(theta)) * 0.05
        assert penalised(rows, columns, grades, beta + step[:k], theta + step[k:]) > best - 1e-3


def test_repeated_labels_and_long_texts(spark):
    """Of a document's labels the worse counts; a grade of 2 takes three different words that speak for toxicity, however often they stand."""
    clean = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join([*clean[i % 40 : i % 40 + 9], *(["scum"] if i % 3 == 0 else []), *(["moron", "filth"] if i % 6 == 0 else [])])) for i in range(240)]
    rows += [(1000, "moron " * 200_000), (1001, "moron scum filth"), (1002, "w1 " * 300_000), (1003, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, 1, int(i % 3 == 0)) for i in range(240)] + [(i, 1, 0) for i in range(0, 240, 3)] + [(None, 1, 1), (5, 1, None)]
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].toxic == (i % 3 == 0) for i in range(240)) and got[1001].toxic and not got[1002].toxic and not got[1003].toxic
    assert got[1001].grade == 2 and got[3].grade == 1 and got[6].expected_severity > got[3].expected_severity


# pipeline


def test_pipeline_edges(spark, tmp_path):
    """An empty table, null ids and texts, repeated rows and further columns go through all stages."""
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(70))
    full = [(None, text, 1), (None, text, 1), (None, " ".join(f"v{i}" for i in range(70)), 2), (4, None, 3), (5, "", None)]
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows, want in ((full, 2), ([], 0)):
        docs = spark.createDataFrame([(d, t, "en", None, None, k) for d, t, k in rows], "doc_id long, text string, lang string, source string, n_chars long, __key long")
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            docs = out
        assert docs.count() == want and corpus_pipeline.best_fit_packing(spark, docs, str(tmp_path)).count() == want


def test_pipeline(spark, folder, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, " ".join(f"bench{i}" for i in range(30)))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "substring_dedup", "decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {d: t for d, t, *_ in ROWS if (m := brute_measures(t)) and m[0] >= 50 and 100 * m[4] <= 50 * m[0]}
    kept = set(brute_kept(list(left.items()), 5, 0.8))
    left = {d: t for d, t in left.items() if d in kept}
    want = {d: " ".join(k) if r else left[d] for d, (n, r, k) in brute_substring([(d, t) for d, t in left.items()]).items() if r < n or not r}
    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert sorted(docs.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars"])
    assert {r.doc_id: r.text for r in docs.collect()} == want
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(want)
