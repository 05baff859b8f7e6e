"""Cases of a review: edited copies, null and repeated ids."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pyarrow as pa
from tidemark.llm import licenses, nearcopies, simhash, substring
from tidemark.llm import textkernel as tk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in rows], SCHEMA)


def prose(rng, n):
    return [rng.choice("abcdefgh") * rng.randint(1, 4) + rng.choice("xyz") for _ in range(n)]


# near copies


def shingles(text, width):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_kept(rows, width, similarity):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x == y or 10 * len(x & y) >= round(10 * similarity) * len(x | y):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, r in enumerate(rows):
        members[root(i)].append(r[0])
    return sorted(min(m) for m in members.values())


def edited_copies():
    rng = random.Random(11)
    rows = []
    for n in (6, 12, 50, 51, 90, 200, 400):
        base = prose(rng, n)
        for edits in (0, 0, 1, 1, 1, 2, 3, 4, 5, 6):
            w = list(base)
            for _ in range(edits):
                i = rng.randrange(len(w))
                w[i : i + 1] = [[], [w[i], "added"], ["other"]][rng.randrange(3)]
            rows.append(" ".join(w))
    rows += [" ".join(prose(rng, 60)) for _ in range(20)] + [None, "", "one", "One", "two words"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_near_dedup_drops_edited_copies(spark):
    rows = edited_copies()
    docs = frame(spark, rows)
    want = brute_kept(rows, 5, 0.8)
    got = corpus_pipeline.near_dedup(spark, docs, None)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == want
    assert len(want) < len(rows) - 30


def test_near_copies_by_stars(spark, monkeypatch):
    """One large group and many texts that share most of their words without being copies."""
    rng = random.Random(12)
    base = prose(rng, 120)
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        rows.append((i, " ".join(w)))
    assert [r.doc_id for r in nearcopies.keep_one(frame(spark, rows), width=3, similarity=0.9).sort("doc_id").collect()] == brute_kept(rows, 3, 0.9)
    assert [r.doc_id for r in nearcopies.keep_one(frame(spark, rows)).sort("doc_id").collect()] == brute_kept(rows, 5, 0.8)


def test_null_and_repeated_ids_lose_no_group(spark):
    rng = random.Random(13)
    texts = [" ".join(prose(rng, 30)) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (4, texts[1]), (7, texts[2]), (7, texts[3]), (None, None), (8, ""), (9, texts[3]), (9, texts[4])]
    got = corpus_pipeline.near_dedup(spark, frame(spark, rows), None).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (None, None), (9, texts[4])])
    assert corpus_pipeline.near_dedup(spark, frame(spark, []), None).count() == 0


def test_shared_ids_do_not_join_components(spark):
    rng = random.Random(14)
    a, b = (" ".join(prose(rng, 30)) for _ in range(2))
    component = {(r.key, r.fp): r.component for r in simhash.near_duplicates(frame(spark, [(5, a), (5, b), (3, a + " "), (8, b)])).collect()}
    fp = {k: f for k, f in component if k in (3, 8)}
    assert component == {(3, fp[3]): 3, (5, fp[3]): 3, (5, fp[8]): 5, (8, fp[8]): 5}


# substring dedup


def test_substring_ids_shared_by_texts(spark):
    """Null and repeated ids over texts of unequal length: each text loses its own later windows only."""
    rng = random.Random(15)
    run, other = prose(rng, 25), prose(rng, 40)
    texts = [prose(rng, 300) + run, prose(rng, 30), run + prose(rng, 9), prose(rng, 60) + other + prose(rng, 4), other]
    texts = [" ".join(w) for w in texts]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (None, None), (9, texts[4]), (9, "short"), (5, texts[3])]
    got = Counter((r["__key"], r.n_words, r.n_removed) for r in substring.remove_repeats(frame(spark, rows)).collect())
    null = substring.NO_KEY
    assert got == Counter([(null, 325, 0), (null, 30, 0), (5, 34, 25), (5, 104, 0), (null, 0, 0), (9, 40, 40), (9, 1, 0), (5, 104, 0)])
    kept = Counter((r.doc_id, r.text) for r in substring.without_repeats(frame(spark, rows)).collect())
    tail = " ".join(texts[2].split()[25:])
    assert kept == Counter([(None, texts[0]), (None, texts[1]), (5, tail), (5, texts[3]), (5, texts[3]), (None, None), (9, "short")])
    twins = [(None, " ".join(run)), (None, "x " + " ".join(run) + " y")]
    assert sum(r.n_removed for r in substring.remove_repeats(frame(spark, twins)).collect()) == 25


# licences


def found_in(*texts):
    return [{name: round(v, 6) for name, (v, _) in x.items()} for x in licenses.Scanner().scan(tk.read_texts(pa.array(texts)))]


def test_notices_beside_shared_bigrams():
    """A notice that stands next to itself, or in running text that shares bigrams with it, is found as it is."""
    long = next(t for _, t in licenses.TEMPLATES if t.startswith("Permission is hereby granted"))
    around = "the software of this software and the rights to use of the software is granted " * 4
    got = found_in("All rights reserved. All rights reserved.", "Released under the MIT License. Released under the MIT License.", around + long + " " + around, around)
    assert got[0] == {"Proprietary": 1.0} and got[1]["MIT"] == 1.0 and got[2]["MIT"] == 1.0 and got[3] == {}
