"""Licence scans against a search of every window of every document."""

import random
import re
import time
from collections import Counter

import pyarrow as pa
import pytest
from tidemark.llm import licenses, toxicity
from tidemark.llm import textkernel as tk


def bigrams(text):
    words = [w for x in re.findall(r"[^\x20\x09-\x0D]+", text or "") if (w := re.sub("[A-Z]", lambda m: m[0].lower(), x.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")))]
    return list(zip(words, words[1:]))


def brute_best(text, template):
    """The best coefficient of any run of bigrams of the text."""
    own, grams = Counter(bigrams(template)), bigrams(text)
    best = 0.0
    for a in range(len(grams)):
        seen = Counter()
        for b in range(a, len(grams)):
            seen[grams[b]] += 1
            best = max(best, 2 * (seen & own).total() / (seen.total() + own.total()))
    return best


def scanned(*texts, templates=None):
    return [{name: round(v, 6) for name, (v, _) in x.items()} for x in licenses.Scanner(templates).scan(tk.read_texts(pa.array(texts, pa.string())))]


def test_every_window():
    rng = random.Random(41)
    words = "the of this software and licence may use copy".split()
    for _ in range(150):
        template = " ".join(rng.choices(words, k=rng.randint(2, 14)))
        text = " ".join(rng.choices(words + ["x"], k=rng.randint(0, 25)))
        if rng.random() < 0.6:
            part = template.split()
            part[rng.randrange(len(part))] = rng.choice(words)
            text = f"{text} {' '.join(part)} {text}"
        want = brute_best(text, template)
        got = scanned(text, templates=[("t", template)])[0]
        assert got == ({"t": round(want, 6)} if want >= licenses.MIN_DICE else {})


@pytest.mark.parametrize(
    "name, text",
    [
        ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
        ("GPL-3.0-or-later", "This file is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
        ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify\n it under the terms of the GNU Affero General Public License as published\n by the Free Software Foundation, either version 3 of the License, or\n (at your option) any later version."),
        ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
        ("CC-BY-NC-SA-4.0", "this work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
        ("Proprietary", "Copyright 2001 someone. All rights reserved."),
    ],
)
def test_notices(name, text):
    assert list(scanned(f"Some code here. {text} And more of it.")[0])[0] == name


def test_full_texts():
    """Each full text is its own licence and nothing else, inside other text too; three clauses aren't two."""
    texts = dict(licenses.full_texts())
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0"} <= set(texts)
    for name, text in texts.items():
        got = scanned(f"first some words of our own\n{text}\nand some behind it")[0]
        assert next(iter(got)) == name and got[name] == 1.0
    three = f"{licenses._BSD_HEAD} {licenses._BSD_THIRD} {licenses._BSD_TAIL}"
    assert scanned(three, three.replace(licenses._BSD_THIRD, "")) == [{"BSD-3-Clause": 1.0}, {"BSD-2-Clause": 1.0}]
    both = scanned(f"{licenses._MIT} {licenses._AS_IS_MIT} {three}")[0]
    assert both == {"MIT": 1.0, "BSD-3-Clause": 1.0}


def test_edges():
    assert scanned(None, "", "word", "x " * 3000) == [{}, {}, {}, {}] and scanned("All rights reserved.", templates=[]) == [{}]
    assert scanned("All rights reserved", templates=[("one word", "rights"), ("b", "all rights reserved"), ("a", "all rights reserved")]) == [{"a": 1.0}]


def test_long_runs_of_punctuation():
    t = tk.read_texts(pa.array(["=" * 1_000_000 + " moron " + "a" + "-" * 1_000_000, "All rights reserved."]))
    began = time.process_time()
    doc, h = toxicity.word_features(t)
    assert len(doc) == 5 and licenses.Scanner().scan(t)[1] and time.process_time() - began < 2


def test_a_megabyte_of_stock_words():
    """Bigrams that templates hold, in numbers that none has: no beginning is worth a look."""
    scanner = licenses.Scanner()
    texts = ["of the " * 150_000, "to the extent of the software " * 33_000, " ".join(["in the", "of this", "the software", "and the", "or the"] * 40_000)]
    for text in texts:
        t = tk.read_texts(pa.array([text]))
        began = time.process_time()
        scanner.scan(t)
        assert time.process_time() - began < 4


def test_many_repeats_in_every_window():
    rng = random.Random(43)
    for _ in range(100):
        template = " ".join(rng.choices("the of a b".split(), k=rng.randint(2, 12)))
        text = " ".join(rng.choices("the of a b".split(), k=rng.randint(5, 40)))
        want = brute_best(text, template)
        assert scanned(text, templates=[("t", template)])[0] == ({"t": round(want, 6)} if want >= licenses.MIN_DICE else {})
