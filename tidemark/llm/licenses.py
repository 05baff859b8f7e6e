"""Licence scans by Dice coefficient over word bigrams.

Text is normalised (A-Z lower-cased, ASCII punctuation at word ends removed). Templates are the usual
notices of each licence and version, the whole texts of short licences, and the full texts in
``licence_texts``; callers can pass their own. Of each template the best passage of a document counts,
whatever stands around it: a passage that can't be bettered by cutting begins and ends at a shared bigram, so
all such windows are judged whose number of bigrams allows the coefficient ``MIN_DICE``:
2 min(a, b) / (a + b) bounds it from above. An index from bigrams to templates gives the candidates;
those without enough shared bigrams in reach of each other are passed over, which prunes most. Bigrams are
counted with their repeats.

A licence is reported if its best passage doesn't lie over a better licence's: the text of the 3-clause
BSD licence holds most of the 2-clause one and is not both.

Scale: one pass without a shuffle; the templates go to each task once, their bigram hashes as a sorted array.
Documents without a shared bigram cost the lookup only.

Edge cases: null or empty texts have no licence; ties go to the longer template, then the name; repeated
rows are judged one by one; extra columns are ignored; an empty table gives an empty result; without
templates nothing is found.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkernel as tk
from tidemark.llm.toxicity import _LOWER, _PUNCTUATION
from tidemark.llm.workspace import bound_batches

MIN_DICE = 0.8

_AS_IS_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY '
    "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = "and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_TAIL = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE '
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)


def _gnu_notice(licence: str, which: str, thing: str = "program") -> str:
    return f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {licence} as published by the Free Software Foundation, {which}."


# Public licence notices and short licences, (licence, text).
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", _MIT),
    ("MIT", f"{_MIT} {_AS_IS_MIT}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", _gnu_notice("General Public License", "either version 3 of the License, or (at your option) any later version")),
    ("GPL-3.0", _gnu_notice("General Public License", "version 3 of the License")),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-or-later", _gnu_notice("General Public License", "either version 2 of the License, or (at your option) any later version").replace("software: you", "software; you")),
    ("GPL-2.0", _gnu_notice("General Public License", "version 2 of the License")),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0-or-later", _gnu_notice("Lesser General Public License", "either version 3 of the License, or (at your option) any later version")),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1-or-later", _gnu_notice("Lesser General Public License", "either version 2.1 of the License, or (at your option) any later version", "library")),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0-or-later", _gnu_notice("Affero General Public License", "either version 3 of the License, or (at your option) any later version")),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_THIRD}"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("BSD-2-Clause", _BSD_HEAD),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", f"Permission to use, copy, modify, {_ISC}, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", f"Permission to use, copy, modify, {_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_TAIL}"),
    ("0BSD", f"Permission to use, copy, modify, {_ISC}. {_ISC_TAIL}"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
] + [
    x
    for short, long in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
    for x in ((f"CC-{short}-4.0", f"Licensed under CC {short} 4.0."), (f"CC-{short}-4.0", f"This work is licensed under a Creative Commons {long} 4.0 International License."))
] + [("Proprietary", "All rights reserved.")]


@cache
def full_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text) of the files in ``licence_texts``."""
    folder = resources.files("tidemark.llm.licence_texts")
    return tuple((x.name.removesuffix(".txt"), x.read_text()) for x in sorted(folder.iterdir(), key=lambda x: x.name) if x.name.endswith(".txt"))


def all_templates() -> list[tuple[str, str]]:
    return [*TEMPLATES, *full_texts()]


def normal_words(t: tk.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, document and hash of each word that has more than punctuation."""
    start, end, some = tk.trimmed(t, _PUNCTUATION)
    return t.start[some], t.doc[some], tk.segment_hashes(_LOWER[t.bytes], start, end, 0)


def _bigrams(words: np.ndarray) -> np.ndarray:
    return tk.mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])


def dice(a: Counter, b: Counter) -> float:
    n = a.total() + b.total()
    return 2 * (a & b).total() / n if n else 0.0


class Scanner:
    def __init__(self, templates=None) -> None:
        templates = all_templates() if templates is None else templates
        t = tk.read_texts(pa.array([text for _, text in templates], pa.string()))
        _, doc, words = normal_words(t)
        self.names = [name for name, _ in templates]
        grams = [Counter(_bigrams(words[doc == k]).tolist()) if (doc == k).sum() > 1 else Counter() for k in range(len(templates))]
        sizes = np.array([g.total() for g in grams], np.int64)
        self.sizes = sizes
        self.least = np.ceil(sizes * MIN_DICE / (2 - MIN_DICE) - 1e-9).astype(np.int64)
        self.most = np.floor(sizes * (2 - MIN_DICE) / MIN_DICE + 1e-9).astype(np.int64)
        # index: of each bigram the templates that hold it, and how often
        entries = sorted((g, k, c) for k, own in enumerate(grams) for g, c in own.items())
        self.all = np.unique(np.array([g for g, _, _ in entries], np.uint64))
        self.first = np.searchsorted(np.array([g for g, _, _ in entries], np.uint64), self.all) if entries else np.zeros(0, np.int64)
        self.first = np.append(self.first, len(entries))
        self.template = np.array([k for _, k, _ in entries], np.int64)
        self.times = np.array([c for _, _, c in entries], np.int64)

    def scan(self, t: tk.Texts) -> list[dict[str, tuple[float, int]]]:
        """Of each text its licences with the best coefficient, at least MIN_DICE, and the size of the template."""
        _, doc, words = normal_words(t)
        found: list[list[tuple[float, int, int, int, int]]] = [[] for _ in range(len(t.offsets) - 1)]
        if len(words) < 2 or not len(self.all):
            return [{} for _ in found]
        grams = _bigrams(words)
        slot = np.minimum(np.searchsorted(self.all, grams), len(self.all) - 1)
        hits = np.flatnonzero((self.all[slot] == grams) & (doc[1:] == doc[:-1]))
        if not len(hits):
            return [{} for _ in found]
        slot = slot[hits]
        n = self.first[slot + 1] - self.first[slot]
        hit = np.repeat(np.arange(len(hits)), n)
        entry = np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[slot], n)
        group = doc[hits][hit] * len(self.names) + self.template[entry]
        order = np.argsort(group, kind="stable")
        group, at, entry = group[order], hits[hit[order]], entry[order]
        head = np.flatnonzero(np.diff(group, prepend=-1))
        size = np.diff(np.append(head, len(group)))
        enough = size >= self.least[group[head] % len(self.names)]
        for a, b in zip(head[enough].tolist(), (head + size)[enough].tolist()):
            d, k = divmod(int(group[a]), len(self.names))
            best = self._best(k, at[a:b], entry[a:b])
            if best:
                found[d].append((best[0], int(self.sizes[k]), k, best[1], best[2]))
        return [self._told(x) for x in found]

    def _told(self, found: list[tuple[float, int, int, int, int]]) -> dict[str, tuple[float, int]]:
        """The best licences whose passages don't lie over each other."""
        out: dict[str, tuple[float, int]] = {}
        taken: list[tuple[int, int, str]] = []
        for value, size, k, a, b in sorted(found, key=lambda x: (-x[0], -x[1], self.names[x[2]])):
            name = self.names[k]
            if all(b < x or y < a or name == other for x, y, other in taken):
                taken.append((a, b, name))
                out.setdefault(name, (value, size))
        return out

    def _best(self, k: int, at: np.ndarray, entry: np.ndarray) -> tuple[float, int, int] | None:
        """The best coefficient of a passage that begins and ends at one of the shared bigrams, and its first and last place.

        An occurrence counts for the beginnings within reach that have fewer than its bigram's times before it: an interval of
        beginnings, so one sum of interval ends gives how many each could share at most. Only beginnings are looked at that could
        then be better than what was found. From one to the next a bigram that was one too many begins to count.
        """
        m, least, most = int(self.sizes[k]), int(self.least[k]), int(self.most[k])
        if not least:
            return None
        order = np.argsort(entry, kind="stable")
        new = np.diff(entry[order], prepend=-1) != 0
        rank = np.empty(len(at), np.int64)  # of an occurrence among those of its bigram
        head = np.flatnonzero(new)
        rank[order] = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
        times = self.times[entry]
        place = np.empty(len(at), np.int64)
        place[order] = np.arange(len(at))
        earlier = np.where(rank >= times, order[np.maximum(place - times, 0)], -1)
        ends = np.zeros(len(at) + 1, np.int64)
        np.add.at(ends, np.maximum(earlier + 1, np.searchsorted(at, at - most, side="right")), 1)
        ends[1:] -= 1
        could = np.cumsum(ends)[:-1]
        begins = np.flatnonzero(could >= least)
        if not len(begins):
            return None
        bound = 2 * could / (could + m)
        later = place + times  # where in `order` the occurrence stands that begins to count when this one goes
        same = (later < len(at)) & (entry[order[np.minimum(later, len(at) - 1)]] == entry)
        counted = rank < times
        best, where, done = 0.0, (0, 0), 0
        for i in begins.tolist():
            if bound[i] <= best:
                continue
            gone = np.arange(done, i)
            counted[order[later[gone[same[gone]]]]] = True
            done = i
            stop = int(np.searchsorted(at, at[i] + most))
            shared = np.cumsum(counted[i:stop])
            values = 2 * shared / (at[i:stop] - at[i] + 1 + m)
            j = int(np.argmax(values))
            if values[j] > best:
                best, where = float(values[j]), (int(at[i]), int(at[i + j]))
                if best == 1.0:
                    break
        return (best, *where) if best >= MIN_DICE else None


def _scanned(templates: list[tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in tk.gathered(batches):
            found = scanner.scan(tk.read_texts(batch.column("text")))
            best = [min(((-v, -m, name) for name, (v, m) in x.items()), default=None) for x in found]
            arrays = [
                batch.column("doc_id"),
                pa.array([b and b[2] for b in best], pa.string()),
                pa.array([b and round(-b[0], 6) for b in best], pa.float64()),
                pa.array([sorted(x) for x in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "license", "dice", "licenses"])

    return run


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, license, dice, licenses): the best licence of each document and the names of all; templates: (licence, text)."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scan = _scanned(all_templates() if templates is None else templates)
    return bound_batches(slim).mapInArrow(scan, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, license string, dice double, licenses array<string>")


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "license", "dice", F.array_join("licenses", ",").alias("licenses"))
