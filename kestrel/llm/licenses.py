"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams.

Units of a text are all runs of neighbouring lines (empty ones don't count): single lines, paragraphs, notices of
several paragraphs inside a longer document, hard-wrapped headers, and the whole text. Templates are the notices
below and the complete texts in ``license_texts``, those also by paragraph.

With a and b bigrams in the two multisets, Dice = 2 * common / (a + b) reaches a threshold t only if a lies between
t / (2 - t) * b and (2 - t) / t * b, and only if at least t / (2 - t) * b bigrams of the template are in the unit,
hence in the text: runs are made only for templates that the text as a whole has so much of.

A null or empty text has no licence (null, score 0); equal scores go to the licence name that sorts first;
repeated rows are scanned each; extra columns are dropped; an empty table gives an empty one.
"""

from __future__ import annotations

import pkgutil
import re
from collections import Counter
from functools import cache, lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.batches import id_and_text, map_rows, struct

THRESHOLD = 0.8

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. """
_BSD_3 = _BSD_2 + """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission. """

#: Notices of public licences, (licence, text), several per licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("All-rights-reserved", "All rights reserved."),
    ("BSD-2-Clause", _BSD_2 + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_3 + _BSD_TAIL),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
                "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
                "PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU "
                "General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
)

#: Licences whose complete text is a file in ``license_texts``.
TEXTS = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.0", "LGPL-2.1",
         "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
#: Shorter paragraphs of a complete text (headings, definitions) don't tell a licence.
PARAGRAPH_WORDS = 20

_WORD = re.compile(r"[^\W_]+")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n")


def words(text: str) -> list[str]:
    """Normalised text: lower case, letters and digits only."""
    return _WORD.findall(text.lower())


def bigrams(ws: list[str]) -> Counter:
    return Counter(zip(ws, ws[1:]))


@cache
def all_templates() -> tuple[tuple[str, str], ...]:
    """``TEMPLATES``, the complete texts, and their paragraphs that no other licence has as well."""
    texts = [(name, pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()) for name in TEXTS]
    paragraphs = [(name, p) for name, text in texts for p in _PARAGRAPH.split(text) if len(words(p)) >= PARAGRAPH_WORDS]
    matcher = Matcher(paragraphs, THRESHOLD)
    return (*TEMPLATES, *texts, *((name, p) for name, p in paragraphs if {m[1] for m in matcher.matches(" ".join(words(p)))} == {name}))


class Matcher:
    """Templates as counts of their bigrams."""

    def __init__(self, templates, threshold: float):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must lie in (0, 1]")
        made = [(name, grams) for name, grams in ((name, bigrams(words(text))) for name, text in templates) if grams]
        self.threshold = threshold
        self.names = [name for name, _ in made]
        self.sizes = np.array([sum(grams.values()) for _, grams in made], np.int64)
        self.ids = {w: i for i, w in enumerate(sorted({w for _, grams in made for pair in grams for w in pair}))}
        code = lambda pair: self.ids[pair[0]] * len(self.ids) + self.ids[pair[1]]
        self.codes = np.array(sorted({code(pair) for _, grams in made for pair in grams}), np.int64)
        self.counts = np.zeros((len(self.codes), len(made)), np.int32)
        for i, (_, grams) in enumerate(made):
            self.counts[np.searchsorted(self.codes, [code(pair) for pair in grams]), i] = list(grams.values())
        # rounded to the safe side: what passes is compared exactly
        self.least = np.floor(threshold / (2 - threshold) * self.sizes).clip(1).astype(np.int64)
        self.most = np.ceil((2 - threshold) / threshold * self.sizes).astype(np.int64)

    def _found(self, ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the text's bigrams that some template has, and their rows in ``counts``."""
        get = self.ids.get
        ids = np.array([get(w, -1) for w in ws], np.int64)
        places = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        code = ids[places] * len(self.ids) + ids[places + 1]
        rows = np.searchsorted(self.codes, code).clip(max=len(self.codes) - 1)
        same = self.codes[rows] == code
        return places[same], rows[same]

    def matches(self, text: str) -> list[tuple[float, str, int, int, int]]:
        """(dice, licence, bigrams of the template, first line, last line) of every run of lines and template at or above
        the threshold; lines without words don't count."""
        text = text.lower()
        ws = _WORD.findall(text)
        if len(ws) < 2 or not self.names:
            return []
        places, rows = self._found(ws)
        once, n = np.unique(rows, return_counts=True)
        common = np.zeros(len(self.names), np.int64)
        for k in range(0, len(once), 1024):
            common += np.minimum(self.counts[once[k:k + 1024]], n[k:k + 1024, None]).sum(0)
        candidates = np.flatnonzero(common >= self.least)
        if not len(candidates):
            return []
        lengths = np.array([n for n in (len(_WORD.findall(line)) for line in text.split("\n")) if n], np.int64)
        ends = np.cumsum(lengths)
        return [m for t in candidates for m in self._runs(int(t), places, rows, ends - lengths, ends)]

    def _runs(self, t: int, places: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """The matches of one template. A bigram that the template has c times counts in a run that starts at s if its c-th
        last occurrence before lies in front of s."""
        held = self.counts[rows, t] > 0
        places, rows = places[held], rows[held]
        order = np.argsort(rows, kind="stable")
        back = np.arange(len(rows)) - self.counts[rows[order], t]
        same = (back >= 0) & (rows[order][back.clip(0)] == rows[order])
        before = np.empty(len(rows), np.int64)
        before[order] = np.where(same, places[order][back.clip(0)], -1)
        b, least, most = int(self.sizes[t]), int(self.least[t]), int(self.most[t])
        first, last = np.searchsorted(places, starts), np.searchsorted(places, starts + most)
        # a first line without a bigram of the template only lowers the score
        useful = np.flatnonzero((last - first >= least) & (np.searchsorted(places, ends) > first))
        for i in useful.tolist():
            s, lo, hi = int(starts[i]), int(first[i]), int(last[i])
            shared = np.concatenate(([0], np.cumsum(before[lo:hi] < s)))
            if shared[-1] < least:
                continue
            j0, j1 = np.searchsorted(ends, s + 1 + max(1, least)), np.searchsorted(ends, s + 1 + most, "right")
            a = ends[j0:j1] - s - 1
            dice = 2 * shared[np.searchsorted(places, ends[j0:j1] - 1) - lo] / (a + b)
            for k in np.flatnonzero(dice >= self.threshold).tolist():
                yield float(dice[k]), self.names[t], b, i, int(j0) + k

    def scan(self, text: str) -> tuple[float, str | None]:
        """The best template of any unit."""
        best = min(((-dice, name) for dice, name, *_ in self.matches(text)), default=(0.0, None))
        return -best[0] if best[1] else 0.0, best[1]

    def every(self, text: str) -> list[tuple[str, float]]:
        """(licence, score) of all licences of the text, the best first: of units that share a line the best one counts, of
        equal ones that of the longer template."""
        found = self.matches(text)
        taken = bytearray(max((m[4] for m in found), default=0) + 1)  # lines
        scores: dict[str, float] = {}
        for dice, name, _, i, j in sorted(found, key=lambda m: (-m[0], -m[2], m[1], m[3])):
            if taken.find(1, i, j + 1) < 0:
                taken[i:j + 1] = b"\x01" * (j + 1 - i)
                scores.setdefault(name, dice)
        return sorted(scores.items(), key=lambda x: (-x[1], x[0]))


@lru_cache(1)
def _matcher(templates, threshold: float) -> Matcher:
    return Matcher(templates, threshold)


def scan(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, licence, score): the best template of any unit of the text, null and 0 below the threshold."""
    templates = all_templates() if templates is None else tuple(templates)

    def make():
        matcher = _matcher(templates, threshold)

        def one(doc_id, text):
            score, name = matcher.scan(text)
            return doc_id, name, score

        return one

    return map_rows(id_and_text(docs), make, struct("doc_id long, licence string, score double"))


def every(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, licences): all licences of the text as an array of (licence, score), the best first."""
    templates = all_templates() if templates is None else tuple(templates)

    def make():
        matcher = _matcher(templates, threshold)

        def one(doc_id, text):
            found = matcher.every(text)
            return doc_id, [name for name, _ in found], [score for _, score in found]

        return one

    found = map_rows(id_and_text(docs), make, struct("doc_id long, licences array<string>, scores array<double>"))
    return found.select("doc_id", F.zip_with("licences", "scores", lambda a, b: F.struct(a.alias("licence"), b.alias("score"))).alias("licences"))
