"""Licence scans: passages compared with licence templates by the Dice coefficient of their word bigrams.

*Passages.* A text is cut into units at line ends and behind ends of sentences; a passage is any run of
units that begins and ends with a unit sharing a bigram with the template. Words are lower-cased runs of
letters or digits, one spelling for licence; bigrams are a set, and a single word counts as one bigram.

*Bounds.* A passage of n bigrams reaches the threshold t against a template of m only if n is between
m t / (2 - t) and m (2 - t) / t, and if it shares at least m t / (2 - t) of them. So a text that does not
hold that many of a template's bigrams anywhere is done with it, and a run ends where it grows too long. Of
runs with one beginning and one bigram set only the shortest is looked at, so that a text of any number of
equal lines costs a few steps a line.

*Choice.* Of overlapping passages the one with the best score stays (ties: the longer template, then the
earlier passage, then the licence's name). The result has a row per passage; a text without one has none.

Null and empty texts have no passages; rows are scanned one by one, so repeated rows repeat their passages,
and a null id is kept. Other columns are ignored. The templates are a parameter, a few texts per licence.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession

from lakemodels.llm.common import map_rows
from lakemodels.llm.plans import PLANS, read

THRESHOLD = 0.8

# Public licence notices and short licence texts, by SPDX identifier.
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_TAIL = (
    "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, "
    "including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, "
    "special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or "
    "services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, "
    "whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use "
    "of this software, even if advised of the possibility of such damage."
)
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. The "
        "Software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the "
        "warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors "
        "or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or "
        "otherwise, arising from, out of or in connection with the Software or the use or other dealings in the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", _BSD_HEAD + _BSD_TAIL],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. " + _BSD_TAIL,
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
}

_UNIT = re.compile(r"[^\n]*?(?:[.!?;](?=[^\S\n])|(?=\n)|\Z)")
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower().replace("licence", "license"))


def bigrams(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:], strict=False)) if len(words) > 1 else {tuple(words)} if words else set()


def dice(left: set, right: set) -> float:
    return 2 * len(left & right) / (len(left) + len(right)) if left or right else 0.0


class Templates:
    """The templates' bigrams, and for each bigram the templates that hold it."""

    def __init__(self, texts: dict[str, list[str]], threshold: float):
        self.threshold = threshold
        self.names, self.sets = [], []
        for name, versions in sorted(texts.items()):
            for version in versions:
                self.names.append(name)
                self.sets.append(bigrams(words_of(version)))
        self.holders: dict[tuple, list[int]] = defaultdict(list)
        for number, held in enumerate(self.sets):
            for bigram in held:
                self.holders[bigram].append(number)
        self.known = frozenset(self.holders)
        # Templates of one word match units of one word.
        self.single = frozenset(b for b in self.holders if len(b) == 1)
        t = threshold
        self.least = [math.ceil(len(s) * t / (2 - t) - 1e-9) for s in self.sets]
        self.most = [math.floor(len(s) * (2 - t) / t + 1e-9) for s in self.sets]

    def candidates(self, text: str) -> list[int]:
        """Templates of which the text holds enough bigrams at all."""
        words = words_of(text)
        found = self.known.intersection(zip(words, words[1:], strict=False))
        if self.single:
            found |= self.single.intersection(zip(words, strict=True))
        counts = Counter(n for bigram in found for n in self.holders[bigram])
        return sorted(n for n, c in counts.items() if c >= self.least[n])

    def scan(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """(start, end, licence, score) of the passages chosen, in order."""
        numbers = self.candidates(text) if text else []
        if not numbers:
            return []
        units = [m.span() for m in _UNIT.finditer(text) if m.end() > m.start()]
        words = [words_of(text[a:b]) for a, b in units]
        full = [i for i, w in enumerate(words) if w]
        units, words = [units[i] for i in full], [words[i] for i in full]
        made = _Units(words)
        passages = [p for number in numbers for p in self._passages(number, made)]
        passages.sort(key=lambda p: (-p[0], -len(self.sets[p[3]]), p[1], p[2], p[3]))
        out = []
        used = bytearray(len(units))
        for score, i, j, number in passages:
            if used.find(1, i, j + 1) < 0:
                used[i : j + 1] = b"\1" * (j + 1 - i)
                start = units[i][0] + len(text[slice(*units[i])]) - len(text[slice(*units[i])].lstrip())
                out.append((start, units[j][1], self.names[number], score))
        return sorted(out)

    def _passages(self, number: int, units: _Units):
        """(score, first unit, last unit, template) of runs of units that reach the threshold.

        Of the runs with one first unit and one bigram set only the shortest is given: the others hold it, score
        alike, and so could never be chosen. Going from the last unit to the first, ``ahead`` keeps the distinct
        bigrams by their next place, the nearest last. A first unit looks at no more of them than a passage may
        hold, so the work is units times passage size however often lines repeat.
        """
        wanted, most, least = self.sets[number], self.most[number], self.least[number]
        own, crossing, single, n = units.own, units.crossing, units.single, len(units.own)
        ahead: dict[tuple[str, ...], int] = {}
        next_near = n
        near_from = [n] * (n + 1)
        for i in range(n - 1, -1, -1):
            into = crossing[i - 1] if i else None
            if i + 1 < n:
                ahead.pop(crossing[i], None)
                ahead[crossing[i]] = i + 1
            for bigram in own[i]:
                ahead.pop(bigram, None)
                ahead[bigram] = i
            is_near = not own[i].isdisjoint(wanted) or crossing[i] in wanted or into in wanted or single[i] in wanted
            if is_near:
                next_near = i
            near_from[i] = next_near
            if not is_near:
                continue
            if not own[i]:
                if least <= 1 <= most and (score := dice({single[i]}, wanted)) >= self.threshold:
                    yield score, i, i, number
            size = shared = at = 0
            for bigram, place in reversed(ahead.items()):
                if place != at and size:
                    if size > most:
                        break
                    if (score := 2 * shared / (size + len(wanted))) >= self.threshold and size >= least:
                        j = near_from[at]
                        if j < place:
                            yield score, i, j, number
                at = place
                size += 1
                shared += bigram in wanted
            else:
                if least <= size <= most and (score := 2 * shared / (size + len(wanted))) >= self.threshold:
                    if (j := near_from[at]) < n:
                        yield score, i, j, number


class _Units:
    """Bigrams of every unit of a text: its own, the one into the next unit, and its word if it has only one."""

    def __init__(self, words: list[list[str]]):
        known: dict[tuple[str, ...], frozenset] = {}
        self.own = []
        for unit in words:
            key = tuple(unit)
            if key not in known:
                known[key] = frozenset(bigrams(unit)) if len(unit) > 1 else frozenset()
            self.own.append(known[key])
        self.crossing = [(w[-1], v[0]) for w, v in zip(words, words[1:], strict=False)] + [None]
        self.single = [tuple(w) if len(w) == 1 else None for w in words]


def scan(documents: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, start, end) of every licence passage in (doc_id, text); code points, end exclusive."""

    def start():
        known = Templates(templates, threshold)

        def work(part):
            out: dict[str, list] = {"doc_id": [], "license": [], "dice": [], "start": [], "end": []}
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                for a, b, name, score in known.scan(text):
                    for key, value in zip(out, (doc_id, name, score, a, b), strict=True):
                        out[key].append(value)
            return out

        return work

    return map_rows(
        documents.select("doc_id", "text"), "doc_id long, license string, dice double, start long, end long", start
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence passage of every document."""
    return scan(read(spark, sf_dir, "documents"))


PLANS["op10_licenses"] = op10_licenses
