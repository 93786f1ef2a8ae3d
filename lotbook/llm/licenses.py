"""License scans: passages of a text against license templates, by Dice over word bigrams."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lotbook.llm.common import text_of

#: Least Dice coefficient of a match.
LEAST = 0.8

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain "
    "the above copyright notice, this list of conditions and the following disclaimer. 2. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_NO_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission. "
)
_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND "
    "ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Notices and grants of public licenses, in their published wording.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the 3-clause BSD License."),
    ("BSD-2-Clause", "Released under the 2-clause BSD License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License version 2 as published by the Free Software "
        "Foundation.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    ("BSD-2-Clause", _BSD + _DISCLAIMER),
    ("BSD-3-Clause", _BSD + _NO_ENDORSEMENT + _DISCLAIMER),
)

_WORD = re.compile(r"[a-z0-9]+(?:[.][0-9]+)*")
_CLOSING = re.compile(r"[.,;:!?)\]\"'>]*")
_PARAGRAPH = re.compile(r"(?:[^\n]*\S[^\n]*(?:\n|\Z))+")


def normalised(text: str) -> list[str]:
    """Words in lower case, without marks; version numbers stay whole."""
    return _WORD.findall(text.lower())


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))  # noqa: B905


class Templates:
    """Templates by the size of their bigram sets, and words of which every match holds one."""

    def __init__(self, templates: tuple[tuple[str, str], ...], least: float):
        self.least = least
        known: dict[frozenset, tuple[str, frozenset]] = {}
        for name, text in templates:
            grams = frozenset(bigrams(normalised(text)))
            if grams:
                known.setdefault(grams, (name, grams))
        self.all = sorted(known.values(), key=lambda t: (len(t[1]), t[0], sorted(t[1])))
        self.index: dict[tuple[str, str], list[int]] = {}
        for k, (_, grams) in enumerate(self.all):
            for gram in grams:
                self.index.setdefault(gram, []).append(k)
        words: dict[frozenset, int] = {}
        for _, text in templates:
            found = normalised(text)
            words.setdefault(frozenset(bigrams(found)), len(found))
        #: Words of the longest window for each template.
        self.longest = [int(words[g] * (2 - least) / least) for _, g in self.all]
        self.largest = max((len(g) for _, g in self.all), default=0) * (2 - least) / least
        self.anchors = sorted(self._anchors())
        self._anchor = re.compile(
            r"(?<![a-z0-9])(?:" + "|".join(map(re.escape, self.anchors)) + r")(?![a-z0-9])"
        )

    def possible(self, text: str) -> bool:
        """False only where no passage can match: every match holds an anchor word."""
        low = text.lower()
        return any(word in low for word in self.anchors) and bool(self._anchor.search(low))

    def _anchors(self) -> set[str]:
        """Words such that a match misses at least one bigram of them only below the bar.

        Greedily the words that hold most bigrams of the templates, long ones (rare in texts) first, until every template has
        more than the share a match may lack covered by them.
        """
        chosen: set[str] = set()
        for _, grams in self.all:
            # Dice >= least needs at least this many of the template's bigrams.
            needed = self.least / (2 - self.least) * len(grams)
            left = {g for g in grams if not chosen & set(g)}
            while len(left) >= needed:
                words = sorted({w for g in left for w in g})
                best = max(words, key=lambda w: (len(w) >= 6, sum(w in g for g in left), len(w), w))
                chosen.add(best)
                left = {g for g in left if best not in g}
        return chosen

    def best(self, words: list[str]) -> tuple[str, float] | None:
        grams = bigrams(words)
        size = len(grams)
        if not size or size > self.largest:
            return None
        found, top = None, self.least
        for name, wanted in self.all:
            # 2 * min / (sum) bounds the coefficient by the sizes alone.
            if 2 * min(size, len(wanted)) < top * (size + len(wanted)):
                continue
            dice = 2 * len(grams & wanted) / (size + len(wanted))
            if dice > top or (dice == top and found is None):
                found, top = name, dice
        return None if found is None else (found, top)


@lru_cache(maxsize=4)
def _templates(templates: tuple[tuple[str, str], ...], least: float) -> Templates:
    return Templates(templates, least)


def find_licenses(text: str, templates: Templates) -> list[tuple[str, float, int, int]]:
    """(license, Dice, start, end) of the passages that match, by start.

    A passage is each line by itself, or a paragraph (lines without a blank one between) where
    that fits better than any of its lines. Offsets are code points, the end exclusive.
    """
    if not templates.possible(text):
        return []
    found = []
    for paragraph in _PARAGRAPH.finditer(text):
        start, block = paragraph.start(), paragraph.group()
        if not templates.possible(block):
            continue
        lines = block.splitlines(keepends=True)
        hits, at = [], start
        for line in lines:
            if templates.possible(line) and (hit := templates.best(normalised(line))):
                lead = len(line) - len(line.lstrip())
                hits.append((*hit, at + lead, at + len(line.rstrip())))
            at += len(line)
        whole = templates.best(normalised(block)) if len(lines) > 1 else None
        if whole and whole[1] > max((h[1] for h in hits), default=0.0):
            hits = [(*whole, start, start + len(block.rstrip()))]
        found += hits
    return found


def _folded(text: str) -> str:
    """Lower case, character by character where that alone keeps the offsets."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def windows(words: list[str], templates: Templates) -> Iterator[tuple[float, int, str, int, int]]:
    """(Dice, bigrams, license, first word, last word): for each template and each word that may
    start a match, the window that fits best.

    A window starts and ends with bigrams of the template, as others at its ends only lower the
    coefficient. It counts as many bigrams as the template at least, so that a notice of another
    version does not match by its beginning alone.
    """
    grams = list(zip(words, words[1:]))  # noqa: B905
    places: dict[int, list[int]] = {}
    for i, gram in enumerate(grams):
        for k in templates.index.get(gram, ()):
            places.setdefault(k, []).append(i)
    for k, at in places.items():
        name, wanted = templates.all[k]
        needed = max(1, math.ceil(templates.least * len(wanted) - 1e-9))
        reach = templates.longest[k] - 1
        for n in range(len(at) - needed + 1):
            start = at[n]
            if at[n + needed - 1] >= start + reach:
                continue
            seen: set[tuple[str, str]] = set()
            common, found = 0, None
            for i in range(start, min(start + reach, len(grams))):
                gram = grams[i]
                if gram in seen:
                    continue
                seen.add(gram)
                if gram in wanted:
                    common += 1
                    dice = 2 * common / (max(len(seen), len(wanted)) + len(wanted))
                    if dice >= templates.least and (found is None or dice > found[0]):
                        found = dice, len(seen), name, start, i + 1
            if found:
                yield found


def find_passages(text: str, templates: Templates) -> list[tuple[str, float, int, int]]:
    """(license, Dice, start, end) of the passages that match, by start: lines, paragraphs, and
    windows of words anywhere in the text, whatever its line breaks.

    Of passages that overlap the best stays: by the coefficient, and the longer one if that is
    about the same.
    """
    if not templates.possible(text):
        return []
    hits = []
    for name, dice, start, end in find_licenses(text, templates):
        size = len(bigrams(normalised(text[start:end])))
        hits.append((-(dice**4) * size, 0, start, end, name, dice))
    low = _folded(text)
    spans = [m.span() for m in _WORD.finditer(low)]
    words = [low[a:b] for a, b in spans]
    for dice, size, name, first, last in windows(words, templates):
        end = _CLOSING.match(text, spans[last][1]).end()
        hits.append((-(dice**4) * size, 1, spans[first][0], end, name, dice))
    chosen: list[tuple[int, int, str, float]] = []
    for _, _, start, end, name, dice in sorted(hits):
        place = bisect_left(chosen, (start,))
        before = place == 0 or chosen[place - 1][1] <= start
        if before and (place == len(chosen) or end <= chosen[place][0]):
            chosen.insert(place, (start, end, name, dice))
    return [(name, dice, start, end) for start, end, name, dice in chosen]


def scan(
    text: Column,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    least: float = LEAST,
) -> Column:
    """array<struct(license, dice, start, end)> of each text; empty where nothing matches."""

    @pandas_udf("array<struct<license:string,dice:double,start:bigint,end:bigint>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _templates(templates, least)
        names = ("license", "dice", "start", "end")
        for texts in batches:
            yield pd.Series(
                [
                    [dict(zip(names, hit, strict=True)) for hit in find_passages(t or "", known)]
                    for t in texts
                ],
                dtype=object,
            )

    return run(text)


def license_matches(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_matches, its licenses (distinct, in order of
    name, comma-joined), the best coefficient (null without a match) and every match's span as
    ``license:start:end``.

    Null text counts as empty and matches nothing; null ids stay; repeated rows give repeated
    results; other columns are ignored; an empty table gives no rows. Ties between templates go
    to the smaller one, then by name. No shuffle; memory holds one Arrow batch.
    """
    found = docs.select("doc_id", scan(text_of()).alias("found"))
    spans = F.transform(
        "found", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"])
    )
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_matches"),
        F.concat_ws(",", F.array_sort(F.array_distinct("found.license"))).alias("licenses"),
        F.array_max("found.dice").alias("best_dice"),
        F.concat_ws(",", spans).alias("spans"),
    )
