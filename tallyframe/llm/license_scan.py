"""License scan: winnowed fingerprints, inverted index, banded alignment (operator 3).

Templates and texts are cut into grams of GRAM words, and winnowing picks the smallest hash of every
window of grams: any run of words that a text shares with a template and that is as long as window and
gram together shares a picked fingerprint.  Where at least a share of a template's words align, at
most the rest is missing, which cuts the matched words into so many runs at most; the longest of these
gives the template its window.  The picked fingerprints stand in an inverted index fingerprint ->
(template, position).  Templates too short to be sure of a shared gram are looked up by their words
instead: of one word more than may be missing, one is matched.

A hit puts text and template on a diagonal.  Where enough of the template's words stand close enough
together about it, a banded alignment reports how many template words are matched, the coverage, and the
span in the text.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .hashing import Words, byte_table, mix64, slices, texts

#: Words of a fingerprint, and most fingerprints that one is picked of.
GRAM, MOST_WINDOW = 3, 8
#: Words of the shortest template that is looked for.
LEAST_WORDS = 3
#: Words by which an alignment may leave its diagonal at least; as many more as may be missing.
BAND = 8
#: Templates are a fixed parameter of bounded size, held by every task.
MAX_TEMPLATES = 10_000

# Public license lines, notices and whole short texts.
_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_GNU = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. You should have "
    "received a copy of the GNU {0} along with this program. If not, see <https://www.gnu.org/licenses/>.")
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied."),
    "MIT": "Released under the MIT License",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0-1.0": (
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this "
        "work to the public domain worldwide under the CC0 1.0 Universal Public Domain Dedication"),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."),
    "BSD-2-Clause-text": _BSD_2 + _WARRANTY,
    "BSD-3-Clause-text": (
        _BSD_2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. " + _WARRANTY),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."),
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version. " + _GNU.format("General Public License")),
    "LGPL-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version. " + _GNU.format("Lesser General Public License")),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. " + _GNU.format("Affero General Public License")),
}


def _align(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """Best local alignment within band of the diagonal text = template + shift: matched template
    words and the first and last matched word of the text.  A match scores 2, a mismatch or a gap
    -1; the band is advanced one template word at a time, all its cells at once."""
    width, n = 2 * band + 1, len(text)
    place = np.arange(width) + shift - band  # of the band's cells in the text, for the first word
    cells, best = np.arange(width), (0, 0, -1, -1)
    score, count, first, last = np.zeros(width, np.int64), np.zeros(width, np.int64), np.full(width, -1), np.full(width, -1)
    for word in template:
        inside = (place >= 0) & (place < n)
        if place[0] >= n:
            break
        if place[-1] >= 0:
            same = inside & (text[np.clip(place, 0, n - 1)] == word) if n else inside
            # from above: the band moves on with the template, so the next cell of the last row
            up_score = np.append(score[1:], 0) - 1
            began = np.where((first < 0) | (score == 0), place, first)
            now = np.where(same, score + 2, np.where(score > 1, score - 1, 0))
            begin = np.where(same, began, first)
            number, end = count + same, np.where(same, place, last)
            above = up_score > now
            shifted = lambda x: np.append(x[1:], 0)
            now = np.where(above, up_score, now)
            begin, number, end = (np.where(above, shifted(x), y) for x, y in ((first, begin), (count, number), (last, end)))
            now = np.where(inside & (now > 0), now, 0)
            # from the left: the best cell before, a point less for each step (the nearest of equals)
            reach = np.maximum.accumulate((now + cells) * width + cells)
            source = reach % width
            best_left = reach // width - cells
            left = best_left > now
            source = np.where(left & inside, source, cells)
            score = np.where(inside, np.maximum(now, best_left), 0)
            score = np.where(score > 0, score, 0)
            first, count, last = (np.where(score > 0, x[source], y) for x, y in ((begin, -1), (number, 0), (end, -1)))
            top = int(score.max())
            if top > best[0] or top and top == best[0]:
                of = np.flatnonzero(score == top)
                at = int(of[np.argmin(first[of])])
                if top > best[0] or first[at] < best[2]:
                    best = (top, int(count[at]), int(first[at]), int(last[at]))
        place = place + 1
    return best[1], best[2], best[3]


def _grams(words: np.ndarray) -> np.ndarray:
    """Hash of the GRAM words from each word on."""
    n = max(0, len(words) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    for j in range(GRAM):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + words[j:j + n])
    return out


def _picked(hashes: np.ndarray, window: int) -> np.ndarray:
    """Winnowing: places of the smallest hash of every ``window`` neighbours (the last of equals)."""
    n = len(hashes)
    if window == 1 or n <= 1:
        return np.arange(n)
    size = min(window, n)
    best = np.arange(n - size + 1) + size - 1
    for back in range(1, size):
        other = np.arange(n - size + 1) + size - 1 - back
        best = np.where(hashes[other] < hashes[best], other, best)
    return np.unique(best)


class _Index:
    def __init__(self, templates: Mapping[str, str], least: float):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"at most {MAX_TEMPLATES} templates")
        self.names = list(templates)
        words = Words(*texts(pa.array(list(templates.values()), pa.large_string())), byte_table("alnum"))
        self.words = [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        bags = [np.unique(w, return_counts=True) for w in self.words]
        self.known, self.df = np.unique(np.concatenate([np.zeros(0, np.uint64), *[g for g, _ in bags]]), return_counts=True)
        # words that must be matched: the least n with n >= least * length
        self.need = [next(n for n in range(len(w) + 2) if n >= least * len(w)) for w in self.words]
        #: by known word: {template: (times, positions that are looked up)}
        self.places: list[dict[int, tuple[int, list[int]]]] = [{} for _ in self.known]
        #: fingerprint -> [(template, position)], and the window of winnowing, by it the templates
        self.prints: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for t, (own, (distinct, times)) in enumerate(zip(self.words, bags)):
            if len(own) < LEAST_WORDS or self.need[t] > len(own):
                continue
            ids, need = np.searchsorted(self.known, own), max(1, self.need[t])
            for x, n in zip(np.searchsorted(self.known, distinct).tolist(), times.tolist()):
                self.places[x][t] = (n, [])
            # missing words cut the matched ones into runs; the longest has at least so many
            run = -(-need // (len(own) - need + 1))
            if run < GRAM:
                for p in sorted(np.argsort(self.df[ids], kind="stable")[:len(own) - need + 1].tolist()):
                    self.places[ids[p]][t][1].append(p)
                continue
            index = self.prints.setdefault(min(MOST_WINDOW, run - GRAM + 1), {})
            grams = _grams(own)
            for p in _picked(grams, min(MOST_WINDOW, run - GRAM + 1)).tolist():
                index.setdefault(int(grams[p]), []).append((t, p))
        self.anchor = np.array([any(p for _, p in x.values()) for x in self.places], bool)
        self.keys = {w: np.array(sorted(index), np.uint64) for w, index in self.prints.items()}

    def hits(self, words: np.ndarray, at: np.ndarray) -> dict[int, set[int]]:
        """By template, the diagonals (word of the text less word of the template) on which a picked
        fingerprint or a looked-up word of one text stands."""
        out: dict[int, set[int]] = {}
        grams = _grams(words)
        for window, keys in self.keys.items():
            picked = _picked(grams, window)
            place = np.minimum(np.searchsorted(keys, grams[picked]), len(keys) - 1)
            for j in picked[keys[place] == grams[picked]].tolist():
                for t, p in self.prints[window][int(grams[j])]:
                    out.setdefault(t, set()).add(j - p)
        for j in np.flatnonzero((at >= 0) & self.anchor[at]).tolist() if len(self.known) else ():
            for t, (_, positions) in self.places[at[j]].items():
                for p in positions:
                    out.setdefault(t, set()).add(j - p)
        return out

    def of(self, words: np.ndarray) -> np.ndarray:
        """Place of each word among the known ones, or -1."""
        if not len(self.known):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        return np.where(self.known[at] == words, at, -1)

    def matches(self, words: np.ndarray, at: np.ndarray, least: float) -> Iterator[tuple]:
        """(template, matched, first, last) of one text, not overlapping for one template."""
        for t, shifts in sorted(self.hits(words, at).items()):
            yield from self._of_template(t, words, at, sorted(shifts), least)

    def _of_template(self, t: int, words: np.ndarray, at: np.ndarray, shifts: list[int], least: float) -> Iterator[tuple]:
        own, need = self.words[t], max(1, self.need[t])
        band = len(own) - need + BAND  # dropped words leave the anchor's diagonal
        mine = np.array([t in x for x in self.places], bool)
        hits = np.flatnonzero((at >= 0) & mine[at])
        if len(hits) < need:
            return
        # an alignment spans no more words than the template and the band's width
        close = np.flatnonzero(hits[need - 1:] - hits[:len(hits) - need + 1] < len(own) + 2 * band)
        if not len(close):
            return
        inside = np.zeros(len(hits) + 1, np.int64)
        np.add.at(inside, close, 1)
        np.add.at(inside, close + need, -1)
        hits = hits[np.cumsum(inside)[:-1] > 0]
        # diagonals with such a word within the band about the template
        reach = np.searchsorted(hits, [s - band for s in shifts]) < np.searchsorted(hits, [s + len(own) + band for s in shifts])
        shifts = [s for s, near in zip(shifts, reach.tolist()) if near]
        done, end = None, -1
        for shift in shifts:
            # the last alignment's band covers close diagonals, but for a repeat after its end
            if done is not None and shift - done <= BAND // 2 and not -1 < end < shift:
                continue
            done = shift
            for n, first, last in self._places(
                    own, words, shift, max(0, shift - band, end + 1), shift + len(own) + band, band, least):
                yield t, n, first, last
                end = last

    def _places(self, own, words, shift: int, lo: int, hi: int, band: int, least: float) -> Iterator[tuple]:
        """Alignments about a diagonal in words lo to hi: the best one and those before and after it."""
        n, first, last = _align(own, words[lo:max(lo, hi)], shift - lo, band)
        if not n or n < least * len(own):
            return
        yield from self._places(own, words, shift, lo, lo + first, band, least)
        yield n, lo + first, lo + last
        yield from self._places(own, words, shift, lo + last + 1, hi, band, least)


def _scan(batches, templates: Mapping[str, str], least: float):
    index, table = _Index(templates, least), byte_table("alnum")
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(*texts(batch.column("text")), table)
            at = index.of(words.hash)
            # texts that hold any fingerprint or looked-up word at all
            known = np.flatnonzero((at >= 0) & index.anchor[at]) if len(index.known) else np.zeros(0, np.int64)
            grams = _grams(words.hash)
            for keys in index.keys.values():
                place = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
                known = np.append(known, np.flatnonzero(keys[place] == grams))
            rows = []
            for d in np.unique(np.searchsorted(words.first, known, side="right") - 1):
                lo, hi = words.first[d], words.first[d + 1]
                begin = words.offsets[d]
                for t, n, a, b in index.matches(words.hash[lo:hi], at[lo:hi], least):
                    chars = [len(words.data[begin:x].tobytes().decode()) for x in (words.start[lo + a], words.end[lo + b])]
                    rows.append((batch.column("id")[int(d)].as_py(), index.names[t], len(index.words[t]), n,
                                 n / len(index.words[t]), int(a), int(b) + 1, *chars))
            cols = list(zip(*rows)) if rows else [()] * 9
            kinds = [batch.schema.field("id").type, pa.string(), *[pa.int64()] * 2, pa.float64(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [
                "id", "license", "template_words", "matched_words", "coverage", "start_word", "end_word",
                "start_char", "end_char"])


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None, id_col: str = "doc_id",
                  text_col: str = "text", coverage: float = 0.8) -> DataFrame:
    """One row per license text found: ``id_col, license, template_words, matched_words, coverage,
    start_word, end_word, start_char, end_char`` (ends exclusive; words are runs of ASCII letters,
    digits and other characters over 127, A-Z folded; characters are code points).

    A template is reported where at least ``coverage`` of its words align; of overlapping finds of
    one template the first is.  Defined results: null or empty texts have no license; every repeat
    in a text and every repeated row is reported; an empty table gives no row; other columns are
    ignored; a template of fewer than three words is never found.
    """
    chosen = dict(TEMPLATES if templates is None else templates)
    narrow = docs.selectExpr(f"`{id_col}` as id", f"`{text_col}` as text")
    id_type = narrow.schema["id"].dataType.simpleString()
    found = narrow.mapInArrow(lambda it: _scan(it, chosen, coverage), (
        f"id {id_type}, license string, template_words bigint, matched_words bigint, coverage double, "
        "start_word bigint, end_word bigint, start_char bigint, end_char bigint"))
    return found.withColumnRenamed("id", id_col)
