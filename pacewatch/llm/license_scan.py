"""Licence notices by conditional compression.

Around every word that hints at a licence lies a candidate block, wide enough for a whole
template on either side of the word; overlapping blocks are one. A block is compressed alone
and with each template as a raw zstandard dictionary: the more a template shortens it, the more
of the template's wording it holds. Every template that shortens it is then compared with the
block's best passage word by word, so that no licence is named for a likeness of bytes alone.
The passage of the winner is taken out and the rest of the block is scanned again until no
template is confirmed, so a block tells all its licences.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewatch.llm.common import bounded_batches, column_of, given_back, only, texts_of

#: Usual wordings of licence notices, and notices and headers as their publishers
#: give them, without the lines that name a holder. What follows a slash tells wordings of one licence apart.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT": "Released under the MIT License.",
    "MIT/licensed": "Licensed under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MIT-text/whole": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0/header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-2.0/only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1/header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0/header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0/notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0/notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights (CC0 1.0).",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Identifiers that a tag line may name.
IDENTIFIERS = ("Apache-2.0", "MIT", "ISC", "GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.1", "LGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense")
TEMPLATES |= {
    f"{name}/tag{end}": f"SPDX-License-Identifier: {name}{end}"
    for name in IDENTIFIERS
    for end in (("", "-only", "-or-later") if "GPL" in name else ("",))
}
#: Parts of words, in lower case, that open a candidate block. Every template has one.
HINTS = (b"licen", b"copyright", b"permission", b"redistribut", b"warrant", b"creative commons", b"public domain", b"cc by", b"cc0")
#: Words that may be missing, changed or put in, as a share of a template's words.
DIFFERENT = 0.1
#: Templates up to so many words share the width of their blocks; longer ones share another.
WIDTHS = (30, 90)
#: Blocks longer than so many widths are scanned in pieces that overlap by one width.
PIECE = 4

_WORDS = re.compile(rb"[^\s,;:.()\"']+(?:[.-][^\s,;:.()\"']+)*")
_SPOKEN = re.compile(rb"[a-z0-9\x80-\xff]")
#: Words that tell licences of the same wording apart: none may be missing, changed or put in.
_TELLING = re.compile(rb"\d\.\d|^(?:attribution.*|lesser|library|affero)$")
_NEVER = 1 << 20


def wording(text: bytes) -> list[bytes]:
    """Words in lower case without marks at their ends; marks alone, as before comment lines, are none."""
    folded = _folded(text)
    return [folded[a:b] for a, b in _places(folded)]


def _folded(text: bytes) -> bytes:
    """Lower case, one spelling of licence, plain spaces for curly quotes; places stay."""
    text = text.lower().replace(b"licence", b"license")
    for mark in "“”‘’":
        text = text.replace(mark.encode(), b"   ")
    return text


def _places(folded: bytes) -> list[tuple[int, int]]:
    return [m.span() for m in _WORDS.finditer(folded) if _SPOKEN.search(m[0])]


def prices(words: list[bytes]) -> np.ndarray:
    """What a difference in each word costs: one, or more than any template allows."""
    tells = [bool(_TELLING.search(w)) or (w.isdigit() and i > 0 and words[i - 1] in (b"version", b"v")) for i, w in enumerate(words)]
    return np.where(tells, _NEVER, 1).astype(np.int64)


def edits(block: np.ndarray, cost: np.ndarray, template: np.ndarray, price: np.ndarray, anchored: bool = False) -> np.ndarray:
    """Least cost of turning the template into words of the block that end before each place.

    A passage may start anywhere, or at the first word if ``anchored``.
    """
    added = np.r_[0, np.cumsum(cost)]
    row = added.copy() if anchored else np.zeros(len(block) + 1, np.int64)
    for word, lost in zip(template, price):
        other = np.where(block == word, 0, np.maximum(cost, lost))
        here = row + lost
        here[1:] = np.minimum(here[1:], row[:-1] + other)
        row = np.minimum.accumulate(here - added) + added
    return row


@dataclass
class Match:
    first: int  # words of the text
    last: int
    license: str
    reduction: float  # share of the block's compressed size that the template saves
    differences: int  # words missing, changed or put in; all words if a telling one is among them
    confirmed: bool


class Template:
    def __init__(self, name: str, words: list[bytes], numbers: dict[bytes, int]):
        self.license = name.partition("/")[0]
        self.name = name
        self.size = len(words)
        self.allowed = int(DIFFERENT * len(words))
        self.ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
        self.price = prices(words)
        shared = zstandard.ZstdCompressionDict(b" ".join(words), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=19, write_content_size=False, write_checksum=False, dict_data=shared)


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.hint = re.compile(b"|".join(map(re.escape, HINTS)))
        self.plain = zstandard.ZstdCompressor(level=19, write_content_size=False, write_checksum=False)
        self.numbers: dict[bytes, int] = {}
        made = [Template(name, wording(text.encode()), self.numbers) for name, text in sorted(templates.items())]
        for t in made:
            if not self.hint.search(_folded(templates[t.name].encode())):
                raise ValueError(f"template {t.name} holds none of the words that open a block")
        # Longest first: a whole text is found before the sentence that it shares with others.
        edges = (0, *WIDTHS, 1 << 30)
        groups = [[t for t in made if a < t.size <= b] for a, b in zip(edges, edges[1:])]
        self.groups = [(g, max(t.size + t.allowed for t in g)) for g in reversed(groups) if g]
        self.counts = {
            t.name: np.bincount(t.ids, minlength=len(self.numbers)) for t in made
        }

    @staticmethod
    def blocks(hints: list[int], n: int, width: int) -> list[tuple[int, int]]:
        """(first, end) of the words around each hint, a template's width on either side; overlapping ones merged."""
        out: list[tuple[int, int]] = []
        for at in hints:
            first, end = max(0, at - width), min(n, at + width + 1)
            if out and first <= out[-1][1]:
                out[-1] = (out[-1][0], end)
            else:
                out.append((first, end))
        return out

    @staticmethod
    def pieces(first: int, end: int, width: int) -> Iterator[tuple[int, int]]:
        """Parts of a block; each passage of a width lies whole in one of them."""
        while end - first > PIECE * width:
            yield first, first + PIECE * width
            first += (PIECE - 1) * width
        yield first, end

    def reductions(self, block: bytes, group: list[Template]) -> list[tuple[float, Template]]:
        """Share saved by each template, best first; ties by name."""
        size = len(self.plain.compress(block))
        saved = [((size - len(t.compressor.compress(block))) / size, t) for t in group]
        return sorted(saved, key=lambda x: (-x[0], x[1].name))

    def scan(self, text: bytes) -> list[Match]:
        folded = _folded(text)
        if not self.hint.search(folded):
            return []
        places = _places(folded)
        if not places:
            return []
        begins = [a for a, _ in places]
        words = [folded[a:b] for a, b in places]
        raw = [m.end() for m in re.finditer(rb"[^\x20\x09-\x0d]+", text)]
        hints = sorted({max(0, bisect.bisect_right(begins, m.start()) - 1) for m in self.hint.finditer(folded)})
        ids = np.array([self.numbers.get(w, -1) for w in words], np.int64)
        cost = prices(words)
        free = np.ones(len(words), bool)

        def match(a: int, z: int, *rest) -> Match:
            return Match(bisect.bisect_right(raw, places[a][0]), bisect.bisect_right(raw, places[z - 1][0]), *rest)

        found = []
        for group, width in self.groups:
            for block in self.blocks(hints, len(words), width):
                for piece in self.pieces(*block, width):
                    while (best := self.confirmed(words, ids, cost, free, *piece, group)) is not None:
                        a, z, saved, template, differences = best
                        free[a:z] = False
                        found.append((a, match(a, z, template.license, saved, differences, True)))
        # Blocks without a confirmed passage: the template that saves most, as a guess.
        group, width = self.groups[-1]
        for first, end in self.blocks(hints, len(words), width):
            if free[first:end].all():
                for a, z in self.pieces(first, end, width):
                    saved, template = self.reductions(b" ".join(words[a:z]), group)[0]
                    differences = int(min(template.size, edits(ids[a:z], cost[a:z], template.ids, template.price).min()))
                    found.append((a, match(a, z, template.license, saved, differences, False)))
        return [m for _, m in sorted(found, key=lambda x: (x[0], x[1].last, x[1].license))]

    def confirmed(self, words, ids, cost, free, first, end, group) -> tuple[int, int, float, Template, int] | None:
        """(first, end, reduction, template, differences) of the confirmed template with most words in place."""
        at = first + np.flatnonzero(free[first:end])
        if not len(at):
            return None
        present = np.bincount(ids[at][ids[at] >= 0], minlength=len(self.numbers))
        # No passage goes across what was taken out before.
        gaps = np.flatnonzero(np.diff(at) > 1) + 1
        block = np.insert(ids[at], gaps, -2)
        price = np.insert(cost[at], gaps, _NEVER)
        where = np.insert(at, gaps, -1)
        best = None
        for saved, t in self.reductions(b" ".join(words[i] for i in at), group):
            # A passage lacks at least the words that the block lacks.
            if saved <= 0 or np.minimum(present, self.counts[t.name]).sum() < t.size - t.allowed:
                continue
            ends = edits(block, price, t.ids, t.price)
            z = int(ends.argmin())
            differences = int(ends[z])
            if differences > t.allowed or (best is not None and t.size - differences <= best[0]):
                continue
            length = int(edits(block[:z][::-1], price[:z][::-1], t.ids[::-1], t.price[::-1], anchored=True).argmin())
            best = (t.size - differences, (int(where[z - length]), int(where[z - 1]) + 1, saved, t, differences))
        return None if best is None else best[1]


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document: (doc_id, n_blocks, matches).

    ``matches`` lists, in the order of the whole text, every passage that a template's wording
    confirms, and every candidate block without one with the template that saves most of it:
    first and last word, the share of compressed size saved, the number of differing words,
    and whether it is confirmed. A notice all of whose hinting words are changed opens no
    block. Null and empty texts have none. Repeated rows are scanned each. Other columns are
    not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(TEMPLATES if templates is None else templates))
    kind = "array<struct<first:int,last:int,license:string,reduction:double,differences:int,confirmed:boolean>>"
    arrow = pa.list_(
        pa.struct(
            [
                ("first", pa.int32()), ("last", pa.int32()), ("license", pa.string()),
                ("reduction", pa.float64()), ("differences", pa.int32()), ("confirmed", pa.bool_()),
            ]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for batch in given_back(batches):
            found = [[vars(m) for m in scanner.scan(text)] for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(map(len, found), pa.int32()), pa.array(found, arrow)],
                names=["doc_id", "n_blocks", "matches"],
            )

    bounded_batches(docs.sparkSession)
    return only(docs, doc_id="long", text="string").mapInArrow(run, f"doc_id long, n_blocks int, matches {kind}")


def licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``license_matches`` with ``licenses``, the sorted names that the wording confirms."""
    sure = F.filter("matches", lambda m: m["confirmed"])
    return license_matches(docs, templates).withColumn("licenses", F.array_sort(F.array_distinct(F.transform(sure, lambda m: m["license"]))))
