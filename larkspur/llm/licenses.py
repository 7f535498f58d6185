"""License scan: winnowed fingerprints pick templates, banded alignment measures the match.

Words are runs of letters and digits, compared without case.  A template's fingerprints are the minimum
k-gram hashes of its sliding windows, kept in an inverted index (fingerprint -> template and
place).  A text's fingerprints that are in the index give hits; hits of one template near one diagonal are
one candidate place, and a banded alignment of the template with the words around it gives the
matched template words.  A candidate with at least ``LEAST_COVERAGE`` of the template's words, that are
``LEAST_DENSITY`` of the words they span, is reported with its span; of overlapping reports the one with most matched less missing template words stays.

The words that tell one license from another, its name and version, stand in braces in a template.  Each such phrase
must be in the matched span, word by word: a share of matched words cannot tell "the MIT License" from "the Sony license".

Templates are a bounded table that every task holds; texts are worked on where they are read.

Defined cases: a null or empty text has no match; positions are code points, end exclusive; ties between overlapping
matches of one length go to the earlier name; repeated passages are all reported; ids may repeat or be null; extra
columns stay out; no rows give no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import store
from larkspur.llm.words import Hasher, alphanumeric, byte_values, mix, runs

GRAM, WINDOW = 3, 2              # every match of GRAM + WINDOW - 1 words or more has a common fingerprint
LEAST_COVERAGE = 0.8
LEAST_DENSITY = 0.6              # of the words in a match's span, how many are the template's
BAND = 6                         # diagonals on each side, besides a tenth of the template

# In braces: phrases that a match must hold.
# Whole public license notices, their opening parts, and the usual one-line references to them.
_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
    BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
    THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
    (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
    HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
    ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
    IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
    CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
    NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


def _gnu(kind: str, what: str, version: str) -> str:
    """The notice of a GNU license in a source file."""
    address = ("If not, see <https://www.gnu.org/licenses/>." if version == "3" else
               "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.")
    return f"""This {what} is free software: you can redistribute it and/or modify it under the terms of the {{GNU {kind} Public License}} as
        published by the Free Software Foundation, either {{version {version}}} of the License, or (at your option) any later version. This {what}
        is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details. You should have received a copy of the GNU {kind}
        Public License along with this {what}. {address}"""


TEMPLATES = {
    "apache-2.0-header": """Licensed under the {Apache License, Version 2.0} (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "apache-2.0-line": "Licensed under the {Apache License, Version 2.0}.",
    "bsd-2-clause-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    "cc-by-line": "This work is licensed under a {Creative Commons Attribution 4.0} International License.",
    "cc-by-nc-line": "Licensed under {CC BY-NC 4.0}.",
    "gpl-3.0-header-opening": """This program is free software: you can redistribute it and/or modify it under the terms of the {GNU General
        Public License} as published by the Free Software Foundation, either {version 3} of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    "gpl-3.0-line": "This work is licensed under the {GNU General Public License, version 3}.",
    "isc-grant": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit-grant": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software.""",
    "mit-line": "Released under the {MIT License}.",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense-line": "This is {free and unencumbered software} released into the public domain.",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
            + _ISC_DISCLAIMER,
    "agpl-3.0-header": _gnu("Affero General", "program", "3"),
    "gpl-2.0-header": _gnu("General", "program", "2"),
    "gpl-3.0-header": _gnu("General", "program", "3"),
    "lgpl-2.1-header": _gnu("Lesser General", "library", "2.1"),
    "lgpl-3.0-header": _gnu("Lesser General", "program", "3"),
    "agpl-3.0-line": "This work is licensed under the {GNU Affero General Public License, version 3}.",
    "gpl-2.0-line": "This work is licensed under the {GNU General Public License, version 2}.",
    "lgpl-2.1-line": "This work is licensed under the {GNU Lesser General Public License, version 2.1}.",
    "lgpl-3.0-line": "This work is licensed under the {GNU Lesser General Public License, version 3}.",
    "bsd-line": "Released under the {BSD License}.",
    "isc-line": "Released under the {ISC License}.",
    "cc-by-short-line": "Licensed under {CC BY 4.0}.",
    "cc-by-sa-short-line": "Licensed under {CC BY-SA 4.0}.",
    "cc-by-nd-short-line": "Licensed under {CC BY-ND 4.0}.",
    "cc-by-nc-sa-short-line": "Licensed under {CC BY-NC-SA 4.0}.",
    "cc-by-nc-nd-short-line": "Licensed under {CC BY-NC-ND 4.0}.",
    "cc-by-sa-line": "This work is licensed under a {Creative Commons Attribution-ShareAlike 4.0} International License.",
    "cc-by-nd-line": "This work is licensed under a {Creative Commons Attribution-NoDerivatives 4.0} International License.",
    "cc-by-nc-long-line": "This work is licensed under a {Creative Commons Attribution-NonCommercial 4.0} International License.",
    "cc-by-nc-sa-line": "This work is licensed under a {Creative Commons Attribution-NonCommercial-ShareAlike 4.0} International License.",
    "cc-by-nc-nd-line": "This work is licensed under a {Creative Commons Attribution-NonCommercial-NoDerivatives 4.0} International License.",
    "cc0-1.0-notice": """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this
        software to the public domain worldwide. This software is distributed without any warranty. You should have received a copy of the
        {CC0 Public Domain Dedication} along with this software. If not, see <http://creativecommons.org/publicdomain/zero/1.0/>.""",
}
TEMPLATES |= {
    "bsd-2-clause": f"{TEMPLATES['bsd-2-clause-conditions']} {_DISCLAIMER}",
    "bsd-3-clause": f"""{TEMPLATES['bsd-2-clause-conditions']} 3. Neither the name of the copyright holder nor the names of its contributors may
        be used to endorse or promote products derived from this software without specific prior written permission. {_DISCLAIMER}""",
    "isc": f"{TEMPLATES['isc-grant']} {_ISC_DISCLAIMER}",
    "mit": TEMPLATES["mit-grant"] + """ THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
        FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "unlicense": TEMPLATES["unlicense-line"] + """ Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,
        either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions
        that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the
        public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We
        intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
        copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>""",
}

_FSF = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
# The openings of the long license texts themselves.
TEMPLATES |= {
    "apache-2.0-text-opening": """{Apache License Version 2.0}, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE,
        REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution
        as defined by Sections 1 through 9 of this document.""",
    "gpl-2.0-text-opening": f"""{{GNU GENERAL PUBLIC LICENSE Version 2}}, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.,
        51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA {_FSF} Preamble The licenses for most software are designed to take away
        your freedom to share and change it.""",
    "gpl-3.0-text-opening": f"""{{GNU GENERAL PUBLIC LICENSE Version 3}}, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.
        <https://fsf.org/> {_FSF} Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works.""",
    "agpl-3.0-text-opening": f"""{{GNU AFFERO GENERAL PUBLIC LICENSE Version 3}}, 19 November 2007 Copyright (C) 2007 Free Software Foundation,
        Inc. <https://fsf.org/> {_FSF} Preamble The GNU Affero General Public License is a free, copyleft license for software and other kinds
        of works, specifically designed to ensure cooperation with the community in the case of network server software.""",
    "lgpl-3.0-text-opening": f"""{{GNU LESSER GENERAL PUBLIC LICENSE Version 3}}, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.
        <https://fsf.org/> {_FSF} This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of
        the GNU General Public License, supplemented by the additional permissions listed below.""",
    "mpl-2.0-text-opening": """{Mozilla Public License Version 2.0} 1. Definitions 1.1. "Contributor" means each individual or legal entity
        that creates, contributes to the creation of, or owns Covered Software.""",
    "cc-by-4.0-text-opening": """{Creative Commons Attribution 4.0 International Public License} By exercising the Licensed Rights (defined
        below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public
        License ("Public License").""",
}

MATCHES = "array<struct<license: string, coverage: double, start: long, end: long>>"


def _hasher() -> Hasher:
    return Hasher(alphanumeric(), byte_values())


def winnow(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, first word of their k-gram) of word hashes; windows stay inside one text."""
    n = len(h) - GRAM + 1
    if n <= 0:
        return h[:0], np.zeros(0, np.int64)
    g = sum(mix(h[i: i + n] + np.uint64(i + 1)) * np.uint64(2 * i + 1) for i in range(GRAM))
    inside = doc[:n] == doc[GRAM - 1:]
    at = np.flatnonzero(inside)
    g = g[at]
    chosen = np.zeros(len(at), bool)
    near = (at[1:] == at[:-1] + 1) & (doc[at[1:]] == doc[at[:-1]])       # windows of two k-grams
    left = g[:-1] <= g[1:]
    chosen[:-1] |= near & left
    chosen[1:] |= near & ~left
    alone = np.ones(len(at), bool)                                       # a text of one k-gram only
    alone[:-1] &= ~near
    alone[1:] &= ~near
    chosen |= alone
    return g[chosen], at[chosen]


def pairs_of(h: np.ndarray) -> np.ndarray:
    """Hashes of every two words one after the other."""
    return mix(h[:-1] + np.uint64(GRAM + 1)) * np.uint64(3) + mix(h[1:] + np.uint64(GRAM + 2))


class Index:
    """Templates as word hashes, and the inverted index of their fingerprints and first phrases."""

    def __init__(self, templates: dict[str, str], hasher: Hasher):
        self.names = sorted(templates)
        self.words, self.phrases, places = [], [], defaultdict(list)
        for t, name in enumerate(self.names):
            h, doc, _, _ = hasher.words(pa.array([plain(templates[name])]))
            self.phrases.append([hasher.words(pa.array([p]))[0] for p in re.findall(r"\{([^}]*)\}", templates[name])])
            if len(h) < GRAM + WINDOW - 1:
                raise ValueError(f"template {name!r} has too few words")
            self.words.append(h)
            for f, at in zip(*winnow(h, doc), strict=True):
                places[int(f)].append((t, int(at)))
            for phrase in self.phrases[-1][:1]:             # which every match holds, however short or changed around it
                at = next(i for i in range(len(h)) if (h[i: i + len(phrase)] == phrase).all())
                places[int(pairs_of(phrase)[0])].append((t, at))
        self.keys = np.array(sorted(places), np.uint64)
        self.places = [places[int(k)] for k in self.keys]

    def fits(self, t: int, words: np.ndarray, pairs: list[tuple[int, int]]) -> bool:
        """Whether matched words are enough of the template and of their span, and hold its phrases."""
        if not pairs or len(pairs) < LEAST_COVERAGE * len(self.words[t]):
            return False
        span = words[pairs[0][1]: pairs[-1][1] + 1]
        return len(pairs) >= LEAST_DENSITY * len(span) and all(holds(span, p) for p in self.phrases[t])


def plain(template: str) -> str:
    """A template without its braces."""
    return template.replace("{", "").replace("}", "")


def holds(words: np.ndarray, phrase: np.ndarray) -> bool:
    """Whether the phrase stands in the words, one after the other."""
    n = len(words) - len(phrase) + 1
    return n > 0 and bool(np.all([words[i: i + n] == w for i, w in enumerate(phrase)], axis=0).any())


def align(template: np.ndarray, words: np.ndarray, diagonal: int, band: int) -> list[tuple[int, int]]:
    """Matched (template place, text place) pairs of a banded alignment with the most matches.

    Text place minus template place stays within ``band`` of ``diagonal``.
    """
    m, width = len(template), 2 * band + 1
    best = np.zeros((m + 1, width + 1), np.int32)          # row i: the first i template words; column: diagonal offset
    for i in range(m):
        j = i + diagonal - band + np.arange(width)
        ok = (j >= 0) & (j < len(words))
        hit = np.zeros(width, bool)
        hit[ok] = words[j[ok]] == template[i]
        up = np.append(best[i, 1:width], best[i, width - 1])
        best[i + 1, :width] = np.maximum.accumulate(np.maximum(best[i, :width] + hit, up))
        best[i + 1, :width] = np.maximum(best[i + 1, :width], 0)
    pairs, i, c = [], m, width - 1
    while i > 0 and best[i, c] > 0:
        j = i - 1 + diagonal - band + c
        if c > 0 and best[i, c - 1] == best[i, c]:
            c -= 1
        elif c + 1 < width and best[i - 1, c + 1] == best[i, c]:
            i, c = i - 1, c + 1
        else:
            if 0 <= j < len(words) and words[j] == template[i - 1] and best[i, c] == best[i - 1, c] + 1:
                pairs.append((i - 1, j))
            i -= 1
    return pairs[::-1]


def tightest(template: np.ndarray, words: np.ndarray, diagonal: int, band: int) -> list[tuple[int, int]]:
    """``align``, with the latest first word that gives as many matches before the same last word."""
    pairs = align(template, words, diagonal, band)
    if len(pairs) < LEAST_COVERAGE * len(template):
        return pairs
    m, last = len(template), pairs[-1][1]
    back = align(template[::-1], words[last::-1], last - m + 1 - diagonal, band)
    back = [(m - 1 - i, last - j) for i, j in reversed(back)]
    return back if len(back) >= len(pairs) else pairs


def chosen(index: Index, found: list[tuple[int, int, int, int]]) -> list[tuple[int, float, int, int]]:
    """Of overlapping matches (words matched, -template, first, last) those of most matched less missing words, then the
    shortest, then by name and place; as (template, coverage, first, last) in text order."""
    found = sorted(set(found), key=lambda x: (len(index.words[-x[1]]) - 2 * x[0], x[3] - x[2], -x[1], x[2]))
    out: list[tuple[int, float, int, int]] = []
    for n, t, a, z in found:
        if all(z < b or a > e for _, _, b, e in out):
            out.append((-t, n / len(index.words[-t]), a, z))
    return sorted(out, key=lambda x: x[2])


def _matches(index: Index, h: np.ndarray, hits: list[tuple[int, int]]) -> list[tuple[int, float, int, int]]:
    """(template, coverage, first word, last word) of a text, from hits (word, index entry)."""
    diagonals: dict[int, list[int]] = defaultdict(list)
    for p, f in hits:
        for t, q in index.places[f]:
            diagonals[t].append(p - q)
    found = []
    for t, ds in diagonals.items():
        template = index.words[t]
        band = BAND + len(template) // 10
        ds = sorted(set(ds))
        k = 0
        while k < len(ds):
            z = k
            while z + 1 < len(ds) and ds[z + 1] - ds[k] <= band:
                z += 1
            pairs = tightest(template, h, (ds[k] + ds[z]) // 2, band)
            if index.fits(t, h, pairs):
                found.append((len(pairs), -t, pairs[0][1], pairs[-1][1]))
            k = z + 1
    return chosen(index, found)


def _task(templates: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        index = Index(templates, hasher)
        kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()),
                                   ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts = batch.column(1)
            h, doc, start, end = hasher.words(texts)
            f, at = winnow(h, doc)
            two = np.flatnonzero(doc[1:] == doc[:-1])
            f, at = np.append(f, pairs_of(h)[two]), np.append(at, two)
            place = np.minimum(np.searchsorted(index.keys, f), len(index.keys) - 1)
            known = index.keys[place] == f
            place, at = place[known], at[known]
            out: list[list] = [[] for _ in range(batch.num_rows)]
            bounds = runs(doc, batch.num_rows)
            for d in np.unique(doc[at]):
                a, z = bounds[d], bounds[d + 1]
                mine = (at >= a) & (at < z)
                raw = None
                for t, coverage, first, last in _matches(index, h[a:z], list(zip((at[mine] - a).tolist(), place[mine].tolist(), strict=True))):
                    raw = raw if raw is not None else texts[int(d)].as_py().encode()
                    s = len(raw[: start[a + first]].decode())
                    out[d].append({"license": index.names[t], "coverage": coverage, "start": s,
                                   "end": s + len(raw[start[a + first]: end[a + last]].decode())})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "matches"])
    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_matches, matches) per row: license, coverage and span of every match, in text order."""
    store.small_batches(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(_task(templates or TEMPLATES), f"doc_id long, matches {MATCHES}")
            .select("doc_id", F.size("matches").cast("long").alias("n_matches"), "matches"))
