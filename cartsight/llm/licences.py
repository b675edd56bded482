"""License scans by conditional compression.

Each candidate block (the words around a licence word) is compressed alone and with every template as a raw
zstandard dictionary, in frames without a head. Templates are ranked by how many bytes they save, and those that save fewer than
``least_saved``, in the block and in the words around each licence word, are passed over. The others are confirmed by the exact differences in wording: at least ``coverage`` of the
template's words stand in the block in order, with few others between them, and neither a version number nor a word that
tells licences apart is among the differences. Those words come from the templates: near ones of different licences differ in
them (affero, lesser, sharealike, later, ...), and none of one licence do. Of places that overlap the longest wording stays.

Cases: null and empty texts have no findings; a text with several notices has one row for each; repeated rows have
findings each, null ids too; of equally good templates the first counts; texts are searched whole, blocks of any length are taken in pieces that overlap by the longest template and its spare words; case, line ends and
punctuation around words do not matter, version numbers do. Extra columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cartsight.llm.registry import query, table
from cartsight.llm.rows import slices

# Public licence notices and texts, by SPDX name.
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)


def _gnu(work: str, licence: str, version: str, later: bool) -> str:
    """The header of a work under a licence of the GNU family."""
    terms = f"either version {version} of the License, or (at your option) any later version." if later else f"version {version} of the License."
    return (
        f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {licence} "
        f"License as published by the Free Software Foundation, {terms}"
    )


# Name, wording in the header, version, of the works that are usually named in it.
_GNU = (
    ("GPL-2.0", "General Public", "2", ("program", "library", "software", "file")),
    ("GPL-3.0", "General Public", "3", ("program", "library", "software", "file")),
    ("LGPL-2.0", "Library General Public", "2", ("program", "library", "software", "file")),
    ("LGPL-2.1", "Lesser General Public", "2.1", ("program", "library", "software", "file")),
    ("LGPL-3.0", "Lesser General Public", "3", ("program", "library", "software", "file")),
    ("AGPL-3.0", "Affero General Public", "3", ("program", "library", "software", "file")),
)

TEMPLATES = (
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    ("ISC", "notice", "Licensed under the ISC License."),
    ("ISC", "text", f"{_ISC} {_ISC_AS_IS}"),
    ("ISC", "terms", _ISC),
    ("BSD-2-Clause", "text", f"{_BSD} {_AS_IS}"),
    ("BSD-2-Clause", "terms", _BSD),
    ("BSD-3-Clause", "text", f"{_BSD} 3. {_BSD_NAMES} {_AS_IS}"),
    ("BSD-3-Clause", "terms", f"{_BSD} 3. {_BSD_NAMES}"),
    ("BSD-3-Clause", "clause", _BSD_NAMES),
    ("BSD-2-Clause", "notice", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "notice", "Licensed under the BSD 3-Clause License."),
    (
        "Zlib",
        "text",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "header",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)",
    ),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "Apache-2.0",
        "text",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        'by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    ("GPL-2.0", "notice", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "notice", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "notice", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "notice", "This work is licensed under the GNU Affero General Public License, version 3."),
    *(
        (f"{name}-or-later" if later else f"{name}-only", "header", _gnu(work, licence, version, later))
        for name, licence, version, works in _GNU
        for work in works
        for later in (True, False)
    ),
    (
        "GPL-2.0-only",
        "header",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License version 2 as published by the Free Software Foundation.",
    ),
    (
        "MPL-2.0",
        "header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "EPL-2.0",
        "header",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "notice", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "notice", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    (
        "CC-BY-NC-SA-4.0",
        "notice",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    ("CC0-1.0", "notice", "This work is dedicated to the public domain under the CC0 1.0 Universal license."),
    (
        "Unlicense",
        "text",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication "
        "for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be "
        "an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ),
    ("Unlicense", "notice", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "notice", "All rights reserved."),
)
ANCHORS = (b"licens", b"licenc", b"copyright", b"rights reserved", b"permission", b"redistribut", b"public domain")


@dataclass(frozen=True)
class LicenceParams:
    around: int = 60  # words on each side of a licence word, more if a template has longer stretches without one
    piece: int = 600  # words of a block compared at a time, more if templates are long
    coverage: float = 0.9  # of the template's words
    least_saved: int = 4  # bytes that a template must save
    near: float = 0.8  # likeness of templates of two licences whose differing words tell them apart
    level: int = 3


PARAMS = LicenceParams()
VERSION = re.compile(r"v?\d+(\.\d+)*").fullmatch  # a number that differs is another licence
_STRIP = ".,;:!?\"'()[]{}<>*#"


def plain(words: list[str]) -> list[str]:
    return [w.lower().strip(_STRIP) for w in words]


def anchored(words: list[str]) -> Iterator[int]:
    """Places of licence words, also of those of two words."""
    lower = [w.lower().encode() for w in words]
    for i, w in enumerate(lower):
        pair = w + b" " + lower[i + 1] if i + 1 < len(lower) else w
        if any(a in pair for a in ANCHORS):
            yield i


def telling_words(templates: list[tuple[str, list[str]]], near: float) -> list[frozenset[str]]:
    """For each template the words that tell its licence from others: near templates of other licences have them and it has
    not, or it has them and they have not; but no word in which templates of its own licence differ."""
    out = []
    for name, words in templates:
        across: set[str] = set()
        within: set[str] = set()
        for other, wording in templates:
            shared = sum((Counter(words) & Counter(wording)).values())
            if 2 * shared >= near * (len(words) + len(wording)):
                (within if name == other else across).update(set(words) ^ set(wording))
        out.append(frozenset(across - within))
    return out


class Scanner:
    """Compressors of all templates; made once per Python worker."""

    def __init__(self, templates: tuple, p: LicenceParams) -> None:
        self.p = p
        # frames without a head, so that the sizes of short blocks differ by their content alone
        plain_frames = zstandard.ZstdCompressionParameters.from_level(
            p.level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        # without a template the coder gets a dictionary too, of nothing that texts have: with one it codes short blocks otherwise
        empty = zstandard.ZstdCompressionDict(b"\0" * 64, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.alone = zstandard.ZstdCompressor(compression_params=plain_frames, dict_data=empty)
        self.templates = []
        self.around = p.around
        for name, kind, text in templates:
            words = plain(text.split())
            anchors = list(anchored(words))
            if not anchors:
                raise ValueError(f"no licence word in a template of {name}")
            known = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, kind, words, zstandard.ZstdCompressor(compression_params=plain_frames, dict_data=known)))
            # a block holds the whole place: the longest stretch without a licence word, and extra words in it
            spare = int((1 - p.coverage) * len(words))
            gaps = [b - a for a, b in zip([-1, *anchors], [*anchors, len(words)])]
            self.around = max(self.around, max(gaps) + spare)
        self.telling = telling_words([(name, words) for name, _, words, _ in self.templates], p.near)
        # a place is whole in a piece: no longer than a template and the extra words among its own
        longest = max((len(words) for _, _, words, _ in self.templates), default=0)
        self.overlap = max(2 * self.around, longest + int((1 - p.coverage) * longest))
        self.piece = max(p.piece, 2 * self.overlap)

    def blocks(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """Ranges of words around licence words; overlapping ones are one block."""
        begin = stop = -1
        for i in anchored(words):
            low, high = max(0, i - self.around), min(len(words), i + self.around + 1)
            if begin < 0:
                begin, stop = low, high
            elif low <= stop:
                stop = high
            else:
                yield begin, stop
                begin, stop = low, high
        if begin >= 0:
            yield begin, stop

    def block(self, words: list[str]) -> list[tuple]:
        """Findings of one block: (name, kind, start, stop, bytes saved, rank, coverage, differences).

        Templates that save enough are confirmed. Of places that overlap the longer wording stays, of equally long ones
        the one with fewer differences, then the better rank.
        """
        text = " ".join(words).encode()
        size = len(self.alone.compress(text))
        ranked = sorted(
            ((size - len(c.compress(text)), k) for k, (_, _, _, c) in enumerate(self.templates)),
            key=lambda x: (-x[0], x[1]),
        )
        found, held = [], Counter(words)
        for rank, (saved, k) in enumerate(ranked, 1):
            name, kind, wanted, _ = self.templates[k]
            if sum(min(n, held[w]) for w, n in Counter(wanted).items()) < len(wanted) - int((1 - self.p.coverage) * len(wanted)):
                continue
            if saved < self.p.least_saved:
                saved = self.saved_nearby(k, words)
            if saved < self.p.least_saved:
                continue
            for start, stop, part, said in self.confirmed(wanted, words, self.telling[k]):
                same = round(part * len(wanted))
                found.append(((-same, len(said.split()), rank, start), (name, kind, start, stop, saved, rank, part, said)))
        out: list[tuple] = []
        for _, x in sorted(found):
            if all(x[3] <= y[2] or x[2] >= y[3] for y in out):
                out.append(x)
        return sorted(out, key=lambda x: (x[5], x[2]))

    def saved_nearby(self, k: int, words: list[str]) -> int:
        """Bytes that a template saves in the words around a licence word, as many as its own: in a whole block a few bytes
        more or less of the coder's tables may hide what a short notice saves."""
        m, best = len(self.templates[k][2]), 0
        for i in anchored(words):
            near = " ".join(words[max(0, i - m) : i + m + 1]).encode()
            best = max(best, len(self.alone.compress(near)) - len(self.templates[k][3].compress(near)))
        return best

    def confirmed(self, wanted: list[str], words: list[str], telling: frozenset[str]) -> Iterator[tuple[int, int, float, str]]:
        """Places where the template's words stand in order, nearly without gaps and extra words, and no telling one is
        missing or added."""
        m, at = len(wanted), 0
        spare = int((1 - self.p.coverage) * m)
        counts = {}
        for i, w in enumerate(words):
            counts.setdefault(w, []).append(i)
        if sum(min(n, len(counts.get(w, ()))) for w, n in Counter(wanted).items()) < m - spare:
            return
        while at < len(words):
            # a place begins at one of the template's first words
            starts = [i for j in range(spare + 1) for i in counts.get(wanted[j], ()) if i - j >= at - spare]
            if not starts:
                return
            found = None
            for i in sorted(set(starts)):
                part = words[i : i + m + spare]
                match = SequenceMatcher(None, wanted, part, autojunk=False)
                same = [b for b in match.get_matching_blocks() if b.size]
                hit = sum(b.size for b in same)
                if not same or hit < m - spare:
                    continue
                stop = same[-1].b + same[-1].size
                if same[0].b == 0 and stop - hit <= spare:
                    said = []
                    for op, a0, a1, b0, b1 in SequenceMatcher(None, wanted, part[:stop], autojunk=False).get_opcodes():
                        if op != "equal":
                            said += [f"-{w}" for w in wanted[a0:a1]] + [f"+{w}" for w in part[b0:b1]]
                    if any(VERSION(x[1:]) or x[1:] in telling for x in said):
                        continue
                    found = i, i + stop, hit / m, " ".join(said)
                    break
            if not found:
                return
            yield found
            at = found[1] + spare
            counts = {w: [i for i in v if i >= found[1]] for w, v in counts.items()}

    def text(self, text: str) -> list[tuple]:
        raw = text.lower().encode()
        if not any(a.split(b" ")[0] in raw for a in ANCHORS):
            return []
        words = text.split()
        out = []
        for begin, stop in self.blocks(words):
            found = []
            for at in range(begin, max(begin + 1, stop - self.overlap), self.piece - self.overlap):
                piece = plain(words[at : min(stop, at + self.piece)])
                found += [(name, kind, at + a, at + b, *rest) for name, kind, a, b, *rest in self.block(piece)]
            # of places in two pieces the one with more of the wording stays
            kept: list[tuple] = []
            for x in sorted(found, key=lambda x: (-x[6] * (x[3] - x[2]), x[5], x[2])):
                if all(x[3] <= y[2] or x[2] >= y[3] for y in kept):
                    kept.append(x)
            out += [x for k, x in enumerate(found) if x in kept and x not in found[:k]]
        return out


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("licence", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("start_word", T.IntegerType()),
        T.StructField("stop_word", T.IntegerType()),
        T.StructField("bytes_saved", T.IntegerType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("differences", T.StringType()),
    ]
)


def scan(
    docs: DataFrame, templates: tuple = TEMPLATES, p: LicenceParams = PARAMS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per licence found in a document, with the place in words and the differences in wording."""
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    arrow = to_arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, p)
        for batch in batches:
            for at, n in slices(batch.column(1)):
                ids, texts = batch.column(0).slice(at, n).to_pylist(), batch.column(1).slice(at, n).to_pylist()
                rows = [(i, *x) for i, t in zip(ids, texts) for x in scanner.text(t)]
                columns = list(zip(*rows)) if rows else [()] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return source.mapInArrow(run, RESULT)


@query("op1_licences")
def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All licences in all documents."""
    return scan(table(spark, sf_dir, "documents"))
