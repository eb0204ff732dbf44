"""License notices by conditional compression.

Candidate blocks are the lines that hold a word of license notices, and the lines around them as far
as the longest template reaches; inside them, the words near each signal. A block is compressed alone and
with each template as a raw dictionary of zstandard; templates that make it smaller are ranked by the bytes they save. In that order they are
confirmed by wording: signal words of the block are laid on the like words of the template, whatever the
line breaks, and the words around them are aligned with it word by word. A stretch that differs in at
most ``DIFFER`` of the template's words is a finding; where others that save bytes fit the same words
better, the best fit is (versions of one license compress nearly alike). Its words are taken out,
and what is left of the block is compressed and ranked again, until no template that saves bytes
is confirmed. ``exact`` findings differ in no word.

Defined results: a NULL or empty text, or one without a candidate, gives no row; a document gives one
row per finding, with the lines it covers, and repeated rows give theirs each; words inside a longer
finding are not reported again, other notices of the same lines are. An empty table gives no rows. No
other columns are read.
"""

from __future__ import annotations

import bisect
import difflib
import functools
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.llm.frames import text_bytes

# Wording of public notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
        "in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have "
        "received a copy of the GNU Affero General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."
    ),
    "bsd-3-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
        "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
        "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
        "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsl-1.0-header": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or "
        "copy at http://www.boost.org/LICENSE_1_0.txt)"
    ),
    "cc0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide. This software is distributed "
        "without any warranty."
    ),
    "epl-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU "
        "General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "lgpl-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
        "License, or (at your option) any later version. This library is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received "
        "a copy of the GNU Lesser General Public License along with this library; if not, write to the Free "
        "Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
    ),
    "lgpl": "This library is licensed under the GNU Lesser General Public License.",
    "mit-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "spdx-agpl-3.0": "SPDX-License-Identifier: AGPL-3.0-or-later",
    "spdx-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd-2-clause": "SPDX-License-Identifier: BSD-2-Clause",
    "spdx-bsd-3-clause": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-gpl-2.0-only": "SPDX-License-Identifier: GPL-2.0-only",
    "spdx-gpl-2.0-or-later": "SPDX-License-Identifier: GPL-2.0-or-later",
    "spdx-gpl-3.0-or-later": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-lgpl-2.1-or-later": "SPDX-License-Identifier: LGPL-2.1-or-later",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-mpl-2.0": "SPDX-License-Identifier: MPL-2.0",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."
    ),
    "mit": "Released under the MIT License.",
    "mit-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}
SIGNAL = r"(?i)licen[cs]e|copyright|permission|redistribut|warrant|rights\W+reserved|creative\W+commons|public\W+domain"
DIFFER = 0.1
#: Words on each side of a signal in a near block.
NEAR = (6, 40)
LEVEL = 3
#: Signs that lay a text's word on a template's.
_STEM = re.compile(r"licen|copyright|permission|redistribut|warrant|rights|reserved|creative|commons|public|domain")
_WORD = re.compile(r"[^\W_]+(?:[.\-/][^\W_]+)*")

_FOUND = (
    "doc_id bigint, license string, first_line int, last_line int, reduction double, n_differ int, exact boolean"
)


def wording(text: str) -> list[str]:
    """Lower-cased words; numbers with their points and hyphens are one word."""
    return _WORD.findall(text.lower())


def fitted(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """Differing words, and the stretch of ``block`` with the fewest.

    They are words of ``template`` missing, and foreign words inside the stretch.
    """
    matcher = difflib.SequenceMatcher(None, block, template, autojunk=False)
    runs = [m for m in matcher.get_matching_blocks() if m.size]
    best = (len(template), 0, 0)
    for i in range(len(runs)):
        same = 0
        for run in runs[i:]:
            same += run.size
            start, end = runs[i].a, run.a + run.size
            best = min(best, (len(template) + end - start - 2 * same, start, end))
    return best


def stems(words: list[str]) -> dict[str | None, list[int]]:
    """Places of the words that hold each stem of a signal."""
    out: dict[str | None, list[int]] = {}
    for i, word in enumerate(words):
        for stem in set(_STEM.findall(word)):
            out.setdefault(stem, []).append(i)
    return out


def _all(words: list[str]) -> dict[str | None, list[int]]:
    return {None: list(range(len(words)))}


def _windows(signals: list[int], taken: list[bool]) -> list[tuple[int, int]]:
    """Runs of words that are not taken, and in them the words near signals, close and not so close.

    Against a long block a short notice saves less than compression varies by chance; near ones are joined.
    """
    out, start = [], 0
    for stop in [i for i, gone in enumerate(taken) if gone] + [len(taken)]:
        if stop > start:
            own = signals[bisect.bisect_left(signals, start) : bisect.bisect_left(signals, stop)]
            found = [(start, stop)]
            for reach in NEAR:
                near: list[tuple[int, int]] = []
                for i in own:
                    a, b = max(start, i - reach), min(stop, i + reach + 1)
                    if near and a <= near[-1][0] + reach // 2:
                        near[-1] = (near[-1][0], b)
                    else:
                        near.append((a, b))
                found += near
            out += sorted(set(found))
        start = stop + 1
    return out


class Scanner:
    """Compressors of the templates, made once per task."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.words = {name: wording(text) for name, text in templates.items()}
        self.counts = {name: Counter(words) for name, words in self.words.items()}
        self.slack = {name: int(DIFFER * len(words)) for name, words in self.words.items()}
        self.reach = max((len(words) + self.slack[name] for name, words in self.words.items()), default=0)
        self.places = {name: stems(words) or _all(words) for name, words in self.words.items()}
        self.with_template = {}
        for name, text in templates.items():
            raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.with_template[name] = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False
            )

    def reduction(self, block: str, name: str) -> float:
        """Share of the compressed size that a template saves."""
        data = " ".join(block.split()).encode()
        return 1 - len(self.with_template[name].compress(data)) / len(self.plain.compress(data))

    def regions(self, lines: list[str]) -> list[tuple[int, int]]:
        """First and last line of what may hold notices: signals and the longest template around them."""
        text = "\n".join(lines)
        borders = list(itertools.accumulate((len(line) + 1 for line in lines), initial=0))
        ends = (at for m in re.finditer(SIGNAL, text) for at in (m.start(), m.end() - 1))
        hits = sorted({bisect.bisect_right(borders, at) - 1 for at in ends})
        size, out = functools.cache(lambda i: len(wording(lines[i]))), []
        for i in hits:
            if out and i < out[-1][1]:
                # Inside: only lines after may be new.
                a = out[-1][0]
            else:
                a, n = i, 0
                while a > 0 and n < self.reach:
                    a -= 1
                    n += size(a)
            b, n = i, 0
            while b < len(lines) - 1 and n < self.reach:
                b += 1
                n += size(b)
            if out and a <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def saved(self, data: bytes) -> Iterator[tuple[str, int]]:
        """Templates that make a block smaller, and by how many bytes."""
        alone = len(self.plain.compress(data))
        for name, compressor in self.with_template.items():
            less = alone - len(compressor.compress(data))
            if less > 0:
                yield name, less

    def ranked(self, blocks: list[str]) -> list[str]:
        """Templates that make some block smaller, those that save most bytes first."""
        most: dict[str, int] = {}
        for block in blocks:
            for name, less in self.saved(" ".join(block.split()).encode()):
                most[name] = max(less, most.get(name, 0))
        return sorted(most, key=lambda name: (-most[name], name))

    def stretches(self, words: list[str], name: str) -> list[tuple[int, int, int, str, int]]:
        """``(same - differing, start, end, template, differing)`` of all stretches near a template."""
        places, found = self.places[name], set()
        template, slack, counts = self.words[name], self.slack[name], self.counts[name]
        own = _all(words) if None in places else stems(words)
        starts = {p - q for stem, at in places.items() for p in own.get(stem, ()) for q in at}
        for start in starts:
            low, high = max(0, start - slack), max(0, start + len(template) + slack)
            block = words[low:high]
            if sum(map(counts.__contains__, block)) < len(template) - slack:
                continue
            if sum((Counter(block) & counts).values()) < len(template) - slack:
                continue
            differ, a, b = fitted(template, block)
            if b > a and differ <= DIFFER * len(template):
                same = (len(template) + b - a - differ) // 2
                found.add((same - differ, low + a, low + b, name, differ))
        return sorted(found, key=lambda x: (-x[0], x[1], x[2]))

    def findings(self, block: str) -> list[tuple[int, int, str, int]]:
        """Start and end of each finding in a block, its template and its differing words."""
        # The same words whatever case, at their places in the text as it is.
        spans = [m.span() for m in _WORD.finditer(block)]
        words, taken = [block[a:b].lower() for a, b in spans], [False] * len(spans)
        near = functools.cache(lambda name: self.stretches(words, name))
        signals = [i for i, word in enumerate(words) if _STEM.search(word)]
        out = []
        while True:
            parts = _windows(signals, taken)
            ranks = self.ranked([block[spans[a][0] : spans[b - 1][1]] for a, b in parts])
            free = [x for name in ranks for x in near(name) if not any(taken[x[1] : x[2]])]
            if not free:
                return sorted(out)
            # The first confirmed one, or what fits its words better among the templates that save bytes.
            _, a, b, *_ = free[0]
            _, a, b, name, differ = min(
                (x for x in free if x[1] < b and a < x[2]), key=lambda x: (-x[0], x[1], x[2], x[3])
            )
            taken[a:b] = [True] * (b - a)
            out.append((spans[a][0], spans[b - 1][1], name, differ))

    def scan(self, text: str) -> list[tuple[str, int, int, float, int]]:
        """Findings of a text with their first and last line, in order."""
        lines, out = text.split("\n"), []
        for first, last in self.regions(lines):
            block = "\n".join(lines[first : last + 1])
            for start, end, name, differ in self.findings(block):
                line = first + block.count("\n", 0, start)
                saved = self.reduction(block[start:end], name)
                out.append((name, line, line + block.count("\n", start, end), saved, differ))
        return out


def _scan(templates: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("_data").to_pylist()):
                for name, a, b, saved, differ in scanner.scan(data.decode("utf-8", "replace")):
                    rows.append((doc_id, name, a, b, round(saved, 6), differ, differ == 0))
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_()]
            names = ["doc_id", "license", "first_line", "last_line", "reduction", "n_differ", "exact"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names
            )

    return run


def license_notices(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per notice found. Texts without a signal word never leave the JVM."""
    candidates = docs.filter(F.col("text").rlike(SIGNAL))
    return text_bytes(candidates).mapInArrow(_scan(templates or TEMPLATES), _FOUND)
