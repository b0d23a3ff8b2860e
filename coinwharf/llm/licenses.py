"""Licence notices in texts, by the Dice coefficient over word bigrams.

A text is normalised to lower-case words. For each template, the windows of words that begin and
end with one of its bigrams and whose size it allows are compared to it, wherever lines end: for a
coefficient of at least t, the numbers of bigrams may differ by a factor of (2 - t) / t at most. Of
the windows that begin at one word the best counts. A window is widened to whole lines where these
still match; stretches of whole lines that share bigrams with templates are compared as such, too.
Of overlapping ones the best stays, then the longest, then the first.

Defined cases: null and empty texts have no notices; equal rows are reported each; a text of one
word has no bigrams and matches no template; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from coinwharf.llm.common import id_and_text, text_slices

LEAST_DICE = 0.8
# fixed values: licence names and the wording of their usual notices
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE file in the project root for full license information."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies"
        " or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF"
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
        " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General"
        " Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either"
        " version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General"
        " Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code"
        " must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this"
        " list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of"
        " its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
        " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
        " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
        " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS"
        " INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE"
        " USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code"
        " must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this"
        " list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
        " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
        " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
        " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS"
        " INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE"
        " USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("proprietary", "All rights reserved."),
)

_CLOSING = re.compile(r"[^\w\s]*")
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:]))


def words_of(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def _lower(text: str) -> str:
    """Lower case, code point by code point where the length would change."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(one if len(one := c.lower()) == 1 else c for c in text)


def dice(one: Counter, two: Counter, sizes: int) -> float:
    return 2 * sum(min(n, two[g]) for g, n in one.items() if g in two) / sizes if sizes else 0.0


class Templates:
    def __init__(self, templates, least: float):
        self.least, self.factor = least, (2 - least) / least
        self.all = [(name, b, sum(b.values())) for name, text in templates if (b := bigrams(words_of(text)))]
        self.known = {g for _, b, _ in self.all for g in b}
        self.of: dict[tuple[str, str], list[int]] = {}
        for i, (_, b, _) in enumerate(self.all):
            for g in b:
                self.of.setdefault(g, []).append(i)
        self.most = max((size for _, _, size in self.all), default=0) * self.factor

    def best(self, found: Counter, size: int) -> tuple[float, str] | None:
        """The best coefficient over the templates that the size allows, then the first name."""
        fits = [(dice(found, b, size + n), name) for name, b, n in self.all if n <= size * self.factor and size <= n * self.factor]
        fits = [f for f in fits if f[0] >= self.least]
        return min(fits, key=lambda f: (-f[0], f[1])) if fits else None

    def _windows(self, pairs: list[tuple[str, str]]) -> set[tuple[float, str, int, int]]:
        """Coefficient, name, first and last bigram of the best window of each template from each
        of its bigrams on."""
        places: dict[int, list[int]] = {}
        for at, g in enumerate(pairs):
            for i in self.of.get(g, ()):
                places.setdefault(i, []).append(at)
        found = set()
        for i, at in places.items():
            name, own, n = self.all[i]
            most, fewest = n * self.factor, n / self.factor
            needed = math.ceil(self.least * (n + fewest) / 2 - 1e-9)  # common bigrams in the smallest window
            for first in range(len(at) - needed + 1):
                if at[first + needed - 1] - at[first] + 1 > most:
                    continue
                seen: Counter = Counter()
                common, best = 0, None
                for last in range(first, len(at)):
                    size = at[last] - at[first] + 1
                    if size > most:
                        break
                    g = pairs[at[last]]
                    seen[g] += 1
                    common += seen[g] <= own[g]
                    if size >= fewest and (d := 2 * common / (size + n)) >= self.least and (best is None or d >= best[0]):
                        best = (d, name, at[first], at[last])
                if best:
                    found.add(best)
        return found

    def _stretches(self, text: str) -> list[tuple[str, float, int, int]]:
        """The stretches of whole lines that match a template."""
        runs: list[list[tuple[int, int, list[str]]]] = [[]]
        at = 0
        for line in text.split("\n"):
            end = at + len(line)
            words = words_of(line)
            if any(g in self.known for g in zip(words, words[1:])):
                runs[-1].append((at, end, words))
            elif words and runs[-1]:
                runs.append([])
            at = end + 1
        found = []
        for run in runs:
            for first in range(len(run)):
                words: list[str] = []
                for last in range(first, len(run)):
                    words = words + run[last][2]
                    if len(words) - 1 > self.most:
                        break
                    if best := self.best(bigrams(words), len(words) - 1):
                        found.append((best[1], best[0], run[first][0], run[last][1]))
        return found

    def notices(self, text: str) -> list[tuple[str, float, int, int]]:
        """Name, coefficient, start and end (code points, end exclusive) of the notices of a text."""
        words = _WORD.findall(_lower(text))
        windows = self._windows(list(zip(words, words[1:])))
        if not windows:
            return []
        spans = [m.span() for m in _WORD.finditer(_lower(text))]
        found = set(self._stretches(text))
        widened: dict[tuple[int, int], tuple[str, float, int, int] | None] = {}
        for d, name, first, last in windows:
            start, end = spans[first][0], _CLOSING.match(text, spans[last + 1][1]).end()
            lines = (text.rfind("\n", 0, start) + 1, len(text) if (stop := text.find("\n", end)) < 0 else stop)
            if lines not in widened:
                a, b = bisect_left(spans, (lines[0],)), bisect_left(spans, (lines[1],))
                best = self.best(bigrams(words[a:b]), b - a - 1) if b - a - 1 <= self.most else None
                widened[lines] = best and (best[1], best[0], *lines)
            found.add(widened[lines] or (name, d, start, end))
        kept: list[tuple[int, int, str, float]] = []
        for name, d, start, end in sorted(found, key=lambda n: (-n[1], n[2] - n[3], n[2], n[0])):
            at = bisect_left(kept, (start,))
            if (at == 0 or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0]):
                kept.insert(at, (start, end, name, d))
        return [(name, d, start, end) for start, end, name, d in kept]


def license_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """One row per notice: doc_id, license, dice (4 decimals), start, end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, least)
        for batch, texts in text_slices(batches):
            rows = [(i, name, round(d, 4), a, b) for i, t in zip(batch.column("id").to_pylist(), texts) for name, d, a, b in known.notices(t)]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 5, kinds)], ["doc_id", "license", "dice", "start", "end"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, license string, dice double, start long, end long")
