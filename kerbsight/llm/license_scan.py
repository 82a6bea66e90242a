"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

Texts are lower-cased (A-Z) and their ASCII punctuation counts as space. For each template length ``L`` there are windows of
``L`` words that start every ``max(1, L // 8)`` words. A window's MinHash has ``BANDS`` bands of ``ROWS`` values. A text that holds
0.75 of a template's shingles has a window within L / 16 words of it, whose Jaccard similarity is at least 0.5 then; it agrees
in some band with probability ``1 - (1 - 0.5 ** ROWS) ** BANDS`` = 0.9999. A retrieved template matches if the window, widened
by L / 8 words on both sides, contains at least ``LEAST`` of its shingles.

Windows without any shingle of any template contain nothing of them; they are skipped by one lookup for each word.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator, Mapping
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import words as W

c = F.col
SHINGLE, LEAST, BANDS, ROWS, SEED = 5, 0.75, 32, 2, 5
_PLAIN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
RESULT = "doc_id long, license string, start long, n_words long, containment double"

_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
    "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. ")
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu_notice(name: str, what: str, version: str) -> str:
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free "
        f"Software Foundation, either version {version} of the License, or (at your option) any later version. This {what} is distributed "
        "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR "
        f"A PARTICULAR PURPOSE. See the {name} for more details.")


#: The names by which short lines call a license; a line is "under the <name>", whatever stands before and after.
_CALLED = {
    "MIT": ["MIT License", "MIT Licence", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "BSD": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "2-Clause BSD License", "3-Clause BSD License", "New BSD License", "Simplified BSD License"],
    "ISC": ["ISC License"],
    "GPL": ["GNU General Public License", "GNU GPL", "GPL License", "GPL v2", "GPL v3", "GPLv2 License", "GPLv3 License"],
    "LGPL": ["GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "LGPL License"],
    "AGPL": ["GNU Affero General Public License", "GNU AGPL", "AGPL License"],
    "MPL": ["Mozilla Public License", "MPL 2.0"],
    "CC0": ["Creative Commons Zero", "CC0 1.0"],
}
_KINDS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def _lines() -> dict[str, str]:
    out = {f"{key} line: {name}": f"under the {name}" for key, names in _CALLED.items() for name in names}
    for version in ("3.0", "4.0"):
        for kind, name in _KINDS.items():
            of = "Unported" if version == "3.0" else "International"
            out[f"CC-{kind}-{version}"] = f"licensed under a Creative Commons {name} {version} {of} License."
            out[f"CC-{kind}-{version} name"] = f"Creative Commons {name} {version}"
            out[f"CC-{kind}-{version} line"] = f"under CC {kind} {version}"
            out[f"CC-{kind}-{version} URL"] = f"creativecommons.org/licenses/{kind.lower()}/{version}"
    return out


def _texts() -> dict[str, str]:
    """The whole license texts in the folder ``licenses``."""
    files = (f for f in resources.files("kerbsight.llm").joinpath("licenses").iterdir() if f.name.endswith(".txt"))
    return {f.name[:-4] + " text": f.read_text("utf-8") for f in files}


#: Whole notices and texts of the usual public licenses, and the short lines that name them.
TEMPLATES: dict[str, str] = _lines() | _texts() | {
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. " + _DISCLAIMER),
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software"),
    "BSD-2-Clause text": _BSD_TERMS + _BSD_DISCLAIMER,
    "BSD-3-Clause text": _BSD_TERMS + _BSD_NAMES + _BSD_DISCLAIMER,
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        'that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "GPL-2.0 notice": _gnu_notice("GNU General Public License", "program", "2"),
    "GPL-3.0 notice": _gnu_notice("GNU General Public License", "program", "3"),
    "LGPL-2.1 notice": _gnu_notice("GNU Lesser General Public License", "library", "2.1"),
    "LGPL-3.0 notice": _gnu_notice("GNU Lesser General Public License", "program", "3"),
    "AGPL-3.0 notice": _gnu_notice("GNU Affero General Public License", "program", "3"),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "CC0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}


def plain_words(text: bytes) -> list[bytes]:
    return text.lower().translate(_PLAIN).split()


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """BANDS * ROWS minima of a set of shingle codes under seeded bijections."""
    salts = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
    return W.mixed(shingles[:, None] ^ salts).min(0)


def bands_of(shingles: np.ndarray) -> list[tuple[int, bytes]]:
    held = min_hashes(shingles).reshape(BANDS, ROWS)
    return [(i, row.tobytes()) for i, row in enumerate(held)]


class Templates:
    """The templates' shingle sets and their bands."""

    def __init__(self, templates: Mapping[str, str]):
        self.names, self.sets, self.sizes = [], [], []
        self.bands: dict[tuple[int, bytes], list[int]] = defaultdict(list)
        for name, text in sorted(templates.items()):
            words = plain_words(text.encode())
            shingles = W.shingle_set(words, SHINGLE)
            if len(shingles):
                for band in bands_of(shingles):
                    self.bands[band].append(len(self.names))
                self.names.append(name)
                self.sets.append(shingles)
                self.sizes.append(len(words))
        self.known = {k: np.unique(np.concatenate([s for s, n in zip(self.sets, self.sizes, strict=True) if min(n, SHINGLE) == k])) for k in {min(n, SHINGLE) for n in self.sizes}}
        #: by size: all shingles of its templates, and how many of them the smallest match has
        self.of_size = {}
        for size in sorted(set(self.sizes)):
            own = [s for s, n in zip(self.sets, self.sizes, strict=True) if n == size]
            self.of_size[size] = np.unique(np.concatenate(own)), LEAST * min(map(len, own))

    def matches(self, text: bytes) -> list[tuple[str, int, int, float]]:
        """(license, first word, words, containment) of every verified window that overlaps no better one of its template.

        Of windows less than 7 / 8 of a length apart the best stays, the first on ties; what they still overlap by is left to the later one."""
        codes = W.word_codes(plain_words(text))
        verified: dict[int, list[tuple[float, int]]] = defaultdict(list)
        for k, known in self.known.items():
            runs = W.run_codes(codes, k)
            at = np.minimum(np.searchsorted(known, runs), len(known) - 1)
            of_any = np.flatnonzero(known[at] == runs)
            if not len(of_any):
                continue
            for size, (own, fewest) in self.of_size.items():
                if min(size, SHINGLE) != k:
                    continue
                hits = of_any[np.isin(runs[of_any], own)]
                if len(hits) < fewest:
                    continue
                step, wide = max(1, size // 8), size - k + 1
                starts = np.unique(np.concatenate([np.maximum(0, hits // step - d) * step for d in range(-(-wide // step) + 1)]))
                held = np.searchsorted(hits, starts + wide + step) - np.searchsorted(hits, starts - step)
                for start in starts[(starts < len(runs)) & (held >= fewest)].tolist():
                    window = np.unique(runs[start : start + wide])
                    found = {t for band in bands_of(window) for t in self.bands.get(band, ()) if self.sizes[t] == size}
                    for t in found:
                        a, b = max(0, start - step), start + wide + step
                        share = float(np.isin(self.sets[t], runs[a:b]).mean())
                        if share >= LEAST:
                            verified[t].append((share, start))
        out = []
        for t, windows in sorted(verified.items()):
            size = self.sizes[t]
            apart, kept = size - size // 8, {}
            for share, start in sorted(windows, key=lambda w: (-w[0], w[1])):
                if all(abs(start - other) >= apart for other in kept):
                    kept[start] = share
            ends = [*sorted(kept)[1:], len(codes)]
            out += [(self.names[t], start, min(size, end - start), kept[start]) for start, end in zip(sorted(kept), ends, strict=True)]
        return out


def license_matches(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license, start, n_words, containment): every occurrence of a template in a document, as windows of it that do not overlap.

    ``docs`` needs doc_id and text. The templates are a parameter, not a table, and are sent to the tasks as such. Null and empty
    texts match nothing; templates of fewer than five words are one shingle. Repeated rows repeat their matches. ``start`` counts
    words after punctuation has been taken for space. Documents are not shuffled. An empty table gives no rows."""
    known = Templates(templates)
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, *m) for doc, text in zip(batch.column("doc_id").to_pylist(), W.texts_of(batch), strict=True) for m in known.matches(text or b"")]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)

    docs = docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text"))
    return docs.mapInArrow(run, RESULT)
