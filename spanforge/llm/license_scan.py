"""License scans by conditional compression.

Places of a text that hold a cue, or a run of words of a notice, are widened to
candidate blocks.  A notice is cut in one run more than the differences that it
may have, so one run is intact in every notice to be found; white space and
punctuation between words are free.  Around cues the blocks are wide enough for
the full license texts, which are searched in every block; each of them holds
several cues and notices.

Within a block each template is aligned with all stretches of words at once (an
alignment that may begin and end anywhere).  Stretches within the limit of
differences are its occurrences; templates that lack too many words need no
alignment.  Where occurrences overlap, the one that explains most words stays
and the others are aligned again with what is left, so a stretch that is closer
to one license is not a hit of others.  Words are compared without the
punctuation around them; a hit is exact if its punctuation is the template's too.

Each hit is compressed with what stands around it with Zstandard, once plainly
and once with its template as a raw-content dictionary.  What the dictionary
saves, against what it would save if the template stood there verbatim, ranks
the hits of a block; it decides none.

Texts without a candidate are filtered out by a pattern in the scan; the rest is one
pass over each text without a shuffle.

Defined cases: null and empty texts have no hits; every occurrence is a hit of
its own, with its own range; licenses whose templates explain equally many words
of a stretch with equally many differences are all hits of it;
repeated rows and a null doc_id are scanned like others; a very long text is
scanned whole, and work grows with its blocks; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common

#: Wordings of license notices, by license.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "Proprietary": ["All rights reserved."],
}
#: Full license texts, without the copyright line.
FULL_TEXTS = {
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD-3-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
}
CUES = r"licen[cs]e|all\s+rights\s+reserved|redistribut|permission\s+is\s+hereby|permission\s+to\s+use|cc\s+by"
BEFORE, AFTER = 120, 260
MOST_DIFFERENCES = 0.15
#: Templates of fewer words may have words between theirs, but none changed or dropped.
LEAST_WORDS = 4
LEVEL = 9

HITS = "doc_id long, begin long, end long, license string, template int, saved_percent int, place int, n_words int, n_differences int, exact boolean, changes string, block string"
_words = re.compile(r"[^\W_](?:\S*[^\W_])?")


def words_of(text: str) -> list[str]:
    """Words in lower case without the punctuation around them."""
    return [w.lower() for w in _words.findall(text)]


def most_differences(n_words: int) -> int:
    return max(1, int(MOST_DIFFERENCES * n_words))


def _runs() -> list[tuple[str, int, int]]:
    """(pattern, most words before, most words after) of the runs of words of which a notice keeps one."""
    out = []
    for words in (words_of(t) for ts in TEMPLATES.values() for t in ts):
        most = most_differences(len(words))
        at = [len(words) * i // (most + 1) for i in range(most + 2)]
        if len(words) < LEAST_WORDS:  # every word is there, so the last one is
            at = [len(words) - 1, len(words)]
        out += [(r"[\W_]+".join(map(re.escape, words[b:e])), b + most, len(words) - e + most) for b, e in zip(at, at[1:], strict=False)]
    return out


#: Any cue or run, for texts in the scan and places in a text.
CANDIDATES = rf"(?i)(?:{CUES}|{'|'.join(dict.fromkeys(p for p, _, _ in _runs()))})"
_place = re.compile(rf"(?={CANDIDATES[4:]})", re.ASCII | re.IGNORECASE)
_longest = max(len(words_of(t)) + most_differences(len(words_of(t))) for t in FULL_TEXTS.values())
_kinds = [(re.compile(p, re.ASCII | re.IGNORECASE), before, after) for p, before, after in [(CUES, _longest, _longest), *_runs()]]


def _back(text: str, at: int, n: int) -> int:
    """Where the n words before a place begin."""
    size = 16 * n
    while n:
        low = max(0, at - size)
        starts = [m.start() for m in _words.finditer(text, low, at)]
        if low == 0 or len(starts) > n:  # the first one may be cut
            return starts[-n] if len(starts) >= n else 0
        size *= 2
    return at


def _ahead(text: str, at: int, n: int) -> int:
    """Where the n words after a place end."""
    return max((m.end() for m in islice(_words.finditer(text, at), n)), default=at)


def blocks(text: str) -> list[tuple[int, int]]:
    """Ranges around candidates, those that touch merged; each holds the whole of its notice."""
    out: list[tuple[int, int]] = []
    for place in _place.finditer(text):
        for kind, before, after in _kinds:
            m = kind.match(text, place.start())
            if m:
                begin, end = min(max(0, m.start() - BEFORE), _back(text, m.start(), before)), max(min(len(text), m.end() + AFTER), _ahead(text, m.end(), after))
                while out and begin <= out[-1][1]:
                    low, high = out.pop()
                    begin, end = min(begin, low), max(end, high)
                out.append((begin, end))
    return out


def _aligned(template: list[str], block: list[str], lost: int = 1) -> np.ndarray:
    """The least edits of words between template and any stretch that ends at each place of block; lost: what a word of the template that is not there counts."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys([*template, *block]))}
    there = np.array([numbers[w] for w in block], np.int64)
    row = np.zeros(len(block) + 1, np.int64)
    steps = np.arange(len(block) + 1)
    for i, word in enumerate(template, 1):
        best = np.minimum(row[1:] + lost, row[:-1] + lost * (there != numbers[word]))
        full = np.concatenate([[i * lost], best])
        row = np.minimum.accumulate(full - steps) + steps  # words of the block that the template lacks
    return row


def differences(template: list[str], block: list[str]) -> int:
    """The least edits of words between template and any stretch of block."""
    return int(_aligned(template, block).min())


def occurrences(template: list[str], block: list[str]) -> list[tuple[int, int, int]]:
    """(differences, begin, end) of the stretches of block that are template within its limit of differences; of stretches that end closely together the closest, then the first."""
    most = most_differences(len(template))
    short = len(template) < LEAST_WORDS
    there = set(block)
    if sum(w not in there for w in template) > (0 if short else most):
        return []
    lost = most + 1 if short else 1
    row = _aligned(template, block, lost)
    ends = np.flatnonzero(row <= most)
    apart = max(1, (len(template) - most) // 2)
    taken: list[int] = []
    blocked = np.zeros(len(row), bool)
    for end in ends[np.argsort(row[ends], kind="stable")].tolist():
        if not blocked[end]:
            blocked[max(0, end - apart) : end + apart + 1] = True
            taken.append(end)
    out = []
    for end in taken:
        size = int(_aligned(template[::-1], block[max(0, end - len(template) - most) : end][::-1], lost).argmin())
        if size:
            out.append((int(row[end]), end - size, end))
    return out


def changes(template: list[str], stretch: list[str]) -> str:
    """The words to drop (-) and add (+) to make stretch of template, in order, by a least edit."""
    rows = [list(range(len(stretch) + 1))]
    for i, word in enumerate(template, 1):
        row = [i]
        for j, other in enumerate(stretch, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (word != other)))
        rows.append(row)
    i, j, out = len(template), len(stretch), []
    while i or j:
        if i and j and rows[i][j] == rows[i - 1][j - 1] + (template[i - 1] != stretch[j - 1]):
            i, j = i - 1, j - 1
            if template[i] != stretch[j]:
                out += [f"+{stretch[j]}", f"-{template[i]}"]
        elif j and rows[i][j] == rows[i][j - 1] + 1:
            j -= 1
            out.append(f"+{stretch[j]}")
        else:
            i -= 1
            out.append(f"-{template[i]}")
    return " ".join(reversed(out))


@lru_cache(1)
def _compressors():
    import zstandard

    def sized(data=None):
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0)
        compressor = zstandard.ZstdCompressor(compression_params=params, dict_data=data)
        return lambda raw: len(compressor.compress(raw))

    both = {name: [*TEMPLATES.get(name, []), *([FULL_TEXTS[name]] if name in FULL_TEXTS else [])] for name in [*TEMPLATES, *FULL_TEXTS]}
    return sized(), [(name, i, sized(zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)), t, words_of(t)) for name, ts in both.items() for i, t in enumerate(ts)]


def _saved(plain, sized, block: str) -> int:
    """Bytes that a template as dictionary saves of a block."""
    raw = block.encode()
    return plain(raw) - sized(raw)


def scanned(block: str) -> list[tuple]:
    """(license, template, begin, end, percent saved, words of the template, differing words, exact, changes) of each notice found, best saving first."""
    plain, templates = _compressors()
    spans = [m.span() for m in _words.finditer(block)]
    have = [block[b:e].lower() for b, e in spans]
    owner = np.full(len(have), -1)  # the hit that holds each word
    queue = [(differ - len(t[4]), differ, k, begin, end) for k, t in enumerate(templates) for differ, begin, end in occurrences(t[4], have)]
    heapq.heapify(queue)
    found, ranks, names = [], [], []
    while queue:
        rank, differ, k, begin, end = heapq.heappop(queue)
        name, i, sized, template, words = templates[k]
        owners = np.unique(owner[begin:end])
        tied = len(owners) == 1 and owners[0] >= 0 and ranks[owners[0]] == (rank, differ) and name not in names[owners[0]]
        if owners.max() >= 0 and not tied:  # align again with the words that are left around it
            low, high = max(0, begin - len(words)), end + len(words)
            left = [w if held < 0 else "" for w, held in zip(have[low:high], owner[low:high].tolist(), strict=True)]
            again = [(d, low + b, low + e) for d, b, e in occurrences(words, left) if (owner[low + b : low + e] < 0).all() and low + b < end and low + e > begin]
            for d, b, e in again:
                heapq.heappush(queue, (d - len(words), d, k, b, e))
            continue
        if tied:
            names[owners[0]].add(name)
        else:
            owner[begin:end] = len(ranks)
            ranks.append((rank, differ))
            names.append({name})
        low, high = spans[begin][0], spans[end - 1][1]
        before, after = block[max(0, low - BEFORE) : low], block[high : high + AFTER]
        bare = [m.span() for m in _words.finditer(template)]
        wanted = f" {' '.join(template.lower().split())} "
        exact = not differ and wanted in f" {' '.join(block[max(0, low - 1) : high + 4 + len(template) - bare[-1][1]].lower().split())} "
        whole = _saved(plain, sized, before + template[bare[0][0] : bare[-1][1]] + after)
        saved = round(100 * _saved(plain, sized, before + block[low:high] + after) / max(1, whole))
        found.append((name, i, low, high, saved, len(words), differ, exact, changes(words, have[begin:end]) if differ else ""))
    return sorted(found, key=lambda hit: (-hit[4], hit[2]))


def scan(docs: DataFrame) -> DataFrame:
    """HITS: a row for each notice in docs (doc_id, text), begin to end being its place in the text."""

    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for begin, end in blocks(text or ""):
                    for place, (name, i, low, high, saved, *rest) in enumerate(scanned(text[begin:end]), 1):
                        rows.append((doc_id, begin + low, begin + high, name, i, saved, place, *rest, text[begin + low : begin + high]))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.string()]
                names = ["doc_id", "begin", "end", "license", "template", "saved_percent", "place", "n_words", "n_differences", "exact", "changes", "block"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").where(F.col("text").rlike(CANDIDATES)).mapInArrow(run, HITS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents")).select("doc_id", "begin", "end", "license", "template", "saved_percent", "place", "n_differences", "exact", "changes", F.sha2("block", 256).alias("block_sha256"))
