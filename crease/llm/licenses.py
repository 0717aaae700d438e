"""Licence scans by conditional compression.

Candidate blocks (runs of lines with licence wording) are compressed alone and with
each template as a raw zstandard dictionary.  Every template that saves bytes is
ranked by how many, and confirmed or refused by its exact wording differences: most of its words must
stand there in order, all that tell it from its kin (names, versions) among them and no others
of that sort between, and nothing before that denies it.  The best confirmed
one is a statement; its words are taken out, and what is left on either side is judged in turn until
nothing confirms, so a block may hold several licences.
"""

from __future__ import annotations

import difflib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Public licence statements and notices, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                   "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                   "specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
            "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
            "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
            "PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
                     "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
                     "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
                     "distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
                     "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
                     "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
                     "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # whole notices, with what they say of warranty
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
            "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
            "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
            "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
            "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
            "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
            "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
            "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
            "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
            "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
)

_BSD_TAIL = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
             "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
             "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
             "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
             "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
             "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_NOTICE = ("This {what} is free software{stop} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
           "Free Software Foundation{stop2} either version {version} of the License, or (at your option) any later version.")


def _families() -> list[tuple[str, str]]:
    """Templates that differ by a name or version alone, made by rule."""
    out = [(f"BSD-{n}-Clause", next(t for i, t in TEMPLATES if i == f"BSD-{n}-Clause" and len(t) > 200) + _BSD_TAIL) for n in (2, 3)]
    gnu = (("AGPL", "Affero General Public License", ("3",)), ("LGPL", "Lesser General Public License", ("2.1", "3")),
           ("GPL", "General Public License", ("2", "3")))
    for short, name, versions in gnu:
        for v in versions:
            spdx = f"{short}-{v if '.' in v else v + '.0'}"
            old = v.startswith("2")
            for what in ("library", "program"):
                out.append((spdx, _NOTICE.format(what=what, name=name, version=v, stop=";" if old else ":", stop2=";" if old else ",")))
            out.append((spdx, f"This work is licensed under the GNU {name}, version {v}."))
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        out += [(f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}.") for v in ("2.0", "2.5", "3.0", "4.0")]
    for spdx in dict.fromkeys([i for i, _ in TEMPLATES] + [i for i, _ in out] + ["0BSD", "BSL-1.0", "EPL-2.0", "Zlib", "GPL-3.0-or-later",
                              "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "LGPL-2.1-or-later", "AGPL-3.0-or-later"]):
        out.append((spdx, f"SPDX-License-Identifier: {spdx}"))
    return out


TEMPLATES += tuple(_families())

#: Words that tell licences apart, beside versions: those of a template must stand in a statement, and no others of them within it.
NAMES = frozenset(("apache", "mit", "isc", "bsd", "mozilla", "mpl", "gnu", "affero", "lesser", "cc", "2-clause", "3-clause", "unencumbered",
                   "by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"))
DENIALS = frozenset(("not", "never", "no", "neither", "nor", "cannot", "without"))

#: A line with one of these may belong to a licence statement.
CUES = ("licen", "copyright", "permission is", "permitted provided", "redistribut", "spdx-", "public domain", "without warrant")
MORE_CUES = CUES + ("warrant", "merchantab", "liab", "conditions", "free software", "as is", "the software", "notice", "endorse", "later version", "your option")
_CUE = re.compile("|".join(map(re.escape, CUES)))
_MORE = re.compile("|".join(map(re.escape, MORE_CUES)))
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
_VERSION = re.compile(r"v?[0-9]+(?:\.[0-9]+)+")
GAP = 3                  # lines without wording that a block may hold in a row
SPAN, LAP = 1200, 500    # words of a block that are judged at once, and that two spans share (no statement has more)
SHORT = 20               # a statement of fewer words is one sentence, which a denial within it turns round
MIN_MATCHED = 0.8        # share of the template's words that the block must have in order
CACHE = 50_000           # distinct blocks whose verdict a worker remembers


def blocks(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of runs of lines with licence wording; a run begins and ends with
    such lines, holds at most ``GAP`` others in a row and has a sure cue."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):                    # a letter that lengthens in lower case would shift positions
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    if not any(c in low for c in CUES):
        return []
    out, at, start, end, idle, sure = [], 0, None, 0, 0, False
    for line in low.split("\n"):
        stop = at + len(line)
        if _MORE.search(line):
            start = at if start is None else start
            end, idle, sure = stop, 0, sure or _CUE.search(line) is not None
        elif start is not None:
            idle += 1
            if idle > GAP:
                if sure:
                    out.append((start, end))
                start, idle, sure = None, 0, False
        at = stop + 1
    if start is not None and sure:
        out.append((start, end))
    return out


def telling(words: list[str]) -> list[bool]:
    """Which words tell a licence from its kin: names, versions, and what an SPDX tag says."""
    tag = words[:1] == ["spdx-license-identifier"]
    return [w in NAMES and not (w == "by" and words[max(0, i - 1)] != "cc") or _VERSION.fullmatch(w) is not None
            or i > 0 and words[i - 1] in ("version", "v") and w[0].isdigit() or tag
            for i, w in enumerate(words)]


class Scanner:
    def __init__(self, templates=TEMPLATES):
        squeeze = lambda t: " ".join(t.lower().split())
        self.squeeze = squeeze
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.templates = []
        for name, text in templates:
            held = zstandard.ZstdCompressionDict(squeeze(text).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words = _WORD.findall(text.lower())
            self.templates.append((name, words, telling(words),
                                   zstandard.ZstdCompressor(level=3, dict_data=held, write_content_size=False)))
        self.known: dict[str, list[tuple]] = {}

    def judge(self, block: str) -> list[tuple]:
        """(start, end, licence, template number, reduction, words matched, missing, extra) of every
        statement of a block, by start; positions are the block's."""
        if block not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[block] = self._judge(block)
        return self.known[block]

    def _judge(self, block: str) -> list[tuple]:
        low = block.lower()
        if len(low) != len(block):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in block)
        found = [(m.start(), m.end()) for m in _WORD.finditer(low)]
        words, out, start = [low[a:b] for a, b in found], [], 0
        while start < len(words):
            stop = min(len(words), start + SPAN)
            limit = stop if stop == len(words) else stop - LAP       # what begins behind it may be cut: the next span has it
            here = [v for v in self._within(low, words, found, start, stop) if v[0] < limit]
            out += here
            start = max([limit, *(v[1] + 1 for v in here)])
        return sorted((found[first][0], found[last][1], *verdict) for first, last, *verdict in out)

    def _within(self, low, words, found, lo, hi) -> list[tuple]:
        """Statements between two words: the best one, then those on either side of it."""
        out, left = [], [(lo, hi)]
        while left:
            lo, hi = left.pop()
            best = self._best(low, words, found, lo, hi) if hi - lo > 1 else None
            if best is not None:
                out.append(best)
                left += [(lo, best[0]), (best[1] + 1, hi)]
        return out

    def _best(self, low, words, found, lo, hi) -> tuple | None:
        """The best confirmed template between two words: the one with the most words matched over missing and
        extra ones; ties go to the greater reduction, then to the earlier template."""
        raw = self.squeeze(low[found[lo][0]:found[hi - 1][1]]).encode("utf-8", "replace")
        alone = len(self.plain.compress(raw))
        best, rank = None, None
        for i, (name, wording, tells, compressor) in enumerate(self.templates):
            less = len(compressor.compress(raw)) - alone
            if less >= 0:
                continue
            got = self.confirm(words[lo:hi], wording, tells)
            if got is None:
                continue
            first, last, same, extra = got
            if len(wording) < SHORT and self._denied(low, words, found, lo + first, lo + last):
                continue
            missing = len(wording) - same
            mine = (same - missing - extra, -less, -i)
            if rank is None or mine > rank:
                rank, best = mine, (lo + first, lo + last, name, i, -less / max(1, alone), same, missing, extra)
        return best

    @staticmethod
    def confirm(words: list[str], wording: list[str], tells: list[bool]) -> tuple[int, int, int, int] | None:
        """(first, last word, words matched, words between that are not the template's), or None: too few words
        match, or one that tells licences apart is missing or too many."""
        if not {w for w, t in zip(wording, tells, strict=True) if t} <= set(words):
            return None
        match = [m for m in difflib.SequenceMatcher(None, wording, words, autojunk=False).get_matching_blocks() if m.size]
        # a chance match far from the rest is no part of the statement
        while len(match) > 1 and match[1].b - match[0].b - match[0].size > 2 * match[0].size + 2:
            match.pop(0)
        while len(match) > 1 and match[-1].b - match[-2].b - match[-2].size > 2 * match[-1].size + 2:
            match.pop()
        same = sum(m.size for m in match)
        if not match or same < MIN_MATCHED * len(wording):
            return None
        kept = {m.a + k for m in match for k in range(m.size)}
        if any(t and i not in kept for i, t in enumerate(tells)):
            return None
        first, last = match[0].b, match[-1].b + match[-1].size - 1
        inside = {m.b + k for m in match for k in range(m.size)}
        span = words[first:last + 1]
        if any(t and first + k not in inside for k, t in enumerate(telling(span))):
            return None
        return first, last, same, len(span) - same

    @staticmethod
    def _denied(low, words, found, first, last) -> bool:
        """Whether a short statement is turned round: a denial within it, or up to three words before in its sentence."""
        if any(w in DENIALS for w in words[first:last + 1]):
            return True
        for k in range(first - 1, max(-1, first - 4), -1):
            if re.search(r"[.;!?\n]", low[found[k][1]:found[k + 1][0]]):
                return False
            if words[k] in DENIALS:
                return True
        return False


def scan(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence statement: ``doc_id, start, end, license, template,
    reduction, n_matched, n_missing, n_extra, exact``.

    ``start`` and ``end`` are code points of the whole text, of the statement's first and last words; ``reduction`` is the
    share of the compressed size of what was judged that the template saves; ``exact`` says that the
    wording has no difference.  A block with several statements gives a row for each.  Null, empty
    and other texts give no rows; repeated rows give repeated results; templates that confirm alike: the earlier.
    """
    def run(batches):
        scanner = Scanner(templates)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for start, end in blocks(text):
                    rows += [(doc, start + a, start + z, *v, v[4] == 0 and v[5] == 0) for a, z, *v in scanner.judge(text[start:end])]
            columns = list(zip(*rows, strict=True)) or [()] * 10
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[
                "doc_id", "start", "end", "license", "template", "reduction", "n_matched", "n_missing", "n_extra", "exact"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, start long, end long, license string, template long, reduction double, n_matched long, "
             "n_missing long, n_extra long, exact boolean")
