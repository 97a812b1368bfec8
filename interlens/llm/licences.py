"""Licence scan: normalised text against licence templates by the Dice
coefficient over word bigrams.

Normalised: A-Z folded, and only letters, digits and bytes above 127 count, so
punctuation and layout do not matter.  Each template is a set of word bigrams.
Compared are the passages of a text: every line, the blocks of lines between
blank lines (a notice of several lines) and, with ``windows``, every run of words
inside the text, whatever its lines, comment marks and surroundings.  Two sets of
a and b bigrams have a Dice coefficient 2|A & B| / (a + b) of at most
2 min(a, b) / (a + b); so for a threshold t only templates of t / (2 - t) * a to
(2 - t) / t * a bigrams are candidates, and the rest are never compared.

Windows are cut per template of b bigrams: a run that reaches t holds t / (2 - t) * b
of them at least, and loses nothing if it starts and ends with one of them.  So
runs start only where that many of the template's bigrams follow within
(2 - t) / t of its length (repeats counted), and only those are compared.

Templates are a short fixed table (a parameter): its size is known before it is
sent.  Documents are never shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textvec as tv
from .common import id_text

# The short notices as authors write them (four are those of the given documents), the notices and
# conditions as the licences word them, and the whole texts of the short ones (of the long ones the title and notice).  Licences that share wording stand side by side with the same notices, so that
# the best template is the right one; what several share alone has a name of its own (BSD) or one without a version.
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:")
_BSD_SOURCE = (" 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
               "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
               "this list of conditions and the following disclaimer in the documentation and/or other materials "
               "provided with the distribution.")
_BSD_ADVERT = (" 3. All advertising materials mentioning features or use of this software must display the following "
               "acknowledgement: This product includes software developed by the copyright holder.")
_BSD_NAMES = (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission.")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."
# whole texts of the short licences
_AS_IS = (" THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
          "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
          "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
          "IN THE SOFTWARE.")
_MIT_KEEP = (", subject to the following conditions: The above copyright notice and this permission notice shall be included "
             "in all copies or substantial portions of the Software.")
_ISC_AS_IS = (" THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
              "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
              "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
              "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
              "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_AS_IS = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
              "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
              "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
              "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
              "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
              "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
              "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_PUBLIC_DOMAIN = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
    "or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
    "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the "
    "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
    "relinquishment in perpetuity of all present and future rights to this software under copyright law.")
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
    "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
    "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The "
    "origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this "
    "software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered "
    "source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice "
    "may not be removed or altered from any source distribution.")


def _gnu(full: str, version: str, *things: str) -> list[str]:
    """Short notices of a GNU licence, its own notice (which may name the work a
    program or a library) and the form without later versions."""
    of = "," if version == "1" else " of the License,"
    return [f"This work is licensed under the GNU {full} Public License, version {version}.",
            *(f"This {x} is free software: you can redistribute it and/or modify it under the terms of the GNU {full} "
              f"Public License as published by the Free Software Foundation, either version {version}{of} or (at your "
              "option) any later version." for x in things),
            *(f"This {x} is free software; you can redistribute it and/or modify it under the terms of the GNU {full} "
              f"Public License version {version} as published by the Free Software Foundation." for x in things)]


def _creative_commons() -> dict[str, list[str]]:
    out = {}
    for version, where in (("4.0", " International"), ("3.0", " Unported"), ("2.5", " Generic"), ("2.0", " Generic"),
                           ("1.0", " Generic"), ("", "")):
        for kind, full in (("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-NC", "-NonCommercial"), ("BY-ND", "-NoDerivatives"),
                           ("BY-NC-SA", "-NonCommercial-ShareAlike"), ("BY-NC-ND", "-NonCommercial-NoDerivatives")):
            v = f" {version}" if version else ""
            out[f"CC-{kind}{v.replace(' ', '-')}"] = [
                f"Licensed under CC {kind}{v}.",
                f"This work is licensed under a Creative Commons Attribution{full}{v}{where} License."]
    return out


TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"],
    "ECL-2.0": [
        "Licensed under the Educational Community License, Version 2.0.",
        "Licensed under the Educational Community License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.opensource.org/licenses/ECL-2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", f"{_MIT}, subject to the following conditions:",
            f"{_MIT}{_MIT_KEEP}{_AS_IS}"],
    "MIT-0": [f"{_MIT}. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND", f"{_MIT}.{_AS_IS}"],
    "GPL-3.0": [*_gnu("General", "3", "program"),
                "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "GPL-2.0": [*_gnu("General", "2", "program"),
                "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-1.0": [*_gnu("General", "1", "program"),
                "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"],
    "GPL": ["This work is licensed under the GNU General Public License."],
    "LGPL-3.0": [*_gnu("Lesser General", "3", "program", "library"),
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.1": [*_gnu("Lesser General", "2.1", "library", "program"),
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-2.0": [*_gnu("Library General", "2", "library", "program"),
                 "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL": ["This work is licensed under the GNU Lesser General Public License."],
    "AGPL-3.0": [*_gnu("Affero General", "3", "program"),
                 "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "AGPL": ["This work is licensed under the GNU Affero General Public License."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", f"{_BSD}{_BSD_SOURCE} 3.{_BSD_NAMES}",
                     f"{_BSD}{_BSD_SOURCE} 3.{_BSD_NAMES}{_BSD_AS_IS}"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", f"{_BSD}{_BSD_SOURCE}", f"{_BSD}{_BSD_SOURCE}{_BSD_AS_IS}"],
    "BSD-4-Clause": ["Licensed under the BSD 4-Clause License.", f"{_BSD}{_BSD_SOURCE}{_BSD_ADVERT} 4.{_BSD_NAMES}",
                     f"{_BSD}{_BSD_SOURCE}{_BSD_ADVERT} 4.{_BSD_NAMES}{_BSD_AS_IS}"],
    "BSD": [_BSD],
    "ISC": ["Released under the ISC License.", "Licensed under the ISC License.", f"{_ISC}{_ISC_KEEP}", f"{_ISC}{_ISC_KEEP}{_ISC_AS_IS}"],
    "0BSD": [f"{_ISC}.", f"{_ISC}.{_ISC_AS_IS}"],
    "Zlib": ["Licensed under the zlib License.", _ZLIB],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "MPL-1.1": [
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
        "use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.mozilla.org/MPL/"],
    "CC0-1.0": [
        "Licensed under CC0 1.0.",
        "Licensed under CC0 1.0 Universal.",
        "This work is licensed under a CC0 1.0 Universal License.",
        "This work is marked with CC0 1.0 Universal.",
        "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty."],
    **_creative_commons(),
    "Unlicense": ["This is free and unencumbered software released into the public domain.", _PUBLIC_DOMAIN,
                  f"{_PUBLIC_DOMAIN}{_AS_IS} For more information, please refer to https://unlicense.org"],
}

_PART = np.ones(256, bool)       # separators of normalised words
for _c in (*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)):
    _PART[_c] = False
_NOT_LINE = np.zeros(256, bool)
_NOT_LINE[10] = True


def _bigrams(c: tv.Chunk):
    w = tv.words(c, lower=True, separator=_PART)
    n = len(w.hash)
    if n < 2:
        return w, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = np.flatnonzero(w.doc[1:] == w.doc[:-1])
    return w, ok, tv.mix(w.hash[ok] * tv.U64(0xD6E8FEB86659FD93) + w.hash[ok + 1])


class Templates:
    def __init__(self, table: dict[str, list[str]], threshold: float):
        self.threshold = threshold
        self.names, sets, runs = [], [], []
        for name, texts in table.items():
            for t in texts:
                self.names.append(name)
                sets.append(np.unique(_bigrams(next(tv.chunks(pa.array([t]), 1)))[2]))
                runs.append(len(_bigrams(next(tv.chunks(pa.array([t]), 1)))[2]))
        order = np.argsort([len(s) for s in sets], kind="stable")
        self.names = [self.names[i] for i in order]
        self.sets = [sets[i] for i in order]
        self.size = np.array([len(s) for s in self.sets])
        self.known = np.unique(np.concatenate(self.sets))
        self.member = np.array([np.isin(self.known, s) for s in self.sets])
        self.least = [max(1, math.ceil(b * threshold / (2 - threshold) - 1e-9)) for b in self.size]
        self.longest = [math.floor(runs[i] * (2 - threshold) / threshold + 1e-9) for i in order]

    def best(self, h: np.ndarray) -> tuple[float, int]:
        """Highest coefficient of the bigrams ``h`` with a candidate template."""
        a, t = len(h), self.threshold
        lo = np.searchsorted(self.size, math.ceil(a * t / (2 - t) - 1e-9))
        hi = np.searchsorted(self.size, math.floor(a * (2 - t) / t + 1e-9), "right")
        out = (0.0, -1)
        for i in range(lo, hi):
            dice = 2 * len(np.intersect1d(h, self.sets[i], assume_unique=True)) / (a + len(self.sets[i]))
            if dice > out[0]:
                out = (dice, i)
        return out

    def scan(self, c: tv.Chunk):
        """(row, start byte, end byte, template, coefficient) of passages at or
        over the threshold, in text order."""
        w, at, h = _bigrams(c)
        lines = tv.words(c, separator=_NOT_LINE, hashed=False)
        if not len(at) or not len(lines.start):
            return []
        known = np.isin(h, self.known)
        line = np.searchsorted(lines.start, w.start[at], "right") - 1
        after = np.searchsorted(lines.start, w.start[at + 1], "right") - 1
        # blocks: lines with nothing but one line break between them
        joined = np.zeros(len(lines.start), bool)
        joined[1:] = (lines.doc[1:] == lines.doc[:-1]) & (lines.start[1:] == lines.end[:-1] + 1)
        block = np.cumsum(~joined) - 1
        first = np.flatnonzero(~joined)
        last = np.append(first[1:], len(joined)) - 1
        out = set()
        # a passage reaches t only if enough of its bigrams are any template's
        for unit, begin, end in ((np.where(line == after, line, -1), lines.start, lines.end),
                                 (np.where(block[line] == block[after], block[line], -1), lines.start[first], lines.end[last])):
            at_unit = np.flatnonzero(unit >= 0)
            ordered = unit[at_unit]
            seen = np.bincount(ordered[known[at_unit]], minlength=len(begin))
            for u in np.flatnonzero(seen):
                mine = np.unique(h[at_unit[np.searchsorted(ordered, u):np.searchsorted(ordered, u, "right")]])
                dice, i = self.best(mine)
                if dice >= self.threshold:
                    out.add((int(lines.doc[np.searchsorted(lines.start, begin[u])]), int(begin[u]), int(end[u]), i, dice))
        return sorted(out)

    def _windows(self, w: tv.Words, at: np.ndarray, h: np.ndarray):
        """(first word, last word, template, bigrams in common, coefficient) of
        the runs of words at or over the threshold, as arrays for each template."""
        k = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        place = np.flatnonzero(self.known[k] == h)
        k, doc, before = k[place], w.doc[at], None
        for i, (b, least, longest) in enumerate(zip(self.size, self.least, self.longest)):
            p = place[self.member[i, k]]
            if len(p) < least:
                continue
            start, enough = p[:len(p) - least + 1], p[least - 1:]
            start = start[(enough - start < longest) & (doc[enough] == doc[start])]
            if not len(start):
                continue
            if before is None:       # place of the same bigram before
                order = np.argsort(h, kind="stable")
                same = h[order[1:]] == h[order[:-1]]
                before = np.full(len(h), -1)
                before[order[1:][same]] = order[:-1][same]
            mine = np.zeros(len(h), bool)
            mine[p] = True
            size = max(1, (1 << 18) // longest)
            for lo in range(0, len(start), size):
                s = start[lo:lo + size, None]
                j = s + np.arange(longest)
                inside = j < len(h)
                j = np.minimum(j, len(h) - 1)
                new = inside & (doc[j] == doc[s]) & (before[j] < s)
                hit = new & mine[j]
                common = np.cumsum(hit, 1)
                dice = 2 * common / (np.cumsum(new, 1) + b)
                r, e = np.nonzero(hit & (dice >= self.threshold))
                yield at[s[r, 0]], at[j[r, e]] + 1, np.full(len(r), i), common[r, e], dice[r, e]

    def search(self, c: tv.Chunk):
        """As ``scan``, over lines, blocks and windows: of passages that share a
        word, the one with the most in common (bigrams times coefficient)."""
        w, at, h = _bigrams(c)
        if not len(at):
            return []
        parts = list(self._windows(w, at, h))
        units = self.scan(c)
        if units:
            _, a, b, i, dice = (np.array(x) for x in zip(*units))
            a, b = np.searchsorted(w.start, a), np.searchsorted(w.start, b) - 1
            common = [len(np.intersect1d(h[np.searchsorted(at, x):np.searchsorted(at, y)], self.sets[n]))
                      for x, y, n in zip(a, b, i)]
            parts.append((a, b, i, np.array(common), dice))
        if not parts:
            return []
        a, b, i, common, dice = (np.concatenate(x) for x in zip(*parts))
        left = np.lexsort((i, b, a, -dice, -(common * dice)))
        taken, out, step = np.zeros(len(w.start), bool), [], 64
        while len(left):
            for x in left[:step].tolist():
                if not taken[a[x]:b[x] + 1].any():
                    taken[a[x]:b[x] + 1] = True
                    out.append((int(w.doc[a[x]]), int(w.start[a[x]]), int(w.end[b[x]]), int(i[x]), float(dice[x])))
            left, step = left[step:], step * 2
            used = np.concatenate([[0], np.cumsum(taken)])
            left = left[used[b[left] + 1] == used[a[left]]]
        return sorted(out)


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = 0.8,
         id_col: str = "doc_id", text_col: str = "text", windows: bool = False) -> DataFrame:
    """Licences of every document, from the passages that match a template.

    Returns one row per input row: doc_id, licences (names, sorted, joined by
    commas; empty if none), n_passages, best_dice, spans (start:end:name in code
    points, joined by commas).  Null, empty and single-word texts match nothing.
    A template that a line and its block both match counts for each passage.
    With ``windows`` (the registered query) passages are also any run of words,
    and no two of them share a word: of those that do the one with the most in
    common counts, so a notice is found inside longer lines, across line breaks
    and comment marks, and once.
    Rows without an id are left out; repeated rows are scanned each.  Empty
    table: empty result.  Extra columns are not read.
    """
    table = TEMPLATES if templates is None else templates

    def run(batches):
        t = Templates(table, threshold)
        for batch in batches:
            for c in tv.chunks(batch.column(1)):
                found: dict[int, list] = {}
                for row, a, b, i, dice in t.search(c) if windows else t.scan(c):
                    raw, lo = c.data, c.offsets[row]
                    before = int(np.count_nonzero((raw[lo:a] & 0xC0) != 0x80))
                    size = int(np.count_nonzero((raw[a:b] & 0xC0) != 0x80))
                    found.setdefault(row, []).append((before, before + size, t.names[i], dice))
                rows = [found.get(r, []) for r in range(c.n_docs)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(c.first, c.n_docs),
                    pa.array([",".join(sorted({x[2] for x in r})) for r in rows], pa.string()),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([max((x[3] for x in r), default=0.0) for r in rows], pa.float64()),
                    pa.array([",".join(f"{a}:{b}:{n}" for a, b, n, _ in r) for r in rows], pa.string())],
                    ["doc_id", "licences", "n_passages", "best_dice", "spans"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, licences string, n_passages long, best_dice double, spans string")
