"""License scan: winnowed fingerprints pick candidates, banded alignment confirms them.

Templates and documents are folded to lower-case words.  The hashes of all
K-word grams are winnowed (the smallest of every W neighbours stays), so any
common run of K + W - 1 words shares a fingerprint.  An inverted index maps a
fingerprint to its places in the templates; the hits of a document that lie
near one diagonal of a template make a candidate, whose words are aligned with
the template inside a band.  A match reports the share of the template's words
that are aligned with equal words, and the span in the document; it must hold
the phrases that tell the template from its siblings (DECIDING) word for word,
without insertions.

The index is built from the given templates, a fixed list, and goes to every
task; documents are read whole and nothing is shuffled.

Odd input: a null or empty text matches nothing; of overlapping matches the one
with most equal words is reported (then the better covered, then the first); templates with
fewer than K words are compared as one gram of their length; repeated rows
give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recunify.llm.license_texts import TEXTS
from recunify.llm.text import map_slices, mix, pick, roll_windows, span_hashes, utf8, words

K, W = 3, 2
#: Half width of the alignment band, as a share of the template's words and at least so many.
BAND_SHARE, BAND = 0.1, 4
#: Share of a template's fingerprints that makes a candidate, and of its words that makes a match.
CANDIDATE, COVERAGE = 0.25, 0.75

_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General "
        "Public License as published by the Free Software Foundation, either version {1} of the License, or (at your "
        "option) any later version.")
_GNU_REST = (" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
             "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public "
             "License for more details. You should have received a copy of the GNU {0}General Public License along with "
             "this program.")
_GNU_KINDS = {"GPL-2.0": ("", "2"), "GPL-3.0": ("", "3"), "LGPL-2.1": ("Lesser ", "2.1"), "LGPL-3.0": ("Lesser ", "3"),
              "AGPL-3.0": ("Affero ", "3")}
_APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
           "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")
_CC = ("BY", "BY-NC", "BY-NC-ND", "BY-NC-SA", "BY-ND", "BY-SA")

# Short references, grants, whole notices and whole texts of common licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": _APACHE,
    "Apache-2.0-header-whole": _APACHE + " Unless required by applicable law or agreed to in writing, software distributed "
                               "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
                               "ANY KIND, either express or implied. See the License for the specific language governing "
                               "permissions and limitations under the License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                      "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    **{f"CC-{v}-4.0": f"Licensed under CC {v} 4.0." for v in _CC},
    **{n: f"This work is licensed under the GNU {k}General Public License, version {v}." for n, (k, v) in _GNU_KINDS.items()},
    **{f"{n}-notice": _GNU.format(*kv) for n, kv in _GNU_KINDS.items()},
    **{f"{n}-notice-whole": (_GNU + _GNU_REST).format(*kv) for n, kv in _GNU_KINDS.items()},
    **TEXTS,
}

#: Phrases that tell a template from its siblings: a match must hold them unbroken, each.
DECIDING = {
    **{n: ["Apache License Version 2.0"] for n in ("Apache-2.0", "Apache-2.0-header", "Apache-2.0-header-whole")},
    "MIT": ["MIT License"],
    **{n: ["Mozilla Public License v 2.0"] for n in ("MPL-2.0", "MPL-2.0-notice")},
    **{f"CC-{v}-4.0": [f"under CC {v} 4.0"] for v in _CC},
    **{n: [f"GNU {k}General Public License version {v}"] for n, (k, v) in _GNU_KINDS.items()},
    **{n + end: [f"GNU {k}General Public License as published", f"version {v} of the License"]
       for n, (k, v) in _GNU_KINDS.items() for end in ("-notice", "-notice-whole")},
    "GPL-1.0-text": ["GNU General Public License Version 1"], "GPL-2.0-text": ["GNU General Public License Version 2"],
    "GPL-3.0-text": ["GNU General Public License Version 3"],
    "LGPL-2.0-text": ["GNU Library General Public License Version 2"],
    "LGPL-2.1-text": ["GNU Lesser General Public License Version 2.1"],
    "LGPL-3.0-text": ["GNU Lesser General Public License Version 3"],
    "BSD-3-Clause-text": ["may be used to endorse or promote products"],
    "BSD-4-Clause-text": ["must display the following acknowledgement", "may be used to endorse or promote products"],
}

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _FOLD[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _FOLD[_c] = _c + 32


def folded(column: pa.Array) -> np.ndarray:
    """The bytes of a text column: A-Z in lower case, all but letters, digits and non-ASCII as spaces."""
    return _FOLD[utf8(column)[1]]


def word_codes(column: pa.Array):
    """Codes of the folded words of a text column, first word of each text, and their byte spans."""
    offs, data = utf8(column)
    data = _FOLD[data]
    starts, ends, first = words(offs, data)
    return span_hashes(data, starts, ends), first, starts, ends, offs


def winnow(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, places) of the words of one text."""
    k = min(K, len(codes))
    if not k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = mix(roll_windows(codes, k)[:len(codes) - k + 1] + np.uint64(k))
    if len(grams) <= W:
        return grams, np.arange(len(grams))
    view = np.lib.stride_tricks.sliding_window_view(grams, W)
    at = np.unique(view.argmin(1) + np.arange(len(view)))
    return grams[at], at


class Index:
    """Fingerprints of all templates in order, with template and place."""

    def __init__(self, templates: dict[str, str], deciding: dict[str, list[str]] | None = None):
        self.names = sorted(templates)
        self.deciding = [[word_codes(pa.array([p]))[0] for p in (deciding or {}).get(n, [])] for n in self.names]
        self.codes = [word_codes(pa.array([templates[n]]))[0] for n in self.names]
        prints = [winnow(c) for c in self.codes]
        self.sizes = np.array([len(p[0]) for p in prints])
        flat = np.concatenate([p[0] for p in prints])
        order = np.argsort(flat, kind="stable")
        self.prints = flat[order]
        self.template = np.repeat(np.arange(len(prints)), self.sizes)[order]
        self.place = np.concatenate([p[1] for p in prints])[order]

    def hits(self, prints: np.ndarray, places: np.ndarray):
        """(template, place in template, place in text) of every shared fingerprint."""
        lo, hi = np.searchsorted(self.prints, prints, "left"), np.searchsorted(self.prints, prints, "right")
        some = np.flatnonzero(hi > lo)
        at = [np.arange(lo[i], hi[i]) for i in some]
        if not at:
            return []
        n, at = np.repeat(places[some], [len(a) for a in at]), np.concatenate(at)
        return sorted(zip(self.template[at].tolist(), self.place[at].tolist(), n.tolist()))


#: A cell of the alignment is one number: score, then equal words, then the smallest start.
_PART = 21
_EQUAL, _SCORE, _LOW = 1 << _PART, 1 << 2 * _PART, (1 << _PART) - 1
_NONE = -(1 << 60)


def align(template: np.ndarray, text: np.ndarray, band: int) -> tuple[int, int, int]:
    """(equal words, first, end) of the best alignment of the template with a part
    of the text; cell (i, j) is inside the band if |j - i - band| <= 2 * band."""
    best, n = (0, 0, 0), len(text)
    row = _LOW - np.arange(n + 1, dtype=np.int64)  # score 0, no equal words, start j
    for i, t in enumerate(template):
        lo, hi = max(0, i - band), min(n, i + 3 * band)
        if lo > hi:
            break
        new = row[lo:hi + 1] - _SCORE
        at = np.arange(max(lo, 1), hi + 1)
        same, before = text[at - 1] == t, row[at - 1]
        fresh = (before >> _PART) & _LOW == 0
        began = np.where(fresh, (before & ~_LOW) | (_LOW - (at - 1)), before)
        step = np.where(same, began + (2 * _SCORE + _EQUAL), before - _SCORE)
        np.maximum(new[len(new) - len(at):], step, out=new[len(new) - len(at):])
        drop = np.arange(len(new), dtype=np.int64) * _SCORE
        new = np.maximum.accumulate(new + drop) - drop
        row = np.full(n + 1, _NONE, np.int64)
        row[lo:hi + 1] = new
        if same.any():
            cells, ends = row[at][same], at[same]
            equal = np.where(cells > _NONE // 2, (cells >> _PART) & _LOW, 0)
            k = int(equal.argmax())
            if equal[k] > best[0]:
                best = (int(equal[k]), _LOW - int(cells[k] & _LOW), int(ends[k]))
    return best


def holds(codes: np.ndarray, phrase: np.ndarray) -> bool:
    """Whether the words hold the phrase unbroken."""
    if len(codes) < len(phrase):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(codes, len(phrase)) == phrase).all(1).any())


def scan(codes: np.ndarray, index: Index) -> list[tuple[str, int, int, float]]:
    """(template, first word, end word, coverage) of the matches in one text, by place."""
    hits, found, k = index.hits(*winnow(codes)), [], 0
    while k < len(hits):
        t = hits[k][0]
        own = []
        while k < len(hits) and hits[k][0] == t:
            own.append(hits[k])
            k += 1
        template = index.codes[t]
        band = max(BAND, round(BAND_SHARE * len(template)))
        diagonals = sorted((d - p, p, d) for _, p, d in own)
        groups = [[diagonals[0]]]
        for x in diagonals[1:]:
            if x[0] - groups[-1][0][0] <= band:
                groups[-1].append(x)
            else:
                groups.append([x])
        for g in groups:
            if len({p for _, p, _ in g}) < max(1, CANDIDATE * index.sizes[t]):
                continue
            lo = max(0, g[0][0] - band)
            equal, a, z = align(template, codes[lo:lo + len(template) + 3 * band], band)
            if equal >= COVERAGE * len(template) and all(holds(codes[lo + a:lo + z], p) for p in index.deciding[t]):
                found.append((equal, equal / len(template), lo + a, lo + z, index.names[t]))
    out = []
    for _, c, a, z, name in sorted(found, key=lambda f: (-f[0], -f[1], f[2], f[4])):
        if all(z <= x[1] or a >= x[2] for x in out):
            out.append((name, a, z, c))
    return sorted(out, key=lambda f: (f[1], f[2], f[0]))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id, n_matches, names, coverage, starts, ends (characters of the text) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(
        Index(templates) if templates else Index(TEMPLATES, DECIDING))  # the given list
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(b: pa.RecordBatch):
        codes, first, starts, ends, offs = word_codes(b.column(1))
        found = [scan(codes[a:z], shared.value) for a, z in zip(first[:-1], first[1:])]
        chars = []
        for k, f in enumerate(found):
            raw = (b.column(1)[k].as_py() or "").encode() if f else b""
            at = lambda n: len(raw[:n - offs[k]].decode(errors="ignore"))
            chars.append([(at(starts[first[k] + a]), at(ends[first[k] + z - 1])) for _, a, z, _ in f])
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(f) for f in found], pa.int64()),
             pa.array([[x[0] for x in f] for f in found], pa.list_(pa.string())),
             pa.array([[round(x[3], 6) for x in f] for f in found], pa.list_(pa.float64())),
             pa.array([[c[0] for c in x] for x in chars], pa.list_(pa.int64())),
             pa.array([[c[1] for c in x] for x in chars], pa.list_(pa.int64()))],
            ["doc_id", "n_matches", "names", "coverage", "starts", "ends"])
    return map_slices(pick(docs, doc_id=doc_id, text=text),
                      f"doc_id {kind}, n_matches bigint, names array<string>, coverage array<double>, "
                      "starts array<bigint>, ends array<bigint>", run)
