"""License scans by patience alignment.

Text and template are sequences of words (runs of letters and digits in lower case). An
alignment anchors on words that occur once in both, takes the longest run of anchors that
rises in both, and aligns the gaps between them in the same way; equal words at the ends of
a gap match as well. Coverage is the share of the template's words that are matched.

Templates are whole license texts (``licenses``), short notices and lines that name a
license; versions and variants are templates of their own. Words that tell variants apart
(version numbers, NC, SA, Lesser, ...) have to be matched, and a span that holds others of
them unmatched is no match. Of matches that overlap, the best stays: the one with most
matched words, less the template's words it lacks and half of the further words it spans.

Only texts whose words, counted with repeats, can reach the coverage are aligned, and of
those only stretches where anchors are at most two templates apart. Spans are searched from
left to right at the places a once-occurring word puts the template's beginning, a sixteenth
of the template apart at least. A span has one, one and a half and two templates' length and
grows by a template more as long as that matches further words. The next search starts
behind a match, so a text may hold a license several times.

Defined cases: a null text and one without words give no rows, nor does a text without a
match; a null id is kept; repeated rows are scanned row by row; further columns are ignored.
Whole texts are scanned; a task holds one text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain, count
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, rows_of

WORD = re.compile(r"[^\W_]+")
MATCHES = "doc_id long, license string, coverage double, start long, stop long, matched int, words int"

#: Words that tell variants apart, in any template; in templates of fewer than NOTICE words; numbers there are versions.
VARIANT = frozenset("lesser affero noncommercial sharealike noderivs noderivatives endorse advertising".split())
TELLING = VARIANT | frozenset("mit apache mozilla eclipse bsd isc boost cc creative gnu documentation library nc nd sa cc0 zero either later only".split())
NOTICE = 100
VERSION = re.compile(r"\d{1,2}$")
#: Words at the top of a whole text among which "version" names its version.
TITLE = 20
#: What follows is advice on how to apply a license.
END = ["end", "of", "terms", "and", "conditions"]


def _templates() -> dict[str, str]:
    """Licenses, notices and names as they are published. Read on the driver, which sends them along."""
    out = {p.name.removesuffix(".txt"): p.read_text("utf-8").strip() for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}
    out["Apache-2.0 (notice)"] = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License."""
    for family, kind, versions in (("Apache", "Apache", ("1.0", "1.1", "2.0")), ("MPL", "Mozilla Public", ("1.0", "1.1", "2.0")), ("EPL", "Eclipse Public", ("1.0", "2.0"))):
        for v in versions:
            out[f"{family}-{v} (named)"] = f"Licensed under the {kind} License, Version {v}."
    out["MPL-2.0 (notice)"] = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at"""
    out["MPL-1.1 (notice)"] = """The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not
        use this file except in compliance with the License."""
    for name in ("MIT", "ISC"):
        out[f"{name} (named)"] = f"Released under the {name} License."
    for n in "234":
        out[f"BSD-{n}-Clause (named)"] = f"Released under the BSD {n}-Clause License."
    out["BSL-1.0 (named)"] = "Distributed under the Boost Software License, Version 1.0."
    out["CC0-1.0 (named)"] = "Licensed under CC0 1.0."
    for family, kind, versions in (("GPL", "", "123"), ("LGPL", "Library ", "2"), ("LGPL", "Lesser ", ("2.1", "3")), ("AGPL", "Affero ", "3")):
        for v in versions:
            name = f"{family}-{v}" if "." in v else f"{family}-{v}.0"
            line = f"This work is licensed under the GNU {kind}General Public License, version {v}"
            terms = f"you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation"
            out[f"{name} (named)"] = f"{line}."
            out[f"{name}-or-later (named)"] = f"{line} or later."
            out[f"{name}-only"] = f"{terms}, version {v} of the License."
            out[f"{name}-or-later"] = f"{terms}, either version {v} of the License, or (at your option) any later version."
    for v, where in (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
        no = "NoDerivatives" if v == "4.0" else "NoDerivs"
        for short, long in (("", ""), ("-SA", "-ShareAlike"), ("-ND", f"-{no}"), ("-NC", "-NonCommercial"), ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", f"-NonCommercial-{no}")):
            out[f"CC-BY{short}-{v} (named)"] = f"Licensed under CC BY{short} {v}."
            out[f"CC-BY{short}-{v} (notice)"] = f"This work is licensed under a Creative Commons Attribution{long} {v} {where} License."
    return out


TEMPLATES = _templates()


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, ordered by the first number, whose second number rises."""
    tops: list[int] = []  # the pair that ends the best subsequence of each length
    ends: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(ends, b)
        before.append(tops[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(i)
            ends.append(b)
        else:
            tops[pile], ends[pile] = i, b
    out, i = [], tops[-1] if tops else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def align(template: list[str], text: list[str]) -> list[tuple[int, int]]:
    """Matched places (template, text), rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(text))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and template[a] == text[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and template[a_end - 1] == text[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            out.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        in_a, in_b = Counter(template[a:a_end]), Counter(text[b:b_end])
        at = {w: j for j, w in enumerate(text[b:b_end], b) if in_b[w] == 1}
        anchors = rising([(i, at[w]) for i, w in enumerate(template[a:a_end], a) if in_a[w] == 1 and w in at])
        if anchors:
            out += anchors
            corners = [(a - 1, b - 1), *anchors, (a_end, b_end)]
            todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(corners, corners[1:])]
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str, least: float):
        self.name, self.words = name, words(text)
        self.counts = Counter(self.words)
        self.places = {w: i for i, w in enumerate(self.words) if self.counts[w] == 1}
        self.need = max(1, -int(-least * len(self.words) + 1e-9))
        if not self.places:
            raise ValueError(f"{name}: none of its words occurs once")
        notice = len(self.words) < NOTICE
        self.telling = TELLING if notice else VARIANT
        self.numbered = notice and any(VERSION.match(w) for w in self.words)
        end = next((i for i in range(len(self.words)) if self.words[i : i + len(END)] == END), len(self.words))
        self.required = frozenset(w for w in self.words[:end] if self.tells(w))
        top = self.words if notice else self.words[:TITLE]
        #: The word before the version's first number, and the places of its numbers.
        at = next((i for i in range(len(top) - 1) if VERSION.match(top[i + 1]) and (notice or top[i] == "version")), len(top))
        self.version = [i for i in (at + 1, at + 2) if i < len(top) and VERSION.match(top[i])]
        self.titled = not notice
        # A match lacks at most so many words before its first anchor.
        self.starts = frozenset(sorted(self.places, key=self.places.get)[: len(self.words) - self.need + 1])

    def tells(self, word: str) -> bool:
        return word in self.telling or self.numbered and VERSION.match(word) is not None

    def reachable(self, text: Counter[str]) -> bool:
        return self.required <= text.keys() and sum(min(n, text[w]) for w, n in self.counts.items()) >= self.need

    def score(self, found: list[tuple[int, int]]) -> float:
        return 2 * len(found) - len(self.words) - (found[-1][1] - found[0][1] + 1 - len(found)) / 2 if found else -len(self.words)

    def told(self, found: list[tuple[int, int]], text: list[str]) -> bool:
        """Whether the words that tell variants apart speak for this template."""
        taken, here = {b for _, b in found}, {a for a, _ in found}
        if not self.required <= {self.words[a] for a in here}:
            return False
        if self.version and not here.issuperset(self.version) and not (self.titled and self.version[0] - 1 not in here):
            return False
        return not any(b not in taken and self.tells(text[b]) for b in range(found[0][1], found[-1][1]))

    def grown(self, text: list[str], begin: int) -> list[tuple[int, int]]:
        """The best alignment from a place on."""
        m = len(self.words)
        best: list[tuple[int, int]] = []
        most = 0
        for size in chain((m, m + m // 2), count(2 * m, m)):
            found = align(self.words, text[begin : begin + size])
            more, most = len(found) > most, max(most, len(found))
            if (len(found) >= self.need, self.score(found)) > (len(best) >= self.need, self.score(best)):
                best = found
            if len(best) == m or begin + size >= len(text) or size >= 2 * m and not more:
                break
        return [(a, begin + b) for a, b in best]

    def stretches(self, text: list[str]) -> Iterator[tuple[int, int, list[int]]]:
        """(begin, end, anchors) where anchors follow each other closely and the words suffice."""
        m = len(self.words)
        hits = [i for i, w in enumerate(text) if w in self.places]
        cuts = [0, *(k for k in range(1, len(hits)) if hits[k] - hits[k - 1] > 2 * m), len(hits)]
        for low, high in zip(cuts, cuts[1:]):
            if part := hits[low:high]:
                begin, end = max(0, part[0] - 2 * m), part[-1] + 2 * m
                if self.reachable(Counter(text[begin:end])):
                    yield begin, end, part

    def matches(self, text: list[str]) -> Iterator[tuple[int, int, int, float]]:
        """(first word, end, matched words, score) of each match, from left to right."""
        m, behind = len(self.words), 0
        for low, high, hits in self.stretches(text):
            tried: set[int] = set()
            here = text[:high]
            for i in hits:
                begin = max(behind, i - self.places[text[i]], 0)
                if i < behind or text[i] not in self.starts or begin // max(1, m // 16) in tried:
                    continue
                tried.add(begin // max(1, m // 16))
                best = self.grown(here, begin)
                if len(best) >= self.need and best[0][1] > begin:
                    best = max(best, self.grown(here, best[0][1]), key=self.score)
                if len(best) >= self.need and self.told(best, text):
                    yield best[0][1], best[-1][1] + 1, len(best), self.score(best)
                    behind = best[-1][1] + 1
                    tried.clear()


def scan(text: str | None, templates: list[Template], vocabulary: frozenset[str]) -> list[tuple]:
    """(license, coverage, start, stop, matched, words) with character places in the text."""
    lower = (text or "").lower()
    found = Counter(w for w in WORD.findall(lower) if w in vocabulary)
    wanted = [t for t in templates if t.reachable(found)]
    if not wanted:
        return []
    # Lower-casing may change lengths, so places come from the text itself.
    spans = [m.span() for m in WORD.finditer(text)]
    text_words = [text[a:b].lower() for a, b in spans]
    every = sorted(((t, *m) for t in wanted for m in t.matches(text_words)), key=lambda x: (-x[4], x[1], x[0].name))
    best: list[tuple] = []
    for match in every:
        at = bisect_left(best, match[1], key=lambda x: x[1])
        if (at == 0 or best[at - 1][2] <= match[1]) and (at == len(best) or match[2] <= best[at][1]):
            best.insert(at, match)
    return [(t.name, n / len(t.words), spans[a][0], spans[b - 1][1], n, len(t.words)) for t, a, b, n, _ in best]


def _scanned(templates: dict[str, str], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Template(n, t, least) for n, t in templates.items()]
        vocabulary = frozenset(w for t in ready for w in t.counts)
        types = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        for batch in batches:
            out = [(doc_id, *m) for doc_id, text in rows_of(iter([batch])) for m in scan(text, ready, vocabulary)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [c.split()[0] for c in MATCHES.split(", ")])

    return run


def matches(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per match: doc_id, license, coverage, start, stop (characters), matched, words (of the template)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(rows, _scanned(templates or TEMPLATES, least), MATCHES)
