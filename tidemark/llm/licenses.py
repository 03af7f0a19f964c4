"""License scans by patience alignment.

A template's words are aligned with a stretch of text: words that are unique in both are anchors,
the longest increasing run of anchors is kept, and each gap between kept anchors is aligned in the
same way, where more words have become unique. Coverage is the aligned share of the template.

The templates are notices (TEMPLATES) and the public texts and file headers in the folder templates.
A text may hold a notice several times, which leaves no unique words, so it is first cut into
stretches around seeds (SEED words in a row that a template has; LONG_SEED for templates of over LONG
words, of whose seeds a tenth must stand in a stretch); stretches further apart than the
template is long are aligned on their own. Within a stretch a copy's seeds agree on where it begins
(place in the text less place in the template), so each such beginning is aligned alone in a window
of about one template. Of overlapping alignments the one with the fewest words missing or inserted
stays; each that stays is aligned once more in the room between its neighbours. Words are lower-cased
runs of letters and digits.

Work per text is its hashing plus alignment around seeds only, where enough words of the template
stand; no shuffle, templates are a parameter of fixed size.

Defined results: null and empty texts, and templates without words, give no rows; every row of the
input is scanned, repeats included; a null id stays null; the best coverage per license is returned
with its number of stretches; a stretch that overlaps one in which a license has more words aligned (or
as many and a better coverage) is left to that one, so a longer license is not reported as a shorter one
that it contains; equals are both returned, and the earlier stretch stands for several; other columns are left
out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from importlib import resources
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.textkit import shingles, word_hashes

COVERAGE = 0.8
SEED = 2
LONG = 200  # words of a template from which seeds are longer
LONG_SEED = 4
LONG_SHARE = 0.1

# Fixed texts: license notices as they are commonly written.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software."
    ),
    "bsd-2-clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
}


def all_templates() -> dict[str, str]:
    """The notices, and the public license texts and headers of the folder templates."""
    files = resources.files(__package__).joinpath("templates").iterdir()
    texts = {f.name[: -len(".txt")]: f.read_text("utf-8") for f in files if f.name.endswith(".txt")}
    return {**texts, **TEMPLATES}


# ASCII letters in lower case, digits and bytes beyond ASCII stay; the rest parts words.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
    for b in range(256)
)


def normal(text: str) -> bytes:
    return text.encode().translate(_NORMAL)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs rising in both; pairs are sorted by the first."""
    tops: list[int] = []
    piles: list[int] = []
    below: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        below.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            piles.append(k)
        else:
            tops[at], piles[at] = j, k
    run, k = [], piles[-1] if piles else -1
    while k >= 0:
        run.append(pairs[k])
        k = below[k]
    return run[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions of a and b, rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = _rising(
            [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        )
        if not anchors:
            continue
        out.extend(anchors)
        ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:]))
    return sorted(out)


class _Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.words = next(word_hashes([normal(text)]))[1]
        width = LONG_SEED if len(self.words) > LONG else SEED
        self.width = min(width, max(1, len(self.words)))
        own = shingles(self.words, self.width)
        self.order = np.argsort(own, kind="stable")  # places of seeds, by seed
        self.placed = own[self.order]
        self.least_hits = LONG_SHARE * len(own) if len(self.words) > LONG else 1
        self.pattern = self.words.tolist()


class _Lookup:
    """Values that several templates have, looked up once for all of them."""

    def __init__(self, sets: dict[str, np.ndarray]):
        self.values = np.unique(np.concatenate(list(sets.values())))
        self.of = {}
        for name, own in sets.items():
            self.of[name] = np.zeros(len(self.values), bool)
            self.of[name][np.searchsorted(self.values, own)] = True

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where values lie in x that any template has, and which they are."""
        at = np.minimum(np.searchsorted(self.values, x), len(self.values) - 1)
        where = np.flatnonzero(self.values[at] == x)
        return where, at[where]


class _Templates:
    def __init__(self, templates: dict[str, str]):
        found = [_Template(k, v) for k, v in sorted(templates.items())]
        self.all = [t for t in found if len(t.words)]
        self.words = _Lookup({t.name: t.words for t in self.all}) if self.all else None
        widths = {t.width for t in self.all}
        self.seeds = {
            w: _Lookup({t.name: t.placed for t in self.all if t.width == w}) for w in widths
        }


def _stretches(hits: np.ndarray, reach: int, n: int) -> Iterator[tuple[int, int]]:
    """Word ranges around groups of hits; groups are further than reach apart."""
    cuts = np.flatnonzero(np.diff(hits) > reach) + 1
    for group in np.split(hits, cuts):
        yield max(0, int(group[0]) - reach), min(n, int(group[-1]) + reach + 1)


def scan(words: np.ndarray, templates: _Templates, least: float) -> Iterator[tuple]:
    """(license, coverage, first word, word after the last, stretches) of what a text holds."""
    if len(words) < 1 or not templates.all:
        return
    known, which = templates.words.places(words)
    seeds: dict[int, tuple] = {}
    matches: list[tuple] = []  # (aligned words, coverage, first word, word after the last, license)
    for t in templates.all:
        need = least * len(t.words)
        if len(known) < need:
            continue
        own = known[templates.words.of[t.name][which]]
        if len(own) < need:
            continue
        if t.width not in seeds:
            runs = shingles(words, t.width)
            seeds[t.width] = runs, *templates.seeds[t.width].places(runs)
        runs, at, seed = seeds[t.width]
        hits = at[templates.seeds[t.width].of[t.name][seed]]
        if not len(hits):
            continue
        is_known = np.zeros(len(words), np.int64)
        is_known[own] = 1
        sums = np.append(0, np.cumsum(is_known))
        for a, b in _stretches(hits, len(t.words), len(words)):
            inside = hits[(hits >= a) & (hits < b)]
            if sums[b] - sums[a] >= need and len(inside) >= t.least_hits:
                found = _copies(words, runs, inside, a, b, t, sums, least)
                matches.extend((round(c * len(t.words)), c, lo, hi, t.name) for c, lo, hi in found)
    kept = _undisputed(sorted(matches, key=lambda m: (-m[0], -m[1], m[2], m[4])))
    found = Counter(m[4] for m in kept)
    seen: set[str] = set()
    for _, coverage, first, last, name in kept:  # the best of each license comes first
        if name not in seen:
            seen.add(name)
            yield name, coverage, first, last, found[name]


def _beginnings(seeds: np.ndarray, hits: np.ndarray, t: _Template) -> Iterator[int]:
    """Where copies may begin: of each group of near beginnings the one that most seeds agree on."""
    low = np.searchsorted(t.placed, seeds[hits], "left")
    times = np.searchsorted(t.placed, seeds[hits], "right") - low
    at = np.repeat(low - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(times.sum())
    begins, votes = np.unique(np.repeat(hits, times) - t.order[at], return_counts=True)
    group = begins // max(1, len(t.words) // 8)
    best = np.lexsort((begins, -votes, group))
    yield from begins[best[np.append(True, np.diff(group[best]) != 0)]].tolist()


def _copies(
    words: np.ndarray,
    seeds: np.ndarray,
    hits: np.ndarray,
    a: int,
    b: int,
    t: _Template,
    sums: np.ndarray,
    least: float,
) -> list[tuple[float, int, int]]:
    """(coverage, first word, word after the last) of a template's copies in a stretch, disjoint.

    sums: how many words before each place of the text the template has, a bound of what can align.
    """
    n = len(t.pattern)
    tried: dict[tuple[int, int], tuple | None] = {}

    def aligned(lo: int, hi: int) -> tuple | None:
        lo, hi = max(a, lo), min(b, hi)
        if (lo, hi) not in tried:
            found = None
            if hi > lo and sums[hi] - sums[lo] >= least * n:
                pairs = align(t.pattern, words[lo:hi].tolist())
                if len(pairs) >= least * n:
                    first, last = pairs[0][1] + lo, pairs[-1][1] + lo + 1
                    found = (n - len(pairs)) + (last - first - len(pairs)), first, last, len(pairs)
            tried[lo, hi] = found
        return tried[lo, hi]

    def exact(found: list[tuple]) -> bool:
        """Whole copies unchanged, with too few of the template's words outside for another."""
        ends = [a, *(x for m in found for x in m[1:3]), b]
        return all(m[0] == 0 for m in found) and all(
            sums[hi] - sums[lo] < least * n for lo, hi in zip(ends[::2], ends[1::2])
        )

    found = [m for lo, hi in _windows(a, b, n) if (m := aligned(lo, hi))]
    if not (len(found) == 1 and exact(found)):
        ahead, behind = 1 + n // 8, n + 1 + n // 4
        for begin in _beginnings(seeds, hits, t):
            m = aligned(begin, begin + n)
            if m is None or m[0]:
                tries = [(begin - ahead, begin + behind), (begin, begin + 2 * n)]
                found.extend(x for lo, hi in tries if (x := aligned(lo, hi)))
            if m:
                found.append(m)
    kept: list[tuple] = []
    for m in sorted(set(found)):
        at = bisect_left(kept, m[1], key=lambda k: k[1])
        if (at == 0 or kept[at - 1][2] <= m[1]) and (at == len(kept) or kept[at][1] >= m[2]):
            kept.insert(at, m)
    begins = [*(m[1] for m in kept[1:]), b]
    done: list[tuple[float, int, int]] = []
    room = a
    for (_, first, last, size), following in zip(kept, begins):
        if size < n and (m := aligned(max(room, first - n), min(following, last + n))):
            if m[3] > size:
                _, first, last, size = m
        done.append((size / n, first, last))
        room = last
    return done


def _undisputed(matches: list[tuple]) -> list[tuple]:
    """Matches, best first, without those that overlap a better one: similar notices differ in few
    words, and a stretch of text is the one that fits it best."""
    kept: list[tuple] = []
    starts: list[int] = []
    ends: list[int] = []  # disjoint ranges of all better matches, in order
    for _, group in groupby(matches, key=lambda m: m[:2]):
        group = list(group)
        for m in group:
            at = bisect_left(ends, m[2] + 1)
            if at == len(starts) or starts[at] >= m[3]:
                kept.append(m)
        ranges = sorted([*zip(starts, ends), *((m[2], m[3]) for m in group)])
        starts, ends = [], []
        for a, b in ranges:
            if ends and a <= ends[-1]:
                ends[-1] = max(ends[-1], b)
            else:
                starts.append(a)
                ends.append(b)
    return kept


def _windows(a: int, b: int, length: int) -> Iterator[tuple[int, int]]:
    """A stretch as one window, or, where many seeds chain up, as overlapping windows."""
    size = 4 * length
    if b - a <= size:
        yield a, b
        return
    for lo in range(a, b - length, 2 * length):
        yield lo, min(b, lo + size)


def licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE
) -> DataFrame:
    """doc_id, license, coverage, first_word, last_word, n_found of each license in each row.

    templates: texts by name, of a fixed size; by default all that the library has.
    """
    texts = all_templates() if templates is None else templates

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Templates(texts)
        for b in batches:
            raw = [normal(t.as_py()) for t in b.column(1)]
            out = [(i, *row) for i, w in word_hashes(raw) for row in scan(w, known, least)]
            columns = list(zip(*out)) if out else [[], [], [], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(columns[0], pa.int64())),
                    pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.float64()),
                    *(pa.array(c, pa.int64()) for c in columns[3:]),
                ],
                ["doc_id", "license", "coverage", "first_word", "last_word", "n_found"],
            )

    schema = (
        "doc_id long, license string, coverage double, first_word long, last_word long, "
        "n_found long"
    )
    return docs.where("text IS NOT NULL").select("doc_id", "text").mapInArrow(rows, schema)
