"""License scans: winnowed fingerprints find candidates, banded alignment measures them.

Templates and texts are taken as runs of ASCII letters and digits, lower-cased. Hashes of ``GRAM``
tokens are winnowed (the least of every ``WINDOW`` in a row is kept), so any stretch of GRAM + WINDOW - 1
tokens that a text shares with a template shares a fingerprint with it. The templates' fingerprints form an inverted
index (bounded by the templates, not the corpus) that goes to every task. Hits near the same diagonal
become one candidate, which is aligned with the template in a band around that diagonal (for long templates by bit-parallel
common subsequences, in a band that grows with them);
matched tokens, their share of the template (coverage) and the span are reported.

Whole texts are scanned, in one pass without a shuffle. A row is one place where a template is covered to at least ``min_coverage``.

Defined cases: null and empty texts give no rows; very long texts are scanned whole; repeated rows give
their rows again; where places overlap, the one with the most matched less unmatched tokens (then the better covered, then the earlier) stays; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3
WINDOW = 2
BAND = 4
MIN_COVERAGE = 0.75
TOKEN = re.compile(r"[a-z0-9]+")

#: Templates of at most SHORT tokens must stand whole and without a gap. Those of at most HEADER tokens must have all their numbers and names;
#: those of over BANDED tokens are aligned in a band that grows with them.
SHORT, HEADER, BANDED = 16, 100, 48
#: Words that tell sister licences apart: a place has the same of them as its template.
KINDS = frozenset("noncommercial noderivatives noderivs sharealike".split())
NAMES = KINDS | frozenset("lesser affero library documentation mit bsd apache mozilla eclipse isc nc nd sa".split())


def notices() -> dict[str, str]:
    """The usual one-line notices of the common licences, as fixed values."""
    out: dict[str, str] = {}
    count: Counter[str] = Counter()

    def add(name: str, *phrases: str) -> None:
        for phrase in phrases:
            count[name] += 1
            out[f"{name} notice {count[name]}"] = phrase

    starts = ("Licensed under", "Released under", "Distributed under", "Available under")
    for name, said in (
        ("MIT", "MIT License"), ("ISC", "ISC License"), ("BSD", "BSD License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
        ("BSD-4-Clause", "BSD 4-Clause License"), ("Zlib", "zlib License"), ("Unlicense", "Unlicense"), ("BSL-1.0", "Boost Software License, Version 1.0"),
        ("Apache-1.1", "Apache License, Version 1.1"), ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "Apache License 2.0"), ("MPL-1.1", "Mozilla Public License, Version 1.1"),
        ("MPL-2.0", "Mozilla Public License, Version 2.0"), ("MPL-2.0", "Mozilla Public License 2.0"), ("EPL-1.0", "Eclipse Public License, Version 1.0"), ("EPL-1.0", "Eclipse Public License 1.0"),
        ("EPL-2.0", "Eclipse Public License, Version 2.0"), ("EPL-2.0", "Eclipse Public License 2.0"), ("Artistic-1.0", "Artistic License 1.0"), ("Artistic-2.0", "Artistic License 2.0"),
        ("OFL-1.1", "SIL Open Font License, Version 1.1"),
    ):
        order = sorted(starts, key=lambda s: s != ("Released under" if name == "MIT" else "Licensed under"))
        add(name, *[f"{s} {the}{said}" for the in ("the ", "") for s in order])
    for name, family, versions in (
        ("GPL", "General", ("1", "2", "3")), ("LGPL", "Lesser General", ("2.1", "3")), ("LGPL", "Library General", ("2",)), ("AGPL", "Affero General", ("3",)), ("GFDL", "Free Documentation", ("1.1", "1.2", "1.3")),
    ):
        for v in versions:
            full = v if "." in v else f"{v}.0"
            for said in dict.fromkeys((f", version {v}", f" version {full}", f" v{v}", f" v{full}")):
                add(f"{name}-{full}", f"licensed under the GNU {family} {'' if name == 'GFDL' else 'Public '}License{said}")
    words = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        said = "-".join(words[k] for k in kind.split("-"))
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            port = "International" if v == "4.0" else "Unported" if v == "3.0" else "Generic"
            add(f"CC-{kind}-{v}", f"licensed under CC {kind} {v}", f"under CC {kind} {v}", *[f"{on}licensed under {the} Creative Commons {said} {v} {port}" for the in ("a", "the") for on in ("This work is ", "")], f"licensed under a Creative Commons {said} {v} License")
    add("CC0-1.0", "under CC0 1.0", "under the CC0 1.0 Universal", "under a Creative Commons CC0 1.0", "under the Creative Commons Zero")
    return out


def headers() -> dict[str, str]:
    """The notices that licences ask to be put into files."""
    out = {
        "Apache-2.0 header": (
            'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
            "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
            "by applicable law or agreed to in writing, software distributed under the License is distributed on an "
            '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
        ),
        "MPL-2.0 header": (
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
            "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
        ),
        "MPL-1.1 header": (
            "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in "
            "compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"
        ),
        "GFDL-1.3 header": (
            "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, "
            "Version 1.3 or any later version published by the Free Software Foundation"
        ),
        "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    }
    out["GFDL-1.2 header"] = out["GFDL-1.3 header"].replace("1.3", "1.2")
    for name, family, v in (
        ("GPL header", "", "3"), ("GPL-2.0 header", "", "2"), ("GPL-1.0 header", "", "1"), ("LGPL-3.0 header", "Lesser ", "3"), ("LGPL-2.1 header", "Lesser ", "2.1"),
        ("LGPL-2.0 header", "Library ", "2"), ("AGPL-3.0 header", "Affero ", "3"),
    ):
        terms = f"it under the terms of the GNU {family}General Public License as published by the Free Software Foundation"
        out[name] = f"This program is free software: you can redistribute it and/or modify {terms}, either version {v} of the License, or (at your option) any later version."
        only = "GPL-3.0 header" if name == "GPL header" else name
        out[f"{only}, only"] = f"This program is free software; you can redistribute it and/or modify {terms}; version {v} of the License."
    return out


#: The licences' own notices.
TEMPLATES = notices() | headers()
TEXTS = "licence_texts"
#: What notices of one licence have behind its name, and rows don't.
NUMBERED = re.compile(r" notice \d+$")


def bodies() -> dict[str, str]:
    """The whole licence texts that stand beside this module; read on the driver only."""
    folder = files(__package__) / TEXTS
    return {f"{f.name.removesuffix('.txt')} text": f.read_text("utf-8") for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}

RESULTS = "license string, coverage double, n_matched int, start_token int, end_token int, start_char int, end_char int"


def winnow(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the kept grams. Grams that hold an unknown token (0) can't occur in a template and are left out."""
    n = len(ids) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.zeros(n, np.uint64)
    valid = np.ones(n, bool)
    for k in range(GRAM):
        part = ids[k:k + n]
        value = (value ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        valid &= part > 0
    if n < WINDOW:
        kept = np.arange(n)
    else:
        windows = np.lib.stride_tricks.sliding_window_view(value, WINDOW)
        kept = np.unique(np.arange(len(windows)) + windows.argmin(1))
    kept = kept[valid[kept]]
    return kept, value[kept]


def grams(ids: np.ndarray) -> np.ndarray:
    """Hashes of all grams, in order."""
    n = max(0, len(ids) - GRAM + 1)
    value = np.zeros(n, np.uint64)
    for k in range(GRAM):
        value = (value ^ ids[k:k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value


@dataclass(frozen=True)
class Index:
    """``posted`` holds the grams' hashes, ``first[i]:first[i + 1]`` their templates and places; counts and keys are those of each template."""

    names: list[str]
    tokens: list[np.ndarray]
    known: dict[str, int]
    posted: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    counts: list[tuple[np.ndarray, np.ndarray]]
    keys: list[tuple[frozenset[int], frozenset[int], frozenset[int]]]


def build_index(templates: dict[str, str]) -> Index:
    """Every gram of a template is posted, not only the winnowed ones, so that texts and templates need not agree at their ends."""
    known: dict[str, int] = {}
    tokens = [np.array([known.setdefault(w, len(known) + 1) for w in TOKEN.findall(t.lower())], np.int64) for t in templates.values()]
    for word in sorted(NAMES):
        known.setdefault(word, len(known) + 1)
    values = np.concatenate([grams(t) for t in tokens])
    owners = np.repeat(np.arange(len(tokens)), [max(0, len(t) - GRAM + 1) for t in tokens])
    places = np.concatenate([np.arange(max(0, len(t) - GRAM + 1)) for t in tokens])
    order = np.argsort(values, kind="stable")
    posted, first = np.unique(values[order], return_index=True)
    names, kinds, numbers = (frozenset(known[w] for w in words) for words in (NAMES, KINDS, [w for w in known if any(c.isdigit() for c in w)]))
    keys = []
    for t in tokens:
        own, watched = frozenset(t.tolist()), names if len(t) <= HEADER else kinds
        keys.append((watched, own & watched, own & numbers if len(t) <= HEADER else frozenset()))
    counts = [np.unique(t, return_counts=True) for t in tokens]
    sizes = np.array([len(t) for t in tokens])
    return Index([NUMBERED.sub("", n) for n in templates], tokens, known, posted, np.append(first, len(values)), owners[order], places[order], sizes, counts, keys)


def align(template: np.ndarray, text: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """Best local alignment of the two within BAND of the diagonal: matched tokens, and the text's first and last matched place.

    A match scores 2, a mismatch or gap -1. Of equal ends the earlier wins.
    """
    width = 2 * BAND + 1
    none = (0, 0, -1, -1)
    best, row = none, [none] * (width + 2)
    for i, token in enumerate(template.tolist()):
        new = [none] * (width + 2)
        for b in range(1, width + 1):
            j = i + diagonal + b - 1 - BAND
            if not 0 <= j < len(text):
                continue
            same = token == text[j]
            score, matched, first, last = row[b]
            ways = [(score + (2 if same else -1), matched + same, (j if first < 0 else first) if same else first, j if same else last)]
            for score, matched, first, last in (row[b + 1], new[b - 1]):
                ways.append((score - 1, matched, first, last))
            top = max(ways, key=lambda w: w[0])
            new[b] = top if top[0] > 0 else none
            if new[b][0] > best[0]:
                best = new[b]
        row = new
    return best[1:]


def lcs_lengths(masks: dict[int, int], size: int, text: list[int]) -> list[int]:
    """Length of the longest common subsequence of the template (as bit masks of its tokens) and every beginning of the text."""
    full = (1 << size) - 1
    row, out = full, []
    for token in text:
        mask = masks.get(token)
        if mask is not None:
            meet = row & mask
            row = ((row + meet) | (row - meet)) & full
        out.append(size - row.bit_count())
    return out


def masks_of(template: list[int]) -> dict[int, int]:
    out: dict[int, int] = defaultdict(int)
    for i, token in enumerate(template):
        out[token] |= 1 << i
    return out


def align_long(template: np.ndarray, text: np.ndarray, low: int) -> tuple[int, int, int]:
    """Like ``align`` for long templates, in a band of three times ``slack`` diagonals around ``low``; matches score 3, every token of the text costs 1."""
    slack, start = slack_of(len(template)), max(0, low - slack_of(len(template)))
    part = text[start:low + len(template) + 2 * slack].tolist()
    ids = template.tolist()
    end = int(np.argmax(3 * np.array(lcs_lengths(masks_of(ids), len(ids), part)) - np.arange(len(part)))) + 1
    back = np.array(lcs_lengths(masks_of(ids[::-1]), len(ids), part[:end][::-1]))
    size = int(np.argmax(3 * back - np.arange(end))) + 1
    return int(back[size - 1]), start + end - size, start + end - 1


def slack_of(size: int) -> int:
    return max(BAND, size // 8)


def may_cover(index: Index, t: int, part: np.ndarray, needed: float) -> bool:
    """False if the part has too few of the template's tokens, in whatever order: an exact bound on what an alignment can match."""
    kinds, counts = index.counts[t]
    have = np.bincount(part, minlength=len(index.known) + 1)[kinds]
    return int(np.minimum(have, counts).sum()) >= needed


def told_apart(index: Index, t: int, part: np.ndarray) -> bool:
    """Whether a place has the names and numbers by which the template differs from its sisters."""
    watched, names, numbers = index.keys[t]
    have = frozenset(part.tolist())
    return have & watched == names and numbers <= have


def matches(text: str, ids: np.ndarray, found_at: np.ndarray, where: np.ndarray, index: Index, min_coverage: float) -> list[tuple]:
    """Rows of one text from its hits (numbers of posted grams, places in the text)."""
    n = index.first[found_at + 1] - index.first[found_at]
    at = np.repeat(index.first[found_at] - np.cumsum(n) + n, n) + np.arange(n.sum())
    owners, lows = index.owners[at], np.repeat(where, n) - index.places[at]
    sizes = index.sizes[owners]
    # what can't be covered because the text is too short, or too few of its tokens there are known
    known = np.append(0, np.cumsum(ids > 0))
    slack = np.where(sizes > BANDED, np.maximum(BAND, sizes // 8), BAND)
    reach = np.where(sizes > BANDED, 3 * slack, slack)
    around = known[np.clip(lows + sizes + reach, 0, len(ids))] - known[np.clip(lows - reach, 0, len(ids))]
    needed = np.where(sizes <= SHORT, sizes, min_coverage * sizes)
    able = around >= needed
    owners, lows, sizes, slack = owners[able], lows[able], sizes[able], slack[able]
    if not len(owners):
        return []
    lows = np.where(sizes > BANDED, lows // slack * slack, lows)
    places = []
    for t, low in np.unique(np.stack([owners, lows], 1), axis=0).tolist():
        size, template = int(index.sizes[t]), index.tokens[t]
        if size <= SHORT:
            if low >= 0 and np.array_equal(ids[low:low + size], template):
                places.append((t, size, low, low + size - 1))
            continue
        reach = 3 * slack_of(size) if size > BANDED else BAND
        if not may_cover(index, t, ids[max(0, low - reach):low + size + reach], min_coverage * size):
            continue
        matched, first, last = align_long(template, ids, low) if size > BANDED else align(template, ids, low)
        if matched >= min_coverage * size:
            places.append((t, int(matched), int(first), int(last)))
    # at a place stays the template with the most matched tokens less those missing and those in between
    rows, taken = [], []
    for t, matched, first, last in sorted(set(places), key=lambda p: (-(3 * p[1] - int(index.sizes[p[0]]) - (p[3] - p[2] + 1)), -p[1] / int(index.sizes[p[0]]), p[2], p[0])):
        if all(last < a or first > b for a, b in taken):
            if int(index.sizes[t]) > SHORT and not told_apart(index, t, ids[first:last + 1]):
                continue
            taken.append((first, last))
            rows.append((index.names[t], matched / int(index.sizes[t]), matched, first, last + 1))
    if not rows:
        return []
    spans = [m.span() for m in TOKEN.finditer(ascii_lower(text))]
    return [(*r, spans[r[3]][0], spans[r[4] - 1][1]) for r in sorted(rows, key=lambda r: (r[3], r[0]))]


UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_lower(text: str) -> str:
    """Lower-cases A-Z only, so places stay the same."""
    return text.translate(UPPER) if not text.isascii() else text.lower()


def scan(docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """doc_id and where its text matches which template. A shared stretch of GRAM + WINDOW - 1 tokens is needed for a candidate."""
    index = build_index(TEMPLATES | bodies() if templates is None else templates)
    names = ["doc_id", *[f.split()[0] for f in RESULTS.split(", ")]]
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k.encode(): v for k, v in index.known.items()}
        tokens_of = re.compile(rb"[a-z0-9]+").findall
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids, ends, total = [], [], 0
            for raw in texts:
                one = np.array([known.get(w, 0) for w in tokens_of((raw or b"").lower())] + [0] * GRAM, np.int64)
                ids.append(one)
                total += len(one)
                ends.append(total)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            places, values = winnow(flat)
            numbers = np.minimum(np.searchsorted(index.posted, values), len(index.posted) - 1)
            hit = index.posted[numbers] == values
            places, numbers = places[hit], numbers[hit]
            owners = np.searchsorted(ends, places, "right")
            rows, rows_of = [], []
            for doc in np.unique(owners).tolist():
                a, b = np.searchsorted(owners, [doc, doc + 1])
                where = places[a:b] - (ends[doc] - len(ids[doc]))
                for row in matches(texts[doc].decode(), ids[doc][:-GRAM], numbers[a:b], where, index, min_coverage):
                    rows.append(row)
                    rows_of.append(doc)
            if rows:
                cols = list(zip(*rows))
                types = [pa.string(), pa.float64(), *[pa.int32()] * 5]
                made = [pa.array(c, t) for c, t in zip(cols, types)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows_of)), *made], names=names)

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind.simpleString()}, {RESULTS}")
