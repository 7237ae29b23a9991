"""Periodic runs of words, by maximal-pair enumeration on the LCP-interval tree of each text.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least
``max(MIN_LENGTH, MIN_EXPONENT * q)`` long, that no neighbouring word extends keeping period q.

Method. Words are numbered, a suffix array of the word sequence is built by prefix doubling (numpy sorts),
and the LCP of neighbouring suffixes by binary lifting over the ranks of every doubling level. The
LCP-interval tree is walked bottom-up with a stack. Each interval holds its positions as a sorted list and,
per left word (the word before a position), a class list. When children of an interval with LCP value l are
merged, the pairs (i, j) from different children are right-maximal with common length exactly l; taking j
only from class lists other than i's makes them left-maximal too. A maximal pair whose distance p satisfies
``2p <= l`` and ``l + p >= MIN_LENGTH`` spans the stretch [i, j + l) of period p that can't be extended: a
run, with no extension step. Its smallest period is the smallest distance found for the same stretch.

Only pairs within the distance bound are looked up (by bisection in the sorted lists), so the work follows
the runs, not all repeats. Intervals with l < 16 can hold no such pair (p <= l/2 and l + p >= 24), so only
stretches of the suffix array whose neighbours share 16 or more words are walked, and a text without a
repeated 16-word sequence (checked first by hashes of all its 16-grams) skips the suffix array entirely.
All texts are whole; nothing is capped.

Defined cases: a null or empty text has no words and no runs; texts shorter than MIN_LENGTH words have none.
Repeated rows give equal results. Runs are listed by start, then period. The collapsed text keeps a word
unless a run holds it after that run's first q words; words are joined by one space.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import map_columns

# Fixed values of the dealt definition.
MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Intervals below this LCP value can hold no run: p <= l / (MIN_EXPONENT - 1) and l + p >= MIN_LENGTH.
MIN_LCP = -(-MIN_LENGTH * (MIN_EXPONENT - 1) // MIN_EXPONENT)

RUN = "struct<start:long,length:long,period:long>"


def word_ids(words: Sequence[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))


def _has_repeat(ids: np.ndarray, width: int) -> bool:
    """Whether some word sequence of ``width`` words occurs twice (hash collisions only cost time)."""
    n = len(ids)
    if n < width + 1:
        return False
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        h = h * np.uint64(1099511628211) + mixed[k:n - width + 1 + k]
    return len(np.unique(h)) < len(h)


def _suffix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of w[i : i + 2**j] for j = 0, 1, ... until all suffixes differ (blocks past the end are padded)."""
    n = len(ids)
    levels = [np.unique(ids, return_inverse=True)[1].astype(np.int64)]
    step = 1
    while True:
        r = levels[-1]
        shifted = np.full(n, -1, dtype=np.int64)
        shifted[: n - step] = r[step:]
        keys, rank = np.unique(r * (n + 1) + shifted + 1, return_inverse=True)
        levels.append(rank.astype(np.int64))
        step *= 2
        if len(keys) == n:
            return levels


def _neighbour_lcp(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """lcp[r] = common length of suffixes sa[r-1] and sa[r] (lcp[0] = 0), by binary lifting."""
    n = len(sa)
    a, b = sa[:-1].copy(), sa[1:].copy()
    got = np.zeros(n - 1, dtype=np.int64)
    for j in range(len(levels) - 1, -1, -1):
        step = 1 << j
        valid = (a < n) & (b < n)
        lev = levels[j]
        same = valid & (lev[np.minimum(a, n - 1)] == lev[np.minimum(b, n - 1)])
        got += same * step
        a += same * step
        b += same * step
    return np.concatenate([[0], got])


class _Node:
    """Positions of an interval: all sorted, and sorted per left word."""

    __slots__ = ("pos", "cls")

    def __init__(self, p: int, left: int):
        self.pos = [p]
        self.cls = {left: [p]}


def _report(small: _Node, big: _Node, lcp: int, left: np.ndarray, out: dict) -> None:
    """Maximal pairs between two children of an interval with value ``lcp`` that are runs."""
    p_max = lcp // (MIN_EXPONENT - 1)
    p_min = max(1, MIN_LENGTH - lcp)
    if p_min > p_max:
        return
    for i in small.pos:
        c = int(left[i])
        same = big.cls.get(c, ())
        for lo, hi in ((i - p_max, i - p_min), (i + p_min, i + p_max)):
            a, b = bisect_left(big.pos, lo), bisect_right(big.pos, hi)
            if b - a == 0 or (same and b - a == bisect_right(same, hi) - bisect_left(same, lo)):
                continue
            js = np.asarray(big.pos[a:b], dtype=np.int64)
            for j in js[left[js] != c].tolist():
                s, p = min(i, j), abs(i - j)
                key = (s, lcp + p)
                if p < out.get(key, 1 << 62):
                    out[key] = p


def _merge(acc: _Node, child: _Node, lcp: int, left: np.ndarray, out: dict) -> _Node:
    small, big = (acc, child) if len(acc.pos) <= len(child.pos) else (child, acc)
    if lcp >= MIN_LCP:
        _report(small, big, lcp, left, out)
    for p in small.pos:
        insort(big.pos, p)
    for c, ps in small.cls.items():
        into = big.cls.get(c)
        if into is None:
            big.cls[c] = list(ps)
        else:
            for p in ps:
                insort(into, p)
    return big


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a word-id sequence, by start, then period."""
    n = len(ids)
    if n < MIN_LENGTH or not _has_repeat(ids, MIN_LCP):
        return []
    levels = _suffix_ranks(ids)
    sa = np.argsort(levels[-1], kind="stable")
    lcp = _neighbour_lcp(sa, levels)
    left = np.concatenate([[-1], ids[:-1]])
    found: dict[tuple[int, int], int] = {}
    deep = lcp >= MIN_LCP
    r = 1
    while r < n:
        if not deep[r]:
            r += 1
            continue
        lo = r - 1
        while r < n and deep[r]:
            r += 1
        _walk(sa, lcp, lo, r - 1, left, found)
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda t: (t[0], t[2]))


def _walk(sa: np.ndarray, lcp: np.ndarray, lo: int, hi: int, left: np.ndarray, out: dict) -> None:
    """Bottom-up walk of the intervals of sa[lo..hi], all of whose neighbours share MIN_LCP or more words."""
    stack: list[list] = []
    carry = _Node(int(sa[lo]), int(left[sa[lo]]))
    for r in range(lo + 1, hi + 1):
        value = int(lcp[r])
        while stack and stack[-1][0] > value:
            top_value, acc = stack.pop()
            carry = _merge(acc, carry, top_value, left, out)
        if stack and stack[-1][0] == value:
            stack[-1][1] = _merge(stack[-1][1], carry, value, left, out)
        else:
            stack.append([value, carry])
        carry = _Node(int(sa[r]), int(left[sa[r]]))
    while stack:
        top_value, acc = stack.pop()
        carry = _merge(acc, carry, top_value, left, out)


def collapse(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, p in runs:
        drop[s + p] += 1
        drop[s + length] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    return b" ".join(w for w, g in zip(words, gone.tolist()) if not g)


def _work():
    def run(texts: pa.Array) -> list[pa.Array]:
        all_runs, collapsed = [], []
        for t in texts.to_pylist():
            words = (t or "").encode("utf-8").split()
            found = find_runs(word_ids(words))
            all_runs.append([{"start": s, "length": length, "period": p} for s, length, p in found])
            collapsed.append(collapse(words, found).decode("utf-8"))
        return [pa.array(all_runs, type=pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                pa.array(collapsed, type=pa.string())]

    return run


def detect(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with ``runs`` (array of start, length, period; by start, then period) and ``collapsed``
    (the text without the repeats of its runs). No shuffle: each text is worked on where it lies."""
    carry = list(docs.columns if carry is None else carry)
    return map_columns(docs, [F.col(text)], f"runs array<{RUN}>, collapsed string", _work, carry=carry)


def plain_runs(words: Sequence) -> list[tuple[int, int, int]]:
    """Runs by the definition, by brute force (for tests): every period, every maximal stretch."""
    n = len(words)
    out = []
    for q in range(1, n // MIN_EXPONENT + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(MIN_LENGTH, MIN_EXPONENT * q) and _smallest_period(words[s:s + length]) == q:
                out.append((s, length, q))
    return sorted(out, key=lambda t: (t[0], t[2]))


def _smallest_period(seq: Sequence) -> int:
    for q in range(1, len(seq) + 1):
        if all(seq[k] == seq[k + q] for k in range(len(seq) - q)):
            return q
    return len(seq)


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
