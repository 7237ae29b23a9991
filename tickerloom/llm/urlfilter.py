"""URL filters by a bit-parallel wildcard automaton.

All rules are globs over the canonical URL (lower-cased host, then path). Their
positions are packed into the bits of a few 64-bit words, so that one shift, two
masks and a few ORs per character move every rule of every URL of a batch at once
(Shift-And with self-loops for wildcards; the shift carries from word to word).

In a glob ``*`` stands for any run without ``/``, ``**`` for any run, ``?`` for one
byte; all else for itself. Globs are matched against the UTF-8 bytes of the whole
canonical URL, written with a leading dot before the host so that ``*.a.b/**`` means a.b and
its subdomains.

Defined cases: null urls and those without ``://`` have an empty host and path, fit no host rule, and get the
verdict of the globs for the empty URL (allow by default); very long urls are matched whole; repeated
rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import map_columns

#: Host and path rules with their verdicts; a rule fits the host and its subdomains, if the path starts with the rule's.
SITE_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Globs that block what no site rule decides: words in the host, with or without a path, and paths.
HOST_WORDS = ("spam", "adult", "casino", "pills", "bets")
BLOCK_GLOBS = (
    *[f"*{word}*" for word in HOST_WORDS],
    *[f"*{word}*/**" for word in HOST_WORDS],
    "*/**/ads/**",
    "*/ads/**",
    "*/**.exe",
)


@dataclass(frozen=True)
class Automaton:
    """Globs as masks. ``step[c]`` has the bits that byte ``c`` moves to, ``stay[c]`` those that it leaves in place."""

    step: np.ndarray
    stay: np.ndarray
    start: np.ndarray
    final: tuple[tuple[int, int], ...]

    @property
    def words(self) -> int:
        return len(self.start)


def compile_globs(globs: Sequence[str]) -> Automaton:
    parsed = []
    for glob in globs:
        symbols: list[int] = []
        loops: dict[int, bool] = {}
        raw, i = glob.encode(), 0
        while i < len(raw):
            if raw[i:i + 1] == b"*":
                run = len(raw[i:]) - len(raw[i:].lstrip(b"*"))
                loops[len(symbols)] = loops.get(len(symbols), False) or run > 1
                i += run
            else:
                symbols.append(-1 if raw[i:i + 1] == b"?" else raw[i])
                i += 1
        parsed.append((symbols, loops))
    size = sum(len(s) + 1 for s, _ in parsed)
    words = max(1, -(-size // 64))
    step = np.zeros((256, words), np.uint64)
    stay = np.zeros((256, words), np.uint64)
    start = np.zeros(words, np.uint64)
    final, base = [], 0

    def put(masks: np.ndarray, chars, bit: int) -> None:
        masks[chars, bit // 64] |= np.uint64(1 << bit % 64)

    for symbols, loops in parsed:
        start[base // 64] |= np.uint64(1 << base % 64)
        for j, c in enumerate(symbols):
            put(step, slice(None) if c < 0 else c, base + j + 1)
        for j, across in loops.items():
            others = np.arange(256) if across else np.delete(np.arange(256), ord("/"))
            put(stay, others, base + j)
        final.append(divmod(base + len(symbols), 64))
        base += len(symbols) + 1
    return Automaton(step, stay, start, tuple(final))


def match_all(auto: Automaton, urls: Sequence[bytes]) -> np.ndarray:
    """For every URL and glob: does the glob match the whole URL? All globs are simulated together."""
    order = np.argsort([-len(u) for u in urls], kind="stable")
    lengths = np.array([len(urls[i]) for i in order], np.int64)
    ends = np.cumsum(lengths)
    text = np.frombuffer(b"".join(urls[i] for i in order), np.uint8)
    begins = ends - lengths
    state = np.repeat(auto.start[None, :], len(urls), axis=0)
    live = len(urls)
    for at in range(int(lengths[0]) if len(urls) else 0):
        while live and lengths[live - 1] <= at:
            live -= 1
        chars = text[begins[:live] + at]
        now = state[:live]
        moved = now << np.uint64(1)
        moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
        state[:live] = (moved & auto.step[chars]) | (now & auto.stay[chars])
    found = np.empty((len(urls), len(auto.final)), bool)
    for g, (word, bit) in enumerate(auto.final):
        found[order, g] = (state[:, word] >> np.uint64(bit) & np.uint64(1)).astype(bool)
    return found


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(
    pages: DataFrame,
    carry: Sequence[str] = ("page_id",),
    site_rules: Sequence[tuple[str, str, str]] = SITE_RULES,
    block_globs: Sequence[str] = BLOCK_GLOBS,
) -> DataFrame:
    """Host, path, the longest fitting site rule (of equally long ones the first) and the verdict of every url."""
    sites = [(verdict, f"{host}{path}") for verdict, host, path in site_rules]
    auto = compile_globs([f"*.{rule}**" for _, rule in sites] + list(block_globs))
    rank = sorted(range(len(sites)), key=lambda i: -len(sites[i][1]))

    def make():
        def work(hosts: pa.Array, paths: pa.Array):
            urls = [b"." + h + p for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
            found = match_all(auto, urls)
            by_site, verdicts = [], []
            globbed = found[:, len(sites):].any(axis=1)
            for row, bad in zip(found, globbed):
                rule = next((i for i in rank if row[i]), None)
                by_site.append(None if rule is None else sites[rule][1])
                verdicts.append(("block" if bad else "allow") if rule is None else sites[rule][0])
            return [hosts.cast(pa.string()), paths.cast(pa.string()), pa.array(by_site, pa.string()), pa.array(verdicts, pa.string())]

        return work

    inputs = [host_of(F.col("url")).cast("binary"), path_of(F.col("url")).cast("binary")]
    return map_columns(pages, inputs, "host string, path string, rule string, verdict string", make, carry)
