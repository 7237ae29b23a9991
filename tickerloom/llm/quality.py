"""Quality rules as a short-circuit cascade.

Every document gets its base figures. Those that pass the base limits then meet
rules one after the other and stop at the first that rejects them. The order is
found on a sample: each rule's cost (seconds) and the documents it rejects are
measured there, and the rule with the most rejections per second among what the
earlier ones leave goes first. The order decides what a run costs and which rule is named,
never which documents stay.

Defined cases: a null or empty text has no words and fails the base; a text is always judged whole; repeated
rows are judged alike; an empty table gives an empty result and the listed order of rules;
columns of the input named like a result give way to it.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import map_columns

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: Rows of the sample on which the cascade's order is found (expected number).
SAMPLE_ROWS = 2000

RESULTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, rejected_by string"
)


class Text:
    """One document's bytes; each figure is worked out when first asked for."""

    def __init__(self, raw: bytes | None):
        self.raw = raw or b""
        self.words = self.raw.split()
        self.n_words = len(self.words)

    @cached_property
    def word_chars(self) -> int:
        solid = self.raw.translate(None, b" \t\n\x0b\x0c\r")
        return len(solid.decode("utf-8", "replace"))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a window of three words that occurs twice or more."""
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        seen, total, end = Counter(windows), 0, 0
        for at, window in enumerate(windows):
            if seen[window] > 1:
                total += at + 3 - max(at, end)
                end = at + 3
        return total

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PCT * self.n_words


def _symbols(t: Text) -> bool:
    return 100 * t.n_symbols > 20 * t.n_words


def _shouting(t: Text) -> bool:
    return 2 * sum(w.isupper() for w in t.words) > t.n_words


def _dup_lines(t: Text) -> bool:
    return 2 * t.n_dup_lines > len(t.lines)


def _word_length(t: Text) -> bool:
    return t.word_chars < 2 * t.n_words or t.word_chars > 15 * t.n_words


def _letterless(t: Text) -> bool:
    """Over two fifths of the words have neither a Latin letter nor a character beyond ASCII."""
    plain = sum(not any(c > 127 or 65 <= c <= 90 or 97 <= c <= 122 for c in w) for w in t.words)
    return 5 * plain > 2 * t.n_words


def _top_word(t: Text) -> bool:
    return t.n_words > 0 and 10 * Counter(t.words).most_common(1)[0][1] > 3 * t.n_words


#: The rules of the verdict, in the order used when there is nothing to measure.
RULES: dict[str, Callable[[Text], bool]] = {
    "symbols": _symbols,
    "shouting": _shouting,
    "dup_lines": _dup_lines,
    "word_length": _word_length,
    "letterless": _letterless,
    "top_word": _top_word,
}


def greedy_order(masks: dict[int, int], seconds: Sequence[float]) -> list[int]:
    """Rules by rejections per second among the documents that the earlier ones leave; ties keep the listed order.

    ``masks`` counts sample documents by the set of rules (bits) that reject them.
    """
    left, order, rest = dict(masks), [], list(range(len(seconds)))
    while rest:
        rate = {r: sum(n for m, n in left.items() if m >> r & 1) / max(seconds[r], 1e-9) for r in rest}
        best = max(rest, key=lambda r: (rate[r], -r))
        order.append(best)
        rest.remove(best)
        left = {m: n for m, n in left.items() if not m >> best & 1}
    return order


def cascade_order(docs: DataFrame, rules: dict[str, Callable[[Text], bool]] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[str]:
    """The rules' names in the order in which they should run.

    The sample holds ``sample_rows`` documents on average, drawn over the whole table.
    To the driver come at most two to the power of the number of rules rows.
    """
    names = list(rules)
    total = docs.count()
    if not total:
        return names
    fields = [f"s{i}" for i in range(len(names))]

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        spent = [0.0] * len(names)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                doc = Text(raw)
                if doc.base_failed:
                    continue
                mask = 0
                for i, name in enumerate(names):
                    fresh = Text.__new__(Text)
                    fresh.raw, fresh.words, fresh.n_words = doc.raw, doc.words, doc.n_words
                    began = time.perf_counter()
                    mask |= int(rules[name](fresh)) << i
                    spent[i] += time.perf_counter() - began
                counts[mask] += 1
        rows = list(counts.items())
        data = [[m for m, _ in rows], [n for _, n in rows], *[[s] + [0.0] * (len(rows) - 1) for s in spent]]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64() if i < 2 else pa.float64()) for i, x in enumerate(data)], names=["mask", "n", *fields]
            )

    sample = docs.select(F.col("text").cast("binary")).sample(False, min(1.0, sample_rows / total), seed)
    schema = "mask long, n long, " + ", ".join(f"{f} double" for f in fields)
    found = sample.mapInArrow(probe, schema).groupBy("mask").agg(F.sum("n").alias("n"), *[F.sum(f).alias(f) for f in fields]).collect()
    if not found:
        return names
    masks = {r["mask"]: r["n"] for r in found}
    return [names[i] for i in greedy_order(masks, [sum(r[f] for r in found) for f in fields])]


def assess(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    rules: dict[str, Callable[[Text], bool]] = RULES,
    order: Sequence[str] | None = None,
    only_kept: bool = False,
) -> DataFrame:
    """Figures and verdict of every document, in one pass without a shuffle."""
    steps = [(name, rules[name]) for name in (order or cascade_order(docs, rules))]

    def make():
        def work(texts: pa.Array):
            cols: list[list] = [[] for _ in range(8)]
            for raw in texts.to_pylist():
                doc = Text(raw)
                by = "base" if doc.base_failed else next((name for name, rule in steps if rule(doc)), None)
                row = (doc.n_words, doc.word_chars, doc.n_symbols, doc.n_dup_lines, doc.n_repeat_words, doc.base_failed, by is None, by)
                for col, value in zip(cols, row):
                    col.append(value)
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            made = [pa.array(c, t) for c, t in zip(cols, types)]
            return (made[6], made) if only_kept else made

        return work

    return map_columns(docs, [F.col("text").cast("binary")], RESULTS, make, carry)
