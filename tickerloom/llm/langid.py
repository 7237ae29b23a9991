"""Language identification by prediction by partial matching (PPM).

For each language, bytes are counted under their contexts of up to ``ORDER`` preceding bytes in a
sample of the labelled training rows. With these counts frozen, a context gives a byte the PPM-C
probability: the byte's count, or an escape to the next shorter context without the bytes already excluded, down to
all 256 bytes alike. A text's code length under a language is the sum of -log2 of these, plus the
length of naming the language; the language with the shortest code wins.

A context's probabilities don't change, so they stand in one table of code lengths (whole numbers of 1/65536 bit, so
sums don't depend on how rows are batched), and a batch is scored by table look-ups.

Bounds of learning: ``train_rows`` documents per language on average, chosen by a hash of the id over the
whole table, and ``max_contexts`` contexts, the most frequent. Every document is scored on its whole text.

Defined cases: ``und`` with score 0 for a text that is null or has no letter, or when nothing could be learned; very long texts are scored in
slices without loss; of equally long codes the language first by name wins; repeated rows are scored alike; rows without a language or id teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import held_out, map_columns

ORDER = 3
TRAIN_ROWS = 1500
MAX_CONTEXTS = 12_000
MIN_CONTEXT = 8
UNIT = 65536
SLICE = 1 << 20
PAD = b" " * ORDER
UNDETERMINED = "und"

RESULTS = "lang_pred string, score double, bits_per_byte double"


@dataclass(frozen=True)
class Model:
    """``symbol`` maps bytes to columns, ``step[k]`` a context of k bytes and the byte before it to the longer context."""

    languages: list[str]
    symbol: np.ndarray
    step: list[np.ndarray]
    bits: np.ndarray
    prior: np.ndarray

    def contexts(self, symbols: np.ndarray) -> np.ndarray:
        """The context of every position from ORDER on."""
        n, width = len(symbols) - ORDER, self.step[0].shape[1]
        at = np.zeros(n, np.int32)
        for k, table in enumerate(self.step):
            at = table.ravel()[at * width + symbols[ORDER - k - 1:ORDER - k - 1 + n]]
        return at

    def lengths(self, texts: Sequence[bytes]) -> np.ndarray:
        """Code lengths, one row per text and one column per language."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = self.symbol[np.frombuffer(PAD + PAD.join(texts), np.uint8)] if texts else np.zeros(0, np.int32)
        starts = np.cumsum(sizes + ORDER) - sizes
        owner = np.flatnonzero(sizes)
        edges = np.stack([starts[owner], starts[owner] + sizes[owner]], 1).ravel()
        width = self.step[0].shape[1]
        for low in range(ORDER, len(flat), SLICE):
            high = min(low + SLICE, len(flat))
            part = flat[low - ORDER:high]
            cost = self.bits[self.contexts(part) * width + part[ORDER:]]
            first, last = np.searchsorted(edges, low, "right"), np.searchsorted(edges, high, "left")
            cuts = np.concatenate([[low], edges[first:last]]).astype(np.int64)
            sums = np.add.reduceat(cost, cuts - low, axis=0, dtype=np.int64)
            inside = (np.arange(first - 1, last) % 2) == 0
            np.add.at(out, owner[np.arange(first - 1, last)[inside] // 2], sums[inside])
        return out


def gram_counts(sample: DataFrame) -> DataFrame:
    """lang, gram (ORDER + 1 bytes as a number) and n over a sample with lang and text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(PAD + text.lower().encode())
            for lang, texts in by_lang.items():
                flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
                code = sum(flat[k:len(flat) - ORDER + k] << 8 * (ORDER - k) for k in range(ORDER + 1))
                ends = np.cumsum([len(t) for t in texts])[:-1]
                crossing = (ends[:, None] + np.arange(-ORDER, ORDER)[None, :]).ravel()
                keep = np.ones(len(code), bool)
                keep[crossing[(crossing >= 0) & (crossing < len(code))]] = False
                grams, n = np.unique(code[keep], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    return sample.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, train_rows: int = TRAIN_ROWS, max_contexts: int = MAX_CONTEXTS) -> Model | None:
    """The frozen model; None if no row can teach. To the driver come the counts of the bounded sample."""
    able = docs.where(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = {r["lang"]: r["n"] for r in able.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows:
        return None
    rate = F.lit(0)
    for lang, n in rows.items():
        rate = F.when(F.col("lang") == lang, F.lit(min(10**6, -(-train_rows * 10**6 // n)))).otherwise(rate)
    sample = able.where(F.pmod(F.xxhash64("doc_id"), F.lit(10**6)) < rate).select("lang", "text")
    found = gram_counts(sample).toArrow()
    if not found.num_rows:
        return None
    languages = sorted(rows)
    places = {lang: i for i, lang in enumerate(languages)}
    langs = np.array([places[x] for x in found.column("lang").to_pylist()], np.int64)
    return build(languages, [rows[x] for x in languages], langs, found.column("gram").to_numpy(), found.column("n").to_numpy().astype(np.float64), max_contexts)


def build(languages: list[str], rows: list[int], langs: np.ndarray, grams: np.ndarray, n: np.ndarray, max_contexts: int) -> Model:
    raw = np.stack([grams >> 8 * (ORDER - k) & 255 for k in range(ORDER + 1)], 1)
    used = np.zeros(256, bool)
    used[raw.ravel()] = True
    used[32] = True
    symbol = np.zeros(256, np.int32)
    symbol[used] = np.arange(1, used.sum() + 1)  # symbol 0: every byte that never occurred
    width = int(used.sum()) + 1
    syms = symbol[raw].astype(np.int64)
    # contexts by frequency; a shorter one is at least as frequent and comes first among equals
    codes, counts, depths = [np.zeros(1, np.int64)], [np.array([np.inf])], [np.zeros(1, np.int64)]
    code = np.zeros(len(grams), np.int64)
    for depth in range(1, ORDER + 1):
        code = code * width + syms[:, ORDER - depth]
        these, back = np.unique(code, return_inverse=True)
        codes.append(these)
        counts.append(np.bincount(back, weights=n))
        depths.append(np.full(len(these), depth))
    every_code, every_count, every_depth = (np.concatenate(x) for x in (codes, counts, depths))
    best = np.lexsort((every_code, every_depth, -every_count))[:max_contexts]
    best = best[every_count[best] >= MIN_CONTEXT]
    best = best[np.lexsort((every_code[best], every_depth[best]))]
    node_code, node_depth = every_code[best], every_depth[best]
    step: list[np.ndarray] = []
    parent = np.zeros(len(best), np.int64)
    ends = np.searchsorted(node_depth, np.arange(ORDER + 1), "right")
    for depth in range(1, ORDER + 1):
        table = np.repeat(np.arange(ends[depth - 1], dtype=np.int32)[:, None], width, axis=1)
        new = np.arange(ends[depth - 1], ends[depth])
        old = np.arange(ends[depth - 2] if depth > 1 else 0, ends[depth - 1])
        parent[new] = old[np.searchsorted(node_code[old], node_code[new] // width)] if len(new) else []
        table[parent[new], node_code[new] % width] = new
        step.append(table)
    bits = np.zeros((len(best) * width, len(languages)), np.int32)
    for lang in range(len(languages)):
        mine = langs == lang
        seen = np.zeros((len(best), width))
        at = np.zeros(mine.sum(), np.int64)
        np.add.at(seen, (at, syms[mine, ORDER]), n[mine])
        for depth, table in enumerate(step, 1):
            longer = table[at, syms[mine, ORDER - depth]].astype(np.int64)
            grown = longer != at
            np.add.at(seen, (longer[grown], syms[mine, ORDER][grown]), n[mine][grown])
            at = longer
        bits[:, lang] = code_lengths(seen, parent, node_depth).ravel()
    share = np.array(rows, np.float64) / sum(rows)
    return Model(languages, symbol, step, bits, np.rint(-np.log2(share) * UNIT).astype(np.int64))


def code_lengths(seen: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """PPM-C with exclusion for every context and symbol, in units. Symbol 0 stands for each byte without a column."""
    nodes, width = seen.shape
    chance = np.zeros((nodes, width))
    escape = np.ones(nodes)
    excluded = np.zeros((nodes, width), bool)
    at, live = np.arange(nodes), np.arange(nodes)
    while len(live):
        counts = seen[at[live]]
        counts[excluded[live]] = 0
        total, distinct = counts.sum(1), (counts > 0).sum(1)
        whole = np.maximum(total + distinct, 1)
        chance[live] += (escape[live] / whole)[:, None] * counts
        escape[live] *= np.where(distinct > 0, distinct / whole, 1.0)
        excluded[live] |= seen[at[live]] > 0
        going = depth[at[live]] > 0
        live = live[going]
        at[live] = parent[at[live]]
    many = np.ones(width)
    many[0] = 256 - (width - 1)
    left = np.maximum(((~excluded) * many).sum(1), 1)
    chance = np.where(excluded, chance, (escape / left)[:, None])
    return np.rint(-np.log2(np.maximum(chance, 2.0**-60)) * UNIT).astype(np.int32)


def predict(docs: DataFrame, model: Model | None, carry: Sequence[str] = ("doc_id",), max_bits: float | None = None) -> DataFrame:
    """Language, its posterior probability and the bits per byte of every text, in one pass without a shuffle.

    With ``max_bits`` only the rows stay whose language is determined and whose text takes no more bits per byte under it.
    """

    def make():
        def work(column: pa.Array):
            texts = column.to_pylist()
            worth = [i for i, t in enumerate(texts) if model is not None and t and any(map(str.isalpha, t))]
            langs: list[str] = [UNDETERMINED] * len(texts)
            scores, rates = [0.0] * len(texts), [None] * len(texts)
            if worth:
                raw = [texts[i].lower().encode() for i in worth]
                total = model.lengths(raw) + model.prior[None, :]
                best = total.argmin(1)
                over = (total - total.min(1)[:, None]) / UNIT
                chance = 1 / np.exp2(-np.minimum(over, 1000)).sum(1)
                for i, b, c, t, r in zip(worth, best.tolist(), chance.tolist(), total.min(1).tolist(), raw):
                    langs[i], scores[i], rates[i] = model.languages[b], c, t / UNIT / len(r)
            made = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())]
            if max_bits is None:
                return made
            return pa.array([r is not None and r <= max_bits for r in rates], pa.bool_()), made

        return work

    return map_columns(docs, [F.col("text")], RESULTS, make, carry)
