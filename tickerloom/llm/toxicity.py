"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Positives are documents confirmed as toxic; everything else is unlabelled text, toxic or not. With
the share of toxic documents (the class prior) the risk of calling unlabelled text clean can be corrected
for the toxic ones among it, and is kept from falling below zero (the non-negative estimator), so the
classifier doesn't learn to tell the confirmed examples from the rest of their kind.

Features are words and word beginnings (runs of letters, lower-cased) found more often in positives; the score is
the sigmoid of a weighted sum. The model is trained in numpy on a bounded sample; every document is scored on its whole text.

Bounds of learning: ``max_positive`` and ``max_unlabelled`` documents on average, chosen by a hash of the id over
the whole table, and ``max_features`` features.

Defined cases: null and empty texts have no features and get the score of the intercept; very long texts count
each feature once; repeated rows are scored alike; of repeated labels the highest counts; rows without an id teach nothing; without positives every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import held_out, map_columns
from tickerloom.staging import stage

MAX_POSITIVE = 4000
MAX_UNLABELLED = 16_000
MAX_FEATURES = 3000
MIN_POSITIVE_DF = 4
#: Standard errors by which a feature must be more frequent among positives.
MIN_LIFT = 4.5
STEMS = (4, 5, 6)
THRESHOLD = 0.3
TOKEN = re.compile(r"[^\W\d_]+")

RESULTS = "score double, predicted int"


def features(text: str | None) -> set[str]:
    """Words, and their beginnings marked with a star."""
    words = set(TOKEN.findall((text or "").lower()))
    out = set(words)
    for n in STEMS:
        out.update([w[:n] + "*" for w in words if len(w) >= n])
    return out


def training_sample(docs: DataFrame, labels: DataFrame, max_positive: int, max_unlabelled: int) -> tuple[DataFrame | None, float]:
    """A written sample (text, positive, unlabelled) of training rows, and the class prior.

    The prior is the toxic share of the labelled training rows. The sampled ids of positives are sent to
    all tasks; their number is bounded by ``max_positive``.
    """
    known = labels.where(~held_out("doc_id") & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_known, n_toxic = known.agg(F.count(F.lit(1)), F.count_if(F.col("toxic") == 1)).first()
    able = docs.where(~held_out("doc_id")).select("doc_id", "text")
    n_able = able.select("doc_id").count()
    if not n_toxic or not n_able:
        return None, 0.0
    million = F.lit(10**6)
    chosen = lambda n, bound, seed: F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), million) < min(10**6, -(-bound * 10**6 // n))
    positive = known.where((F.col("toxic") == 1) & chosen(n_toxic, max_positive, 1)).select("doc_id", F.lit(True).alias("positive"))
    sample = able.join(F.broadcast(positive), "doc_id", "left").withColumn("positive", F.coalesce("positive", F.lit(False)))
    sample = sample.withColumn("unlabelled", chosen(n_able, max_unlabelled, 2)).where("positive OR unlabelled")
    return stage(sample.select("text", "positive", "unlabelled"), "pu-sample"), min(0.9, n_toxic / n_known)


def document_counts(sample: DataFrame) -> DataFrame:
    """Per feature the positives and the unlabelled documents that hold it; counted in the task first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            keys = list(positive | unlabelled)
            made = [pa.array(keys, pa.string()), pa.array([positive[k] for k in keys], pa.int64()), pa.array([unlabelled[k] for k in keys], pa.int64())]
            return pa.RecordBatch.from_arrays(made, names=["feature", "p", "u"])

        positive: Counter[str] = Counter()
        unlabelled: Counter[str] = Counter()
        for batch in batches:
            for text, p, u in zip(*(c.to_pylist() for c in batch.columns)):
                found = features(text)
                if p:
                    positive.update(found)
                if u:
                    unlabelled.update(found)
                if len(unlabelled) + len(positive) > 200_000:
                    yield flush()
                    positive, unlabelled = Counter(), Counter()
        yield flush()

    return sample.mapInArrow(run, "feature string, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def choose_features(sample: DataFrame, max_features: int) -> tuple[list[str], int, int]:
    """The features whose share among positives most exceeds that among the unlabelled, in standard errors."""
    n_p, n_u = sample.agg(F.count_if("positive"), F.count_if("unlabelled")).first()
    if not n_p or not n_u:
        return [], n_p, n_u
    counts = document_counts(sample).where(F.col("p") >= MIN_POSITIVE_DF)
    share_p, share_u = F.col("p") / n_p, F.col("u") / n_u
    pooled = (F.col("p") + F.col("u") + 1) / (n_p + n_u)
    lifted = counts.where(share_p > 2 * share_u).withColumn("z", (share_p - share_u) / F.sqrt(pooled * (1 / n_p + 1 / n_u)))
    lifted = lifted.where(F.col("z") >= MIN_LIFT)
    return [r["feature"] for r in lifted.orderBy(F.desc("z"), "feature").limit(max_features).collect()], n_p, n_u


def vectors(sample: DataFrame, vocabulary: list[str]) -> DataFrame:
    places = {f: i for i, f in enumerate(vocabulary)}

    def make():
        def work(texts: pa.Array):
            rows = [sorted(places[f] for f in features(t) if f in places) for t in texts.to_pylist()]
            return [pa.array(rows, pa.list_(pa.int32()))]

        return work

    return map_columns(sample, [F.col("text")], "places array<int>", make, ("positive", "unlabelled"))


def train(rows: Sequence[Sequence[int]], positive: np.ndarray, unlabelled: np.ndarray, n_features: int, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 3e-5) -> tuple[np.ndarray, float]:
    """Weights and intercept that lower the non-negative PU risk (Adam on all rows).

    Risk = prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)]) with the sigmoid loss l(g) = 1 / (1 + exp(g)),
    which is bounded, so that few far-off documents can't outweigh the correction. While the
    second part is below zero, steps go against it instead, as the estimator's authors propose.
    """
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.fromiter((i for r in rows for i in r), np.int64, count=len(doc))
    in_p = positive / max(1, positive.sum())
    in_u = unlabelled / max(1, unlabelled.sum())
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        g = np.bincount(doc, weights=theta[at], minlength=len(rows)) + theta[-1]
        chance = 1 / (1 + np.exp(-np.clip(g, -50, 50)))
        negative = in_u @ chance - prior * (in_p @ chance)
        steep = chance * (1 - chance)
        slope_negative = (in_u - prior * in_p) * steep
        slope = slope_negative - prior * in_p * steep if negative >= 0 else -slope_negative
        grad = np.append(np.bincount(at, weights=slope[doc], minlength=n_features) + decay * theta[:-1], slope.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def learn(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES) -> tuple[dict[str, float], float]:
    """Weights by feature, and the intercept."""
    sample, prior = training_sample(docs, labels, max_positive, max_unlabelled)
    vocabulary = choose_features(sample, max_features)[0] if sample is not None else []
    if not vocabulary:
        return {}, -np.inf
    rows = vectors(sample, vocabulary).toArrow()
    positive, unlabelled = (rows.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("positive", "unlabelled"))
    weights, intercept = train(rows.column("places").to_pylist(), positive, unlabelled, len(vocabulary), prior)
    return dict(zip(vocabulary, weights.tolist())), intercept


def score(docs: DataFrame, weights: dict[str, float], intercept: float, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Score and verdict of every document, in one pass without a shuffle. The model is bounded by ``max_features``."""

    def make():
        full = {f: w for f, w in weights.items() if not f.endswith("*")}
        stems = {n: {f[:-1]: w for f, w in weights.items() if f.endswith("*") and len(f) == n + 1} for n in STEMS}

        def work(texts: pa.Array):
            scores = []
            for text in texts.to_pylist():
                words = set(TOKEN.findall((text or "").lower()))
                found = {f: full[f] for f in words & full.keys()}
                for n, known in stems.items():
                    found.update((f + "*", known[f]) for f in {w[:n] for w in words if len(w) >= n} & known.keys())
                total = intercept + sum(found[f] for f in sorted(found))
                scores.append(1 / (1 + float(np.exp(-np.clip(total, -500, 500)))) if total > -np.inf else 0.0)
            return [pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())]

        return work

    return map_columns(docs, [F.col("text")], RESULTS, make, carry)
