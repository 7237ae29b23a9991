"""Term features: vocabulary, tf-idf, SVD momentum, themes.

Everything per post stays in columns of the posts frame, so no feature ever has
to be joined back. The passes of a fit are

1. counts of words, then of pairs of frequent words (partial counts before the shuffle) -> at most ``max_terms`` rows,
2. one staged table of posts with their sparse vectors,
3. the Gram matrix of those vectors, summed per task (``max_terms`` squared),
4. one staged table of projected vectors, on which k-means iterates.

What reaches the driver is bounded by the vocabulary size, never by the data.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom import lexicon as lx
from tickerloom.functions import batches
from tickerloom.operators import kmeans, subspace
from tickerloom.staging import stage

FEATURE_DEFAULTS = {"topic_cluster": -1, "tfidf_momentum": 0.0, "market_attention": 0.0}
TEXT_COUNT_KEY = ""
#: Words that may be sent along with a filter on pairs.
MAX_PAIR_WORDS = 20_000


def single_terms(feature_text: Column, stop_words: list[str] = lx.STOP_WORDS) -> Column:
    """ASCII words that start with a letter, without stop words."""
    return F.filter(
        F.split(feature_text, " "),
        lambda w: w.rlike("^[a-zA-Z][a-zA-Z0-9]*$") & ~w.isin(stop_words),
    )


def with_pairs(singles: Column) -> Column:
    """Single terms followed by the pairs of neighbours."""
    count = F.size(singles)
    pairs = F.zip_with(
        F.slice(singles, F.lit(1), count - 1),
        F.slice(singles, F.lit(2), count - 1),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.when(count >= 2, F.concat(singles, pairs)).otherwise(singles)


def with_words(
    posts: DataFrame,
    min_length: int = lx.MIN_TEXT_LENGTH,
    min_words: int = lx.MIN_TEXT_WORDS,
) -> DataFrame:
    """Adds ``text_eligible`` and ``singles``; a text that is too short has none."""
    found = posts.withColumn("_found", batches.feature_words(F.col("content_cleaned"), lx.STOP_WORDS))
    eligible = (F.col("_found")["length"] >= min_length) & (F.col("_found")["words"] >= min_words)
    flagged = found.withColumn("text_eligible", F.coalesce(eligible, F.lit(False)))
    return flagged.withColumn(
        "singles",
        F.when(F.col("text_eligible"), F.col("_found")["singles"]).otherwise(
            F.array().cast("array<string>")
        ),
    ).drop("_found")


def with_terms(posts: DataFrame) -> DataFrame:
    """Adds ``text_eligible`` and ``terms``: single terms, then pairs."""
    return terms_of(with_words(posts))


def terms_of(words: DataFrame) -> DataFrame:
    """``terms`` in place of the ``singles`` that ``with_words`` has found."""
    return words.withColumn("terms", with_pairs(F.col("singles"))).drop("singles")


def term_counts(prepared: DataFrame, terms: str = "terms") -> DataFrame:
    """Corpus and document counts per term, in one pass.

    One more entry per text under the empty term counts the texts. Each batch
    counts its own terms, so only distinct terms per batch are shuffled, and a
    term in every text is no hot key.
    """
    return count_entries(prepared.select(terms, "text_eligible"), batches.entry_counts)


def count_entries(
    lists: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """Corpus and document counts of what the lists hold, by the counts of their batches."""
    counts = lists.mapInArrow(partial, "term string, corpus_count bigint, doc_count bigint")
    return counts.groupBy("term").agg(
        F.sum("corpus_count").alias("corpus_count"), F.sum("doc_count").alias("doc_count")
    )


def frequent_terms(counts: DataFrame, min_docs: int = lx.MIN_DOC_COUNT) -> DataFrame:
    """The counts a vocabulary can come from, staged.

    The vocabulary reads them twice (number of texts, then terms); unstaged,
    each read would tokenise the corpus again.
    """
    kept = counts.filter((F.col("doc_count") >= min_docs) | (F.col("term") == TEXT_COUNT_KEY))
    return stage(kept, "counts")


def pair_words(
    singles: DataFrame,
    max_terms: int = lx.MAX_TERMS,
    min_docs: int = lx.MIN_DOC_COUNT,
    max_share: float = lx.MAX_DOC_SHARE,
    bound: int = MAX_PAIR_WORDS,
) -> list[str] | None:
    """The words that pairs of the vocabulary can be made of; None if there is no telling, or they are more than ``bound``.

    A pair occurs no more often than either of its words. With ``max_terms`` single
    terms within the limits, a pair that occurs less often than the last of them is
    out. Words above the upper document limit stay, since their pairs may be within it.
    """
    last = (
        build_vocabulary(singles, max_terms, min_docs, max_share)
        .agg(F.count(F.lit(1)).alias("terms"), F.min("corpus_count").alias("least"))
        .first()
    )
    if last.terms < max_terms:
        return None
    able = singles.filter((F.col("term") != TEXT_COUNT_KEY) & (F.col("corpus_count") >= last.least))
    words = [r.term for r in able.select("term").limit(bound + 1).collect()]
    return words if len(words) <= bound else None


def vocabulary_counts(
    words: DataFrame,
    max_terms: int = lx.MAX_TERMS,
    min_docs: int = lx.MIN_DOC_COUNT,
    max_share: float = lx.MAX_DOC_SHARE,
) -> DataFrame:
    """Counts of all terms that the vocabulary can come from; ``words`` (with ``singles``) is read twice.

    Single terms are counted first, then only pairs of words frequent enough
    (``pair_words``), so that what is shuffled does not grow with the corpus' distinct pairs.
    """
    singles = frequent_terms(term_counts(words, "singles"), min_docs)
    known = pair_words(singles, max_terms, min_docs, max_share)
    counts = count_entries(words.select("singles"), batches.pair_counts(known))
    return singles.unionByName(frequent_terms(counts, min_docs))


def build_vocabulary(
    counts: DataFrame,
    max_terms: int = lx.MAX_TERMS,
    min_docs: int = lx.MIN_DOC_COUNT,
    max_share: float = lx.MAX_DOC_SHARE,
) -> DataFrame:
    """Most frequent terms within the document-count limits, ties by term.

    Adds ``texts``, the number of texts, to each of the at most ``max_terms`` rows.
    """
    texts = (
        counts.filter(F.col("term") == TEXT_COUNT_KEY)
        .agg(F.coalesce(F.max("doc_count"), F.lit(0).cast("bigint")).alias("texts"))
        .scalar()
    )
    within = counts.filter(
        (F.col("term") != TEXT_COUNT_KEY)
        & (F.col("doc_count") >= min_docs)
        & (F.col("doc_count") <= F.lit(max_share) * texts)
    )
    return (
        within.withColumn("texts", texts)
        .orderBy(F.desc("corpus_count"), F.asc("term"))
        .limit(max_terms)
    )


def idf(doc_count: Column, texts: Column) -> Column:
    """Smoothed inverse document frequency plus one."""
    return F.log((texts + F.lit(1.0)) / (doc_count + F.lit(1.0))) + F.lit(1.0)


@dataclass(frozen=True)
class TermModel:
    terms: list[str]
    idf: list[float]
    texts: int

    @property
    def usable(self) -> bool:
        return self.texts >= lx.MIN_TEXTS and bool(self.terms)


def fit_terms(words: DataFrame, max_terms: int = lx.MAX_TERMS) -> TermModel:
    """Collects the vocabulary: at most ``max_terms`` rows. ``words`` should be staged."""
    vocabulary = build_vocabulary(vocabulary_counts(words, max_terms), max_terms)
    rows = vocabulary.select("term", idf(F.col("doc_count"), F.col("texts")).alias("idf"), "texts")
    kept = rows.collect()
    return TermModel([r.term for r in kept], [r.idf for r in kept], kept[0].texts if kept else 0)


def with_tfidf(prepared: DataFrame, model: TermModel) -> DataFrame:
    """Adds ``features``: sparse tf-idf vectors with rows of length 1 (or 0), of ``terms`` or else of ``singles`` and their pairs."""
    paired = "terms" not in prepared.columns
    lists = F.col("singles" if paired else "terms")
    return prepared.withColumn("features", batches.weighed(lists, model.terms, model.idf, paired))


def sparse_parts(features: Column) -> Column:
    """The stored positions and values of a sparse vector column, as arrays."""
    return F.unwrap_udt(features)


def market_attention(features: Column) -> Column:
    """Length of the feature vector."""
    squares = F.aggregate(
        sparse_parts(features)["values"], F.lit(0.0), lambda total, v: total + v * v
    )
    return F.sqrt(squares)


def term_weights(with_features: DataFrame, model: TermModel) -> DataFrame:
    """One row per post and vocabulary term: (id, term, weight)."""
    parts = sparse_parts(F.col("features"))
    pairs = with_features.select(
        "id", F.inline(F.arrays_zip(parts["indices"].alias("pos"), parts["values"].alias("weight")))
    )
    names = F.array(*[F.lit(t) for t in model.terms])
    return pairs.select("id", F.get(names, F.col("pos")).alias("term"), "weight")


def vocab_match(prepared: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(id, terms, held) of each text, by the vocabulary (at most ``max_terms`` rows, which are collected).

    ``terms`` are those of the text's ``terms``, or else of its ``singles`` and their pairs, that are in the vocabulary, one
    entry per use. ``held`` has a bit for each term of the vocabulary (see ``batches.matched``), so that terms can be
    counted without a row for each. A text stays one row, and nothing is shuffled.
    """
    known = [r.term for r in vocabulary.select("term").collect()]
    paired = "terms" not in prepared.columns
    found = batches.matched(F.col("singles" if paired else "terms"), known, paired)
    return prepared.select("id", found.alias("_found")).select("id", "_found.terms", "_found.held")


def match_counts(matched: DataFrame, size: int = lx.MAX_TERMS) -> DataFrame:
    """Uses and different terms per id with any, of what ``vocab_match`` returned for a vocabulary of at most ``size`` terms.

    The terms of an id are one bit each of a fixed number of longs, so a post is one row of the shuffle and an id that
    repeats, or is null, no long list. Ids without terms go last: a filter on the kernel's output would run it twice.
    """
    bits = {f"_held{i}": F.bit_or(F.get("held", F.lit(i))) for i in range(batches.longs_of(size))}
    counts = matched.groupBy("id").agg(
        F.coalesce(F.sum(F.size("terms").cast("bigint")), F.lit(0).cast("bigint")).alias("matches"),
        *[bit.alias(name) for name, bit in bits.items()],
    )
    terms = sum((F.coalesce(F.bit_count(name), F.lit(0)) for name in bits), F.lit(0))
    return counts.filter(F.col("matches") > 0).select("id", "matches", terms.cast("bigint").alias("terms"))


@dataclass(frozen=True)
class Projection:
    """Loadings (terms x components) and the scale of each component."""

    loadings: np.ndarray
    mean: np.ndarray
    std: np.ndarray
    singular: np.ndarray


#: Rows that are laid out densely at a time.
DENSE_ROWS = 1024
#: Terms for which the Gram matrix and its eigenvectors fit a task and the driver (about 800 MB).
MAX_DENSE_TERMS = 10_000


def dense_rows(indices: pd.Series, values: pd.Series, size: int) -> np.ndarray:
    """Sparse rows as a matrix."""
    dense = np.zeros((len(indices), size))
    counts = indices.map(len).to_numpy()
    if counts.sum():
        rows = np.repeat(np.arange(len(indices)), counts)
        dense[rows, np.concatenate(indices.to_numpy())] = np.concatenate(values.to_numpy())
    return dense


def gram_lines(with_features: DataFrame, size: int) -> DataFrame:
    """(line, sums): the Gram matrix of the eligible texts' vectors, and as line ``size`` the column sums.

    Line i holds the columns from i on, since the matrix is symmetric. Every task adds
    up one block of its rows; blocks are then summed line by line, with a line's sum as the only state.
    """

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size + 1, size))
        seen = False
        for batch in batches:
            for start in range(0, len(batch), DENSE_ROWS):
                part = batch.iloc[start : start + DENSE_ROWS]
                dense = dense_rows(part["indices"], part["values"], size)
                total[:size] += dense.T @ dense
                total[size] += dense.sum(axis=0)
                seen = True
        if seen:
            lines = [total[i, i % size :] for i in range(size + 1)]
            yield pd.DataFrame({"line": np.arange(size + 1), "sums": lines})

    parts = with_features.filter("text_eligible").select(
        sparse_parts(F.col("features"))["indices"].alias("indices"),
        sparse_parts(F.col("features"))["values"].alias("values"),
    )
    blocks = parts.mapInPandas(block, "line int, sums array<double>")
    summed = blocks.groupBy("line").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    return summed.select("line", vector_to_array("sums").alias("sums"))


def gram_matrix(with_features: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(Gram matrix, column sums) of the feature vectors of eligible texts, on the driver."""
    total = np.zeros((size + 1, size))
    for row in gram_lines(with_features, size).collect():
        total[row.line, row.line % size :] = row.sums
    upper = np.triu(total[:size])
    return upper + np.triu(upper, 1).T, total[size]


def fit_projection(
    with_features: DataFrame, model: TermModel, components: int = lx.SVD_COMPONENTS, method: str = "auto"
) -> Projection:
    """Truncated SVD: by the eigenvectors of the Gram matrix (``gram``), or by block subspace iteration
    without one (``subspace``, see ``operators/subspace.py``); ``auto`` takes the Gram route up to
    ``MAX_DENSE_TERMS`` terms and subspace iteration above.

    The sign of a component is fixed so that its largest loading is positive.
    Mean and deviation of the projected values follow from the same sums.
    """
    size = len(model.terms)
    count = min(components, size, model.texts)
    if method == "subspace" or (method == "auto" and size > MAX_DENSE_TERMS):
        parts = with_features.filter("text_eligible").select(
            sparse_parts(F.col("features"))["indices"].alias("indices"),
            sparse_parts(F.col("features"))["values"].alias("values"),
        )
        singular, loadings, sums, _, _ = subspace.truncated_svd(parts, size, count)
        values = singular**2
    else:
        gram, sums = gram_matrix(with_features, size)
        values, vectors = np.linalg.eigh(gram)
        values = np.clip(values[::-1][:count], 0.0, None)
        loadings = vectors[:, ::-1][:, :count]
        largest = np.abs(loadings).argmax(axis=0)
        loadings = loadings * np.where(loadings[largest, np.arange(count)] < 0, -1.0, 1.0)
    mean = loadings.T @ sums / model.texts
    std = np.sqrt(np.clip(values / model.texts - mean**2, 0.0, None))
    return Projection(loadings, mean, std, np.sqrt(values))


def with_components(with_features: DataFrame, projection: Projection) -> DataFrame:
    """Adds ``components``: standardised projected values as an array."""
    scale = np.where(projection.std > 0, projection.std, 1.0)
    context = with_features.sparkSession.sparkContext
    shared = context.broadcast((projection.loadings / scale, projection.mean / scale))

    @F.pandas_udf("array<double>")
    def project(indices: pd.Series, values: pd.Series) -> pd.Series:
        loadings, mean = shared.value
        projected: list[np.ndarray] = []
        for start in range(0, len(indices), DENSE_ROWS):
            part = slice(start, start + DENSE_ROWS)
            dense = dense_rows(indices.iloc[part], values.iloc[part], len(loadings))
            projected.extend(dense @ loadings - mean)
        return pd.Series(projected)

    parts = sparse_parts(F.col("features"))
    return with_features.withColumn("components", project(parts["indices"], parts["values"]))


def cluster_count(texts: int) -> int:
    return min(lx.MAX_CLUSTERS, texts // lx.TEXTS_PER_CLUSTER)


def fit_clusters(
    with_vectors: DataFrame,
    k: int,
    restarts: int = lx.CLUSTER_RESTARTS,
    seed: int = lx.SAMPLE_SEED,
    max_iterations: int = lx.CLUSTER_ITERATIONS,
    tolerance: float = lx.CLUSTER_TOLERANCE,
) -> np.ndarray:
    """The centres of the best of several k-means runs by training cost; ``_vector`` is read once for all.

    A run that is still moving after ``max_iterations`` is reported with a warning.
    """
    values = with_vectors.select(vector_to_array("_vector").alias("values"))
    blocks = kmeans.vector_blocks(values, "values").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres, still = kmeans.fit(with_vectors.sparkSession, blocks, k, list(range(seed, seed + restarts)), max_iterations, tolerance)
    finally:
        blocks.unpersist()
    if not still:
        warnings.warn(f"k-means stopped after {max_iterations} iterations", stacklevel=2)
    return centres


def nearest(centres: np.ndarray):
    """The index of the nearest centre (the first of equal ones) of every vector."""

    @F.arrow_udf("int")
    def pick(vectors: pa.Array) -> pa.Array:
        x = vectors.flatten().to_numpy().reshape(-1, centres.shape[1])
        found = np.zeros(len(x), np.int32)
        for start in range(0, len(x), DENSE_ROWS):
            part = x[start : start + DENSE_ROWS, None, :] - centres[None, :, :]
            found[start : start + DENSE_ROWS] = (part * part).sum(axis=2).argmin(axis=1)
        return pa.array(found)

    return pick


def tfidf_signals(
    posts: DataFrame,
    restarts: int = lx.CLUSTER_RESTARTS,
    seed: int = lx.SAMPLE_SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """Adds topic cluster, momentum and attention to posts, or to the columns ``keep`` of them.

    Posts whose text is too short get -1 / 0 / 0. Too small a corpus, or one
    without a usable vocabulary, is returned as it came. Three staged tables keep
    the columns, beside the words, the vectors and the components, so that the texts are cleaned
    and split once; so ``posts`` is read once, and the result is a staged one.
    Name the columns that are needed: texts are the bulk of what is staged.
    """
    kept = posts.columns if keep is None else keep
    words = stage(with_words(posts).select(*kept, "text_eligible", "singles"), "words")
    terms = fit_terms(words)
    if not terms.usable:
        return words.select(*kept)
    vectors = stage(with_tfidf(words, terms).drop("singles"), "vectors")
    projection = fit_projection(vectors, terms)
    projected = stage(
        with_components(vectors, projection).withColumn(
            "market_attention",
            F.when(F.col("text_eligible"), market_attention(F.col("features"))).otherwise(0.0),
        ).drop("features"),
        "components",
    )
    signals = projected.withColumn(
        "tfidf_momentum",
        F.when(F.col("text_eligible"), F.col("components")[0]).otherwise(F.lit(0.0)),
    )
    k = cluster_count(terms.texts)
    if k >= 2:
        as_vectors = signals.withColumn("_vector", array_to_vector("components"))
        centres = fit_clusters(as_vectors.filter("text_eligible"), k, restarts, seed)
        signals = signals.withColumn(
            "topic_cluster",
            F.when(F.col("text_eligible"), nearest(centres)(F.col("components"))).otherwise(F.lit(-1)),
        )
    return signals.drop("components", "text_eligible")


def attach_features(posts: DataFrame, features: DataFrame) -> DataFrame:
    """Joins separately kept features to posts by id; unmatched -> -1 / 0 / 0."""
    joined = posts.join(features, "id", "left")
    return joined.fillna({k: v for k, v in FEATURE_DEFAULTS.items() if k in features.columns})
