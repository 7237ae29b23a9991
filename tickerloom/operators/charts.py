"""Data sets behind the charts, computed on all rows.

Only point clouds are sampled (that is their feature); counts, bins and
correlations always use the whole data.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom import lexicon as lx
from tickerloom.functions import batches
from tickerloom.operators.ranking import influence_score, stratified_sample, top_k


def signal_counts(posts: DataFrame) -> DataFrame:
    counts = posts.groupBy("trading_signal").agg(F.count(F.lit(1)).alias("posts"))
    return counts.orderBy(F.desc("posts"), F.asc("trading_signal"))


def engagement_by_user(posts: DataFrame, k: int = 10) -> DataFrame:
    sums = posts.groupBy("username").agg(F.sum("total_engagement").alias("engagement"))
    return top_k(sums, "engagement", k, "username")


def influence_by_user(posts: DataFrame, k: int = 10) -> DataFrame:
    scored = posts if "influence_score" in posts.columns else influence_score(posts)
    means = scored.groupBy("username").agg(F.avg("influence_score").alias("mean_influence"))
    return top_k(means, "mean_influence", k, "username")


def engagement_breakdown(posts: DataFrame) -> DataFrame:
    """Total of each engagement type, one row per type."""
    kinds = [c for c in ("likes", "retweets", "replies") if c in posts.columns]
    sums = posts.agg(*[F.sum(c).alias(c) for c in kinds])
    return sums.unpivot([], kinds, "kind", "total")


def histogram(posts: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed, empty ones kept.

    The counts are at most ``bins`` rows; the empty bins come from a generated
    range joined to them.
    """
    values = posts.select(value.cast("double").alias("v")).filter(F.col("v").isNotNull())
    bounds = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    flat = bounds["low"] == bounds["high"]
    low = F.when(flat, bounds["low"] - F.lit(0.5)).otherwise(bounds["low"])
    high = F.when(flat, bounds["high"] + F.lit(0.5)).otherwise(bounds["high"])
    slot = F.floor((F.col("v") - low) / ((high - low) / F.lit(float(bins))))
    counts = (
        values.select(F.least(slot, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("posts"))
    )
    edges = posts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / F.lit(float(bins))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        F.coalesce("posts", F.lit(0)).alias("posts"),
    ).filter(F.col("bin_start").isNotNull())


def signal_histogram(posts: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(posts, F.col("primary_signal"), bins)


def engagement_histogram(posts: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(posts, F.log1p("total_engagement"), bins)


def term_frequency(
    posts: DataFrame,
    k: int = lx.CLOUD_TERMS,
    stop_words: list[str] = lx.STOP_WORDS,
    fold_plurals: bool = True,
) -> DataFrame:
    """Most frequent single words of the cleaned text.

    Words may hold apostrophes; a final 's is cut, numbers and stop words are
    dropped, and a plural in -s is counted with its singular where both occur.
    """
    texts = posts.select("content_cleaned").dropna()
    # Counted as found, so that the rules below look at each distinct word once.
    found = texts.mapInArrow(batches.cloud_counts, "word string, uses bigint")
    raw = found.groupBy("word").agg(F.sum("uses").alias("uses"))
    bare = raw.select(F.regexp_replace("word", "'s$", "").alias("term"), "uses")
    useful = bare.filter(
        (F.col("term") != "") & ~F.col("term").rlike(r"^\p{Nd}+$") & ~F.col("term").isin(stop_words)
    )
    counts = useful.groupBy("term").agg(F.sum("uses").alias("uses"))
    if fold_plurals:
        counts = folded_plurals(counts)
    return top_k(counts, "uses", k, "term")


def folded_plurals(counts: DataFrame) -> DataFrame:
    """Adds the count of '<term>s' to '<term>' where both are in the table.

    Every row offers itself under its own key and, if it is a plural, under its
    singular's key too; a group that holds the singular takes the plural in.
    """
    plural = F.col("term").endswith("s") & ~F.col("term").endswith("ss")
    stem = F.when(plural, F.expr("substring(term, 1, length(term) - 1)")).otherwise(F.col("term"))
    grouped = counts.select(stem.alias("stem"), plural.alias("plural"), "term", "uses")
    merged = grouped.groupBy("stem").agg(
        F.sum("uses").alias("uses"),
        F.min_by("term", F.col("plural").cast("int")).alias("term"),
    )
    return merged.select("term", "uses")


def correlation_matrix(
    posts: DataFrame, columns: list[str] = lx.CORRELATION_COLUMNS
) -> DataFrame | None:
    """Pearson r of every pair as (a, b, r); None with fewer than 3 columns.

    One aggregate holds the upper triangle; the mirrored half and the diagonal
    are laid out from that single row. r is null for a constant column, for
    which the built-in correlation would divide by zero; the regression
    aggregates do not.
    """
    present = [c for c in columns if c in posts.columns]
    if len(present) < 3:
        return None
    pairs = list(combinations(present, 2))

    def pair_r(a: str, b: str) -> Column:
        square, covariance = F.regr_r2(a, b), F.covar_pop(a, b)
        constant = (covariance == 0) & (square == 1)
        return F.when(~constant, F.signum(covariance) * F.sqrt(square))

    aggregates = [pair_r(a, b).alias(f"{a}*{b}") for a, b in pairs]
    aggregates += [F.when(F.min(a) < F.max(a), F.lit(1.0)).alias(f"{a}*{a}") for a in present]
    row = posts.agg(*aggregates)

    def cell(a: str, b: str, source: str) -> Column:
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{source}`").alias("r"))

    cells = [cell(a, b, f"{a}*{b}") for a, b in pairs]
    cells += [cell(b, a, f"{a}*{b}") for a, b in pairs]
    cells += [cell(a, a, f"{a}*{a}") for a in present]
    return row.select(F.inline(F.array(*cells)))


def signal_vs_confidence(posts: DataFrame, max_rows: int = 5000) -> DataFrame:
    return stratified_sample(posts, max_rows).select(
        "id", "primary_signal", "confidence_score", "total_engagement"
    )


def engagement_vs_signal(posts: DataFrame, max_rows: int = 3000) -> DataFrame:
    return stratified_sample(posts, max_rows).select(
        "id", F.log1p("total_engagement").alias("log_engagement"), "primary_signal"
    )


def signal_over_time(posts: DataFrame, max_rows: int = 2000) -> DataFrame:
    return stratified_sample(posts, max_rows).select("id", "timestamp", "primary_signal")


def sentiment_vs_engagement(posts: DataFrame, max_rows: int = 2000) -> DataFrame:
    return stratified_sample(posts, max_rows).select(
        "id", "primary_signal", "total_engagement", "confidence_score"
    )
