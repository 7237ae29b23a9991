"""Top-k, per-group limits, samples and influence."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom import lexicon as lx

# Spark cuts every input partition to k rows per group before a shuffle up to this k.
LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"
#: Partial lists per group between the cut in the partitions and the last ranking.
MERGE_FAN = 64


def cut_before_shuffle(df: DataFrame, k: int) -> None:
    """Raises Spark's own bound of the early cut to ``k``; plans change by it, results never. Left alone where it is switched off."""
    conf = df.sparkSession.conf
    if 0 <= int(conf.get(LIMIT_SETTING)) < k:
        conf.set(LIMIT_SETTING, str(k))


def top_k_per_group(
    df: DataFrame, group: list[str | Column], order: list[Column], k: int | Column, k_bound: int
) -> DataFrame:
    """First ``k`` rows of every group, exactly.

    ``k_bound`` is a literal upper bound of ``k``. Each partition is cut to so many rows
    per group before anything is shuffled; the lists of neighbouring partitions
    are merged first, then all of a group. So a hot group costs a task no more than
    its share of the lists.
    """
    cut_before_shuffle(df, k_bound)
    keys = [F.col(g) if isinstance(g, str) else g for g in group]
    parts = Window.partitionBy(*keys, "_part").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    located = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(MERGE_FAN)))
    merged = located.withColumn("_rank", F.row_number().over(parts)).filter(F.col("_rank") <= k_bound)
    ranked = merged.drop("_part").withColumn("_rank", F.row_number().over(whole))
    kept = ranked.filter(F.col("_rank") <= k_bound)
    if isinstance(k, Column):
        kept = kept.filter(F.col("_rank") <= k)
    return kept.drop("_rank")


def per_source_limit(
    posts: DataFrame,
    source_count: int,
    target: int = lx.TARGET_POSTS,
    minimum: int = lx.MIN_POSTS_PER_SOURCE,
) -> DataFrame:
    """Newest rows of each source, an equal share of the target each."""
    k = max(target // source_count, minimum)
    return top_k_per_group(posts, ["hashtag_source"], [F.desc("timestamp"), F.asc("id")], k, k)


def sort_recent(posts: DataFrame) -> DataFrame:
    return posts.orderBy(F.desc("timestamp"), F.asc("id"))


def sample_order(seed: int = lx.SAMPLE_SEED) -> list[Column]:
    """A fixed pseudo-random order of rows that does not depend on layout."""
    return [F.md5(F.concat_ws("_", F.col("id"), F.lit(str(seed)))), F.col("id")]


def stratified_sample(
    posts: DataFrame,
    max_rows: int = 1000,
    stratum: str = "trading_signal",
    seed: int = lx.SAMPLE_SEED,
) -> DataFrame:
    """Everything when it fits, else an equal quota from each stratum.

    A quota that a small stratum cannot fill is not given to the others.
    Without the stratum column it is a plain sample of ``max_rows``.
    """
    if stratum not in posts.columns:
        return posts.orderBy(*sample_order(seed)).limit(max_rows)
    sizes = posts.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    quota = sizes.agg(
        F.when(F.sum("n") > max_rows, F.floor(F.lit(max_rows) / F.count(F.lit(1))))
        .otherwise(F.lit(max_rows))
        .cast("int")
        .alias("quota")
    ).scalar()
    return top_k_per_group(posts, [stratum], sample_order(seed), quota, max_rows)


def influence_columns(posts: DataFrame) -> list[Column]:
    """The influence factors whose inputs exist."""
    factors = []
    if "signal_strength" in posts.columns:
        factors.append(F.col("signal_strength"))
    if "confidence_score" in posts.columns:
        factors.append(F.col("confidence_score"))
    if "total_engagement" in posts.columns:
        highest = posts.agg(F.max("total_engagement").alias("highest")).scalar()
        factors.append(F.col("total_engagement") / (highest + F.lit(1)))
    if "quality_score" in posts.columns:
        factors.append(F.col("quality_score"))
    return factors


def influence_score(posts: DataFrame) -> DataFrame:
    """Mean of the factors present; unchanged when there is none."""
    factors = influence_columns(posts)
    if not factors:
        return posts
    return posts.withColumn("influence_score", reduce(add, factors) / F.lit(float(len(factors))))


TOP_COLUMNS = [
    "username", "content", "timestamp", "trading_signal", "primary_signal",
    "confidence_score", "influence_score", "likes", "retweets", "replies",
]


def top_influential(posts: DataFrame, n: int = 20) -> DataFrame:
    """Highest influence first, ties by id; the first n rows without factors."""
    scored = influence_score(posts)
    if "influence_score" not in scored.columns:
        return scored.limit(n)
    best = scored.orderBy(F.desc("influence_score"), F.asc("id")).limit(n)
    return best.select(*TOP_COLUMNS)


def top_k(df: DataFrame, value: str, k: int, tie: str) -> DataFrame:
    """Largest k by value, ties by the named column."""
    return df.orderBy(F.desc(value), F.asc(tie)).limit(k)
