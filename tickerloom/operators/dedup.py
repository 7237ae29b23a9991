"""Deduplication, merging and unions.

Each "first row per key" is ``row_number() = 1``: Spark keeps one row per key in
every input partition before the shuffle, so a key that holds a third of all
rows reaches its task as at most one row per partition.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions import text as tx


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def source_rank(sources: list[str]) -> Column:
    """Position in the list of followed sources; unknown ones come last."""
    pairs = chain.from_iterable((F.lit(s), F.lit(i)) for i, s in enumerate(sources))
    return F.coalesce(
        F.try_element_at(F.create_map(*pairs), F.col("hashtag_source")), F.lit(len(sources))
    )


def with_content_hash(posts: DataFrame) -> DataFrame:
    return posts.withColumn(
        "hash", tx.content_hash(F.col("username"), F.col("timestamp"), F.col("content"))
    )


def dedup_by_id(posts: DataFrame) -> DataFrame:
    """First occurrence of an id within its source."""
    return first_per_key(posts, ["hashtag_source", "id"], [F.asc("feed_pos")])


def dedup_first(posts: DataFrame, sources: list[str]) -> DataFrame:
    """First occurrence of a content hash, sources in their followed order."""
    return first_per_key(
        with_content_hash(posts), ["hash"], [source_rank(sources), F.asc("feed_pos"), F.asc("id")]
    )


def merge_keep_last(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Both batches, last row per hash, newest first."""
    if existing is None:
        return new
    batches = existing.withColumn("_batch", F.lit(0)).unionByName(
        new.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    if "hash" in batches.columns:
        batches = first_per_key(
            batches, ["hash"], [F.desc("_batch"), F.desc("feed_pos"), F.desc("id")]
        )
    merged = batches.drop("_batch")
    if "timestamp" in merged.columns:
        merged = merged.orderBy(F.desc("timestamp"), F.asc("id"))
    return merged


def union_sources(feeds: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
