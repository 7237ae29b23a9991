"""Reading landed posts and turning provider records into posts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom import lexicon as lx
from tickerloom import schema
from tickerloom.functions import text as tx
from tickerloom.functions import timing as tm


def read_posts(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    sources: list[str] | None = None,
    columns: T.StructType = schema.POST,
) -> DataFrame:
    """Landed posts of the given sources. The filter is pushed to the scan."""
    posts = spark.read.schema(columns).options(**schema.TIME_OPTIONS).format(fmt).load(path)
    return posts if sources is None else posts.filter(F.col("hashtag_source").isin(sources))


def read_provider_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.PROVIDER_RECORD).json(path)


def load_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame | None:
    """A Parquet data set, or None where there is none. ``merge_schema`` takes in columns that only some files have."""
    try:
        return spark.read.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def normalize_records(records: DataFrame, as_of: Column) -> DataFrame:
    """Provider record -> post. Unreadable times become ``as_of``."""
    c = F.col
    zero = F.lit(0).cast("bigint")
    named = records.select(
        c("id").cast("string").alias("id"),
        "feed_pos",
        F.coalesce(c("user.screen_name"), F.lit(lx.UNKNOWN_USER)).alias("username"),
        F.coalesce(F.nullif(c("text"), F.lit("")), c("full_text"), F.lit("")).alias("content"),
        F.coalesce(tm.parse_iso(c("created_at")), as_of).alias("timestamp"),
        F.coalesce("favorite_count", zero).alias("likes"),
        F.coalesce("retweet_count", zero).alias("retweets"),
        F.coalesce("reply_count", zero).alias("replies"),
        "hashtag_source",
        as_of.alias("scraped_at"),
    )
    tagged = named.withColumns({
        "total_engagement": c("likes") + c("retweets") + c("replies"),
        "mentions": tx.mentions(c("content")),
        "hashtags": tx.hashtags(c("content")),
        "url": tx.post_url(c("username"), c("id")),
        "hash": tx.content_hash(c("username"), c("timestamp"), c("content")),
        "content_length": F.length("content"),
    })
    return tagged.withColumns({
        "hashtag_count": F.size("hashtags"),
        "mention_count": F.size("mentions"),
    })
