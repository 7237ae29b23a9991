"""Posts from the benchmark star schema: one post per event.

The text of a post is the whole text of a document plus market phrases and
tags, so that every lexicon rule has something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.functions import text as tx
from tickerloom.session import prepare

# --- fixed values: market phrases, by user ---------------------------------
PHRASES = [
    "strong buy", "crash", "breakout rally", "support broken", "profit booking",
    "market", "nifty trend", "sideways", "volatile mixed", "stop loss",
]
SOURCES = ["#click", "#error", "#purchase", "#signup", "#view"]


def _when_divides(n: int, text: Column) -> Column:
    return F.when(F.col("event_id") % n == 0, text).otherwise(F.lit(""))


def base_posts(spark: SparkSession, tables: str) -> DataFrame:
    """id .. scraped_at of every event, with its document's text.

    Documents and events meet on the document key by sort-merge join, since
    both sides grow with the data. The partition count is given because the
    join multiplies every text: sized by its inputs alone, the adaptive planner
    would merge the join into too few tasks.
    """
    prepare(spark)
    events = spark.read.parquet(f"{tables}/events.parquet")
    documents = spark.read.parquet(f"{tables}/documents.parquet")
    keys = documents.agg((F.max("doc_id") + 1).alias("keys")).scalar()
    newest = events.agg(F.max("ts").cast("timestamp").alias("newest")).scalar()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = events.withColumn("doc_id", F.col("event_id") % keys).repartition(tasks, "doc_id")
    texts = documents.select("doc_id", "text").repartition(tasks, "doc_id")
    joined = keyed.join(texts.hint("merge"), "doc_id", "left")
    user, kind = F.col("user_id"), F.col("event_type")
    phrase = F.get(F.array(*[F.lit(p) for p in PHRASES]), (user % 10).cast("int"))
    content = F.when(
        F.col("event_id") % 17 == 0, F.concat(F.lit("ok "), kind)
    ).otherwise(
        F.concat(
            F.coalesce(F.col("text"), F.lit("")),
            F.lit(" "), phrase,
            F.lit(" #"), kind,
            _when_divides(7, F.concat(F.lit(" @user_"), user)),
            _when_divides(11, F.lit(" https://ex.com/a?b=1#frag")),
            _when_divides(13, F.lit(" #a #b #c #d #e #f #g #h")),
        )
    )
    return joined.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_id").alias("feed_pos"),
        F.when(user % 3 == 0, F.concat(F.lit("trader_"), kind))
        .otherwise(F.concat(F.lit("user_"), user))
        .alias("username"),
        content.alias("content"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.floor("value").cast("bigint").alias("likes"),
        F.get_json_object("props", "$.k").cast("bigint").alias("retweets"),
        (user % 5).alias("replies"),
        F.concat(F.lit("#"), kind).alias("hashtag_source"),
        (newest + F.make_dt_interval(mins=F.lit(1))).alias("scraped_at"),
    )


def posts(spark: SparkSession, tables: str) -> DataFrame:
    """Collected posts: base columns plus tags and url."""
    c = F.col
    base = base_posts(spark, tables)
    return base.withColumns({
        "total_engagement": c("likes") + c("retweets") + c("replies"),
        "mentions": tx.mentions(c("content")),
        "hashtags": tx.hashtags(c("content")),
        "url": tx.post_url(c("username"), c("id")),
    })


def as_of(spark: SparkSession, tables: str) -> Column:
    """Newest event time, read from the time column alone."""
    events = spark.read.parquet(f"{tables}/events.parquet")
    return events.agg(F.max("ts").cast("timestamp").alias("as_of")).scalar()


def provider_records(spark: SparkSession, tables: str) -> DataFrame:
    """The same posts in the nested form a provider delivers them."""
    c = F.col
    base = base_posts(spark, tables)
    even = c("feed_pos") % 2 == 0
    return base.select(
        "id",
        "feed_pos",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        F.when(even, c("content")).alias("text"),
        F.when(~even, c("content")).alias("full_text"),
        F.struct(
            F.when(c("username") != "trader_view", c("username")).alias("screen_name")
        ).alias("user"),
        F.when(c("likes") > 0, c("likes")).alias("favorite_count"),
        c("retweets").alias("retweet_count"),
        F.when(c("replies") > 0, c("replies")).alias("reply_count"),
        "hashtag_source",
    )


def repeated_posts(spark: SparkSession, tables: str) -> DataFrame:
    """Posts with copies: one fifth under another source, one fifth re-sent."""
    c = F.col
    base = base_posts(spark, tables)
    other = base.filter(c("hashtag_source") == "#error").withColumns({
        "hashtag_source": F.lit("#click"),
        "feed_pos": c("feed_pos") + 1000000000,
    })
    again = base.filter(c("hashtag_source") == "#view").withColumns({
        "likes": c("likes") + 1,
        "feed_pos": c("feed_pos") + 2000000000,
    })
    return base.unionByName(other).unionByName(again)


def flawed_posts(spark: SparkSession, tables: str) -> DataFrame:
    """Posts with empty users and missing texts among them."""
    c = F.col
    return base_posts(spark, tables).withColumns({
        "username": F.when(c("retweets") == 7, F.lit("")).otherwise(c("username")),
        "content": F.when(c("retweets") != 11, c("content")),
    })
