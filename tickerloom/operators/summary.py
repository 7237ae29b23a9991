"""One-row summaries and the themes they list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
LEANING_BAND = 0.1
HIGH_CONFIDENCE = 0.7
THEME_COUNT = 5


def _leaning_counts(value: str, names: tuple[str, str, str]) -> list[Column]:
    c = F.col(value)
    positive, negative, neutral = names
    return [
        F.count_if(c > LEANING_BAND).alias(positive),
        F.count_if(c < -LEANING_BAND).alias(negative),
        F.count_if(F.abs(c) <= LEANING_BAND).alias(neutral),
    ]


def data_statistics(posts: DataFrame) -> DataFrame:
    """One row of counts, ranges, totals and means; none for empty input."""
    have = set(posts.columns)
    plan: list[tuple[str, list[Column]]] = [
        ("username", [F.count_distinct("username").alias("unique_users")]),
        ("timestamp", [
            F.date_format(F.min("timestamp"), ISO).alias("range_start"),
            F.date_format(F.max("timestamp"), ISO).alias("range_end"),
        ]),
        ("likes", [F.sum("likes").alias("total_likes")]),
        ("retweets", [F.sum("retweets").alias("total_retweets")]),
        ("replies", [F.sum("replies").alias("total_replies")]),
        ("engagement_rate", [F.avg("engagement_rate").alias("avg_engagement_rate")]),
        ("content_length", [F.avg("content_length").alias("avg_length")]),
        ("hashtag_count", [F.avg("hashtag_count").alias("avg_hashtags")]),
        ("mention_count", [F.avg("mention_count").alias("avg_mentions")]),
        ("quality_score", [F.avg("quality_score").alias("avg_quality_score")]),
        ("is_potential_bot", [F.count_if("is_potential_bot").alias("potential_bots")]),
        ("has_market_keywords", [F.count_if("has_market_keywords").alias("market_relevant")]),
        ("sentiment_score", [
            F.avg("sentiment_score").alias("avg_sentiment"),
            *_leaning_counts(
                "sentiment_score", ("positive_tweets", "negative_tweets", "neutral_tweets")
            ),
        ]),
    ]
    columns = [col for needed, cols in plan if needed in have for col in cols]
    stats = posts.agg(F.count(F.lit(1)).alias("total_tweets"), *columns)
    return stats.filter(F.col("total_tweets") > 0)


def market_summary(posts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row of signal, confidence and label counts; none for empty input.

    With ``as_of`` the row says as of when (``timestamp``, ISO text).
    """
    have = set(posts.columns)
    columns = []
    if "primary_signal" in have:
        columns += [
            F.avg("primary_signal").alias("mean_signal"),
            F.stddev_samp("primary_signal").alias("signal_std"),
            *_leaning_counts(
                "primary_signal", ("bullish_tweets", "bearish_tweets", "neutral_signal_tweets")
            ),
        ]
    if "confidence_score" in have:
        columns += [
            F.avg("confidence_score").alias("avg_confidence"),
            F.count_if(F.col("confidence_score") > HIGH_CONFIDENCE).alias(
                "high_confidence_signals"
            ),
        ]
    if "trading_signal" in have:
        columns += [
            F.count_if(F.col("trading_signal") == label).alias(f"{label.lower()}_signals")
            for label in ("BUY", "SELL", "HOLD")
        ]
    summary = posts.agg(F.count(F.lit(1)).alias("scored_tweets"), *columns)
    summary = summary.filter(F.col("scored_tweets") > 0)
    return summary if as_of is None else summary.withColumn("timestamp", F.date_format(as_of, ISO))


def theme_counts(posts: DataFrame, count: int = THEME_COUNT) -> DataFrame:
    """Largest clusters. 'No cluster' (-1) is counted first and dropped after."""
    sizes = posts.groupBy("topic_cluster").agg(F.count(F.lit(1)).alias("posts"))
    largest = sizes.orderBy(F.desc("posts"), F.asc("topic_cluster")).limit(count)
    return largest.filter(F.col("topic_cluster") != -1).select(
        F.concat(F.lit("theme_"), F.col("topic_cluster").cast("string")).alias("theme"), "posts"
    )


def market_themes(posts: DataFrame, count: int = THEME_COUNT) -> DataFrame:
    """The largest clusters as one map column."""
    entries = F.collect_list(F.struct("theme", "posts"))
    return theme_counts(posts, count).agg(F.map_from_entries(entries).alias("market_themes"))


def merge_summaries(left: DataFrame, right: DataFrame) -> DataFrame:
    """Fields of two one-row summaries side by side; the right one wins."""
    own = [c for c in left.columns if c not in right.columns]
    fields = [left.select(F.struct(*own).alias("s")).scalar()[c].alias(c) for c in own]
    return right.select(*fields, *right.columns)


# --- fixed values: names of the report's sections and keys ------------------
SECTIONS = {
    "timestamp": ["timestamp"],
    "overall_sentiment": [
        "mean_signal", "signal_std", "bullish_tweets", "bearish_tweets", "neutral_signal_tweets",
    ],
    "confidence_metrics": ["avg_confidence", "high_confidence_signals"],
    "trading_recommendations": ["buy_signals", "sell_signals", "hold_signals"],
    "total_tweets": ["total_tweets"],
    "unique_users": ["unique_users"],
    "date_range": ["range_start", "range_end"],
    "engagement": ["total_likes", "total_retweets", "total_replies", "avg_engagement_rate"],
    "content": ["avg_length", "avg_hashtags", "avg_mentions"],
    "quality": ["avg_quality_score", "potential_bots", "market_relevant"],
    "sentiment": ["avg_sentiment", "positive_tweets", "negative_tweets", "neutral_tweets"],
}


# Keys that differ from their column, because two sections use the same key.
KEYS = {"neutral_signal_tweets": "neutral_tweets", "range_start": "start", "range_end": "end"}


def nested_summary(summary: DataFrame) -> DataFrame:
    """The flat summary row as one struct per report section."""
    have = set(summary.columns)
    sections = []
    for section, names in SECTIONS.items():
        present = [n for n in names if n in have]
        if present == [section]:
            sections.append(F.col(section))
        elif present:
            sections.append(F.struct(*[F.col(n).alias(KEYS.get(n, n)) for n in present]).alias(section))
    return summary.select(*sections)


def summary_lines(summary: DataFrame) -> DataFrame:
    """The flat summary row as (section, key, value) text rows."""
    have = set(summary.columns)
    entries = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(KEYS.get(name, name)).alias("key"),
            F.col(name).cast("string").alias("value"),
        )
        for section, names in SECTIONS.items()
        for name in names
        if name in have
    ]
    return summary.select(F.inline(F.array(*entries)))


def theme_lines(posts: DataFrame) -> DataFrame:
    """The largest clusters as (section, key, value) text rows."""
    return theme_counts(posts).select(
        F.lit("market_themes").alias("section"), F.col("theme").alias("key"), F.col("posts").cast("string").alias("value")
    )
