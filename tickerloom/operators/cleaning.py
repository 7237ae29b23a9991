"""Row-wise operators: validation, recency, enrichment, quality.

None of them shuffles, except :func:`recent_prefix`, whose only aggregate is one
small row per source.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom import lexicon as lx
from tickerloom.functions import batches
from tickerloom.functions import scoring as sc
from tickerloom.functions import text as tx
from tickerloom.functions import timing as tm


#: What is known of a post's words, kept only between the steps of one run.
WORD_MARKS = "word_marks"


def latest(posts: DataFrame, ts: str = "timestamp") -> Column:
    """Newest time of a frame as a scalar subquery: the default ``as_of``."""
    return posts.agg(F.max(ts).alias("latest")).scalar()


def validate_posts(posts: DataFrame) -> DataFrame:
    """Keep rows with a user, a text and a time; a blank text is still a text."""
    return posts.filter(
        (F.col("username") != "") & (F.col("content") != "") & F.col("timestamp").isNotNull()
    )


def filter_recent(posts: DataFrame, as_of: Column, hours: int = lx.RECENCY_HOURS) -> DataFrame:
    return posts.filter(tm.is_recent(F.col("timestamp"), as_of, hours))


def recent_prefix(
    posts: DataFrame,
    as_of: Column,
    sources: list[str],
    hours: int = lx.RECENCY_HOURS,
) -> DataFrame:
    """Rows before the first old row of their source, in feed order.

    The cut positions are one row per followed source, bounded by the caller's
    list, so they are broadcast; posts stay where they were read.
    """
    followed = posts.filter(F.col("hashtag_source").isin(sources))
    old = ~F.coalesce(tm.is_recent(F.col("timestamp"), as_of, hours), F.lit(False))
    cuts = followed.groupBy("hashtag_source").agg(
        F.min(F.when(old, F.col("feed_pos"))).alias("cut_pos")
    )
    joined = followed.join(F.broadcast(cuts), "hashtag_source", "left")
    kept = joined.filter(F.col("cut_pos").isNull() | (F.col("feed_pos") < F.col("cut_pos")))
    return kept.select(*posts.columns)


def with_clean_text(posts: DataFrame) -> DataFrame:
    return posts.withColumn("content_cleaned", tx.clean_text(F.col("content")))


def with_lengths(posts: DataFrame) -> DataFrame:
    """Code-point lengths of the raw and the cleaned text."""
    return posts.withColumns({
        "content_length": F.length("content"),
        "cleaned_length": F.length("content_cleaned"),
    })


def with_time_parts(posts: DataFrame) -> DataFrame:
    return posts.withColumns({
        "hour": tm.hour_of_day(F.col("timestamp")),
        "day_of_week": tm.weekday(F.col("timestamp")),
    })


def with_engagement(posts: DataFrame) -> DataFrame:
    total = F.col("likes") + F.col("retweets") + F.col("replies")
    return posts.withColumn("total_engagement", total).withColumn(
        "engagement_rate",
        sc.engagement_rate(F.col("total_engagement"), F.col("content_length")),
    )


def with_tags(posts: DataFrame) -> DataFrame:
    """Counts and joined forms; tags are read from the text where not supplied."""
    found = {"hashtags": tx.hashtags, "mentions": tx.mentions}
    missing = {name: fn(F.col("content")) for name, fn in found.items() if name not in posts.columns}
    tagged = posts.withColumns(missing) if missing else posts
    return tagged.withColumns({
        "hashtag_count": tx.list_length(F.col("hashtags")),
        "mention_count": tx.list_length(F.col("mentions")),
        "hashtags_str": tx.joined(F.col("hashtags")),
        "mentions_str": tx.joined(F.col("mentions")),
    })


def with_word_marks(posts: DataFrame) -> DataFrame:
    """Adds ``word_marks``, which the scores of words read, where it isn't there yet."""
    if WORD_MARKS in posts.columns:
        return posts
    return posts.withColumn(WORD_MARKS, tx.word_marks(F.col("content_cleaned")))


def with_text_scores(posts: DataFrame) -> DataFrame:
    """The words are gone through once for both whole-word tests; marks that were there before stay."""
    marked = with_word_marks(posts)
    scored = marked.withColumns({
        "has_market_keywords": tx.marked_relevance(F.col(WORD_MARKS)),
        "sentiment_score": tx.marked_sentiment(F.col(WORD_MARKS)),
    })
    return scored if WORD_MARKS in posts.columns else scored.drop(WORD_MARKS)


def with_quality(posts: DataFrame) -> DataFrame:
    c = F.col
    flagged = posts.withColumn("_variety", batches.variety(c("content"))).withColumn(
        "is_potential_bot",
        sc.bot_flag(c("username"), c("content"), c("total_engagement"), c("content_length"), c("_variety")),
    ).drop("_variety")
    return flagged.withColumn(
        "quality_score",
        sc.quality_score(
            c("is_potential_bot"),
            c("has_market_keywords"),
            c("total_engagement"),
            c("content_length"),
            c("hashtag_count"),
        ),
    )


def enrich(posts: DataFrame, keep_marks: bool = False) -> DataFrame:
    """All derived columns of valid posts, before the quality cut; with ``keep_marks`` the word marks too."""
    steps = (
        with_clean_text,
        *([with_word_marks] if keep_marks else []),
        with_lengths,
        with_time_parts,
        with_engagement,
        with_tags,
        with_text_scores,
        with_quality,
    )
    enriched = validate_posts(posts)
    for step in steps:
        enriched = step(enriched)
    return enriched


def filter_quality(posts: DataFrame, floor: float = lx.QUALITY_FLOOR) -> DataFrame:
    return posts.filter(F.col("quality_score") >= floor)


def counted(df: DataFrame, stage_name: str) -> DataFrame:
    """Observes the row count of a step, under a name of its own.

    A filter does not move below an observation. Without one, the optimizer
    would copy every expression behind the filtered column into the filter and
    work each text through all patterns twice.
    """
    return df.observe(f"{stage_name}-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def clean_and_process(posts: DataFrame, floor: float = lx.QUALITY_FLOOR, keep_marks: bool = False) -> DataFrame:
    return filter_quality(counted(enrich(posts, keep_marks), "enriched"), floor)


def filter_text_eligible(
    posts: DataFrame,
    min_length: int = lx.MIN_TEXT_LENGTH,
    min_words: int = lx.MIN_TEXT_WORDS,
) -> DataFrame:
    """Texts long enough for term features, with their second cleaning."""
    prepared = posts.withColumn("feature_text", tx.feature_text(F.col("content_cleaned")))
    return counted(prepared, "prepared").filter(
        (F.length("content_cleaned") >= min_length)
        & (F.size(tx.tokens(F.col("feature_text"))) >= min_words)
    )


def fill_defaults(posts: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Null to default, for the columns that exist."""
    present = {name: value for name, value in defaults.items() if name in posts.columns}
    return posts.fillna(present) if present else posts


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropna(subset=columns)
