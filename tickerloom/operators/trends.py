"""Time series over posts.

Posts are first reduced to one row per bucket (partial sums before the
shuffle). Only that series, whose size is bounded by time range / bucket width,
is then ordered in a window.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom import lexicon as lx
from tickerloom.operators.dedup import union_sources

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)
MEANS = ["primary_signal", "confidence_score", "signal_strength", "composite_sentiment"]
SUMS = ["total_engagement", "likes", "retweets", "replies"]


def bucket_start(posts: DataFrame, every: timedelta, ts: str = "timestamp") -> Column:
    """Start of the bucket a time falls in, counted from midnight of the first day.

    A width that divides the day needs no look at the data: it lines up with
    the epoch as well.
    """
    width = F.lit(int(every.total_seconds()))
    seconds = F.unix_seconds(ts)
    if DAY % every == timedelta(0):
        return F.timestamp_seconds(seconds - F.pmod(seconds, width))
    first_day = posts.agg(F.unix_seconds(F.date_trunc("day", F.min(ts))).alias("day")).scalar()
    return F.timestamp_seconds(seconds - F.pmod(seconds - first_day, width))


def resample(
    posts: DataFrame,
    every: timedelta = HOUR,
    means: list[str] = MEANS,
    sums: list[str] = SUMS,
    count_of: str | None = "username",
) -> DataFrame:
    """One row per non-empty bucket, over the columns that exist."""
    aggregates = [F.avg(c).alias(c) for c in means if c in posts.columns]
    aggregates += [F.sum(c).alias(c) for c in sums if c in posts.columns]
    if count_of in posts.columns:
        aggregates.append(F.count(count_of).alias("tweet_count"))
    timed = posts.filter(F.col("timestamp").isNotNull())
    return timed.groupBy(bucket_start(timed, every).alias("bucket")).agg(*aggregates)


def fill_gaps(series: DataFrame, every: timedelta = HOUR) -> DataFrame:
    """Adds the empty buckets between the first and the last one.

    Each row spans the buckets up to the next row, so no calendar is joined.
    In an added bucket sums and counts are 0 and means are null.
    """
    step = F.make_dt_interval(secs=F.lit(int(every.total_seconds())))
    following = F.lead("bucket").over(Window.orderBy("bucket"))
    spans = series.withColumn("_last", F.coalesce(following - step, F.col("bucket")))
    spanned = spans.withColumn("_slot", F.explode(F.sequence(F.col("bucket"), F.col("_last"), step)))
    real = F.col("_slot") == F.col("bucket")
    values = []
    for name in series.columns:
        if name == "bucket":
            continue
        empty = F.lit(0) if name in SUMS or name == "tweet_count" else F.lit(None)
        values.append(F.when(real, F.col(name)).otherwise(empty).alias(name))
    return spanned.select(F.col("_slot").alias("bucket"), *values)


def with_trend(series: DataFrame, column: str = "primary_signal") -> DataFrame:
    """Centred mean of three buckets (all present) and first difference.

    Both are null throughout a series of three buckets or fewer.
    """
    if column not in series.columns:
        return series
    ordered = Window.orderBy("bucket")
    around = ordered.rowsBetween(-1, 1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    enough = F.count(F.lit(1)).over(whole) > 3
    complete = F.count(column).over(around) == 3
    return series.withColumns({
        "signal_trend": F.when(enough & complete, F.avg(column).over(around)),
        "momentum_change": F.when(enough, F.col(column) - F.lag(column).over(ordered)),
    })


def hourly_trends(posts: DataFrame, every: timedelta = HOUR) -> DataFrame:
    """Gap-filled signal and engagement series with its trend columns."""
    return with_trend(fill_gaps(resample(posts, every), every))


def trend_periods(posts: DataFrame, hours: list[int] = lx.TREND_HOURS) -> DataFrame:
    """The trend at several bucket widths, one block of rows per width.

    Posts are reduced once, to hours; the wider series merge those sums and
    counts instead of reading the posts again.
    """
    means = [c for c in MEANS if c in posts.columns]
    sums = [c for c in SUMS if c in posts.columns]
    carried = [F.sum(c).alias(f"{c}_sum") for c in means]
    carried += [F.count(c).alias(f"{c}_n") for c in means]
    carried += [F.sum(c).alias(c) for c in sums]
    carried.append(F.count("username").alias("tweet_count"))
    timed = posts.filter(F.col("timestamp").isNotNull())
    by_hour = timed.groupBy(bucket_start(timed, HOUR).alias("slot")).agg(*carried)
    blocks = []
    for width in hours:
        every = timedelta(hours=width)
        merged = [
            (F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0))).alias(c) for c in means
        ]
        merged += [F.sum(c).alias(c) for c in [*sums, "tweet_count"]]
        series = by_hour.groupBy(bucket_start(by_hour, every, "slot").alias("bucket")).agg(*merged)
        trend = with_trend(fill_gaps(series, every))
        blocks.append(trend.withColumn("period_hours", F.lit(width)))
    return union_sources(blocks)


def sentiment_timeline(posts: DataFrame) -> DataFrame:
    """Hourly means and engagement, empty hours left out."""
    series = resample(
        posts,
        means=["primary_signal", "composite_sentiment", "confidence_score"],
        sums=["total_engagement"],
        count_of=None,
    )
    return series.dropna()


def sentiment_by_hour(posts: DataFrame) -> DataFrame:
    return posts.groupBy(F.hour("timestamp").alias("hour")).agg(
        F.avg("primary_signal").alias("mean_signal")
    )


def rolling_sentiment(
    posts: DataFrame, hours: int = lx.ROLLING_HOURS, value: str = "sentiment_score"
) -> DataFrame:
    """Mean over the trailing hours, per source and minute.

    Minutes are summed first, so a window holds at most one row per minute of
    the time range, however many posts its source has.
    """
    minutes = posts.groupBy(
        "hashtag_source", F.date_trunc("minute", "timestamp").alias("minute")
    ).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    trailing = (
        Window.partitionBy("hashtag_source")
        .orderBy(F.unix_seconds("minute"))
        .rangeBetween(-hours * 3600, 0)
    )
    return minutes.select(
        "hashtag_source",
        "minute",
        (F.sum("_sum").over(trailing) / F.sum("_n").over(trailing)).alias("rolling_sentiment"),
        F.sum("_n").over(trailing).alias("posts_in_window"),
    )
