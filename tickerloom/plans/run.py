"""The full run: collect, enrich, score, summarise, report."""

from __future__ import annotations

import traceback
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickerloom import lexicon as lx
from tickerloom.operators import charts, cleaning, dedup, ranking, signals, summary, trends
from tickerloom.operators import textfeatures as tf
from tickerloom.sources import writers
from tickerloom.staging import stage, staging_scope

# What later steps read of a processed post, apart from its texts.
LEAN_COLUMNS = [
    "id", "username", "timestamp", "likes", "retweets", "replies", "hashtag_source",
    "total_engagement", "engagement_rate", "content_length", "cleaned_length",
    "hashtag_count", "mention_count", "has_market_keywords", "sentiment_score",
    "is_potential_bot", "quality_score", "hour", "day_of_week",
    "bullish_score", "bearish_score", "volatility_score", "time_decay",
    "composite_sentiment", "weighted_sentiment", "time_weighted_sentiment",
]


def collect_posts(
    feed: DataFrame,
    as_of: Column,
    sources: list[str],
    hours: int = lx.RECENCY_HOURS,
    target: int = lx.TARGET_POSTS,
) -> DataFrame:
    """Collection rules over a landed feed.

    Recent prefix of each source, valid rows only, ids once per source, the
    newest share of each source, then one row per content hash. An id counts as
    seen only once a valid post has come with it.
    """
    prefix = cleaning.recent_prefix(feed, as_of, sources, hours)
    once = dedup.dedup_by_id(cleaning.validate_posts(prefix))
    limited = ranking.per_source_limit(once, len(sources), target)
    return dedup.dedup_first(limited, sources)


def lexicon_scored(posts: DataFrame, as_of: Column) -> DataFrame:
    """Processed posts with lexicon signals: one pass, no shuffle."""
    return signals.lexicon_signals(cleaning.clean_and_process(posts, keep_marks=True), as_of)


def scored_posts(
    posts: DataFrame,
    as_of: Column,
    keep_text: bool = False,
    weights: dict[str, float] = lx.SIGNAL_WEIGHTS,
) -> DataFrame:
    """Posts with composite signal and label, without text features.

    The texts are read and scored once into a staged table; the two passes of
    the composite (ranges, then rows) read a few numeric columns of it.
    """
    wide = lexicon_scored(posts, as_of)
    lean = [*LEAN_COLUMNS, "content", "content_cleaned"] if keep_text else LEAN_COLUMNS
    return signals.composite_signals(stage(wide.select(*lean), "scored"), weights)


def scored_posts_with_topics(
    posts: DataFrame, as_of: Column, restarts: int = lx.CLUSTER_RESTARTS, keep_text: bool = False
) -> DataFrame:
    """Posts with composite signal and label, text features included."""
    lean = [*LEAN_COLUMNS, "content", "content_cleaned"] if keep_text else LEAN_COLUMNS
    return signals.composite_signals(tf.tfidf_signals(lexicon_scored(posts, as_of), restarts, keep=lean))


@dataclass
class RunResult:
    status: str = "running"
    counts: dict[str, int] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)


def report_row(
    scored: DataFrame, top: int = lx.REPORT_TOP_POSTS, as_of: Column | None = None
) -> DataFrame:
    """One row: summaries, the top posts and the hourly trends.

    What is gathered into lists is already limited: ``top`` posts and one row
    per hour.
    """
    facts = summary.merge_summaries(
        summary.market_summary(scored, as_of), summary.data_statistics(scored)
    )
    best = ranking.top_influential(scored, top).agg(F.collect_list(F.struct("*")).alias("rows"))
    hours = trends.hourly_trends(scored).agg(
        F.sort_array(F.collect_list(F.struct("*"))).alias("rows")
    )
    report = summary.nested_summary(facts).withColumns({
        "top_influential_tweets": best.scalar(),
        "hourly_trends": hours.scalar(),
    })
    if "topic_cluster" in scored.columns:
        report = report.withColumn("market_themes", summary.market_themes(scored).scalar())
    return report


def run(feed: DataFrame, as_of: Column, out: str, sources: list[str] | None = None) -> RunResult:
    """Collect (when sources are given), process, score and write everything.

    Row counts come from observations on the writes, not from extra passes.
    """
    result = RunResult()
    with staging_scope(feed.sparkSession):
        _run(feed, as_of, out, sources, result)
    return result


def _run(feed: DataFrame, as_of: Column, out: str, sources: list[str] | None, result: RunResult) -> None:
    try:
        posts = feed if sources is None else collect_posts(feed, as_of, sources)
        collected, processed = Observation("collected"), Observation("processed")
        rows = F.count(F.lit(1)).alias("rows")
        wide = lexicon_scored(posts.observe(collected, rows), as_of)
        processed_path = f"{out}/processed_posts"
        wide.observe(processed, rows).write.mode("overwrite").parquet(processed_path)
        result.counts["collected"] = collected.get["rows"]
        result.counts["processed"] = processed.get["rows"]
        if not result.counts["processed"]:
            raise ValueError("no posts left after processing")
        result.paths["processed"] = processed_path

        kept = feed.sparkSession.read.schema(wide.schema).parquet(processed_path)
        lean = kept.select(*LEAN_COLUMNS, "content", "content_cleaned")
        final = signals.composite_signals(tf.tfidf_signals(lean))
        scored_count = Observation("scored")
        signals_path = f"{out}/signals"
        final.observe(scored_count, rows).write.mode("overwrite").parquet(signals_path)
        result.counts["signals"] = scored_count.get["rows"]
        result.paths["signals"] = signals_path

        scored = feed.sparkSession.read.schema(final.schema).parquet(signals_path)
        result.paths["report"] = writers.save_report(report_row(scored, as_of=as_of), f"{out}/report")
        facts = summary.merge_summaries(
            summary.market_summary(scored, as_of), summary.data_statistics(scored)
        )
        lines = summary.summary_lines(facts)
        if "topic_cluster" in scored.columns:
            lines = lines.unionByName(summary.theme_lines(scored))
        result.paths["summary"] = writers.save_text(lines, f"{out}/summary")
        for name, data in chart_data(scored).items():
            path = f"{out}/charts/{name}"
            data.write.mode("overwrite").parquet(path)
            result.paths[name] = path
        result.status = "completed"
    except Exception as error:  # a failed run is reported, not raised
        result.status = "failed"
        result.errors.append("".join(traceback.format_exception(error)))


def chart_data(scored: DataFrame) -> dict[str, DataFrame]:
    """Every chart's data set, by name."""
    ranked = ranking.influence_score(scored)
    return {
        "sentiment_timeline": trends.sentiment_timeline(scored),
        "signal_histogram": charts.signal_histogram(scored),
        "signal_counts": charts.signal_counts(scored),
        "sentiment_by_hour": trends.sentiment_by_hour(scored),
        "signal_vs_confidence": charts.signal_vs_confidence(scored),
        "engagement_histogram": charts.engagement_histogram(scored),
        "engagement_vs_signal": charts.engagement_vs_signal(scored),
        "engagement_by_user": charts.engagement_by_user(scored),
        "engagement_breakdown": charts.engagement_breakdown(scored),
        "term_frequency": charts.term_frequency(scored),
        "correlation_matrix": charts.correlation_matrix(scored),
        "signal_over_time": charts.signal_over_time(scored),
        "influence_by_user": charts.influence_by_user(ranked),
        "sentiment_vs_engagement": charts.sentiment_vs_engagement(scored),
    }
