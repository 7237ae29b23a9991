"""One callable per operator: (spark, tables) -> DataFrame.

All run on whole tables. Times leave as text and doubles rounded to six places,
so that two engines can be compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickerloom import lexicon as lx
from tickerloom import schema
from tickerloom.functions import scoring as sc
from tickerloom.functions import text as tx
from tickerloom.functions import timing as tm
from tickerloom.operators import charts, cleaning, dedup, ranking, signals, summary, trends
from tickerloom.operators import fitted, subspace
from tickerloom.operators import textfeatures as tf
from tickerloom.plans import run
from tickerloom.sources import dictionary, feed, readers, writers
from tickerloom.staging import STAGED_OPTIONS, new_path, stage
from tickerloom.streaming import posts as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Singular values that ``svd_spectrum`` shows; its SQL twin finds them by deflated power iteration.
SPECTRUM_COMPONENTS = 2
c = F.col


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(value: Column) -> Column:
    """Scaled, rounded and scaled back in doubles, as the SQL side does it."""
    return F.round(value * F.lit(1e6)) / F.lit(1e6)


def at(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def shown(df: DataFrame) -> DataFrame:
    """Doubles rounded, times as text."""
    columns = []
    for name, kind in df.dtypes:
        if kind == "double":
            columns.append(r6(c(name)).alias(name))
        elif kind == "timestamp":
            columns.append(at(c(name)).alias(name))
        else:
            columns.append(c(name))
    return df.select(*columns)


def per_post(fn: Callable[[DataFrame], dict[str, Column]]) -> Query:
    """A query that shows computed columns of every post."""

    def build(spark: SparkSession, tables: str) -> DataFrame:
        posts = feed.base_posts(spark, tables)
        return shown(posts.select("id", *[v.alias(k) for k, v in fn(posts).items()]))

    build.__name__ = fn.__name__
    return query(build)


def enriched(spark: SparkSession, tables: str) -> DataFrame:
    return cleaning.clean_and_process(feed.base_posts(spark, tables))


def scored(spark: SparkSession, tables: str, keep_text: bool = False) -> DataFrame:
    return run.scored_posts(
        feed.base_posts(spark, tables), feed.as_of(spark, tables), keep_text
    )



def cleaned(spark: SparkSession, tables: str) -> DataFrame:
    return cleaning.with_clean_text(feed.base_posts(spark, tables))


def per_text(fn: Callable[[Column], dict[str, Column]]) -> Query:
    """A query that shows functions of every cleaned text."""

    def build(spark: SparkSession, tables: str) -> DataFrame:
        posts = cleaned(spark, tables)
        columns = fn(c("content_cleaned"))
        return shown(posts.select("id", *[v.alias(k) for k, v in columns.items()]))

    build.__name__ = fn.__name__
    return query(build)


def landed(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet") -> str:
    path = new_path(spark, name)
    df.write.options(**schema.TIME_OPTIONS).format(fmt).save(path)
    return path


# --- sources and sinks -------------------------------------------------------


@query
def src_posts(spark: SparkSession, tables: str) -> DataFrame:
    path = landed(spark, feed.posts(spark, tables), "landed", "json")
    posts = readers.read_posts(spark, path, "json", ["#click", "#error", "#view"])
    return shown(posts.select(
        "id", "username", "content", "timestamp", "likes", "retweets", "replies",
        "total_engagement", "hashtag_source", "url",
        tx.joined(c("hashtags")).alias("hashtags"), tx.joined(c("mentions")).alias("mentions"),
    ))


@query
def src_normalize(spark: SparkSession, tables: str) -> DataFrame:
    records = feed.provider_records(spark, tables)
    posts = readers.normalize_records(records, feed.as_of(spark, tables))
    return shown(posts.select(
        "id", "hash", "username", "content", "timestamp", "likes", "retweets", "replies",
        "total_engagement", "hashtag_source", "url", "scraped_at", "content_length",
        "hashtag_count", "mention_count",
        tx.joined(c("hashtags")).alias("hashtags"), tx.joined(c("mentions")).alias("mentions"),
    ))


@query
def src_parquet(spark: SparkSession, tables: str) -> DataFrame:
    events = readers.load_parquet(spark, f"{tables}/events.parquet")
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users")
    )


@query
def sink_parquet(spark: SparkSession, tables: str) -> DataFrame:
    path = new_path(spark, "saved")
    writers.save_parquet(feed.base_posts(spark, tables), path)
    return shown(readers.load_parquet(spark, path).select(
        "id", "username", "content", "timestamp", "likes", "retweets", "replies",
        "hashtag_source",
    ))


@query
def narrow_types(spark: SparkSession, tables: str) -> DataFrame:
    posts = stage(feed.base_posts(spark, tables).drop("content"), "posts")
    narrow = writers.narrow_types(posts.select("id", "feed_pos", "likes", "retweets", "replies"))
    kinds = {name: kind for name, kind in narrow.dtypes}
    return narrow.select(
        "id",
        *[c(n).cast("bigint").alias(n) for n in ("feed_pos", "likes", "retweets", "replies")],
        *[F.lit(kinds[n]).alias(f"{n}_type") for n in ("likes", "retweets", "replies")],
    )


@query
def encode_categories(spark: SparkSession, tables: str) -> DataFrame:
    """Category columns of the posts as dense codes in value order, and the values decoded again; content stays text."""
    posts = feed.base_posts(spark, tables).select("id", "username", "hashtag_source", "content")
    encoded, tables_of = dictionary.encode(posts)
    decoded = dictionary.decode(encoded, tables_of)
    return encoded.select("id", *[c(f"{n}_code").cast("bigint").alias(f"{n}_code") for n in ("username", "hashtag_source")]).join(
        decoded.select("id", "username", "hashtag_source", F.lit("content_code" in encoded.columns).alias("content_encoded")), "id")


@query
def sink_json_raw(spark: SparkSession, tables: str) -> DataFrame:
    posts = cleaning.validate_posts(feed.flawed_posts(spark, tables))
    path = writers.save_json(posts, new_path(spark, "raw"))
    saved = readers.read_posts(spark, path, "json")
    return shown(saved.select("id", "username", "content", "timestamp", "likes", "scraped_at"))


@query
def sink_json_report(spark: SparkSession, tables: str) -> DataFrame:
    report = run.report_row(scored(spark, tables, keep_text=True))
    path = writers.save_report(report, new_path(spark, "report"))
    saved = spark.read.schema(report.schema).json(path)
    return shown(saved.select(
        "total_tweets",
        "overall_sentiment.mean_signal",
        "overall_sentiment.neutral_tweets",
        "trading_recommendations.hold_signals",
        F.size("top_influential_tweets").alias("top_posts"),
        c("top_influential_tweets")[0]["influence_score"].alias("best_influence"),
        F.size("hourly_trends").alias("hours"),
        c("hourly_trends")[0]["tweet_count"].alias("first_hour_posts"),
    ))


@query
def sink_text_summary(spark: SparkSession, tables: str) -> DataFrame:
    posts = scored(spark, tables)
    as_of = feed.as_of(spark, tables)
    facts = summary.merge_summaries(summary.market_summary(posts, as_of), summary.data_statistics(posts))
    path = writers.save_text(summary.summary_lines(shown(facts)), new_path(spark, "summary"))
    lines = spark.read.option("header", "true").schema("section string, key string, value string")
    saved = lines.csv(path)
    number = c("value").try_cast("double")
    return saved.select(
        "section", "key", r6(number).alias("number"), F.when(number.isNull(), c("value")).alias("text")
    )


#: Whole texts as plain json and csv take more disk than all else of a run together.
EXPORT_CODECS = {"json": "gzip", "csv": "gzip", "parquet": "zstd"}


@query
def export_formats(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.posts(spark, tables).select(
        "id", "username", "content", "likes", "hashtags", "mentions"
    )
    back = []
    for fmt in lx.EXPORT_FORMATS:
        path = writers.export(posts, new_path(spark, fmt), fmt, EXPORT_CODECS[fmt])
        if fmt == "csv":
            flat = "id string, username string, content string, likes bigint, hashtags string, mentions string"
            read = spark.read.schema(flat).options(**writers.CSV_OPTIONS).csv(path)
        else:
            read = spark.read.schema(posts.schema).format(fmt).load(path)
            read = read.withColumns({n: F.array_join(n, ",") for n in ("hashtags", "mentions")})
        back.append(read.select(
            F.lit(fmt).alias("format"), "id", "username",
            F.md5("content").alias("content_md5"), "likes",
            *[F.coalesce(n, F.lit("")).alias(n) for n in ("hashtags", "mentions")],
        ))
    return dedup.union_sources(back)


# --- projections and filters ---------------------------------------------------


@query
def validate_posts(spark: SparkSession, tables: str) -> DataFrame:
    posts = cleaning.validate_posts(feed.flawed_posts(spark, tables))
    return posts.select("id", "username", F.length("content").alias("content_length"))


@query
def filter_recent(spark: SparkSession, tables: str) -> DataFrame:
    posts = cleaning.filter_recent(feed.base_posts(spark, tables), feed.as_of(spark, tables))
    return shown(posts.select("id", "timestamp"))


@query
def recent_prefix(spark: SparkSession, tables: str) -> DataFrame:
    # Newest first: feed position is the event number counted backwards.
    posts = feed.base_posts(spark, tables).withColumn("feed_pos", -c("feed_pos"))
    recent = cleaning.recent_prefix(posts, feed.as_of(spark, tables), feed.SOURCES, hours=72)
    return shown(recent.select("id", "hashtag_source", "timestamp"))


@query
def filter_quality(spark: SparkSession, tables: str) -> DataFrame:
    return shown(enriched(spark, tables).select("id", "quality_score"))


@query
def clean_and_process(spark: SparkSession, tables: str) -> DataFrame:
    return shown(enriched(spark, tables).select(
        "id", "username", F.md5("content_cleaned").alias("cleaned_md5"), "content_length",
        "cleaned_length", "hour", "day_of_week", "total_engagement", "engagement_rate",
        "hashtag_count", "mention_count", "hashtags_str", "mentions_str", "has_market_keywords",
        "sentiment_score", "is_potential_bot", "quality_score",
    ))


@query
def filter_text_eligible(spark: SparkSession, tables: str) -> DataFrame:
    texts = cleaning.filter_text_eligible(cleaned(spark, tables))
    return texts.select("id", F.md5("feature_text").alias("text_md5"))


@query
def engagement_columns(spark: SparkSession, tables: str) -> DataFrame:
    posts = cleaning.with_lengths(cleaned(spark, tables))
    return shown(cleaning.with_engagement(posts).select("id", "total_engagement", "engagement_rate"))


@query
def length_columns(spark: SparkSession, tables: str) -> DataFrame:
    posts = cleaning.with_lengths(cleaned(spark, tables))
    return posts.select("id", "content_length", "cleaned_length")


@query
def scatter_points(spark: SparkSession, tables: str) -> DataFrame:
    posts = stage(scored(spark, tables).select(
        "id", "timestamp", "trading_signal", "primary_signal", "confidence_score",
        c("total_engagement").cast("double").alias("total_engagement"),
    ), "scatter")
    clouds = {
        "signal_vs_confidence": charts.signal_vs_confidence(posts),
        "engagement_vs_signal": charts.engagement_vs_signal(posts),
        "signal_over_time": charts.signal_over_time(posts),
        "sentiment_vs_engagement": charts.sentiment_vs_engagement(posts),
    }
    named = [shown(points).withColumn("chart", F.lit(name)) for name, points in clouds.items()]
    return dedup.union_sources(named).select(
        "chart", "id", "primary_signal", "confidence_score", "total_engagement",
        "log_engagement", "timestamp",
    )


@query
def drop_null_rows(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.flawed_posts(spark, tables)
    kept = cleaning.drop_null_rows(posts, ["content"])
    return kept.select("id", F.length("content").alias("content_length"))


@query
def fill_defaults(spark: SparkSession, tables: str) -> DataFrame:
    records = feed.provider_records(spark, tables).select("id", "favorite_count", "reply_count")
    return cleaning.fill_defaults(records, {"favorite_count": 0, "reply_count": 0, "absent": 0})


@query
def empty_guard(spark: SparkSession, tables: str) -> DataFrame:
    """Every stage over an empty feed gives an empty result."""
    nothing = feed.base_posts(spark, tables).filter(c("timestamp") < F.lit("1970-01-01"))
    posts = run.scored_posts(nothing, F.lit("2024-01-01").cast("timestamp"))
    stages = {
        "scored": posts,
        "hourly": trends.hourly_trends(posts),
        "summary": summary.market_summary(posts),
        "statistics": summary.data_statistics(posts),
        "histogram": charts.signal_histogram(posts),
    }
    counts = [
        df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"))
        for name, df in stages.items()
    ]
    return dedup.union_sources(counts)


@query
def optional_columns(spark: SparkSession, tables: str) -> DataFrame:
    """A composite from the two columns there are; weights stay as they are."""
    posts = scored(spark, tables).select("id", "total_engagement", "bullish_score", "bearish_score")
    again = signals.composite_signals(posts)
    return shown(again.select("id", "primary_signal", "confidence_score", "trading_signal"))


# --- joins ---------------------------------------------------------------------


@query
def attach_features(spark: SparkSession, tables: str) -> DataFrame:
    words = staged_words(spark, tables)
    terms = tf.fit_terms(words)
    features = tf.with_tfidf(words.filter("text_eligible"), terms).select(
        "id", tf.market_attention(c("features")).alias("market_attention")
    )
    posts = feed.base_posts(spark, tables).select("id", "username")
    return shown(tf.attach_features(posts, features))


@query
def attach_global_stats(spark: SparkSession, tables: str) -> DataFrame:
    posts = cleaning.with_engagement(cleaning.with_lengths(cleaned(spark, tables)))
    lean = stage(posts.select("id", "total_engagement", "engagement_rate"), "engagement")
    bounds = signals.column_ranges(lean, ["total_engagement", "engagement_rate"])
    return shown(lean.select(
        "id",
        (c("total_engagement") / (bounds["total_engagement_max"] + F.lit(1))).alias("share"),
        (c("engagement_rate") - bounds["engagement_rate_min"]).alias("above_lowest"),
    ))


@query
def vocab_match(spark: SparkSession, tables: str) -> DataFrame:
    words = staged_words(spark, tables)
    vocabulary = tf.build_vocabulary(tf.vocabulary_counts(words))
    return tf.match_counts(tf.vocab_match(words, vocabulary))


# --- deduplication and set operations --------------------------------------------


@query
def content_hash(spark: SparkSession, tables: str) -> DataFrame:
    return dedup.with_content_hash(feed.base_posts(spark, tables)).select("id", "hash")


@query
def dedup_by_id(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.repeated_posts(spark, tables).drop("content")
    return dedup.dedup_by_id(posts).select("id", "hashtag_source", "feed_pos", "likes")


@query
def dedup_first(spark: SparkSession, tables: str) -> DataFrame:
    posts = dedup.dedup_first(feed.repeated_posts(spark, tables), feed.SOURCES)
    return posts.select("id", "hash", "hashtag_source", "feed_pos", "likes")


@query
def merge_keep_last(spark: SparkSession, tables: str) -> DataFrame:
    existing = dedup.with_content_hash(feed.base_posts(spark, tables))
    resent = feed.repeated_posts(spark, tables).filter(c("feed_pos") >= 1000000000)
    merged = dedup.merge_keep_last(
        existing, dedup.with_content_hash(resent).drop("scraped_at")
    )
    return shown(merged.select("id", "hash", "hashtag_source", "feed_pos", "likes", "timestamp"))


@query
def union_sources(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables).select("id", "hashtag_source", "likes")
    feeds = [posts.filter(c("hashtag_source") == s) for s in feed.SOURCES]
    return dedup.union_sources(feeds)


@query
def merge_summaries(spark: SparkSession, tables: str) -> DataFrame:
    posts = scored(spark, tables)
    return shown(summary.merge_summaries(
        summary.market_summary(posts, feed.as_of(spark, tables)), summary.data_statistics(posts)
    ))


@query
def collect_posts(spark: SparkSession, tables: str) -> DataFrame:
    """All collection rules in order, on a feed with copies and flaws."""
    flawed = (c("feed_pos") >= 2000000000) & (c("retweets") % 3 == 0)
    posts = feed.repeated_posts(spark, tables).withColumn("content", F.when(~flawed, c("content")))
    posts = posts.withColumn("feed_pos", -c("feed_pos"))
    kept = run.collect_posts(posts, feed.as_of(spark, tables), feed.SOURCES)
    return shown(kept.select("id", "hash", "hashtag_source", "feed_pos", "likes", "timestamp"))


# --- aggregations -------------------------------------------------------------------


@query
def data_statistics(spark: SparkSession, tables: str) -> DataFrame:
    return shown(summary.data_statistics(enriched(spark, tables)))


@query
def market_summary(spark: SparkSession, tables: str) -> DataFrame:
    return shown(summary.market_summary(scored(spark, tables), feed.as_of(spark, tables)))


@query
def hourly_trends(spark: SparkSession, tables: str) -> DataFrame:
    return shown(trends.hourly_trends(scored(spark, tables)))


@query
def hourly_sentiment(spark: SparkSession, tables: str) -> DataFrame:
    """How did plain sentiment move per hour? The smallest end-to-end slice."""
    posts = cleaning.with_text_scores(cleaned(spark, tables))
    series = trends.resample(posts, means=["sentiment_score"], sums=["likes"])
    return shown(series)


@query
def sentiment_timeline(spark: SparkSession, tables: str) -> DataFrame:
    return shown(trends.sentiment_timeline(scored(spark, tables)))


@query
def signal_counts(spark: SparkSession, tables: str) -> DataFrame:
    return charts.signal_counts(scored(spark, tables))


@query
def sentiment_by_hour(spark: SparkSession, tables: str) -> DataFrame:
    return shown(trends.sentiment_by_hour(scored(spark, tables)))


@query
def engagement_by_user(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables)
    total = c("likes") + c("retweets") + c("replies")
    return charts.engagement_by_user(posts.select("username", total.alias("total_engagement")))


@query
def influence_by_user(spark: SparkSession, tables: str) -> DataFrame:
    return shown(charts.influence_by_user(scored(spark, tables)))


@query
def engagement_breakdown(spark: SparkSession, tables: str) -> DataFrame:
    return charts.engagement_breakdown(feed.base_posts(spark, tables))


@query
def signal_histogram(spark: SparkSession, tables: str) -> DataFrame:
    return shown(charts.signal_histogram(scored(spark, tables)))


@query
def engagement_histogram(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables)
    total = c("likes") + c("retweets") + c("replies")
    lean = stage(posts.select("id", total.alias("total_engagement")), "engagement")
    return shown(charts.engagement_histogram(lean))


@query
def term_frequency(spark: SparkSession, tables: str) -> DataFrame:
    return charts.term_frequency(cleaned(spark, tables))


@query
def correlation_matrix(spark: SparkSession, tables: str) -> DataFrame:
    return shown(charts.correlation_matrix(scored(spark, tables)))


@query
def stage_metrics(spark: SparkSession, tables: str) -> DataFrame:
    """Rows collected, processed and scored, as one run reports them."""
    result = run.run(
        feed.flawed_posts(spark, tables), feed.as_of(spark, tables), new_path(spark, "run")
    )
    posts = spark.read.parquet(result.paths["signals"])
    return posts.agg(
        F.lit(result.status).alias("status"),
        *[F.lit(result.counts[n]).cast("bigint").alias(n) for n in ("collected", "processed", "signals")],
        F.count(F.lit(1)).alias("signals_written"),
    )


# --- windows ---------------------------------------------------------------------------


@query
def signal_trend(spark: SparkSession, tables: str) -> DataFrame:
    """Five-minute buckets, many of them empty: gaps, trend and change."""
    posts = scored(spark, tables)
    series = trends.hourly_trends(posts, trends.HOUR / 12)
    return shown(series.select("bucket", "tweet_count", "primary_signal", "signal_trend"))


@query
def momentum_change(spark: SparkSession, tables: str) -> DataFrame:
    series = trends.hourly_trends(scored(spark, tables), trends.HOUR * 7)
    return shown(series.select("bucket", "tweet_count", "primary_signal", "momentum_change"))


@query
def minmax_normalize(spark: SparkSession, tables: str) -> DataFrame:
    names = ["composite_sentiment", "weighted_sentiment", "time_weighted_sentiment",
             "bullish_score", "bearish_score"]
    return shown(scored(spark, tables).select("id", *[f"{n}_normalized" for n in names]))


@query
def stratified_sample(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables).select("id", "hashtag_source", "likes")
    return ranking.stratified_sample(posts, 5000, "hashtag_source")


@query
def union_samples(spark: SparkSession, tables: str) -> DataFrame:
    """The rows of each stratum in a label-stratified sample."""
    lean = stage(scored(spark, tables).select("id", "trading_signal"), "labels")
    sample = ranking.stratified_sample(lean, 1000)
    return sample.groupBy("trading_signal").agg(
        F.count(F.lit(1)).alias("posts"), F.min("id").alias("first_id")
    )


@query
def per_source_limit(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables).drop("content")
    kept = ranking.per_source_limit(posts, len(feed.SOURCES))
    return shown(kept.select("id", "hashtag_source", "timestamp"))


@query
def rolling_sentiment(spark: SparkSession, tables: str) -> DataFrame:
    return shown(trends.rolling_sentiment(cleaning.with_text_scores(cleaned(spark, tables))))


@query
def trend_periods(spark: SparkSession, tables: str) -> DataFrame:
    return shown(trends.trend_periods(scored(spark, tables)))


# --- sorts and top-k ----------------------------------------------------------------------


@query
def sort_recent(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables).select("id", "timestamp")
    return shown(ranking.sort_recent(posts))


@query
def influence_score(spark: SparkSession, tables: str) -> DataFrame:
    posts = ranking.influence_score(scored(spark, tables))
    return shown(posts.select("id", "influence_score"))


@query
def top_influential(spark: SparkSession, tables: str) -> DataFrame:
    return shown(ranking.top_influential(scored(spark, tables, keep_text=True), lx.REPORT_TOP_POSTS))


@query
def top_k_generic(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables).groupBy("username").agg(F.sum("likes").alias("likes"))
    return ranking.top_k(posts, "likes", 10, "username")


# --- text functions -------------------------------------------------------------------------


@query
def clean_text(spark: SparkSession, tables: str) -> DataFrame:
    return cleaned(spark, tables).select("id", "content_cleaned")


@per_post
def extract_hashtags(posts: DataFrame) -> dict[str, Column]:
    return {"hashtags": F.array_join(tx.hashtags(c("content")), ",")}


@per_post
def extract_mentions(posts: DataFrame) -> dict[str, Column]:
    return {"mentions": F.array_join(tx.mentions(c("content")), ",")}


@query
def tag_strings(spark: SparkSession, tables: str) -> DataFrame:
    posts = cleaning.with_tags(feed.base_posts(spark, tables))
    return posts.select("id", "hashtags_str", "mentions_str")


@query
def list_length(spark: SparkSession, tables: str) -> DataFrame:
    posts = cleaning.with_tags(feed.base_posts(spark, tables))
    return posts.select("id", "hashtag_count", "mention_count")


@per_text
def market_relevance(text: Column) -> dict[str, Column]:
    return {"has_market_keywords": tx.has_any_term(tx.terms_held(text))}


@query
def lexicon_match(spark: SparkSession, tables: str) -> DataFrame:
    """How many posts hold each market term as a whole word."""
    terms = spark.createDataFrame([(t,) for t in lx.MARKET_TERMS], "term string")
    words = cleaned(spark, tables).select(
        F.explode_outer(F.array_distinct(tx.tokens(c("content_cleaned")))).alias("term")
    )
    matched = words.join(F.broadcast(terms), "term", "left_semi")
    return matched.groupBy("term").agg(F.count(F.lit(1)).alias("posts"))


@query
def keyword_intersection(spark: SparkSession, tables: str) -> DataFrame:
    found = cleaned(spark, tables).select("id", tx.terms_held(c("content_cleaned")).alias("both"))
    return found.select("id", F.array_join("both", ",").alias("common"), tx.has_any_term(c("both")).alias("any_common"))


@per_text
def basic_sentiment(text: Column) -> dict[str, Column]:
    return {"sentiment_score": tx.basic_sentiment(tx.tokens(text))}


@per_text
def bullish_score(text: Column) -> dict[str, Column]:
    return {"bullish_score": tx.bullish_score(text)}


@per_text
def bearish_score(text: Column) -> dict[str, Column]:
    return {"bearish_score": tx.bearish_score(text)}


@per_text
def volatility_score(text: Column) -> dict[str, Column]:
    return {"volatility_score": tx.volatility_score(text)}


@per_text
def neutral_terms(text: Column) -> dict[str, Column]:
    return {"neutral_words": tx.words_present(text, lx.NEUTRAL_WORDS)}


@per_text
def india_terms(text: Column) -> dict[str, Column]:
    return {"has_india_terms": tx.has_any_term(tx.terms_held(text, lx.INDIA_TERMS), lx.INDIA_TERMS)}


@per_post
def distinct_words(posts: DataFrame) -> dict[str, Column]:
    words = tx.raw_words(c("content"))
    return {"words": F.size(words), "distinct_words": F.size(F.array_distinct(words))}


@per_post
def bot_flag(posts: DataFrame) -> dict[str, Column]:
    total = c("likes") + c("retweets") + c("replies")
    return {"is_potential_bot": sc.bot_flag(c("username"), c("content"), total, F.length("content"))}


@query
def quality_score(spark: SparkSession, tables: str) -> DataFrame:
    posts = cleaning.enrich(feed.base_posts(spark, tables))
    return shown(posts.select("id", "is_potential_bot", "has_market_keywords", "quality_score"))


@per_post
def parse_engagement_text(posts: DataFrame) -> dict[str, Column]:
    """Counts written into a text and read back."""
    line = F.concat(
        c("content"), F.lit(" "), F.format_number(c("likes") * 1000, 0), F.lit(" Likes "),
        c("retweets").cast("string"), F.lit(" rts, "), c("replies").cast("string"),
        F.when(c("replies") > 2, " reply").otherwise(" comments"),
    )
    found = tx.engagement_counts(line)
    return {n: found[n] for n in ("likes", "retweets", "replies")}


@per_post
def post_url(posts: DataFrame) -> dict[str, Column]:
    return {"url": tx.post_url(c("username"), c("id"))}


@per_text
def tfidf_clean(text: Column) -> dict[str, Column]:
    return {"feature_text": tx.feature_text(text)}


# --- time and arithmetic ------------------------------------------------------------------


@per_post
def time_parts(posts: DataFrame) -> dict[str, Column]:
    return {"hour": tm.hour_of_day(c("timestamp")), "day_of_week": tm.weekday(c("timestamp"))}


@query
def parse_timestamp(spark: SparkSession, tables: str) -> DataFrame:
    records = feed.provider_records(spark, tables)
    return shown(records.select("id", tm.parse_iso(c("created_at")).alias("timestamp")))


@query
def age_hours(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables)
    age = tm.age_hours(c("timestamp"), feed.as_of(spark, tables))
    return shown(posts.select("id", age.alias("age_hours")))


@query
def relative_time(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables)
    unit = F.element_at(F.array(*[F.lit(u) for u in ("s", "M", "h", "d ago", "y")]), c("replies").cast("int") + 1)
    text = F.concat(c("retweets").cast("string"), unit)
    when = tm.relative_time(text, feed.as_of(spark, tables))
    return shown(posts.select("id", text.alias("text"), when.alias("time")))


@query
def time_decay(spark: SparkSession, tables: str) -> DataFrame:
    posts = feed.base_posts(spark, tables)
    decay = tm.time_decay(c("timestamp"), feed.as_of(spark, tables))
    return shown(posts.select("id", decay.alias("time_decay")))


@per_post
def market_session(posts: DataFrame) -> dict[str, Column]:
    return {"session": tm.market_session(c("timestamp"))}


@query
def strength_category(spark: SparkSession, tables: str) -> DataFrame:
    strength = r6(c("signal_strength"))
    posts = scored(spark, tables).select(sc.strength_category(strength).alias("category"))
    return posts.groupBy("category").agg(F.count(F.lit(1)).alias("posts"))


def lexicon_columns(spark: SparkSession, tables: str, *names: str) -> DataFrame:
    posts = run.lexicon_scored(feed.base_posts(spark, tables), feed.as_of(spark, tables))
    return shown(posts.select("id", *names))


@query
def composite_sentiment(spark: SparkSession, tables: str) -> DataFrame:
    return lexicon_columns(spark, tables, "composite_sentiment", "time_weighted_sentiment")


@query
def weighted_sentiment(spark: SparkSession, tables: str) -> DataFrame:
    return lexicon_columns(spark, tables, "weighted_sentiment")


@query
def primary_signal(spark: SparkSession, tables: str) -> DataFrame:
    return shown(scored(spark, tables).select("id", "primary_signal"))


@query
def signal_strength(spark: SparkSession, tables: str) -> DataFrame:
    return shown(scored(spark, tables).select("id", "signal_strength", "signal_direction"))


@query
def row_std(spark: SparkSession, tables: str) -> DataFrame:
    names = [n for n in lx.SIGNAL_WEIGHTS if n != "tfidf_momentum"]
    spread = sc.row_std([c(f"{n}_normalized") for n in names])
    return shown(scored(spark, tables).select("id", spread.alias("row_std")))


@query
def confidence_score(spark: SparkSession, tables: str) -> DataFrame:
    return shown(scored(spark, tables).select("id", "confidence_score"))


@query
def trading_signal(spark: SparkSession, tables: str) -> DataFrame:
    label = sc.trading_signal(r6(c("primary_signal")), r6(c("confidence_score")))
    return scored(spark, tables).select("id", label.alias("trading_signal"))


@per_post
def json_encode(posts: DataFrame) -> dict[str, Column]:
    return {"record": F.to_json(F.struct("id", "username", "likes", "retweets", "replies"))}


# --- text features -----------------------------------------------------------------------


def prepared_terms(spark: SparkSession, tables: str) -> DataFrame:
    return tf.with_terms(cleaned(spark, tables)).select("id", "terms", "text_eligible")


def staged_words(spark: SparkSession, tables: str) -> DataFrame:
    return stage(tf.with_words(cleaned(spark, tables)).select("id", "singles", "text_eligible"), "words")


@query
def tokenize_terms(spark: SparkSession, tables: str) -> DataFrame:
    return prepared_terms(spark, tables).select(
        "id", F.size("terms").alias("terms"), F.md5(F.array_join("terms", ",")).alias("terms_md5")
    )


@query
def build_vocabulary(spark: SparkSession, tables: str) -> DataFrame:
    return tf.build_vocabulary(tf.vocabulary_counts(staged_words(spark, tables)))


def term_vectors(spark: SparkSession, tables: str) -> tuple[DataFrame, tf.TermModel]:
    words = staged_words(spark, tables)
    model = tf.fit_terms(words)
    return tf.with_tfidf(words, model), model


@query
def tfidf_weights(spark: SparkSession, tables: str) -> DataFrame:
    vectors, model = term_vectors(spark, tables)
    weights = tf.term_weights(vectors, model)
    return shown(weights.groupBy("term").agg(
        F.count(F.lit(1)).alias("posts"),
        F.avg("weight").alias("mean_weight"),
        F.max("weight").alias("top_weight"),
    ))


@query
def market_attention(spark: SparkSession, tables: str) -> DataFrame:
    vectors, _ = term_vectors(spark, tables)
    return shown(vectors.select("id", tf.market_attention(c("features")).alias("market_attention")))


@query
def min_corpus_guard(spark: SparkSession, tables: str) -> DataFrame:
    """Texts, vocabulary size and cluster count that decide which stages run."""
    vocabulary = tf.build_vocabulary(tf.vocabulary_counts(staged_words(spark, tables)))
    texts = F.max("texts")
    return vocabulary.agg(
        texts.alias("texts"),
        F.count(F.lit(1)).alias("terms"),
        F.least(F.lit(lx.MAX_CLUSTERS).cast("bigint"), F.floor(texts / lx.TEXTS_PER_CLUSTER)).alias("clusters"),
        (texts >= lx.MIN_TEXTS).alias("enough_texts"),
    )


@query
def gram_matrix(spark: SparkSession, tables: str) -> DataFrame:
    """Inner products of all pairs of terms over the texts; zero where two never meet is left out."""
    vectors, model = term_vectors(spark, tables)
    names = F.array(*[F.lit(t) for t in model.terms])
    lines = tf.gram_lines(vectors, len(model.terms)).filter(c("line") < len(model.terms))
    cells = lines.select("line", F.posexplode("sums").alias("offset", "product")).filter("product <> 0")
    one, other = F.get(names, c("line")), F.get(names, c("line") + c("offset"))
    return cells.select(
        F.least(one, other).alias("a"), F.greatest(one, other).alias("b"), F.round("product", 3).alias("product")
    )


def components(spark: SparkSession, tables: str) -> tuple[DataFrame, tf.Projection]:
    vectors, model = term_vectors(spark, tables)
    vectors = stage(vectors.drop("singles"), "vectors")
    projection = tf.fit_projection(vectors, model)
    return tf.with_components(vectors, projection), projection


@query
def svd_project(spark: SparkSession, tables: str) -> DataFrame:
    """Singular values by component, and the spread of the projected texts."""
    projected, projection = components(spark, tables)
    values = F.array(*[F.lit(float(s)) for s in projection.singular])
    parts = projected.filter("text_eligible").select(F.posexplode("components"))
    return shown(parts.groupBy(c("pos").alias("component")).agg(
        F.count(F.lit(1)).alias("texts"),
        F.get(values, F.first("pos")).alias("singular_value"),
    ))


@query
def svd_spectrum(spark: SparkSession, tables: str) -> DataFrame:
    """The two largest singular values by matrix-free subspace iteration, and the sum of all squared values."""
    vectors, model = term_vectors(spark, tables)
    parts = stage(vectors.filter("text_eligible").select(
        tf.sparse_parts(c("features"))["indices"].alias("indices"), tf.sparse_parts(c("features"))["values"].alias("values")
    ), "sparse_rows")
    singular, _, _, _, _ = subspace.truncated_svd(parts, len(model.terms), SPECTRUM_COMPONENTS)
    energy = parts.select(F.aggregate("values", F.lit(0.0), lambda t, v: t + v * v).alias("sq")).agg(F.sum("sq")).first()[0]
    rows = [(i, float(v), float(energy or 0.0)) for i, v in enumerate(singular)]
    found = spark.createDataFrame(rows, "component int, singular_value double, energy double")
    return found.select("component", F.round("singular_value", 4).alias("singular_value"), F.round("energy", 4).alias("energy"))


@query
def standard_scale(spark: SparkSession, tables: str) -> DataFrame:
    """Mean 0 and deviation 1 in every component."""
    projected, _ = components(spark, tables)
    parts = projected.filter("text_eligible").select(F.posexplode("components"))
    stats = parts.groupBy(c("pos").alias("component")).agg(
        F.avg("col").alias("mean"), F.stddev_pop("col").alias("std")
    )
    return shown(stats)


@query
def tfidf_momentum(spark: SparkSession, tables: str) -> DataFrame:
    projected, _ = components(spark, tables)
    momentum = F.when(c("text_eligible"), c("components")[0]).otherwise(F.lit(0.0))
    return shown(projected.select("id", momentum.alias("tfidf_momentum")))


@query
def topic_cluster(spark: SparkSession, tables: str) -> DataFrame:
    posts = tf.tfidf_signals(cleaned(spark, tables).select("id", "content_cleaned"), keep=["id", "content_cleaned"])
    return posts.select("id", "topic_cluster")


@query
def topic_coverage(spark: SparkSession, tables: str) -> DataFrame:
    """Posts with and without a cluster, and in how many clusters they are."""
    clusters = topic_cluster(spark, tables)
    return clusters.groupBy((c("topic_cluster") >= 0).alias("clustered")).agg(
        F.count(F.lit(1)).alias("posts"), F.count_distinct("topic_cluster").alias("clusters")
    )


@query
def market_themes(spark: SparkSession, tables: str) -> DataFrame:
    posts = tf.tfidf_signals(cleaned(spark, tables).select("id", "content_cleaned"), keep=["id", "content_cleaned"])
    return summary.theme_counts(posts)


@query
def full_signals(spark: SparkSession, tables: str) -> DataFrame:
    """Composite signal with text features: the complete scoring run. Clusters are shown by ``topic_cluster``."""
    posts = run.scored_posts_with_topics(
        feed.base_posts(spark, tables), feed.as_of(spark, tables)
    )
    return shown(posts.select(
        "id", "tfidf_momentum", "market_attention", "primary_signal", "confidence_score", "trading_signal",
    ))


# --- streaming ------------------------------------------------------------------------------


BATCHES = 3


#: Fewest rows of a feed for each file that its parts are written in.
ROWS_PER_FILE = 100


def landed_in_parts(spark: SparkSession, posts: DataFrame, name: str, arrival: Column | None = None) -> tuple[str, int]:
    """Lands a feed as it would come in: in order of time, in one folder per part. Also the number of files, which all parts have.

    Each part is written straight from the feed, whose filter on time reaches the events before their texts are
    joined: posts are neither staged nor shuffled, and rows that the join has put side by side stay so. A part has at
    most as many files as the feed has partitions; empty ones are put in where it has fewer, so that a micro-batch is
    always one part. ``arrival`` (a time) decides the part instead of the post's own time where rows come later than
    they were made.
    """
    path, spans = new_path(spark, name), BATCHES
    when = F.unix_micros("timestamp" if arrival is None else arrival)
    times = posts.select(when.alias("at"))
    first, last, rows = (x or 0 for x in times.agg(F.min("at"), F.max("at"), F.count(F.lit(1))).first())
    files = max(1, min(times.rdd.getNumPartitions(), rows // ROWS_PER_FILE))
    part = F.least(F.floor((when - first) * spans / max(1, last - first)), F.lit(spans - 1))
    for number in range(spans):
        folder = f"{path}/part-{number}"
        posts.where(part == number).coalesce(files).write.options(**STAGED_OPTIONS).parquet(folder)
        for _ in range(files - len(spark.read.schema(posts.schema).parquet(folder).inputFiles())):
            spark.createDataFrame([], posts.schema).coalesce(1).write.mode("append").parquet(folder)
    return path, files


def source(spark: SparkSession, posts: DataFrame, name: str, arrival: Column | None = None) -> DataFrame:
    """A stream over a landed feed that takes one part per micro-batch."""
    path, files = landed_in_parts(spark, posts, f"{name}-in", arrival)
    return streaming.stream_posts(spark, f"{path}/*", columns=posts.schema, max_files=files)


def ended(running: StreamingQuery) -> None:
    running.awaitTermination()
    batches = running.lastProgress["batchId"] + 1
    if batches < BATCHES:
        raise RuntimeError(f"only {batches} micro-batches ran")


def streamed(spark: SparkSession, posts: DataFrame, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Lands a feed, runs a stream over it to its end, and reads the sink."""
    stream = build(source(spark, posts, name))
    out = new_path(spark, f"{name}-out")
    ended(streaming.start_file_sink(stream, out, new_path(spark, f"{name}-state")))
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_posts(spark: SparkSession, tables: str) -> DataFrame:
    posts = streamed(spark, feed.base_posts(spark, tables), "posts", lambda s: s)
    return shown(posts.select("id", "username", "timestamp", "likes", F.md5("content").alias("content_md5")))


@query
def stream_enrich(spark: SparkSession, tables: str) -> DataFrame:
    posts = streamed(spark, feed.base_posts(spark, tables), "enrich", streaming.stream_enrich)
    return shown(posts.select("id", "sentiment_score", "is_potential_bot", "quality_score"))


@query
def stream_dedup(spark: SparkSession, tables: str) -> DataFrame:
    posts = streamed(spark, feed.repeated_posts(spark, tables), "dedup", streaming.stream_dedup)
    return posts.select("id", "hash")


#: Originals come this long after their copies (same post time), so that near the end of a part a copy is
#: kept first and its original, with the smaller feed_pos, replaces it in the next micro-batch.
ORIGINALS_LATER = "INTERVAL 12 HOURS"


@query
def stream_dedup_state(spark: SparkSession, tables: str) -> DataFrame:
    """One post per content hash by keyed state with timers: the smallest feed_pos survives, across micro-batches."""
    posts = dedup.with_content_hash(feed.repeated_posts(spark, tables))
    arrival = F.when(c("feed_pos") < 1_000_000_000, c("timestamp") + F.expr(ORIGINALS_LATER)).otherwise(c("timestamp"))
    stream = streaming.stream_keep_smallest(source(spark, posts, "dedup-state", arrival))
    out, checkpoint = new_path(spark, "dedup-state-out"), new_path(spark, "dedup-state-state")
    ended(streaming.start_with_state_store(stream, out, checkpoint))
    emitted = spark.read.schema(stream.schema).parquet(out)
    survivors = emitted.unionByName(streaming.open_rows(spark, checkpoint))
    return survivors.select("id", "hash", "feed_pos", "likes", "hashtag_source")


@query
def stream_score_model(spark: SparkSession, tables: str) -> DataFrame:
    """A stream scored by the saved model of the full run (text features included): equal to ``full_signals`` row by row."""
    batch = stage(run.lexicon_scored(feed.base_posts(spark, tables), feed.as_of(spark, tables)).select(
        *run.LEAN_COLUMNS, "content", "content_cleaned"), "model-posts")
    path = fitted.save(spark, fitted.fit(batch), new_path(spark, "scoring-model"))
    model = fitted.load(spark, path)
    scored = streamed(spark, batch, "score-model", lambda s: fitted.apply(s, model))
    return shown(scored.select("id", "tfidf_momentum", "market_attention", "primary_signal", "confidence_score", "trading_signal"))


@query
def stream_hourly(spark: SparkSession, tables: str) -> DataFrame:
    def build(posts: DataFrame) -> DataFrame:
        texts = cleaning.with_text_scores(cleaning.with_clean_text(posts))
        total = c("likes") + c("retweets") + c("replies")
        return streaming.stream_hourly(texts.withColumn("total_engagement", total))

    stream, out = build(source(spark, feed.base_posts(spark, tables), "hourly")), new_path(spark, "hourly-out")
    ended(streaming.start_updates(stream, streaming.log_batches(out), new_path(spark, "hourly-state")))
    return shown(streaming.read_log(spark, out, ["bucket"]))


@query
def stream_merge(spark: SparkSession, tables: str) -> DataFrame:
    stream, out = source(spark, feed.repeated_posts(spark, tables), "merge"), new_path(spark, "merge-out")
    ended(streaming.start_batches(stream, streaming.merge_batches(out), new_path(spark, "merge-state")))
    return streaming.merged_posts(spark, out).select("id", "hash", "feed_pos", "likes")


def history_name() -> str:
    """A prefix for the history tables of one run, unique in the session's catalog."""
    return f"merge_history_{uuid.uuid4().hex}"


@query
def stream_merge_bucketed(spark: SparkSession, tables: str) -> DataFrame:
    """As ``stream_merge``, on a history bucketed by hash: reads dedupe bucket by bucket, compaction every few batches."""
    stream, base = source(spark, feed.repeated_posts(spark, tables), "merge-bucketed"), history_name()
    ended(streaming.start_batches(stream, streaming.bucketed_history(spark, base, every=2), new_path(spark, "merge-bucketed-state")))
    return streaming.merged_history(spark, streaming.current_history(spark, base)).select("id", "hash", "feed_pos", "likes")


@query
def stream_score(spark: SparkSession, tables: str) -> DataFrame:
    """All micro-batches scored with the ranges of the last full run, so the cuts between them don't matter."""
    batch = run.lexicon_scored(feed.base_posts(spark, tables), feed.as_of(spark, tables))
    posts = stage(batch.select(*run.LEAN_COLUMNS), "score-posts")
    used = [name for name in lx.SIGNAL_WEIGHTS if name in posts.columns]
    ranges = posts.agg(F.max("total_engagement").alias("highest"), *[f(name).alias(f"{name}_{k}") for name in used for k, f in (("low", F.min), ("high", F.max))]).first()
    bounds = {name: (ranges[f"{name}_low"], ranges[f"{name}_high"]) for name in used}
    scored_stream = streamed(spark, posts, "score", lambda s: streaming.frozen_bounds_signals(s, bounds, ranges["highest"]))
    return shown(scored_stream.select("id", "primary_signal", "confidence_score"))
