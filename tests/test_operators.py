"""Operators against brute force on small fixtures, plan shapes and whole runs."""

import json
import random
import warnings
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from registry import queries
from registry.queries import QUERIES
from tickerloom import lexicon as lx
from tickerloom import staging
from tickerloom.operators import charts, cleaning, dedup, ranking, signals, summary, trends
from tickerloom.operators import textfeatures as tf
from tickerloom.plans import run
from tickerloom.sources import feed, readers, writers
from tickerloom.staging import new_path, shared_dir, stage
from tickerloom.streaming import posts as streaming


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- plans --------------------------------------------------------------------


@pytest.mark.parametrize("name", ["dedup_first", "dedup_by_id", "per_source_limit", "merge_keep_last"])
def test_groups_are_cut_before_the_shuffle(spark, tables, name):
    assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, tables))


@pytest.mark.parametrize("name", ["hourly_trends", "collect_posts", "influence_score", "term_frequency"])
def test_no_cross_joins(spark, tables, name):
    plan = plan_of(QUERIES[name](spark, tables))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_recency_and_columns_reach_the_scan(spark, tables):
    path = new_path(spark, "posts")
    feed.posts(spark, tables).write.parquet(path)
    posts = spark.read.parquet(path)
    recent = cleaning.filter_recent(posts, F.lit("2024-01-30").cast("timestamp")).select("id")
    plan = plan_of(recent)
    assert "GreaterThanOrEqual(timestamp" in plan
    assert "ReadSchema: struct<id:string,timestamp:timestamp>" in plan


def test_texts_are_cleaned_once(spark, tables):
    path = new_path(spark, "posts")
    feed.base_posts(spark, tables).write.parquet(path)
    plan = plan_of(cleaning.clean_and_process(spark.read.parquet(path)))
    assert plan.count(lx.URL_PATTERN) == 1


# --- ranking and deduplication ---------------------------------------------------


@pytest.mark.parametrize("k", [3, 1200])
def test_top_k_per_group_keeps_exactly_the_top(spark, k):
    df = spark.range(6000).selectExpr(
        "cast(id AS string) AS id", "IF(id % 3 > 0, 'hot', concat('g', id % 7)) AS g", "hash(id) AS v"
    )
    want = defaultdict(list)
    for r in df.collect():
        want[r.g].append((r.v, r.id))
    expected = {(g, i) for g, rows in want.items() for _, i in sorted(rows)[:k]}
    got = ranking.top_k_per_group(df, ["g"], [F.asc("v"), F.asc("id")], k, k)
    assert {(r.g, r.id) for r in got.collect()} == expected


def test_large_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(20000).selectExpr("cast(id AS string) AS id", "IF(id % 3 > 0, 'hot', 'cold') AS g", "hash(id) AS v")
    plan = plan_of(ranking.top_k_per_group(df, ["g"], [F.asc("v"), F.asc("id")], 5000, 5000))
    assert plan.count("WindowGroupLimit") >= 2
    lowest = plan.rindex("WindowGroupLimit"), plan.rindex("Exchange")
    assert lowest[0] > lowest[1]


def test_sample_quota(spark):
    df = spark.range(100).selectExpr("cast(id AS string) AS id", "IF(id < 5, 'BUY', 'HOLD') AS trading_signal")
    assert ranking.stratified_sample(df, 100).count() == 100
    sizes = Counter(r.trading_signal for r in ranking.stratified_sample(df, 40).collect())
    assert sizes == {"BUY": 5, "HOLD": 20}
    assert ranking.stratified_sample(df.drop("trading_signal"), 40).count() == 40


def test_dedup_is_idempotent(spark, tables):
    posts = feed.repeated_posts(spark, tables)
    once = dedup.dedup_first(posts, feed.SOURCES)
    twice = dedup.dedup_first(once, feed.SOURCES)
    assert once.count() == twice.count() == posts.select("username", "timestamp", "content").distinct().count()


def test_merge_with_itself_and_with_nothing(spark, tables):
    posts = dedup.with_content_hash(feed.base_posts(spark, tables))
    assert dedup.merge_keep_last(posts, posts).count() == posts.count()
    assert dedup.merge_keep_last(None, posts) is posts


def test_recent_prefix_loses_recent_rows_behind_an_old_one(spark):
    rows = [("a", 0, "2024-01-02 00:00:00"), ("a", 1, "2023-12-01 00:00:00"), ("a", 2, "2024-01-02 00:00:00"),
            ("b", 0, "2024-01-01 12:00:00"), ("z", 0, "2024-01-02 00:00:00")]
    posts = spark.createDataFrame(rows, "hashtag_source string, feed_pos int, t string").withColumn(
        "timestamp", F.col("t").cast("timestamp"))
    kept = cleaning.recent_prefix(posts, F.lit("2024-01-02").cast("timestamp"), ["a", "b"])
    assert {(r.hashtag_source, r.feed_pos) for r in kept.collect()} == {("a", 0), ("b", 0)}


# --- series and charts -----------------------------------------------------------


def test_gap_filling_and_trend(spark):
    start = datetime(2024, 1, 1, 5)
    rows = [("u", start + timedelta(hours=h, minutes=m), float(v), 1) for h, m, v in
            [(0, 5, 1), (0, 50, 3), (1, 0, 4), (2, 0, 6), (5, 0, 2)]]
    posts = spark.createDataFrame(rows, "username string, timestamp timestamp, primary_signal double, likes int")
    series = [r.asDict() for r in trends.hourly_trends(posts).orderBy("bucket").collect()]
    assert [r["tweet_count"] for r in series] == [2, 1, 1, 0, 0, 1]
    assert [r["likes"] for r in series] == [2, 1, 1, 0, 0, 1]
    assert [r["primary_signal"] for r in series] == [2.0, 4.0, 6.0, None, None, 2.0]
    assert [r["signal_trend"] for r in series] == [None, 4.0, None, None, None, None]
    assert [r["momentum_change"] for r in series] == [None, 2.0, 2.0, None, None, None]
    week = trends.resample(posts, timedelta(hours=7)).collect()
    assert sorted(r.bucket for r in week) == [datetime(2024, 1, 1), datetime(2024, 1, 1, 7)]


def test_histogram_matches_numpy(spark):
    values = [random.Random(7).gauss(0, 1) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "primary_signal double")
    bins = [r.posts for r in charts.signal_histogram(df).orderBy("bin").collect()]
    assert bins == np.histogram(values, bins=50)[0].tolist()
    flat = spark.createDataFrame([(2.0,), (2.0,)], "primary_signal double")
    assert [r.posts for r in charts.histogram(flat, F.col("primary_signal"), 4).orderBy("bin").collect()] == [0, 0, 2, 0]


def test_plurals_fold_into_singulars(spark):
    df = spark.createDataFrame([("cat cats glass boss s trader's 12 the",), ("cats dogs",)], "content_cleaned string")
    counts = {r.term: r.uses for r in charts.term_frequency(df).collect()}
    assert counts == {"cat": 3, "glass": 1, "boss": 1, "s": 1, "trader": 1, "dogs": 1}


def test_correlations_need_three_columns(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 1.0)], "likes int, primary_signal double")
    assert charts.correlation_matrix(df) is None
    cells = charts.correlation_matrix(df.withColumn("replies", F.lit(1))).collect()
    r = {(c.a, c.b): c.r for c in cells}
    assert len(r) == 9 and r["likes", "primary_signal"] == pytest.approx(-1.0) and r["likes", "replies"] is None


def test_missing_clusters_use_up_a_theme_slot(spark):
    clusters = [-1] * 5 + [0] * 4 + [1] * 3 + [2] * 3 + [3] * 2 + [4]
    df = spark.createDataFrame([(k,) for k in clusters], "topic_cluster int")
    assert summary.market_themes(df).first().market_themes == {"theme_0": 4, "theme_1": 3, "theme_2": 3, "theme_3": 2}


# --- text features -----------------------------------------------------------------


def test_features_match_dense_algebra(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(words, k=12)) for _ in range(60)] + ["short", "two words"]
    posts = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, content_cleaned string")
    prepared = stage(tf.with_terms(posts), "prepared")
    model = tf.fit_terms(stage(tf.with_words(posts), "words"))
    assert model.texts == 60

    def terms(text):
        w = text.split(" ")
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    docs = [Counter(terms(t)) for t in texts[:60]]
    corpus, doc_count = Counter(), Counter()
    for d in docs:
        corpus.update(d)
        doc_count.update(d.keys())
    kept = sorted((t for t in corpus if 2 <= doc_count[t] <= 48), key=lambda t: (-corpus[t], t))[:1000]
    assert model.terms == kept
    x = np.array([[d[t] * (np.log(61 / (1 + doc_count[t])) + 1) for t in kept] for d in docs])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u, s, vt = np.linalg.svd(x, full_matrices=False)

    vectors = stage(tf.with_tfidf(prepared, model), "vectors")
    projection = tf.fit_projection(vectors, model)
    assert projection.singular == pytest.approx(s[:50], abs=1e-6)
    first = x @ projection.loadings[:, 0]
    want = (first - first.mean()) / first.std()
    rows = tf.with_components(vectors, projection).filter("text_eligible").collect()
    got = {int(r.id): r.components[0] for r in rows}
    assert [got[i] for i in range(60)] == pytest.approx(want, abs=1e-6)

    featured = tf.tfidf_signals(posts, restarts=2).collect()
    clusters = Counter(r.topic_cluster for r in featured)
    assert clusters[-1] == 2 and sum(clusters.values()) == 62
    assert set(clusters) == {-1, 0, 1, 2}
    assert all(r.tfidf_momentum == 0.0 and r.market_attention == 0.0 for r in featured if r.topic_cluster == -1)


@pytest.mark.parametrize("max_terms", [5, 40, 10**4])
def test_pruned_pairs_give_the_full_vocabulary(spark, tables, max_terms):
    """Ties at the cut included: small sets of words make many."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["aa", "bb", "cc", "dd", "ee", "ff", "gg"], 6)) for _ in range(40)]
    posts = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, content_cleaned string")
    full = tf.build_vocabulary(tf.term_counts(tf.with_terms(posts)), max_terms).collect()
    pruned = tf.build_vocabulary(tf.vocabulary_counts(tf.with_words(posts), max_terms), max_terms).collect()
    assert pruned == full
    words = tf.frequent_terms(tf.term_counts(tf.with_words(posts), "singles"))
    assert (tf.pair_words(words, max_terms) is not None) == (max_terms == 5)
    assert tf.pair_words(words, max_terms, bound=1) is None


# --- sources, sinks, streams, the run -------------------------------------------------


def test_files_with_other_columns_are_merged(spark, tmp_path):
    path = str(tmp_path / "grown")
    spark.range(2).coalesce(1).write.parquet(path)
    spark.range(2, 3).withColumn("more", F.lit(1)).coalesce(1).write.mode("append").parquet(path)
    rows = readers.load_parquet(spark, path, merge_schema=True).orderBy("id").collect()
    assert [(r.id, r.more) for r in rows] == [(0, None), (1, None), (2, 1)]


def test_missing_and_empty_data_sets(spark, tmp_path):
    assert readers.load_parquet(spark, str(tmp_path / "nothing")) is None
    assert writers.save_parquet(spark.range(0), str(tmp_path / "empty")) == ""
    assert not (tmp_path / "empty").exists()
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_records_fall_back(spark):
    as_of = F.lit("2024-01-01").cast("timestamp")
    record = {"id": "9", "created_at": "soon", "text": "", "full_text": "#A @b", "user": None, "feed_pos": 0}
    rows = spark.read.schema(readers.schema.PROVIDER_RECORD).json(
        spark.createDataFrame([(json.dumps(record),)], "v string").rdd.map(lambda r: r.v))
    post = readers.normalize_records(rows, as_of).first()
    assert (post.username, post.content, post.likes, post.hashtags, post.mentions) == ("unknown", "#A @b", 0, ["A"], ["b"])
    assert post.timestamp == datetime(2024, 1, 1)


def test_stream_merge_over_two_batches(spark, tables):
    source, out, state = (new_path(spark, n) for n in ("in", "out", "state"))
    base = feed.base_posts(spark, tables).coalesce(1)
    resent = feed.repeated_posts(spark, tables).filter("feed_pos >= 2000000000").coalesce(1)
    for part in (base, resent):
        part.write.mode("append").parquet(source)
        stream = streaming.stream_posts(spark, source, columns=base.schema)
        streaming.start_batches(stream, streaming.merge_batches(out), state).awaitTermination()
    batches = sorted(int(p.name.split("=")[1]) for p in Path(out).iterdir() if p.is_dir())
    assert batches == [0, 1]
    merged = streaming.merged_posts(spark, out)
    assert merged.count() == base.count()
    assert merged.filter("feed_pos >= 2000000000").count() == resent.count()
    compacted = spark.read.parquet(streaming.compact(spark, out, new_path(spark, "compact")))
    assert compacted.count() == base.count()


def test_a_missing_batch_is_an_error(spark, tables):
    out = new_path(spark, "gap")
    step, posts = streaming.merge_batches(out), feed.base_posts(spark, tables)
    for number in range(3):
        step(posts.limit(5), number)
    staging.remove(spark, f"{out}/batch=1/_SUCCESS")
    with pytest.raises(FileNotFoundError):
        step(posts.limit(5), 2)
    with pytest.raises(FileNotFoundError):
        streaming.merged_posts(spark, out)
    with pytest.raises(FileNotFoundError):
        streaming.merge_batches(new_path(spark, "late"))(posts.limit(5), 5)


def test_staging_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())
    Context.master = "local[4]"
    assert shared_dir(Session()) == shared_dir(Session())
    before = spark.conf.get("spark.checkpoint.dir")
    with staging.staging_scope(spark):
        kept = stage(spark.range(3), "scoped").inputFiles()[0].removeprefix("file://")
        assert Path(kept).exists()
    assert not Path(kept).exists() and spark.conf.get("spark.checkpoint.dir") == before


def test_save_parquet_by_partition(spark, tmp_path):
    rows = spark.range(10).selectExpr("id", "id % 3 AS part")
    path = writers.save_parquet(rows, str(tmp_path / "parts"), partition_by=["part"])
    assert writers.save_parquet(rows.where("id < 4"), path, partition_by=["part"]) == path
    assert spark.read.parquet(path).where("part = 0").count() == 2 and len(list(tmp_path.iterdir())) == 1


def test_an_invalid_first_copy_does_not_hide_a_valid_one(spark):
    at = "timestamp '2024-01-01 09:00:00'"
    posts = spark.sql(f"""SELECT '1' AS id, 'u' AS username, CAST(NULL AS STRING) AS content, {at} AS timestamp, '#a' AS hashtag_source, 0L AS feed_pos
                          UNION ALL SELECT '1', 'u', 'valid text here', {at}, '#a', 1L""")
    kept = run.collect_posts(posts, F.lit("2024-01-01 10:00:00").cast("timestamp"), ["#a"])
    assert [r.content for r in kept.collect()] == ["valid text here"]


def test_k_means_runs_until_it_stands_still(spark):
    rng = np.random.default_rng(3)
    rows = [(Vectors.dense(rng.random(2)),) for _ in range(4000)]
    data = spark.createDataFrame(rows, ["_vector"])
    with pytest.warns(UserWarning):
        tf.fit_clusters(data, 5, restarts=1, max_iterations=2)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        tf.fit_clusters(data, 5, restarts=1)


def test_frozen_bounds_give_the_batch_signal(spark, tables):
    posts = stage(run.lexicon_scored(feed.base_posts(spark, tables), feed.as_of(spark, tables)), "scored")
    names = [n for n in lx.SIGNAL_WEIGHTS if n in posts.columns]
    ranges = posts.agg(*[f(n).alias(f"{n}_{f.__name__}") for n in names for f in (F.min, F.max)],
                       F.max("total_engagement").alias("highest")).first()
    bounds = {n: (ranges[f"{n}_min"], ranges[f"{n}_max"]) for n in names}
    frozen = streaming.frozen_bounds_signals(posts, bounds, ranges["highest"])
    batch = signals.composite_signals(posts)
    both = frozen.select("id", F.col("primary_signal").alias("a")).join(
        batch.select("id", F.col("primary_signal").alias("b")), "id")
    assert both.filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_run_writes_everything(spark, tables, tmp_path):
    result = run.run(feed.flawed_posts(spark, tables), feed.as_of(spark, tables), str(tmp_path))
    assert result.status == "completed", result.errors
    assert result.counts["collected"] == 1000
    assert result.counts["processed"] == result.counts["signals"] == spark.read.parquet(result.paths["signals"]).count()
    report = json.loads(next(Path(result.paths["report"]).glob("*.txt")).read_text())
    labels = report["trading_recommendations"]
    assert sum(labels.values()) == report["total_tweets"] == result.counts["signals"]
    assert sum(h["tweet_count"] for h in report["hourly_trends"]) == report["total_tweets"]
    assert len(report["top_influential_tweets"]) == 50
    assert sum(report["market_themes"].values()) <= report["total_tweets"]
    broken = run.run(feed.base_posts(spark, tables).filter("likes < 0"), F.current_timestamp(), str(tmp_path / "none"))
    assert broken.status == "failed" and broken.errors


def test_landed_parts_have_several_files_and_empty_feeds_run(spark):
    rows = [(str(i), f"2024-01-0{1 + i % 9 // 8} 10:00:00") for i in range(400)]
    posts = spark.createDataFrame(rows, "id string, at string").selectExpr("id", "to_timestamp(at) AS timestamp").repartition(6)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        for feed in (posts, posts.where("false")):
            path, files = queries.landed_in_parts(spark, feed, "landed")
            parts = [spark.read.schema(feed.schema).parquet(f"{path}/part-{n}") for n in range(queries.BATCHES)]
            assert all(len(p.inputFiles()) == files for p in parts)
            assert sorted(r.id for p in parts for r in p.collect()) == sorted(r.id for r in feed.collect())
            assert feed is not posts or sum(1 for p in [parts[0]] for n in p.groupBy(F.input_file_name()).count().collect()) > 1
            out = queries.streamed(spark, feed, "landed", lambda s: s)
            assert out.count() == feed.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
