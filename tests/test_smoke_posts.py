"""The thirteen posts, against values worked out by hand from the rules."""

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import cleaning, ranking, signals, summary, trends
from tickerloom.operators import textfeatures as tf

EXPECTED = {
    "delta_hedger": (111, 109, 39, 2, 0.2, 0.8, 0.0, 0.333333, 1.229626, 0.75, 0.100601, "HOLD"),
    "ridge_shorts": (96, 94, 38, 2, -0.125, 0.0, 0.3, -0.141667, -0.519005, -0.75, 0.09991, "HOLD"),
    "quiet_quant": (97, 95, 46, 2, 0.0, 0.2, 0.0, 0.066667, 0.256677, -0.164607, 0.608683, "HOLD"),
}
ALIKE = {
    0: (0, 0.0, "HOLD"), 1: (3, 0.241295, "HOLD"), 2: (7, 0.361943, "HOLD"), 3: (10, 0.417372, "HOLD"),
    4: (14, 0.471357, "HOLD"), 5: (17, 0.503091, "SELL"), 6: (21, 0.538019, "SELL"),
    7: (24, 0.56027, "SELL"), 8: (28, 0.586103, "SELL"), 9: (31, 0.603238, "SELL"),
}


@pytest.fixture(scope="module")
def scored(smoke_posts):
    as_of = F.lit("2024-01-01 10:00:00").cast("timestamp")
    processed = signals.lexicon_signals(cleaning.clean_and_process(smoke_posts), as_of)
    return signals.composite_signals(processed)


def test_written_posts(scored):
    rows = {r.username: r for r in scored.collect()}
    assert len(rows) == 13
    for name, want in EXPECTED.items():
        r = rows[name]
        got = (r.content_length, r.cleaned_length, r.total_engagement, r.hashtag_count, r.sentiment_score,
               r.bullish_score, r.bearish_score, r.composite_sentiment, r.weighted_sentiment,
               r.primary_signal, r.confidence_score)
        assert got == pytest.approx(want[:-1], abs=1e-6)
        assert r.trading_signal == want[-1]
    for i, (engagement, confidence, label) in ALIKE.items():
        r = rows[f"user_{i}"]
        assert (r.content_length, r.cleaned_length, r.total_engagement) == (65, 64, engagement)
        assert r.primary_signal == pytest.approx(-0.403351, abs=1e-6)
        assert r.confidence_score == pytest.approx(confidence, abs=1e-6)
        assert r.trading_signal == label
    assert all(r.quality_score == 1.0 and r.has_market_keywords and not r.is_potential_bot for r in rows.values())
    assert all(r.volatility_score == 0.0 for r in rows.values())


def test_summary_counts_add_up(scored):
    s = summary.market_summary(scored).first()
    assert s.buy_signals + s.sell_signals + s.hold_signals == 13
    assert s.bullish_tweets + s.bearish_tweets + s.neutral_signal_tweets == 13
    assert (s.buy_signals, s.sell_signals) == (0, 5)
    facts = summary.merge_summaries(summary.market_summary(scored), summary.data_statistics(scored))
    nested = summary.nested_summary(facts).first()
    assert nested.date_range.start == "2024-01-01T10:00:00.000000+00:00"
    assert nested.overall_sentiment.neutral_tweets == s.neutral_signal_tweets
    assert nested.sentiment.positive_tweets == 1


def test_normalized_columns_span_the_range(scored):
    for name in ("composite_sentiment", "weighted_sentiment", "bullish_score", "bearish_score"):
        low, high = scored.agg(F.min(f"{name}_normalized"), F.max(f"{name}_normalized")).first()
        assert (low, high) == (-1.0, 1.0)


def test_constant_column_normalizes_to_zero(scored):
    flat = signals.minmax_normalize(scored, ["volatility_score"])
    assert {r[0] for r in flat.select("volatility_score_normalized").collect()} == {0.0}


def test_single_bucket_has_no_trend(scored):
    rows = trends.hourly_trends(scored).collect()
    assert len(rows) == 1
    assert rows[0].tweet_count == 13 and rows[0].signal_trend is None and rows[0].momentum_change is None


def test_top_posts(scored):
    top = ranking.top_influential(scored, 3).collect()
    assert len(top) == 3 and top[0].username == "quiet_quant"
    assert [r.influence_score for r in top] == sorted((r.influence_score for r in top), reverse=True)


def test_small_corpus_gives_no_clusters(scored):
    base = scored.select("id", "content_cleaned")
    featured = tf.tfidf_signals(base)
    assert "topic_cluster" not in featured.columns
    lengths = [round(r.market_attention, 9) for r in featured.collect()]
    # The three written posts share no term with another, so none of their terms is in the vocabulary.
    assert sorted(lengths) == [0.0] * 3 + [1.0] * 10
    assert tf.tfidf_signals(base.limit(5)).columns == base.columns
