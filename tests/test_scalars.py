"""Edge cases of the text and time functions."""

import pytest
from pyspark.sql import functions as F

from tickerloom import lexicon as lx
from tickerloom.functions import scoring as sc
from tickerloom.functions import text as tx
from tickerloom.functions import timing as tm

AS_OF = "2024-01-02 00:00:00"


def value(spark, column, **inputs):
    row = spark.createDataFrame([tuple(inputs.values())], [f"{k} string" for k in inputs] and
                                ", ".join(f"{k} string" for k in inputs))
    return row.select(column.alias("v")).first().v


@pytest.mark.parametrize("raw, cleaned", [
    (None, ""),
    ("", ""),
    ("See https://x.co/a?b=1#frag @me #Nifty50", "see frag nifty50"),
    ("  Two\n\tlines here ", "two lines here"),
    ("#निफ्टी up", "निफ्टी up"),
])
def test_clean_text(spark, raw, cleaned):
    assert value(spark, tx.clean_text(F.col("t")), t=raw) == cleaned


@pytest.mark.parametrize("fn, raw, tags", [
    (tx.hashtags, "#A #a #A", ["A", "a", "A"]),
    (tx.hashtags, "#निफ्टी", ["न"]),
    (tx.mentions, "mail a@b.c", ["b"]),
])
def test_tags(spark, fn, raw, tags):
    assert value(spark, fn(F.col("t")), t=raw) == tags


@pytest.mark.parametrize("line, counts", [
    ("1,234 likes 5 rts 1 reply", (1234, 5, 0)),
    ("1.2K likes", (0, 0, 0)),
    ("7 HEARTS 2 retweets 9 comments", (7, 2, 9)),
])
def test_engagement_counts(spark, line, counts):
    assert tuple(value(spark, tx.engagement_counts(F.col("t")), t=line)) == counts


@pytest.mark.parametrize("text, relevant", [
    ("above resistance.", False), ("the market today", True), ("", False),
])
def test_market_relevance(spark, text, relevant):
    assert value(spark, tx.has_any_term(tx.tokens(F.col("t"))), t=text) is relevant


@pytest.mark.parametrize("text, score", [("up up down", 1 / 3), ("", 0.0), ("bull", 1.0), ("sell bad", -1.0)])
def test_basic_sentiment(spark, text, score):
    assert value(spark, tx.basic_sentiment(tx.tokens(F.col("t"))), t=text) == pytest.approx(score)


@pytest.mark.parametrize("text, bullish, bearish", [
    ("support", 0.1, 0.0),
    ("moon moon", 0.5, 0.0),
    ("moonéclat", 0.1, 0.0),
    ("strong  buy", 0.3, 0.0),
    ("resistance broken, support holding", 0.5, 0.0),
    ("crash crash crash crash crash crash", 0.0, 1.0),
    ("stop loss", 0.0, 0.3),
    ("", 0.0, 0.0),
])
def test_leaning(spark, text, bullish, bearish):
    assert value(spark, tx.bullish_score(F.col("t")), t=text) == pytest.approx(bullish)
    assert value(spark, tx.bearish_score(F.col("t")), t=text) == pytest.approx(bearish)


@pytest.mark.parametrize("text, when", [
    ("2h 5m", "2024-01-01 23:55:00"),
    ("12s", "2024-01-01 23:59:48"),
    ("3D", "2023-12-30 00:00:00"),
    ("yesterday", None),
    (None, None),
])
def test_relative_time(spark, text, when):
    ts = tm.relative_time(F.col("t"), F.lit(AS_OF).cast("timestamp"))
    assert value(spark, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), t=text) == when


@pytest.mark.parametrize("time, session", [
    ("04:00", "MARKET_HOURS"), ("03:59", "PRE_MARKET"), ("10:00", "AFTER_MARKET"), ("20:00", "PRE_MARKET"),
])
def test_market_session(spark, time, session):
    ts = F.concat(F.lit("2024-01-01 "), F.col("t")).cast("timestamp")
    assert value(spark, tm.market_session(ts), t=time) == session


@pytest.mark.parametrize("name, content, engagement, flag", [
    ("plain", "a normal text of some length", 0, False),
    ("user_12", "short", 0, True),
    ("user_12", "a normal text of some length", 0, False),
    ("a_very_long_user_name", "go go go go go go go", 0, True),
    ("plain", "viral", 100, True),
])
def test_bot_flag(spark, name, content, engagement, flag):
    got = sc.bot_flag(F.col("n"), F.col("t"), F.lit(engagement), F.length("t"))
    assert value(spark, got, n=name, t=content) is flag


def test_decay_age_and_recency(spark):
    as_of, ts = F.lit(AS_OF).cast("timestamp"), F.col("t").cast("timestamp")
    assert value(spark, tm.age_hours(ts, as_of), t="2024-01-01 12:00:00") == 12.0
    assert value(spark, tm.age_hours(ts, as_of), t=None) == 0.0
    assert value(spark, tm.time_decay(ts, as_of), t="2024-01-02 12:00:00") == pytest.approx(2.718281828)
    assert value(spark, tm.is_recent(ts, as_of), t="2024-01-01 00:00:00") is True
    assert value(spark, tm.is_recent(ts, as_of), t="2023-12-31 23:59:59") is False


@pytest.mark.parametrize("numbers, std", [([1.0, 3.0, None], 2 ** 0.5), ([1.0, None, None], None)])
def test_row_std(spark, numbers, std):
    columns = [F.lit(n).cast("double") for n in numbers]
    got = value(spark, sc.row_std(columns), t="x")
    assert got == (pytest.approx(std) if std else None)


def test_labels_and_categories(spark):
    def label(primary, confidence):
        return value(spark, sc.trading_signal(F.lit(primary), F.lit(confidence)), t="x")

    assert [label(0.31, 0.6), label(-0.31, 0.6), label(0.31, 0.5), label(0.3, 0.9)] == ["BUY", "SELL", "HOLD", "HOLD"]
    named = [value(spark, sc.strength_category(F.lit(s)), t="x") for s in (0.9, 0.5, 0.29, 0.0)]
    assert named == ["VERY_STRONG", "STRONG", "WEAK", "VERY_WEAK"]
    assert sum(lx.SIGNAL_WEIGHTS.values()) == pytest.approx(1.0)
