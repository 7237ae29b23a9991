"""Arithmetic on per-post numbers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom import lexicon as lx
from tickerloom.functions import text as tx


def bot_flag(
    username: Column, content: Column, engagement: Column, length: Column, variety: Column | None = None
) -> Column:
    """Two or more of: odd name, odd length, odd engagement, repeated words.

    The word test is the costly one and runs only where it decides the result,
    unless ``variety`` (``batches.variety`` of the content) already holds what it asks.
    """
    shortest, longest = lx.BOT_LENGTH_RANGE
    odd_name = (F.length(username) > lx.BOT_NAME_LENGTH) | F.substring(username, -3, 3).rlike(
        r"\p{Nd}"
    )
    odd_length = (length < shortest) | (length > longest)
    odd_engagement = (length > 0) & (engagement / length > lx.BOT_ENGAGEMENT_RATIO)
    cheap = reduce(
        add,
        [F.coalesce(t, F.lit(False)).cast("int") for t in (odd_name, odd_length, odd_engagement)],
    )
    if variety is not None:
        repeats = (variety["words"] > lx.BOT_MIN_WORDS) & (
            variety["different"] < variety["words"] * F.lit(lx.BOT_DISTINCT_SHARE)
        )
        return _enough(cheap, repeats)
    # As the element of a list, so that the words are made once for the three places that use them.
    repeats = F.exists(F.array(tx.raw_words(content)), lambda words: (F.size(words) > lx.BOT_MIN_WORDS) & (
        F.size(F.array_distinct(words)) < F.size(words) * F.lit(lx.BOT_DISTINCT_SHARE)
    ))
    return _enough(cheap, repeats)


def _enough(cheap: Column, repeats: Column) -> Column:
    missing = lx.BOT_INDICATORS - 1
    return (
        F.when(cheap > missing, F.lit(True))
        .when(cheap == missing, F.coalesce(repeats, F.lit(False)))
        .otherwise(F.lit(False))
    )


def quality_score(
    is_bot: Column, relevant: Column, engagement: Column, length: Column, tag_count: Column
) -> Column:
    """Product of penalties and rewards, applied in a fixed order, capped at 1."""

    def factor(condition: Column, value: float, otherwise: Column | None = None) -> Column:
        rest = F.lit(1.0) if otherwise is None else otherwise
        return F.when(condition, F.lit(value)).otherwise(rest)

    factors = [
        factor(is_bot, 0.5),
        factor(relevant, 1.2),
        factor(engagement > 10, 1.1),
        factor((length < 20) | (length > 250), 0.8),
        factor(tag_count.between(1, 5), 1.1, factor(tag_count > 8, 0.7)),
    ]
    return F.least(F.lit(1.0), reduce(lambda a, b: a * b, factors, F.lit(1.0)))


def engagement_rate(engagement: Column, length: Column) -> Column:
    return engagement / (length + F.lit(1))


def composite_sentiment(bullish: Column, bearish: Column, basic: Column) -> Column:
    return (bullish - bearish + basic) / F.lit(3.0)


def weighted_sentiment(composite: Column, engagement: Column) -> Column:
    return composite * F.log1p(engagement)


def unit_range(value: Column, low: Column, high: Column) -> Column:
    """Min-max to [-1, 1]; a constant column maps to 0."""
    return F.when(high != low, F.lit(2.0) * (value - low) / (high - low) - F.lit(1.0)).otherwise(
        F.lit(0.0)
    )


def row_std(values: list[Column]) -> Column:
    """Sample deviation across the columns of one row, nulls skipped."""
    count = reduce(add, [v.isNotNull().cast("int") for v in values])
    mean = reduce(add, [F.coalesce(v, F.lit(0.0)) for v in values]) / count
    squares = reduce(add, [F.coalesce((v - mean) * (v - mean), F.lit(0.0)) for v in values])
    return F.when(count >= 2, F.sqrt(squares / (count - F.lit(1))))


def confidence(consistency_std: Column, engagement: Column, max_engagement: Column) -> Column:
    return (F.lit(1.0) - consistency_std) * F.log1p(engagement) / F.log1p(max_engagement + F.lit(1))


def trading_signal(
    primary: Column,
    confidence_score: Column,
    buy_above: float = lx.BUY_ABOVE,
    sell_below: float = lx.SELL_BELOW,
    min_confidence: float = lx.MIN_CONFIDENCE,
) -> Column:
    sure = confidence_score > min_confidence
    return (
        F.when((primary > buy_above) & sure, "BUY")
        .when((primary < sell_below) & sure, "SELL")
        .otherwise("HOLD")
    )


def strength_category(strength: Column, levels: dict[str, float] = lx.STRENGTH_LEVELS) -> Column:
    ordered = sorted(levels.items(), key=lambda kv: -kv[1])
    return F.coalesce(*[F.when(strength >= floor, name) for name, floor in ordered])
