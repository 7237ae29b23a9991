"""Lexicon signals, normalisation, composite signal and label."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom import lexicon as lx
from tickerloom.functions import scoring as sc
from tickerloom.functions import text as tx
from tickerloom.functions import timing as tm
from tickerloom.operators.cleaning import WORD_MARKS, with_word_marks


def lexicon_signals(posts: DataFrame, as_of: Column) -> DataFrame:
    """Bullish, bearish and volatility scores and what follows from them.

    Marks that an earlier step has found are used up here.
    """
    c = F.col
    scored = with_word_marks(posts).withColumns({
        "bullish_score": tx.marked_bullish(c(WORD_MARKS)),
        "bearish_score": tx.marked_bearish(c(WORD_MARKS)),
        "volatility_score": tx.marked_volatility(c(WORD_MARKS)),
        "time_decay": tm.time_decay(c("timestamp"), as_of),
    }).drop(WORD_MARKS)
    combined = scored.withColumn(
        "composite_sentiment",
        sc.composite_sentiment(c("bullish_score"), c("bearish_score"), c("sentiment_score")),
    )
    return combined.withColumns({
        "weighted_sentiment": sc.weighted_sentiment(
            c("composite_sentiment"), c("total_engagement")
        ),
        "time_weighted_sentiment": c("composite_sentiment") * c("time_decay"),
    })


def column_ranges(df: DataFrame, columns: list[str]) -> Column:
    """Min and max of every column as one struct, from one scalar subquery.

    A subquery is a one-row aggregate: partial results per partition, no join,
    and no window over all rows.
    """
    bounds = [F.min(c).alias(f"{c}_min") for c in columns]
    bounds += [F.max(c).alias(f"{c}_max") for c in columns]
    return df.agg(F.struct(*bounds).alias("bounds")).scalar()


def minmax_normalize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``<column>_normalized``, the column mapped to [-1, 1] by its range."""
    if not columns:
        return df
    bounds = column_ranges(df, columns)
    return df.withColumns({
        f"{c}_normalized": sc.unit_range(F.col(c), bounds[f"{c}_min"], bounds[f"{c}_max"])
        for c in columns
    })


def composite_signals(
    posts: DataFrame,
    weights: dict[str, float] = lx.SIGNAL_WEIGHTS,
    buy_above: float = lx.BUY_ABOVE,
    sell_below: float = lx.SELL_BELOW,
    min_confidence: float = lx.MIN_CONFIDENCE,
) -> DataFrame:
    """Primary signal, strength, direction, confidence and BUY/SELL/HOLD.

    Columns that are absent are skipped and the other weights stay as they are.
    The input is read twice (ranges, then rows): pass a staged table.
    """
    present = [c for c in weights if c in posts.columns]
    if not present:
        return posts
    ranged = minmax_normalize(posts, present)
    highest = posts.agg(F.max("total_engagement").alias("highest")).scalar()
    normalized = [F.col(f"{c}_normalized") for c in present]
    weighted = [F.lit(weights[c]) * F.col(f"{c}_normalized") for c in present]
    primary = ranged.withColumns({
        "primary_signal": reduce(add, weighted, F.lit(0.0)),
        "confidence_score": sc.confidence(
            sc.row_std(normalized), F.col("total_engagement"), highest
        ),
    })
    return primary.withColumns({
        "signal_strength": F.abs("primary_signal"),
        "signal_direction": F.signum("primary_signal"),
        "trading_signal": sc.trading_signal(
            F.col("primary_signal"),
            F.col("confidence_score"),
            buy_above,
            sell_below,
            min_confidence,
        ),
    })
