"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

1. Sizes in words are summed per source; weights repeat over the sources in code-point
   order; targets share ``total_pct`` of all words by weight and stop at ``max_epochs``
   times their source, the excess shared again (water filling, in closed form).
2. Blocks of ``block_words`` words are given to the sources by the highest quotients
   target / (2 j - 1). Only quotients near the cut are listed, about three per source
   however many blocks there are (see ``apportion``).
3. Each source's blocks are divided the same way over its shards, to which documents are dealt by a keyed hash
   and whose number follows the source's words and rows, so empty texts don't crowd one either. A hot source has many shards.
4. A shard's documents stand in a keyed order on a circle of its words; its quota of blocks is
   taken from a keyed start onwards, around the circle up to ``max_epochs`` times.

Everything hangs on md5 of the seed and ids, so reruns agree, and SQL can repeat it.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, after the others; a null
doc_id is dealt like the id ''; repeated rows are documents of their own (which of
two equal rows comes first makes no difference to the result); very long documents span blocks and can be taken in part; an empty table
gives an empty result. Columns of the input named like a result give way to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import WORD
from tickerloom.staging import stage

WEIGHTS = (3, 1, 2)
TOTAL_PCT = 150
MAX_EPOCHS = 2
BLOCK_WORDS = 64
#: Words and rows per shard, as long as a source has no more than MAX_SHARDS of them; then its shards grow.
SHARD_WORDS = 50_000
MAX_SHARDS = 200_000
SEED = "mix-1"
MADE = ("size", "source_size", "target", "taken", "shard", "starts", "lead", "drawn", "around")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def keyed(seed: str, *parts: Column) -> Column:
    """A number below 2^60 from md5 of the seed and the parts."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total_pct: int = TOTAL_PCT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to a table of one row per source (source, source_size).

    Sources are full in the order of size / weight. With the first k full, the rest share what is left at one rate per
    weight; k is the least for which the next source then stays within its limit.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    every = W.partitionBy()
    filling = W.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    limit = F.col("source_size") * F.lit(float(max_epochs))
    stepped = (
        weighed.withColumn("limit_", limit)
        .withColumn("left_", F.sum("source_size").over(every) * F.lit(total_pct / 100) - F.coalesce(F.sum("limit_").over(before), F.lit(0.0)))
        .withColumn("open_", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("free_", F.col("weight") * F.col("left_") / F.col("open_") <= F.col("limit_"))
    )
    first = F.struct(F.col("source_size") / F.col("weight"), F.col("left_").alias("left_"), F.col("open_").alias("open_"))
    rate = F.min(F.when(F.col("free_"), first)).over(every)
    return stepped.withColumn("target", F.least(F.col("weight") * rate["left_"] / rate["open_"], F.col("limit_"))).drop(
        "weight", "limit_", "left_", "open_", "free_"
    )


def apportion(votes: DataFrame, group: Sequence[str], seats: str, vote: str, name: Sequence[str]) -> DataFrame:
    """Adds ``quota``: ``seats`` seats per group by the highest quotients vote / (2 j - 1).

    With V votes and n parties, dividing by V / (seats - n) and rounding gives no more
    than ``seats`` seats, and by V / (seats + n) no fewer. So the cut lies between the
    two, and only the quotients between, at most some 3 n, are ranked. Ties go by ``name``.
    """
    whole = W.partitionBy(*group)
    total, n = F.sum(vote).over(whole), F.count(F.lit(1)).over(whole)
    at = lambda house: F.when(F.col("all_") > 0, F.floor(F.col(vote) * house / F.col("all_") + F.lit(0.5))).otherwise(0).cast("long")
    bounds = (
        votes.withColumn("all_", total.cast("double"))
        .withColumn("n_", n)
        .withColumn("low_", at(F.greatest(F.col(seats) - F.col("n_"), F.lit(0))))
        .withColumn("high_", at(F.col(seats) + F.col("n_")))
        .withColumn("open_", F.col(seats) - F.sum("low_").over(whole))
    )
    keys = [*group, *name]
    listed = bounds.select(*keys, vote, "open_", F.explode(F.when(F.col("high_") > F.col("low_"), F.sequence(F.col("low_") + 1, F.col("high_"))).otherwise(F.array())).alias("seat_"))
    highest = W.partitionBy(*group).orderBy((F.col(vote) / (2 * F.col("seat_") - 1)).desc(), *[F.col(c).asc_nulls_last() for c in name], "seat_")
    won = listed.withColumn("place_", F.row_number().over(highest)).where("place_ <= open_").groupBy(*keys).agg(F.count(F.lit(1)).alias("won_"))
    won = won.select(*[F.col(k).alias(f"won_{k}") for k in keys], "won_")
    same = [bounds[k].eqNullSafe(won[f"won_{k}"]) for k in keys]
    joined = bounds.join(won, on=same, how="left").select(*[bounds[c] for c in votes.columns], bounds["low_"], won["won_"])
    return joined.withColumn("quota", F.col("low_") + F.coalesce("won_", F.lit(0))).drop("low_", "won_")


def plan(sizes: DataFrame, weights: Sequence[int], total_pct: int, max_epochs: int, block_words: int, shard_words: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """Two small written tables: goals per source, and what is drawn per source and shard. ``sizes`` has doc_id, source and size."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    goals = targets(sums, weights, total_pct, max_epochs).withColumn("blocks", F.round(F.sum("target").over(W.partitionBy()) / block_words).cast("long"))
    goals = apportion(goals, [], "blocks", "target", ["source"])
    shards = F.least(F.lit(MAX_SHARDS), F.greatest(F.lit(1), F.ceil((F.col("source_size") + F.col("n_rows")) / shard_words))).cast("long")
    goals = stage(goals.select(F.col("source").alias("source_"), "source_size", "target", F.col("quota").alias("source_quota"), shards.alias("shards")), "mix-goals")
    around = deal(sizes, goals, seed).groupBy("source_", "shard").agg(F.sum("size").alias("around"), F.first("source_quota").alias("source_quota"))
    quotas = apportion(around, ["source_"], "source_quota", "around", ["shard"])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("around") / block_words))
    lead = F.pmod(keyed(seed + "/lead", F.col("source_"), F.col("shard")), blocks) * block_words
    quotas = quotas.select(
        F.col("source_").alias("source_q"), F.col("shard").alias("shard_q"), "around", lead.cast("long").alias("lead"),
        F.least(F.col("quota") * block_words, F.col("around") * max_epochs).alias("drawn"),
    )
    return goals, stage(quotas, "mix-quotas")


def deal(rows: DataFrame, goals: DataFrame, seed: str) -> DataFrame:
    """Adds the source's figures and the row's shard."""
    joined = rows.join(goals, rows["source"].eqNullSafe(goals["source_"]), "left")
    return joined.withColumn("shard", F.pmod(keyed(seed + "/shard", F.col("doc_id")), F.col("shards")))


def mix(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = WEIGHTS,
    total_pct: int = TOTAL_PCT,
    max_epochs: int = MAX_EPOCHS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """The carried columns of every row with size, source_size, target, taken and where its words lie on its shard's circle.

    The words taken are those of the circle of ``around`` words from ``lead`` on, ``drawn`` of
    them; the row's begin at ``starts``. Texts are read once for the sizes, and again only if carried.
    """
    sizes = stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    goals, quotas = plan(sizes, weights, total_pct, max_epochs, block_words, shard_words, seed)
    needed = {"doc_id", "source", *carry}
    slim = needed <= {"doc_id", "source"}
    extra = [c for c in docs.columns if c in needed and c.lower() not in MADE]
    rows = sizes if slim else docs.select(*[F.col(f"`{c}`") for c in extra]).withColumn("size", n_words(F.col("text")))
    dealt = deal(rows, goals, seed)
    circle = W.partitionBy("source_", "shard").orderBy(keyed(seed + "/doc", F.col("doc_id")), "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = dealt.withColumn("starts", F.sum("size").over(circle) - F.col("size"))
    joined = placed.join(quotas, placed["source_"].eqNullSafe(quotas["source_q"]) & (placed["shard"] == quotas["shard_q"]), "left")
    taken = sum((overlap(k) for k in range(max_epochs + 1)), F.lit(0)).cast("long")
    return joined.withColumn("taken", taken).select(*[F.col(f"`{c}`") for c in extra if c in carry], *MADE)


def overlap(turn: int) -> Column:
    """Words of the row that are drawn in this turn around the circle."""
    begin = F.col("starts") + turn * F.col("around")
    return F.greatest(F.lit(0), F.least(begin + F.col("size"), F.col("lead") + F.col("drawn")) - F.greatest(begin, F.col("lead")))


def drawn_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each stretch drawn of a document, with the columns of ``docs``.

    A document drawn whole keeps its text as it is; of one drawn in part the drawn words are kept, joined
    by single spaces. ``n_chars`` is the text's length.
    """
    epochs = options.get("max_epochs", MAX_EPOCHS)
    mixed = mix(docs, docs.columns, **options)
    begin = lambda k: F.greatest(F.lit(0), F.col("lead") - F.col("starts") - k * F.col("around"))
    stretches = F.array(*[F.struct(begin(k).alias("from"), overlap(k).alias("count")) for k in range(epochs + 1)])
    each = mixed.where("taken > 0").withColumn("stretch", F.explode(F.filter(stretches, lambda s: s["count"] > 0)))
    part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("stretch.from") + 1).cast("int"), F.col("stretch.count").cast("int")), " ")
    text = F.when(F.col("stretch.count") == F.col("size"), F.col("text")).otherwise(part)
    out = each.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
