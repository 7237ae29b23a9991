"""Chat formatting by prefix-target expansion, in DataFrame functions only (no Python worker).

Every assistant turn becomes its own example: all turns before it, formatted, are the context; the reply is
the only trainable span. Turns after the last assistant turn (or all turns of a conversation without one)
become one more example whose trainable span is empty, so that the examples hold every turn.

Template, per turn: ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>`` and a line feed. Control
strings inside roles and texts are escaped reversibly: an opener (``<`` or ``[``), any backslashes after it,
and a tail (``|``, ``s>``, ``/s>``, ``INST]``, ``/INST]``) get one backslash more; unescaping takes one
away. So an escaped text holds none of ``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, and the markers
of the template (and of the common chat templates) can't be forged by a text.

Layout at scale: one window per conversation ordered by turn; the context of a turn is the running
concatenation of the pieces before it. A conversation's examples together hold its turns quadratically,
which is what the expansion is; nothing is gathered beyond one conversation.

Defined cases: a null text is empty, a null role is empty. Turns are ordered by turn (nulls last), then
role, then text, so repeated rows and ties give one order. Rows with a null conversation id are one
conversation. Empty input gives no examples. Input columns named like results are left behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
REPLY_ROLE = "assistant"
OPENER, TAIL = r"[<\[]", r"\||/?s>|/?INST\]"
ESCAPE = rf"({OPENER})(\\*)({TAIL})"
UNESCAPE = rf"({OPENER})\\(\\*)({TAIL})"
TURN = r"(?s)<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPE, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, UNESCAPE, r"$1$2$3")


def expand(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per example: conv_id, example (0, 1, ... in turn order), text (the example), loss_start and
    loss_end (code points, 0-based, end excluded: the trainable span), is_tail."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    pieces = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("__turn"), r.alias("__role"), t.alias("__text"),
        (r == REPLY_ROLE).alias("is_reply"), escape(t).alias("body"), F.concat(F.lit(START), escape(r), F.lit(SEP)).alias("head"),
    ).withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("conv_id").orderBy(F.col("__turn").asc_nulls_last(), "__role", "__text")
    ranked = pieces.withColumn("k", F.row_number().over(order))
    w = Window.partitionBy("conv_id").orderBy("k")
    whole = Window.partitionBy("conv_id")
    before = F.array_join(F.collect_list("piece").over(w.rowsBetween(Window.unboundedPreceding, -1)), "")
    with_context = ranked.select(
        "*", F.coalesce(before, F.lit("")).alias("context"),
        F.max(F.when(F.col("is_reply"), F.col("k"))).over(whole).alias("last_reply"), F.max("k").over(whole).alias("n_turns"),
    )
    loss_start = F.char_length("context") + F.char_length("head")
    replies = with_context.where("is_reply").select(
        "conv_id", "k", F.concat("context", "piece").alias("text"), loss_start.alias("loss_start"),
        (loss_start + F.char_length("body")).alias("loss_end"), F.lit(False).alias("is_tail"),
    )
    last = (F.col("k") == F.col("n_turns")) & (F.col("last_reply").isNull() | (F.col("last_reply") < F.col("k")))
    tails = with_context.where(last).select(
        "conv_id", (F.col("k") + 1).alias("k"), F.concat("context", "piece").alias("text"),
        F.char_length(F.concat("context", "piece")).alias("loss_start"),
        F.char_length(F.concat("context", "piece")).alias("loss_end"), F.lit(True).alias("is_tail"),
    )
    examples = replies.unionByName(tails)
    number = Window.partitionBy("conv_id").orderBy("k")
    return examples.select(
        "conv_id", (F.row_number().over(number) - 1).alias("example"), "text",
        F.col("loss_start").cast("long").alias("loss_start"), F.col("loss_end").cast("long").alias("loss_end"), "is_tail",
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, what the examples hold: the turns (parsed from the last example, unescaped) and the
    trainable text (every example's span, unescaped, in example order)."""
    spans = examples.select(
        "conv_id", "example", "text",
        unescape(F.expr("substring(text, loss_start + 1, loss_end - loss_start)")).alias("loss_text"),
    )
    per = spans.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("last"),
        F.sort_array(F.collect_list(F.struct("example", "loss_text"))).alias("spans"),
        F.sum(F.char_length("text")).cast("long").alias("formatted_chars"),
    )
    roles = F.regexp_extract_all(F.col("last"), F.lit(TURN), 1)
    texts = F.regexp_extract_all(F.col("last"), F.lit(TURN), 2)
    lines = F.zip_with(roles, texts, lambda a, b: F.concat(unescape(a), F.lit("\n"), unescape(b), F.lit("\n")))
    loss = F.array_join(F.transform("spans", lambda s: s["loss_text"]), "")
    return per.select(
        "conv_id", F.size(roles).cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )
