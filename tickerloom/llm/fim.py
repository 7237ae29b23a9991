"""Fill-in-middle: a text cut into prefix, middle and suffix by one regex match with counted quantifiers.

Method: ``regexp_count`` of the unit gives the number n of units in a text; two keyed hashes give the cut
points a <= b; a pattern written for the row, ``^((?>U){a})((?>U){b-a})(.*)\\z``, captures prefix, middle and
suffix in one match. The unit U is atomic with possessive parts, so the match takes units exactly as
``regexp_count`` counts them (left to right, each as long as it can be) and never backtracks into one;
``(?>U){a}`` runs as a loop, so thousands of units need no deep stack. All of it runs in the JVM.

A unit is a word with the blanks before it, or blanks at the end: the units of a text tile it, so
prefix + middle + suffix is the text again.

Defined cases: a null text is empty; an empty text, or one that holds a sentinel, stays plain. A null
key (doc_id) gives null hashes, and the text stays plain. Very long texts are cut like short ones (whole
texts, no cap). Repeated rows get the same cut, since the key alone decides it. Columns of the input that
clash with result names are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the dealt format: sentinels, the unit, the hash key and the shares of the forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
ATOMIC_UNIT = r"(?>[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"
SEED = 42
PLAIN_SHARE_PCT = 50  #: h3 % 100 at or above this: plain
SPM_SHARE_PCT = 80  #: of the rest, h4 % 100 below this: SPM, else PSM

RESULTS = ("n", "form", "prefix", "middle", "suffix", "output", "prefix_chars", "middle_chars")


def _hash_part(digest: Column, k: int) -> Column:
    """The k-th (from 1) group of eight hex digits of a digest, as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * (k - 1) + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with its FIM form and output.

    Adds n (units), form (plain, psm or spm), prefix, middle, suffix, output, prefix_chars and middle_chars
    (code points; null when plain). Rows without a text count as empty. Nothing is shuffled.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c not in RESULTS]
    t = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col(key).cast("string")), 256)
    h1, h2, h3, h4 = (_hash_part(F.col("__digest"), k) for k in range(1, 5))
    staged = docs.select(*[F.col(f"`{c}`") for c in carry], t.alias("__text"), digest.alias("__digest")).withColumn(
        "n", F.expr(f"regexp_count(__text, '{_sql(UNIT)}')").cast("long")
    )
    cut_a = F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))
    cut_b = F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))
    sentinel = F.col("__text").contains(PREFIX) | F.col("__text").contains(SUFFIX) | F.col("__text").contains(MIDDLE)
    plain = (F.col("__text") == "") | sentinel | F.col("__digest").isNull() | (h3 % 100 >= PLAIN_SHARE_PCT)
    form = F.when(plain, "plain").when(h4 % 100 < SPM_SHARE_PCT, "spm").otherwise("psm")
    staged = staged.select("*", cut_a.alias("__a"), (cut_b - cut_a).alias("__len"), form.alias("form"))
    pattern = F.concat(
        F.lit("(?s)^(" + ATOMIC_UNIT + "{"), F.col("__a").cast("string"),
        F.lit("})(" + ATOMIC_UNIT + "{"), F.col("__len").cast("string"), F.lit(r"})(.*)\z"),
    )
    cut = staged.withColumn("__pattern", F.when(F.col("form") != "plain", pattern))
    part = {i: F.expr(f"regexp_extract(__text, __pattern, {i})") for i in (1, 2, 3)}
    is_plain = F.col("form") == "plain"
    cut = cut.select(
        "*",
        F.when(~is_plain, part[1]).alias("prefix"),
        F.when(~is_plain, part[2]).alias("middle"),
        F.when(~is_plain, part[3]).alias("suffix"),
    )
    output = (
        F.when(is_plain, F.col("__text"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle"))
        .otherwise(F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle"))
    )
    return cut.select(
        *[F.col(f"`{c}`") for c in carry], "n", "form", "prefix", "middle", "suffix", output.alias("output"),
        F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text rebuilt from an output and its form: prefix, middle and suffix in text order."""
    psm, spm = r"(?s)^<P>(.*)<S>(.*)<M>(.*)\z", r"(?s)^<S>(.*)<P>(.*)<M>(.*)\z"
    p_psm, s_psm, m_psm = (F.regexp_extract(output, psm, i) for i in (1, 2, 3))
    s_spm, p_spm, m_spm = (F.regexp_extract(output, spm, i) for i in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(p_psm, m_psm, s_psm))
        .when(form == "spm", F.concat(p_spm, m_spm, s_spm))
        .otherwise(output)
    )


def _sql(pattern: str) -> str:
    """A pattern as a Spark SQL string literal."""
    return pattern.replace("\\", "\\\\").replace("'", "\\'")
