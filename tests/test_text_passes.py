"""Texts are worked through once."""

from pyspark.sql import functions as F

from registry import queries
from tickerloom import lexicon as lx
from tickerloom.functions import scoring as sc
from tickerloom.functions import text as tx
from tickerloom.operators import textfeatures as tf

ODD = ["", " ", "a  b", "a \tb  c", "\n\na, b;c  -- d\n", "café naïve_1 　x", "½٣ !! ok", " .a. ", "--", "a​b", None]


def test_marks_and_blanks_fold_in_one_pass(spark):
    rows = spark.createDataFrame([(t,) for t in ODD], "t string")
    marks = F.regexp_replace("t", lx.NOT_WORD_OR_BLANK, " ")
    marks = F.lower(F.trim(F.regexp_replace(marks, f"{lx.BLANK}+", " ")))
    once = tx.feature_text(F.col("t"))
    for r in rows.select(marks.alias("two"), once.alias("one")).collect():
        assert r.one == r.two
    assert rows.select(once.alias("one"))._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 1


def test_words_of_the_bot_rule_are_split_once(spark):
    posts = spark.createDataFrame([("user_a7", "buy buy buy buy buy now", 5, 23), ("user_a7", "one two three four five six", 5, 27), ("user_a7", None, 5, None)], "u string, t string, e int, l int")
    flag = sc.bot_flag(F.col("u"), F.col("t"), F.col("e"), F.col("l"))
    flagged = posts.select(flag.alias("bot"))
    assert [r.bot for r in flagged.collect()] == [True, False, False]
    assert flagged._jdf.queryExecution().analyzed().toString().count("split(") == 1


def test_features_read_the_staged_words_alone(spark, tables):
    words = queries.staged_words(spark, tables)
    made, again = tf.terms_of(words), tf.with_terms(queries.cleaned(spark, tables)).select("id", "text_eligible", "terms")
    assert sorted(made.collect()) == sorted(again.select(*made.columns).collect())
    plan = queries.attach_features(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
