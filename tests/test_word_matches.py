"""Terms found in texts by kernels: the vocabulary's, and whole words of a list."""

import pytest
from pyspark.sql import functions as F

from registry import queries
from tickerloom import lexicon as lx
from tickerloom.functions import batches
from tickerloom.functions import text as tx
from tickerloom.operators import textfeatures as tf

TEXTS = [
    ("a", ["buy", "now", "buy", "now"]), ("a", ["now", "other", "buy"]), ("b", ["none", "here"]), ("b", []), ("c", None),
    (None, ["now"]), (None, ["buy", "now"]), ("d", ["w129", "w0", "w62", "w61", "w61"]), ("e", ["now", None, "buy"]),
]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def counted(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("table", [batches.MAX_TABLE, 0])
def test_vocabulary_terms_are_counted_per_id(spark, monkeypatch, table):
    monkeypatch.setattr(batches, "MAX_TABLE", table)
    batches._matched.cache_clear()
    words = spark.createDataFrame(TEXTS, "id string, singles array<string>")
    vocabulary = [*[f"w{i}" for i in range(130)], "buy now", "now", "buy"]
    terms = spark.createDataFrame([(t,) for t in vocabulary], "term string")
    matched = tf.vocab_match(words, terms)
    got = counted(tf.match_counts(matched, len(vocabulary)))
    assert got == [("a", 8, 3), ("d", 5, 4), ("e", 2, 2), (None, 4, 3)]
    listed = words.filter("id IS DISTINCT FROM 'e'").withColumn("terms", tf.with_pairs(F.col("singles")))
    assert counted(tf.match_counts(tf.vocab_match(listed, terms), len(vocabulary))) == [r for r in got if r[0] != "e"]
    first = matched.filter("id = 'd'").first()
    assert first.terms == ["w0", "w61", "w61", "w62", "w129"]
    assert [i for i in range(len(vocabulary)) if first.held[i // batches.MAX_INSIDE] >> i % batches.MAX_INSIDE & 1] == [0, 61, 62, 129]
    assert tf.match_counts(tf.vocab_match(words, terms.limit(0)), 0).count() == 0
    batches._matched.cache_clear()


def test_vocab_match_makes_no_row_per_term(spark, tables):
    found = plan(queries.QUERIES["vocab_match"](spark, tables))
    assert "Generate" not in found and "Join" not in found and found.count("ArrowEvalPython") == 1


def test_words_of_a_list(spark):
    texts = ["", "buy", "buybuy sell", "sell buy sell market", "market, buy.", " buy", "profit  loss ", None, "中buy nifty", "e stock é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    terms = F.array(*[F.lit(t) for t in lx.MARKET_TERMS])
    want = F.array_sort(F.array_intersect(tx.tokens(F.col("t")), terms))
    for row in df.select(tx.terms_held(F.col("t")).alias("got"), want.alias("want")).collect():
        assert row.got == row.want
    with pytest.raises(ValueError):
        batches.words_held(F.col("t"), ["two words"])


def test_texts_of_word_lists_stay_in_python(spark, tables):
    for name in ("keyword_intersection", "market_relevance", "india_terms"):
        found = plan(queries.QUERIES[name](spark, tables))
        assert "split(" not in found and found.count("ArrowEvalPython") == 1 and found.count("cleaned(") == 1


def test_a_text_is_cleaned_once_for_its_words(spark, tables):
    words = tf.with_words(queries.cleaned(spark, tables)).select("id", "singles", "text_eligible")
    assert plan(words).count("cleaned(") == 1
