"""The Arrow kernels give what the plain expressions give, on odd texts, and no text passes the JVM's pattern engine or a lambda."""

from pyspark.sql import functions as F

from registry import queries
from tickerloom import lexicon as lx
from tickerloom.functions import batches
from tickerloom.functions import text as tx
from tickerloom.operators import charts, cleaning
from tickerloom.operators import textfeatures as tf

ODD = [
    None, "", " ", "a", "##a #b#c # d @x@y é#éa-b", "  a　a  a\t\n", "@http://x.y z", "ΟΔΟΣ ΣΑΣ. Σ İX K12",
    "strong buy, strong buy", "re-crash crash's crashed (dump)", "support broken resistance holding", "up up down high",
    "stop  loss cut losses stop", "the nifty-50's up!! a1 1a _x x_y", "''a'b 'tis cat cats 12 it's", "buy buy buy buy buy buy",
]


def same(df, new, old):
    for r in df.select("t", new.alias("new"), old.alias("old")).collect():
        assert r.new == r.old, r


def texts(spark):
    return spark.createDataFrame([(t,) for t in ODD], "t string")


def cleaned_before(raw):
    text = F.regexp_replace(F.coalesce(raw, F.lit("")), lx.URL_PATTERN, "")
    text = F.regexp_replace(F.regexp_replace(text, f"@{lx.WORD}+", ""), f"#({lx.WORD}+)", "$1")
    return F.lower(F.trim(F.regexp_replace(text, f"{lx.BLANK}+", " ")))


def test_cleaning_tags_and_variety(spark):
    df, t = texts(spark), F.col("t")
    same(df, tx.clean_text(t), cleaned_before(t))
    for sign, found in (("#", tx.hashtags(t)), ("@", tx.mentions(t))):
        same(df, found, F.regexp_extract_all(t, F.lit(f"{sign}({lx.WORD}+)"), 1))
    words = F.array_remove(F.split(t, f"{lx.BLANK}+"), "")
    same(df, batches.variety(t)["words"], F.size(words))
    same(df, batches.variety(t)["different"], F.size(F.array_distinct(words)))


def test_marks(spark):
    df = cleaning.with_word_marks(texts(spark).withColumn("content_cleaned", cleaned_before(F.col("t"))))
    marks, text = F.col("word_marks"), F.col("content_cleaned")
    same(df, tx.marked_bullish(marks), tx.leaning(text, lx.BULLISH_PHRASES, lx.BULLISH_WORDS))
    same(df, tx.marked_bearish(marks), tx.leaning(text, lx.BEARISH_PHRASES, lx.BEARISH_WORDS))
    same(df, tx.marked_volatility(marks), tx.stepwise(text, lx.VOLATILITY_WORDS, lx.VOLATILITY_STEP))
    same(df, tx.marked_sentiment(marks), tx.basic_sentiment(tx.tokens(text)))
    same(df, tx.marked_relevance(marks), tx.has_any_term(tx.tokens(text)))


def test_words_and_their_counts(spark):
    df, t = texts(spark).withColumn("content_cleaned", F.col("t")), F.col("t")
    words = tf.with_words(df)
    folded = tx.feature_text(t)
    able = F.coalesce((F.length(t) >= lx.MIN_TEXT_LENGTH) & (F.size(tx.tokens(folded)) >= lx.MIN_TEXT_WORDS), F.lit(False))
    same(words, F.col("text_eligible"), able)
    same(words, F.col("singles"), F.when(able, tf.single_terms(folded)).otherwise(F.array().cast("array<string>")))
    terms = tf.terms_of(words).select(F.explode("terms").alias("term"), "t")
    want = {(r.term, r.n, r.d) for r in terms.groupBy("term").agg(F.count("*").alias("n"), F.count_distinct("t").alias("d")).collect()}
    counts = tf.term_counts(tf.with_terms(df)).filter("term <> ''")
    assert {tuple(r) for r in counts.select("term", "corpus_count", "doc_count").collect()} == want
    pairs = tf.count_entries(words.select("singles"), batches.pair_counts(None))
    assert {tuple(r) for r in pairs.select("term", "corpus_count", "doc_count").collect()} == {w for w in want if " " in w[0]}
    few = tf.count_entries(words.select("singles"), batches.pair_counts(["strong", "buy"]))
    assert {r.term for r in few.collect()} == {"strong buy", "buy strong", "buy buy"}
    cloud = {r.term: r.uses for r in charts.term_frequency(df).collect()}
    assert cloud["cat"] == 2 and cloud["a'b"] == 1 and cloud["it"] == 1 and "12" not in cloud


def test_no_text_passes_the_pattern_engine(spark, tables):
    for name in ("sentiment_timeline", "clean_text", "term_frequency", "tokenize_terms"):
        if name == "sentiment_timeline":
            df = cleaning.clean_and_process(queries.feed.base_posts(spark, tables)).select("id", "sentiment_score", "content_cleaned")
        else:
            df = queries.QUERIES[name](spark, tables)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert f"{lx.BLANK}+" not in plan and "regexp_extract_all" not in plan and "aggregate(" not in plan.split("Relation")[0].replace("Aggregate", "")
