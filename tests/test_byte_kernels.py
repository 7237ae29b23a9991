"""Kernels that look at the bytes of texts, and sparse vectors made from single words."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.functions import batches
from tickerloom.operators import textfeatures as tf


def test_vectors_need_no_list_of_pairs(spark):
    texts = [["buy", "now", "buy", "now"], ["now", "buy"], ["other", "buy"], [], ["other"], ["buy", "other", "now"]]
    words = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, singles array<string>")
    model = tf.TermModel(["now buy", "now", "buy", "buy now"], [2.0, 1.5, 1.0, 3.0], len(texts))
    rows = {r.id: r.features for r in tf.with_tfidf(words, model).collect()}
    listed = {r.id: r.features for r in tf.with_tfidf(tf.terms_of(words), model).collect()}
    for i, text in enumerate(texts):
        found = Counter(text) + Counter(f"{a} {b}" for a, b in zip(text, text[1:]))
        want = np.array([found[t] * w for t, w in zip(model.terms, model.idf)])
        want = want / (np.linalg.norm(want) or 1.0)
        assert rows[i].toArray() == pytest.approx(want) and listed[i] == rows[i]


def test_marks_at_the_ends_of_neighbouring_texts(spark):
    texts = ["strong", "buy", "astrong buy", "strong buy", "strong buyé", "中strong buy", "strong buy.", "(strong buy", "", "up upper", "up"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    marks = batches.marks(F.col("t"), [["up", "buy"]], ["upper", "up"], [["strong buy"], ["strong"]])
    got = [(r.m.words, r.m.count0, r.m.phrases0, r.m.phrases1, r.m.inside) for r in rows.select(marks.alias("m")).collect()]
    assert got == [
        (1, 0, 0, 1, 0), (1, 1, 0, 0, 0), (2, 1, 0, 0, 0), (2, 1, 1, 1, 0), (2, 0, 0, 1, 0), (2, 1, 0, 0, 0),
        (2, 0, 1, 1, 0), (2, 1, 1, 0 + 1, 0), (0, 0, 0, 0, 0), (2, 1, 0, 0, 3), (1, 1, 0, 0, 2),
    ]
    with pytest.raises(ValueError):
        batches.marks(F.col("t"), [["a"]], [], [])


def test_long_and_short_words_are_told_apart(spark):
    texts = ["abcdefg abcdefgh abcdefgi abcdefgh", "a\x00 a a\x00", "é　é　e", None, " \n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r.v and tuple(r.v) for r in rows.select(batches.variety(F.col("t")).alias("v")).collect()]
    assert got == [(4, 3), (3, 2), (3, 2), None, (0, 0)]
