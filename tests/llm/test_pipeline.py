"""The pipeline's stages against plain versions, and on odd rows."""

from collections import Counter

import corpus_pipeline as cp
from tickerloom.llm import mixing, sentencepieces
from tickerloom.llm.queries import QUERIES

from .conftest import ODD
from .test_operators import brute_components


def test_stages_follow_from_each_other(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = [docs]
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, kept[-1], tables).cache()
        assert out.columns == cp.COLUMNS, name
        kept.append(out)
    rows = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    verdict = {r.doc_id for r in QUERIES["op10_quality_rules"](spark, tables).where("kept").collect()}
    assert set(rows[1]) == verdict and set(rows[2]) <= set(rows[1])
    classes = brute_components(sorted(rows[2].items()), 5, 80)
    assert set(rows[3]) == {c for _, c in classes.values()}
    taken = {r.doc_id: r.taken for r in mixing.mix(kept[3]).collect() if r.taken}
    assert Counter(r.doc_id for r in kept[4].collect() for _ in r.text.split()) == Counter(taken)
    last = cp.run(spark, tables).collect()
    vocabulary = sentencepieces.load_vocabulary()
    assert Counter((r.doc_id, r.text) for r in last) == Counter((r.doc_id, r.text) for r in kept[4].collect())
    assert all(sentencepieces.decode(r.ids, vocabulary.pieces) == r.text for r in last)


def test_stages_on_odd_rows_and_empty_tables(spark, documents, tables):
    for rows in (ODD, []):
        for name, stage in cp.STAGES:
            out = stage(spark, documents(rows), tables)
            assert set(cp.COLUMNS) <= set(out.columns) and out.count() <= 2 * len(rows) + 1, name
