"""Periodic runs (12): the operator against brute force, and the query against a plain version of its contract."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tickerloom.llm import runs
from tickerloom.llm.queries import periodic_runs


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(300):
        n = rng.randrange(0, 160)
        w = [rng.randrange(rng.choice([1, 2, 3, 6, 40])) for _ in range(n)]
        if n > 5 and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randrange(1, 25)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        assert runs.find_runs(runs.word_ids([str(x).encode() for x in w])) == runs.plain_runs(w)


def test_defined_cases():
    assert runs.find_runs(np.zeros(0, dtype=np.int64)) == []
    assert runs.find_runs(np.zeros(23, dtype=np.int64)) == []  # shorter than 24 words
    assert runs.find_runs(np.zeros(24, dtype=np.int64)) == [(0, 24, 1)]
    assert runs.find_runs(np.arange(5000)) == []  # no repeat: no suffix array built
    words = [b"x"] * 30
    assert runs.collapse(words, runs.find_runs(runs.word_ids(words))) == b"x"
    assert runs.find_runs(runs.word_ids([b"a", b"b"] * 3000)) == [(0, 6000, 2)]


def plain_query(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = runs.plain_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    drop = set()
    for s, length, p in found:
        drop.update(range(s + p, s + length))
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    start, length, period = best if best else (None, None, None)
    return (len(found), start, length, period, None if best is None else 1000 * length // period,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.fixture(scope="module")
def run_table(spark, tmp_path_factory):
    rng = random.Random(5)
    vocab = ["alpha", "beta", "gamma", "délta", "😀", "x"]
    rows = [(None, "no id " * 20), (1, None), (2, ""), (3, " \n "), (6, "only two"), (6, "only two")]
    for doc_id in [6, 29, 37, 40, 48, 81, 82, 88, 94, 114, 7, 8, 9, 10]:
        rows.append((doc_id, " ".join(rng.choice(vocab) for _ in range(rng.randrange(20, 400)))))
    rows.append((500, "a b " * 40 + "c " * 30 + "\tend"))
    folder = tmp_path_factory.mktemp("runs")
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS runs", "'y' AS collapsed") \
        .write.parquet(str(folder / "documents.parquet"))
    return str(folder), rows


def test_query_equals_plain_contract(spark, run_table):
    folder, rows = run_table
    got = periodic_runs(spark, folder).collect()
    assert len(got) == len(rows)
    want = sorted((r[0] is None, r[0] or 0, plain_query(*r)) for r in rows)
    have = sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r)[1:]) for r in got)
    assert have == want
    assert any(r["n_runs"] > 0 for r in got)


def test_empty_table(spark, run_table, tmp_path):
    folder, _ = run_table
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert periodic_runs(spark, str(tmp_path)).count() == 0
