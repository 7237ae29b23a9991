"""K-means of all restarts in shared passes: MLlib's starts and MLlib's centres."""

import warnings

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tickerloom.operators import kmeans
from tickerloom.operators import textfeatures as tf

SEEDS = [42, 43, 44]


def vectors(spark, rows=3000, size=4, parts=5):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(3, size))
    made = [(Vectors.dense(centres[i % 3] + rng.normal(size=size) * 0.7),) for i in range(rows)]
    return spark.createDataFrame(spark.sparkContext.parallelize(made, parts), ["_vector"])


def blocks_of(data):
    return kmeans.vector_blocks(data.select(vector_to_array("_vector").alias("values")), "values")


def test_random_numbers_are_the_jvms(spark):
    theirs = spark._jvm.org.apache.spark.util.random.XORShiftRandom(-77)
    mine = kmeans.XorShift([kmeans.hashed(5), kmeans.hashed(-77)])
    got = [x for count in (1, 31, 32, 33, 500) for x in mine.doubles(count)[1].tolist()]
    assert got == [theirs.nextDouble() for _ in got]
    java = spark._jvm.java.util.Random(0)
    own = kmeans.JavaRandom(0)
    assert [own.below(n) for n in range(1, 60)] == [java.nextInt(n) for n in range(1, 60)]


def test_runs_start_and_end_as_mllibs(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "BLOCK_BYTES", 1000)
    data = vectors(spark).cache()
    starts = kmeans.first_centres(spark, blocks_of(data), 4, SEEDS)
    runs = []
    for seed, start in zip(SEEDS, starts, strict=True):
        theirs = KMeans(k=4, seed=seed, maxIter=0, featuresCol="_vector").fit(data)
        assert np.allclose(start, theirs.clusterCenters(), rtol=0, atol=1e-12)
        runs.append(KMeans(k=4, seed=seed, maxIter=300, tol=1e-4, featuresCol="_vector").fit(data))
    best = min(runs, key=lambda m: m.summary.trainingCost)
    passes = []
    added_up = kmeans.added_up
    monkeypatch.setattr(kmeans, "added_up", lambda *a: passes.append(a) or added_up(*a))
    centres = tf.fit_clusters(data, 4, restarts=3, max_iterations=300, tolerance=1e-4)
    assert np.allclose(centres, best.clusterCenters(), rtol=0, atol=1e-9)
    # The steps of the longest run and three passes before them; not those of all runs.
    assert len(passes) == max(m.summary.numIter for m in runs) + 3
    shown = data.select(tf.nearest(centres)(vector_to_array("_vector")).alias("c")).collect()
    assert [r.c for r in shown] == [r.prediction for r in best.transform(data).collect()]


def test_fewer_different_vectors_than_centres(spark):
    data = spark.createDataFrame([(Vectors.dense([i % 2, 1.0]),) for i in range(50)], ["_vector"]).repartition(3)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        centres = tf.fit_clusters(data, 5, restarts=2)
    assert sorted(centres.tolist()) == [[0.0, 1.0], [1.0, 1.0]]


def test_topics_stage_only_what_is_kept(spark, monkeypatch):
    staged = {}
    stage = tf.stage
    monkeypatch.setattr(tf, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    words = ["alpha", "beta", "gamma", "delta", "rally", "crash", "nifty", "sensex"]
    posts = spark.range(60).select(
        "id", F.concat_ws(" ", *[F.get(F.array(*map(F.lit, words)), ((F.col("id") + i * i) % 8).cast("int")) for i in range(6)]).alias("content_cleaned"))
    topics = tf.tfidf_signals(posts, restarts=2, keep=["id"])
    assert topics.columns == ["id", "market_attention", "tfidf_momentum", "topic_cluster"]
    assert topics.filter("topic_cluster >= 0").count() == 60
    assert all("content_cleaned" not in df.columns for df in staged.values())
