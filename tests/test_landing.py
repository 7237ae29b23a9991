"""Feeds are landed without a second copy of the posts on disk."""

from pathlib import Path

from pyspark.sql import functions as F

from registry import queries
from tickerloom.staging import shared_dir


def feed(spark, rows=1200):
    posts = spark.range(rows, numPartitions=6).select(
        F.col("id").cast("string").alias("id"),
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
        F.concat(F.lit("text "), F.col("id") % 3, F.repeat(F.lit(" words"), 50)).alias("content"),
    )
    return posts.withColumn("timestamp", F.when(F.col("id") != "7", F.col("timestamp")))


def test_parts_are_written_straight_from_the_feed(spark):
    before = set(Path(shared_dir(spark)).iterdir())
    path, files = queries.landed_in_parts(spark, feed(spark), "straight")
    made = [p.name for p in set(Path(shared_dir(spark)).iterdir()) - before]
    assert len(made) == 1 and made[0].startswith("straight-")
    parts = [spark.read.parquet(f"{path}/part-{n}") for n in range(queries.BATCHES)]
    assert all(len(p.inputFiles()) == files for p in parts)
    assert sorted(r for p in parts for r in p.collect()) == sorted(feed(spark).collect())
    ends = [p.where("timestamp is not null").agg(F.min("timestamp"), F.max("timestamp")).first() for p in parts]
    assert ends[0][1] < ends[1][0] and ends[1][1] < ends[2][0]
