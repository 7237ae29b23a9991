"""Exports are compressed by the codec asked for and read back alike."""

from pathlib import Path

from pyspark.sql import functions as F

from registry import queries
from tickerloom.sources import writers


def test_exports_are_compressed_and_read_back_alike(spark, tmp_path):
    posts = spark.range(1200, numPartitions=6).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("text "), F.col("id") % 3, F.repeat(F.lit(" words"), 50)).alias("content")
    )
    for fmt, codec in queries.EXPORT_CODECS.items():
        plain = writers.export(posts, str(tmp_path / f"{fmt}-plain"), fmt)
        small = writers.export(posts, str(tmp_path / f"{fmt}-small"), fmt, codec)
        options = writers.CSV_OPTIONS if fmt == "csv" else {}
        back = [spark.read.schema(posts.schema).options(**options).format(fmt).load(p) for p in (plain, small)]
        assert sorted(back[0].collect()) == sorted(back[1].collect()) == sorted(posts.collect())
        sizes = [sum(f.stat().st_size for f in Path(p).glob("part-*")) for p in (plain, small)]
        assert fmt == "parquet" or sizes[1] * 4 < sizes[0]
