"""Replacing a written table keeps the old one until the new one is in place."""

from tickerloom.staging import exists, new_path, put_in_place


def test_replace_moves_old_aside_then_deletes_it(spark):
    path, fresh = new_path(spark, "target"), new_path(spark, "fresh")
    spark.range(3).write.parquet(path)
    spark.range(5).write.parquet(fresh)
    put_in_place(spark, fresh, path)
    assert spark.read.parquet(path).count() == 5 and not exists(spark, fresh)
    folder = path.rsplit("/", 1)[0]
    leftovers = [p for p in spark.sparkContext._jvm.java.io.File(folder.replace("file:", "")).list() if ".replaced-" in p]
    assert leftovers == []
    again = new_path(spark, "first")
    spark.range(2).write.parquet(again)
    put_in_place(spark, again, new_path(spark, "absent"))  # nothing there yet: a plain rename
