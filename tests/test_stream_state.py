"""Keyed state with timers: the smallest feed_pos of a hash survives across micro-batches."""

import datetime as dt

from tickerloom.staging import new_path
from tickerloom.streaming import posts as streaming

ROWS = "id string, hash string, feed_pos long, likes long, timestamp timestamp"


def at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def test_smallest_survives_across_batches(spark):
    batches = [
        [("c1", "h1", 50, 1, at(0)), ("a", "h2", 7, 2, at(1)), ("n1", None, 9, 0, at(1))],
        # h1's original (smaller feed_pos) comes a batch later; h2's copy is larger and goes
        [("o1", "h1", 5, 3, at(0)), ("b", "h2", 8, 4, at(1)), ("t", "h3", 1, 5, at(10)), ("n2", None, 3, 0, at(2))],
        # time moves on: h1, h2 and the null key close; h3 reopens later as a new key
        [("late", "h4", 2, 6, at(60)), ("h3again", "h3", 0, 7, at(70))],
    ]
    root = new_path(spark, "state-test")
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{root}/in/part-{number}")
    stream = streaming.stream_posts(spark, f"{root}/in/*", columns=spark.createDataFrame([], ROWS).schema, max_files=1)
    kept = streaming.stream_keep_smallest(stream)
    out, checkpoint = f"{root}/out", f"{root}/state"
    running = streaming.start_with_state_store(kept, out, checkpoint)
    running.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != streaming.ROCKSDB
    emitted = {(r.hash, r.id, r.feed_pos) for r in spark.read.parquet(out).collect()}
    still_open = {(r.hash, r.id, r.feed_pos) for r in streaming.open_rows(spark, checkpoint).collect()}
    assert ("h1", "o1", 5) in emitted and ("h2", "a", 7) in emitted and (None, "n2", 3) in emitted
    assert ("h3", "t", 1) in emitted  # closed by its timer before h3 came again
    assert still_open == {("h4", "late", 2), ("h3", "h3again", 0)}
    assert not emitted & still_open


def test_rows_of_a_key_are_no_frames_and_keep_missing_values(spark):
    """A frame per key costs far more than its state; windows that are over on arrival close at once; nulls among numbers."""
    batches = [
        [("a", "k", 5, None, at(0)), ("b", "k", 4, 7, at(1)), ("m", "gone", 1, 1, at(2))],
        [("z", "w", 1, None, at(200))],
        # admitted (the last batch's watermark was lower), but the window was over before it came
        [("old", "x", 3, None, at(30)), ("p", None, None, 2, None), ("k2", "k", 9, 1, at(210))],
    ]
    root = new_path(spark, "state-rows")
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{root}/in/part-{number}")
    kept = streaming.stream_keep_smallest(streaming.stream_posts(spark, f"{root}/in/*", columns=spark.createDataFrame([], ROWS).schema, max_files=1))
    plan = kept._jdf.queryExecution().logical().toString()
    assert "TransformWithStateInPySpark" in plan and "TransformWithStateInPandas" not in plan
    streaming.start_with_state_store(kept, f"{root}/out", f"{root}/state").awaitTermination()
    emitted = {(r.hash, r.id, r.feed_pos, r.likes, r.timestamp) for r in spark.read.parquet(f"{root}/out").collect()}
    still_open = {(r.hash, r.id, r.feed_pos, r.likes, r.timestamp) for r in streaming.open_rows(spark, f"{root}/state").collect()}
    assert emitted == {("k", "b", 4, 7, at(1)), ("gone", "m", 1, 1, at(2)), ("x", "old", 3, None, at(30))}
    assert still_open == {("w", "z", 1, None, at(200)), ("k", "k2", 9, 1, at(210)), (None, "p", None, 2, None)}
