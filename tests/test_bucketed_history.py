"""Hash-bucketed merge history: last row per hash, compaction, reruns, and reads without an exchange of history."""

import datetime as dt
import uuid

from tickerloom.streaming import posts as streaming

ROWS = "id string, username string, content string, timestamp timestamp, feed_pos long, likes long"


def test_history_merges_compacts_and_reads_by_bucket(spark):
    base = f"history_test_{uuid.uuid4().hex}"
    step = streaming.bucketed_history(spark, base, buckets=4, every=2)
    at = dt.datetime(2024, 1, 1)
    batches = [
        [("a", "u1", "same text", at, 1, 10), ("b", "u2", "other", at, 2, 20)],
        [("a2", "u1", "same text", at, 5, 11)],  # a later copy of a's post replaces it
        [("c", "u3", "third", at, 3, 30)],
        [("c", "u3", "third", at, 3, 30)],  # the same batch's rows again, as after a retry
        [("b2", "u2", "other", at, 9, 21)],
    ]
    for number, rows in enumerate(batches):
        step(spark.createDataFrame(rows, ROWS), number)
    name = streaming.current_history(spark, base)
    assert name == f"{base}_g2"  # compacted after batches 1 and 3
    merged = streaming.merged_history(spark, name)
    got = sorted((r.id, r.feed_pos, r.likes) for r in merged.collect())
    assert got == [("a2", 5, 11), ("b2", 9, 21), ("c", 3, 30)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
