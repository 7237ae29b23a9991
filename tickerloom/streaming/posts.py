"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickerloom import lexicon as lx
from tickerloom import schema
from tickerloom.functions import scoring as sc
from tickerloom.operators import cleaning, dedup
from tickerloom.staging import STAGED_OPTIONS, exists

LATENESS = f"{lx.RECENCY_HOURS} hours"


def stream_posts(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    columns: T.StructType = schema.POST,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Posts as they land in a folder; a micro-batch takes no more than the given files or bytes."""
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    reader = spark.readStream.schema(columns).format(fmt)
    return reader.options(**{k: v for k, v in limits.items() if v is not None}).load(path)


def stream_enrich(posts: DataFrame) -> DataFrame:
    """The batch enrichment as it is: it keeps no state."""
    return cleaning.clean_and_process(posts)


def stream_dedup(posts: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One row per content hash; a hash is remembered until the watermark passes."""
    hashed = dedup.with_content_hash(posts)
    return hashed.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["hash"])


#: The state store that keyed state with timers needs; asked for when such a query starts, not kept in the session.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_VARIABLE = "best"


class KeepSmallest(StatefulProcessor):
    """Per key, the row with the smallest ``order`` (ties: smallest ``tie``) among the rows of one window.

    The first row of a key opens a window that ends at its time plus the lateness, and sets an event-time
    timer there. Rows of the window that come later, in any micro-batch, replace the kept one only if they
    are smaller. The kept row is emitted when the timer fires (the watermark passes the end), or at once when
    a row at or past the end comes first; that row opens the next window. A row without a time belongs to the
    open window.
    """

    def __init__(self, columns: T.StructType, order: str, tie: str, time: str, lateness_ms: int):
        self.columns, self.order, self.tie, self.time, self.lateness_ms = columns, order, tie, time, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState(STATE_VARIABLE, self.columns)
        self.end = handle.getValueState("window_end", "end long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Rows as they are, not frames: a key has few rows, for which a frame's operations would cost far more than the state calls.
        names = self.columns.names
        order, tie, time = (names.index(n) for n in (self.order, self.tie, self.time))
        waiting = list(rows)
        if not waiting:
            return
        kept = before = self._kept()
        end = old_end = self.end.get()[0] if kept is not None else None
        while waiting:
            if kept is None:
                times = [_ms(r[time]) for r in waiting if r[time] is not None]
                end = (min(times) if times else timerValues.getCurrentWatermarkInMs()) + self.lateness_ms
            past = [r for r in waiting if r[time] is not None and _ms(r[time]) >= end]
            inside = [r for r in waiting if r[time] is None or _ms(r[time]) < end]
            if inside:
                head = min(inside, key=lambda r: _rank(r[order], r[tie]))
                if kept is None or _rank(head[order], head[tie]) < _rank(kept[order], kept[tie]):
                    kept = tuple(head)
            waiting = past
            if waiting:
                yield Row(**dict(zip(names, kept, strict=True)))
                kept = None
        if end != old_end:
            if old_end is not None:
                self.handle.deleteTimer(old_end)
            self.end.update((end,))
            self.handle.registerTimer(end)
        if kept is not before:
            self.best.update(kept)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = self._kept()
        if kept is not None:
            self.best.clear()
            self.end.clear()
            yield Row(**dict(zip(self.columns.names, kept, strict=True)))

    def _kept(self) -> tuple | None:
        """The kept row. Times come from the state without a zone, in the machine's; rows have them in UTC."""
        if not self.best.exists():
            return None
        zoned = (isinstance(f.dataType, T.TimestampType) for f in self.columns)
        return tuple(v.astimezone(UTC) if z and v is not None else v for v, z in zip(self.best.get(), zoned, strict=True))

    def close(self) -> None:
        pass


def _ms(time: datetime) -> int:
    """Milliseconds since 1970."""
    return T.TimestampType().toInternal(time) // 1000


def _rank(order, tie) -> tuple:
    """Smaller first, missing values last."""
    return (order is None, 0 if order is None else order, tie is None, "" if tie is None else str(tie))


def stream_keep_smallest(
    posts: DataFrame, key: str = "hash", order: str = "feed_pos", tie: str = "id", time: str = "timestamp",
    lateness_hours: int = lx.RECENCY_HOURS,
) -> DataFrame:
    """One row per key and window: the smallest ``order`` among the rows of the key within the lateness of
    the window's first one, emitted when the watermark passes its end. Windows still open when a finite feed
    ends stay in the state store; ``open_rows`` reads them from the checkpoint. Rows without a key form one key."""
    columns = posts.schema
    processor = KeepSmallest(columns, order, tie, time, lateness_hours * 3_600_000)
    return posts.withWatermark(time, f"{lateness_hours} hours").groupBy(key).transformWithState(
        processor, columns, "Append", "EventTime"
    )


def start_with_state_store(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A parquet sink for a stream with keyed state, run to the end of what is there, on RocksDB state."""
    conf = stream.sparkSession.conf
    before = conf.get("spark.sql.streaming.stateStore.providerClass", None)
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        return start_file_sink(stream, path, checkpoint)
    finally:
        if before is None:
            conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            conf.set("spark.sql.streaming.stateStore.providerClass", before)


def open_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The kept rows of keys that are still open in a stream's state, read from its checkpoint."""
    state = spark.read.format("statestore").option("stateVarName", STATE_VARIABLE).load(checkpoint)
    return state.select("value.*")


def stream_hourly(
    posts: DataFrame, value: str = "sentiment_score", lateness: str = LATENESS
) -> DataFrame:
    """Hours with mean and totals. No empty hours and no trend columns.

    In update mode (``log_batches``, then ``read_log`` by bucket) the hours still open are there as
    well; in append mode an hour is written once the watermark has passed it.
    """
    hourly = posts.withWatermark("timestamp", lateness).groupBy(
        F.window("timestamp", "1 hour").alias("_window")
    )
    sums = [F.sum(c).alias(c) for c in ("total_engagement", "likes", "retweets", "replies")]
    totals = hourly.agg(
        F.avg(value).alias(f"mean_{value}"), *sums, F.count("username").alias("tweet_count")
    )
    return totals.select(F.col("_window.start").alias("bucket"), *totals.columns[1:])


def frozen_bounds_signals(
    posts: DataFrame,
    bounds: dict[str, tuple[float, float]],
    max_engagement: int,
    weights: dict[str, float] = lx.SIGNAL_WEIGHTS,
) -> DataFrame:
    """Composite signal of a stream, with the ranges of the last full run."""
    used = [c for c in weights if c in posts.columns and c in bounds]
    scaled = posts.withColumns({
        f"{c}_normalized": sc.unit_range(F.col(c), *(F.lit(float(b)) for b in bounds[c]))
        for c in used
    })
    normalized = [F.col(f"{c}_normalized") for c in used]
    primary: Column = F.lit(0.0)
    for c in used:
        primary = primary + F.lit(weights[c]) * F.col(f"{c}_normalized")
    scored = scaled.withColumns({
        "primary_signal": primary,
        "confidence_score": sc.confidence(
            sc.row_std(normalized), F.col("total_engagement"), F.lit(max_engagement)
        ),
    })
    return scored.withColumn(
        "trading_signal", sc.trading_signal(F.col("primary_signal"), F.col("confidence_score"))
    )


def start_file_sink(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs over what has landed so far and appends it to a Parquet folder."""
    return (
        stream.writeStream.format("parquet")
        .options(**STAGED_OPTIONS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_batches(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hands every micro-batch to ``step``."""
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_updates(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """As ``start_batches``, for aggregates: every micro-batch holds the groups it changed."""
    return (
        stream.writeStream.outputMode("update").foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def log_batches(path: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """Step that writes each batch to a folder of its own and leaves earlier ones alone.

    A batch that is run again after a failure replaces its own folder. A batch whose predecessor
    is missing or unfinished is refused: its rows would be lost without notice.
    """

    def step(batch: DataFrame, number: int) -> None:
        if number and not exists(batch.sparkSession, f"{path}/batch={number - 1}/_SUCCESS"):
            raise FileNotFoundError(f"batch {number - 1} is missing or unfinished in {path}")
        prepare(batch).write.mode("overwrite").options(**STAGED_OPTIONS).parquet(f"{path}/batch={number}")

    return step


def merge_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Step that logs each batch, one row per content hash; ``merged_posts`` reads the merged state.

    A batch costs its own rows only, however long the history.
    """
    order = [F.desc("feed_pos"), F.desc("id")]
    return log_batches(path, lambda batch: dedup.first_per_key(dedup.with_content_hash(batch), ["hash"], order))


#: Buckets of the merged history by content hash; a read dedupes one bucket per task, without an exchange.
HISTORY_BUCKETS = 16
#: Micro-batches between compactions of the history into its next generation.
COMPACT_EVERY = 10


def bucketed_history(spark: SparkSession, base: str, buckets: int = HISTORY_BUCKETS, every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """Step that appends each batch (last row per hash) to a table bucketed by hash, ``<base>_g<k>`` in the warehouse.

    Every ``every`` batches the table is compacted into the next generation: one row per hash, read bucket by bucket
    and written into the same buckets, so no history is shuffled. A batch that runs again after a failure appends
    the same rows, which the last-row rule reads once.
    """

    def step(batch: DataFrame, number: int) -> None:
        rows = dedup.first_per_key(dedup.with_content_hash(batch), ["hash"], [F.desc("feed_pos"), F.desc("id")])
        name = current_history(spark, base) or f"{base}_g0"
        writer = rows.withColumn("batch", F.lit(number).cast("long")).write.mode("append").options(**STAGED_OPTIONS).bucketBy(buckets, "hash")
        writer.saveAsTable(name)
        if (number + 1) % every == 0:
            generation = int(name.rsplit("_g", 1)[1]) + 1
            merged = merged_history(spark, name).withColumn("batch", F.lit(number).cast("long"))
            merged.write.options(**STAGED_OPTIONS).bucketBy(buckets, "hash").saveAsTable(f"{base}_g{generation}")
            spark.sql(f"DROP TABLE {name}")

    return step


def current_history(spark: SparkSession, base: str) -> str | None:
    """The newest generation of a bucketed history, if any."""
    found = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{base}_g")]
    return max(found, key=lambda n: int(n.rsplit("_g", 1)[1])) if found else None


def merged_history(spark: SparkSession, name: str) -> DataFrame:
    """Last row per content hash of a bucketed history; the plan reads bucket by bucket, without an exchange."""
    return dedup.first_per_key(spark.table(name), ["hash"], [F.desc("batch"), F.desc("feed_pos"), F.desc("id")]).drop("batch")


def read_log(spark: SparkSession, path: str, keys: list[str], order: Sequence[Column] = ()) -> DataFrame:
    """The last row per key over all logged batches; a gap among the batches is an error."""
    log = spark.read.parquet(path)
    last = log.agg(F.max("batch")).first()[0]
    for number in range(0 if last is None else last + 1):
        if not exists(spark, f"{path}/batch={number}/_SUCCESS"):
            raise FileNotFoundError(f"batch {number} is missing or unfinished in {path}")
    return dedup.first_per_key(log, keys, [F.desc("batch"), *order]).drop("batch")


def merged_posts(spark: SparkSession, path: str) -> DataFrame:
    """All batches merged: last row per content hash, newest first."""
    rows = read_log(spark, path, ["hash"], [F.desc("feed_pos"), F.desc("id")])
    return rows.orderBy(F.desc("timestamp"), F.asc("id"))


def compact(spark: SparkSession, path: str, to: str) -> str:
    """The merged state as batch 0 of a new log."""
    read_log(spark, path, ["hash"], [F.desc("feed_pos"), F.desc("id")]).write.parquet(f"{to}/batch=0")
    return to
