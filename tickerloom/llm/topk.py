"""Exact top-k search by tiled matrix products.

Components become floor(1024 x), so scores are whole numbers and exact. Queries are
cut into blocks whose bytes are bounded by a parameter; a block goes to all tasks,
each multiplies it with one tile of its shard after another and keeps k per query from each
tile (partial selection). The lists of all shards are then merged as a tree: in the
task, per group of shards, and at last per query.

The shards are scanned once per block of queries, so a larger query set means more passes, never a larger block.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part;
vectors meet only vectors of their own length; a null vec_id is a candidate (last among ties) but never a query;
rows that agree in vec_id and vector are one query (those that share only the vec_id are several), and no row with the
query's vec_id is its candidate; other repeated rows count as often as they occur; products beyond double precision are worked out in whole numbers, and scores beyond a long are held
at its limits; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.staging import new_path

K = 10
SCALE = 1024
#: Bytes of one query block as it goes to the tasks; sets how many passes there are.
BLOCK_BYTES = 16_000_000
TILE_ROWS = 4096
TILE_QUERIES = 256
MERGE_FAN = 16
LIMITS = (-(2**63), 2**63 - 1)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def product(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(tile).max(initial=0)) * max(1, queries.shape[1])
    if top < 2**53:
        return (queries @ tile.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], object).reshape(queries.shape)
    other = np.array([[int(x) for x in row] for row in tile], object).reshape(tile.shape)
    sums = exact @ other.T if queries.shape[1] else np.zeros((len(queries), len(tile)), object)
    return np.clip(sums, *LIMITS).astype(np.int64)


def best_places(ids: np.ndarray, scores: np.ndarray, real: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best real entries per row: highest score, then smallest id."""
    return np.lexsort((ids, -scores.clip(LIMITS[0] + 1), ~real), axis=1)[:, :k]


def tile_best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, tile: np.ndarray, k: int) -> list[np.ndarray]:
    """Per query the ids, scores and validity of what a tile can add to its k best."""
    scores = product(queries, tile)
    keep = ids[None, :] != query_ids[:, None]
    if scores.shape[1] > 4 * k:  # partial selection; all that tie with the k-th stay
        masked = np.where(keep, scores, LIMITS[0])
        cut = np.partition(masked, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        keep &= masked >= cut[:, None]
    place = np.argsort(~keep, axis=1, kind="stable")[:, :int(keep.sum(axis=1).max(initial=0))]
    picked = [np.take_along_axis(x, place, 1) for x in (np.broadcast_to(ids, scores.shape), scores, keep)]
    order = best_places(*picked, k)
    return [np.take_along_axis(x, order, 1) for x in picked]


def search_block(shards: DataFrame, block: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, vector: str) -> DataFrame:
    """Top lists of one block of queries (ids, keys, vectors of one length), one list per task and query."""
    none = np.iinfo(np.int64).max

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            ids = np.array([none if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            lists = batch.column(1)
            sizes, starts = np.diff(lists.offsets.to_numpy()), lists.offsets.to_numpy()[:-1]
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            for group, (query_ids, _, queries) in enumerate(block):
                size = queries.shape[1]
                rows = np.flatnonzero(sizes == size)
                for at in range(0, len(rows), TILE_ROWS):
                    some = rows[at:at + TILE_ROWS]
                    tile = np.floor(SCALE * flat[starts[some][:, None] + np.arange(size)[None, :]])
                    for first in range(0, len(query_ids), TILE_QUERIES):
                        part = slice(first, first + TILE_QUERIES)
                        best = tile_best(query_ids[part], queries[part], ids[some], tile, k)
                        if (group, first) in tops:
                            best = [np.hstack(x) for x in zip(tops[group, first], best)]
                            order = best_places(*best, k)
                            best = [np.take_along_axis(x, order, 1) for x in best]
                        tops[group, first] = best
        for (group, first), (found, scores, real) in tops.items():
            query_ids, keys = (np.broadcast_to(block[group][i][first:first + TILE_QUERIES, None], real.shape)[real] for i in (0, 1))
            made = [pa.array(query_ids), pa.array(keys), pa.array(found[real], mask=found[real] == none), pa.array(scores[real])]
            yield pa.RecordBatch.from_arrays(made, names=["query_id", "query_key", "vec_id", "score"])

    return shards.select("vec_id", vector).mapInArrow(run, "query_id long, query_key long, vec_id long, score long")


def best_rows(found: DataFrame, k: int, *group: str | Column) -> DataFrame:
    """The k best rows of each group; each partition is cut to k per group before the shuffle."""
    order = W.partitionBy(*group).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def merge_lists(tops: DataFrame, k: int) -> DataFrame:
    """The lists of all tasks, merged per group of tasks and then per query."""
    query = ["query_id", "query_key"]
    grouped = best_rows(tops.withColumn("group_", F.pmod(F.spark_partition_id(), F.lit(MERGE_FAN))), k, *query, "group_").drop("rank", "group_")
    return best_rows(grouped, k, *query).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def search(vectors: DataFrame, queries: DataFrame, k: int = K, vector: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates in ``vectors`` of every row of ``queries``.

    One block of queries at a time comes to the driver, ``block_bytes`` on average; the number of blocks follows the query set.
    With several blocks each one's answers are written before the next comes, so neither the driver nor a plan holds more than one.
    """
    shards = vectors.where(usable(F.col(vector))).select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias(vector))
    doubles = F.col(vector).cast("array<double>")
    asked = queries.where(usable(F.col(vector)) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), F.xxhash64(doubles).alias("query_key"), doubles.alias(vector))
    total = asked.agg(F.sum(8 * F.size(vector) + 16)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    spark, path = vectors.sparkSession, new_path(vectors.sparkSession, "topk")
    for number in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number)
        rows = part.distinct().toArrow()
        ids, keys, lists = rows.column(0).to_numpy(), rows.column(1).to_numpy(), rows.column(2).to_pylist()
        by_size: dict[int, list[int]] = {}
        for i, row in enumerate(lists):
            by_size.setdefault(len(row), []).append(i)
        block = [(ids[at], keys[at], np.floor(SCALE * np.array([lists[i] for i in at], np.float64).reshape(len(at), size))) for size, at in by_size.items()]
        found = merge_lists(search_block(shards, block, k, vector), k)
        if blocks > 1:
            found.write.mode("append").parquet(path)
    return found if blocks == 1 else spark.read.schema(found.schema).parquet(path)
