"""Dictionary encoding of category columns, computed across the cluster.

A text column is a category when it has fewer distinct values than ``MAX_SHARE`` of its rows (one aggregate
counts both for all candidates); other text columns are left as they are. A category's dictionary holds
its distinct values with dense codes 0, 1, ... in value order, so codes are the same whatever the layout of
the data: the distinct values are range-sorted, each partition counts its rows, the offsets of the
partitions (one number each) come to the driver, and every value's code is its partition's offset plus
its place in the partition. No window runs over all values in one task.

Encoding joins the dictionary: by broadcast when it has at most ``BROADCAST_ROWS`` values (its size is
known from the count), else by a shuffle join. Codes take the smallest integer type that holds them. Null
stays null in both directions. Decoding joins the codes back to the values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.sources.writers import INTEGER_RANGES
from tickerloom.staging import stage

#: The category rule: fewer distinct values than this share of the rows.
MAX_SHARE = 0.5
#: Dictionaries with at most this many values are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def categories(df: DataFrame, columns: Sequence[str] | None = None, max_share: float = MAX_SHARE) -> dict[str, int]:
    """The text columns that are categories, with their numbers of distinct values."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)]
    if not texts:
        return {}
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_distinct(c).alias(c) for c in texts]).first()
    return {c: row[c] for c in texts if row["__rows"] and row[c] < max_share * row["__rows"]}


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the distinct non-null values of ``column`` with dense codes in value order."""
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct().repartitionByRange("value")
    placed = values.sortWithinPartitions("value").withColumn("part", F.spark_partition_id())
    placed = stage(placed.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1), "dictionary")
    counts = sorted(placed.groupBy("part").count().collect())
    offsets, total = [], 0
    for r in counts:
        offsets.append((r["part"], total))
        total += r["count"]
    shifts = df.sparkSession.createDataFrame(offsets or [(0, 0)], "part int, offset long")
    return stage(placed.join(F.broadcast(shifts), "part").select("value", (F.col("offset") + F.col("place")).alias("code")), "codes")


def code_type(values: int) -> str:
    return next((t for t, edge in INTEGER_RANGES if values <= edge), "bigint")


def encode(
    df: DataFrame, columns: Sequence[str] | None = None, max_share: float = MAX_SHARE
) -> tuple[DataFrame, dict[str, tuple[DataFrame, int]]]:
    """``df`` with every category column replaced by ``<column>_code``, and the dictionary and size of each.
    The dictionaries are staged, so that codes are read, not computed again."""
    found = categories(df, columns, max_share)
    encoded, dictionaries = df, {}
    for column, size in found.items():
        table = dictionary(df, column)
        dictionaries[column] = (table, size)
        side = F.broadcast(table) if size <= BROADCAST_ROWS else table
        kind = code_type(size)
        encoded = encoded.join(side.select(F.col("value").alias(column), F.col("code").cast(kind).alias(f"{column}_code")), column, "left")
        encoded = encoded.drop(column)
    return encoded, dictionaries


def decode(encoded: DataFrame, dictionaries: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """The values back in place of the codes."""
    out = encoded
    for column, (table, size) in dictionaries.items():
        side = table.select(F.col("code").alias(f"{column}_code"), F.col("value").alias(column))
        out = out.join(F.broadcast(side) if size <= BROADCAST_ROWS else side, f"{column}_code", "left").drop(f"{column}_code")
    return out
