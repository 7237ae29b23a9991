"""Sinks: data sets, exports, reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom import lexicon as lx
from tickerloom.schema import TIME_OPTIONS
from tickerloom.staging import put_in_place, remove

# Texts hold quotes, line breaks and outer blanks; all of them must survive.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
INTEGER_RANGES = [("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31)]


def save_parquet(df: DataFrame, path: str, compression: str = "snappy", partition_by: Sequence[str] = ()) -> str:
    """Overwrites ``path``; an empty frame is not written. Returns the path or ''.

    The rows are counted while they are written, to a folder beside; it takes the place of ``path`` if there were any.
    """
    spark, rows = df.sparkSession, Observation()
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    counted.write.partitionBy(*partition_by).option("compression", compression).parquet(beside)
    if not rows.get["rows"]:
        remove(spark, beside)
        return ""
    put_in_place(spark, beside, path)
    return path


def narrow_types(df: DataFrame) -> DataFrame:
    """Smallest integer type that holds each bigint column; doubles to float.

    One aggregate finds all ranges. Text columns with few values need nothing:
    the file format dictionary-encodes them.
    """
    longs = [f.name for f in df.schema if isinstance(f.dataType, T.LongType)]
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    casts = {name: F.col(name).cast("float") for name in doubles}
    if longs:
        bounds = [F.min(c).alias(f"{c}_min") for c in longs]
        bounds += [F.max(c).alias(f"{c}_max") for c in longs]
        row = df.agg(*bounds).first()
        for name in longs:
            low, high = row[f"{name}_min"], row[f"{name}_max"]
            fitting = [t for t, edge in INTEGER_RANGES if low is not None and -edge <= low and high < edge]
            if fitting:
                casts[name] = F.col(name).cast(fitting[0])
    return df.withColumns(casts) if casts else df


def save_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**TIME_OPTIONS).json(path)
    return path


def export(df: DataFrame, path: str, fmt: str, compression: str | None = None) -> str:
    """json, parquet or csv, with the format's own codec. Csv has no lists: they are written comma-joined."""
    if fmt not in lx.EXPORT_FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {lx.EXPORT_FORMATS}")
    writer = df
    if fmt == "csv":
        lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
        if lists:
            writer = df.withColumns({c: F.array_join(c, ",") for c in lists})
        options = CSV_OPTIONS
    else:
        options = {}
    options = {**options, **TIME_OPTIONS}
    if compression:
        options["compression"] = compression
    writer.write.mode("overwrite").options(**options).format(fmt).save(path)
    return path


def save_text(lines: DataFrame, path: str) -> str:
    """(section, key, value) rows as a small headed csv file."""
    lines.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return path


def save_report(report: DataFrame, path: str) -> str:
    """A one-row report as one JSON document."""
    document = report.select(F.to_json(F.struct("*")).alias("value"))
    document.write.mode("overwrite").text(path)
    return path
