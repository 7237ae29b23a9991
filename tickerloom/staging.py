"""Written tables that cut lineage between the passes of one run.

A staged table lives in the shared folder that ``spark.checkpoint.dir`` names,
so it outlives lost executors, is columnar (the next pass reads only the
columns it needs) and costs no executor memory.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Of tables that hold whole texts and are read again soon: zstd finds matches over far more than snappy's 64 KB.
STAGED_OPTIONS = {"compression": "zstd"}

_local_dirs: dict[str, str] = {}
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is set, a temporary one per
    application serves a local master; elsewhere executors would not share it."""
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tickerloom-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader over the written table."""
    path = new_path(df.sparkSession, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.options(**STAGED_OPTIONS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Removes what was staged inside, at its end. For runs that write their results elsewhere."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    place, files = _located(spark, path)
    files.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _located(spark, path)
    return files.exists(place)


def put_in_place(spark: SparkSession, written: str, path: str) -> None:
    """Move a finished folder to ``path``, in place of what is there.

    The old folder is first renamed aside and deleted only once the new one is in place, so a crash in between
    leaves the old table (beside, as ``<path>.replaced-<id>``) or the new one, never neither.
    """
    target, files = _located(spark, path)
    aside = None
    if files.exists(target):
        aside = _located(spark, f"{path}.replaced-{uuid.uuid4().hex}")[0]
        if not files.rename(target, aside):
            raise OSError(f"could not move {path} aside")
    source = _located(spark, written)[0]
    if not files.rename(source, target):
        if aside is not None:
            files.rename(aside, target)
        raise OSError(f"could not move {written} to {path}")
    if aside is not None:
        files.delete(aside, True)
