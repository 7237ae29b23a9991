"""What the operators share: the word rule and passing columns through Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

#: A word is a run of anything but these; ``bytes.split()`` splits at the same six characters.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch that are worked on together; bounds what a task holds beside the batch.
ROWS_AT_ONCE = 500

#: Rows whose ``crc32(doc_id as text) mod 4`` is this are held out from all learning.
HELD_OUT_PART = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """True for the rows kept out of learning. A row without an id can't be dealt and counts as held out."""
    part = F.crc32(F.col(doc_id).cast("string")) if isinstance(doc_id, str) else F.crc32(doc_id.cast("string"))
    return F.coalesce(part % 4 == HELD_OUT_PART, F.lit(True))


def result_schema(df: DataFrame, carry: Sequence[str], results: str) -> StructType:
    """The carried columns and the result columns. A carried column named like a result gives way to it."""
    made = _parse_datatype_string(results)
    taken = {f.name.lower() for f in made.fields}
    kept = [StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name in carry and f.name.lower() not in taken]
    return StructType(kept + made.fields)


def map_columns(
    df: DataFrame,
    inputs: Sequence[Column],
    results: str,
    make: Callable[[], Callable[..., list[pa.Array] | tuple[pa.Array | None, list[pa.Array]]]],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Result columns computed from ``inputs`` batch by batch, beside the carried columns; no shuffle.

    ``make`` is called once per task, so that tables and caches are set up once. What it
    returns gets one Arrow array per input and returns one per result column; a pair
    of a mask and arrays keeps only the rows where the mask is true.
    """
    schema = result_schema(df, carry, results)
    n_made = len(_parse_datatype_string(results).fields)
    kept = schema.names[: len(schema.names) - n_made]
    picked = df.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(f"__input_{i}") for i, c in enumerate(inputs)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                columns = whole.slice(at, ROWS_AT_ONCE).columns
                made = work(*columns[len(kept):])
                mask = None
                if isinstance(made, tuple):
                    mask, made = made
                out = pa.RecordBatch.from_arrays([*columns[: len(kept)], *made], names=schema.names)
                yield out if mask is None else out.filter(mask)

    return picked.mapInArrow(run, schema)
