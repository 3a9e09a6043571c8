"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words and are stripped from lines: space, tab, \n, \v, \f, \r.
WHITE = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows in an Arrow batch: the longest texts are a few MB, so that a batch of them still fits a Python worker.
BATCH_ROWS = 1000
#: Bytes of text that one vectorised step takes at once (a longer text is one step of its own).
BLOCK_BYTES = 2 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches bounded by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text (null and empty differ in nothing that uses them)."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(sizes: list[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows that hold at most ``limit`` bytes, or one longer row."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def arrow_map(df: DataFrame, schema: str, step: Callable[[pa.RecordBatch], dict | None]) -> DataFrame:
    """mapInArrow with a function from a batch to columns (a dict of arrays in the schema's order, or None)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = StructType.fromDDL(schema)

    def run(batches):
        arrow = to_arrow_schema(wanted)
        for batch in batches:
            if batch.num_rows and (columns := step(batch)) is not None:
                yield record_batch(columns, arrow)

    return df.mapInArrow(run, wanted)


def record_batch(columns: dict, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in arrow],
                                      schema=arrow)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (uint64, wraps)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def lists(offsets: np.ndarray, values: np.ndarray, kind=pa.int64()) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
