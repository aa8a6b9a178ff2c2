"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import scratch_path

#: White space between words, as a Java regex and as characters.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"

#: Python workers get batches of at most this many rows and bytes, so very long texts do not pile up in one.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def bound_batches(spark: SparkSession) -> None:
    for key, value in BATCH_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def col(name: str):
    """A column by its exact name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def text_key(text: str):
    """Hash that, with its id, names a row's content."""
    return F.xxhash64(F.coalesce(col(text), F.lit("")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back.

    Used where several branches read one result, or where row numbers must
    not change between two reads; survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text):
    """Array of the words of a text column (null text: no words)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset:]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (a longer row stands alone)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def word_bounds(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words of consecutive rows, and per row the number of its first word (n + 1)."""
    gap = np.zeros(256, bool)
    gap[[32, 9, 10, 11, 12, 13]] = True
    inside = ~gap[flat]
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(flat), bool)             # first byte of a row: a word never crosses rows
    edge[offsets[:-1][offsets[:-1] < len(flat)]] = True
    before = np.empty(len(flat), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    after = np.empty(len(flat), bool)
    after[-1] = False
    after[:-1] = inside[1:] & ~edge[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)
