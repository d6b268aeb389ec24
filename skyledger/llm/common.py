"""Helpers the operators share: staging, Arrow text blocks, stable hashes, folds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import shared_dir

#: Odd multipliers of the mixers below, as usual for 64-bit finalisers (fixed values).
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

#: Bytes that a Python worker is handed at a time.
BATCH_BYTES = str(8 << 20)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package; where it is not installed they find it beside the driver's
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: the rows are then
    fixed, whatever executors are lost, and the lineage is cut."""
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, whose rows then go to Python in batches of BATCH_BYTES, or one larger row,
    and not of so many rows, whatever they hold."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()``; a folder is set only where the session names none."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        context = spark.sparkContext
        if not context._jsc.sc().getCheckpointDir().isDefined():
            context.setCheckpointDir(shared_dir(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fold_of(doc_id: int | None, folds: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its row offsets; null rows are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = offsets[0] if len(offsets) else 0
    return whole[start : offsets[-1] if len(offsets) else 0], offsets - start


def blocks(
    batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 1 << 18, most_rows: int = 2048
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the column ``text`` of a block holds about ``most_bytes``
    (one row may be longer), in so many rows at most: temporaries then stay small whatever
    the rows hold."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + most_bytes, side="right")) - 1
            end = min(max(end, begin + 1), begin + most_rows, batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points in each row: bytes that do not continue a character."""
    starts = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=starts[1:])
    return starts[offsets[1:]] - starts[offsets[:-1]]


def segments(offsets: np.ndarray) -> np.ndarray:
    """The row number of every element between the offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def bounded_sample(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """At most ``most`` rows: those that come first by the md5 of ``key``, the same ones
    on any cluster. The limit is taken in each task before rows meet."""
    return rows.withColumn("_order", F.md5(key.cast("string"))).orderBy("_order").limit(most).drop("_order")


def broadcast_if_small(df: DataFrame, rows: int, most_rows: int) -> DataFrame:
    """A broadcast hint only while ``rows``, counted before, is within ``most_rows``; a
    larger side is joined by shuffle, where skewed partitions are split."""
    return F.broadcast(df) if rows <= most_rows else df
