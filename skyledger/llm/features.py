"""Hashed n-grams of UTF-8 bytes, and bounded samples of labelled documents to fit on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import GOLDEN, blocks, broadcast_if_small, checkpointed, in_batches, text_buffer

#: Different labels whose shares are sent to every executor; more are joined by shuffle.
MOST_LABELS = 100_000

#: Texts whose n-gram counts a task holds at a time.
BLOCK_ROWS = 512

#: Lower case for A-Z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def hashed_ngrams(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A bucket below ``2 ** bits`` for the ``n`` bytes from each position on; the last
    ``n - 1`` positions have none. ``n`` is 8 at most."""
    m = max(len(data) - n + 1, 0)
    packed = data[:m].astype(np.uint64)
    for k in range(1, n):
        packed |= data[k : k + m].astype(np.uint64) << np.uint64(8 * k)
    packed += np.uint64(n) << np.uint64(61)
    packed *= GOLDEN
    packed ^= packed >> np.uint64(29)
    packed *= np.uint64(0xBF58476D1CE4E5B9)
    return (packed >> np.uint64(64 - bits)).astype(np.int32)


def inside(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and the past-last position of the n-grams that lie within each row."""
    return offsets[:-1], np.maximum(offsets[1:] - n + 1, offsets[:-1])


def ngram_counts(data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """rows x 2**bits counts of the n-grams of each row."""
    rows, width = len(offsets) - 1, 1 << bits
    data = LOWER[data]
    counts = np.zeros(rows * width, dtype=np.float32)
    row = np.repeat(np.arange(rows, dtype=np.int64) * width, np.diff(offsets))
    for n in sizes:
        grams = hashed_ngrams(data, n, bits)
        begin, end = inside(offsets, n)
        keep = np.zeros(len(data) + 1, dtype=np.int8)
        np.add.at(keep, begin, 1)
        np.add.at(keep, end, -1)
        within = np.cumsum(keep[: len(grams)]) > 0
        counts += np.bincount(row[: len(grams)][within] + grams[within], minlength=rows * width)
    return counts.reshape(rows, width)


def scored(
    docs: DataFrame, columns: list[str], run: Callable[[np.ndarray, np.ndarray, pa.RecordBatch], list[pa.Array]], schema: str
) -> DataFrame:
    """``columns`` of ``docs`` and what ``run`` makes of each block of texts."""
    names = [*columns, *[x.split()[0] for x in schema.split(", ")]]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", most_rows=BLOCK_ROWS):
            data, offsets = text_buffer(block.column("text"))
            made = run(data, offsets, block)
            yield pa.RecordBatch.from_arrays([*[block.column(c) for c in columns], *made], names=names)

    kinds = dict(docs.dtypes)
    declared = ", ".join([*[f"`{c}` {kinds[c]}" for c in columns], schema])
    needed = columns if "text" in columns else [*columns, "text"]
    return in_batches(docs.select(*[F.col(f"`{c}`") for c in needed])).mapInArrow(score, declared)


def labelled_sample(rows: DataFrame, label: str, each: int) -> DataFrame:
    """About ``each`` rows of every value of ``label``: those whose id hashes below the
    share that this many are of all rows of the value (all, if there are fewer).

    The counts cover all rows; the sample is the same on any cluster.
    """
    shares = rows.groupBy(label).agg(F.least(F.lit(1.0), each / F.count("*")).alias("_share"))
    shares = broadcast_if_small(checkpointed(shares), shares.count(), MOST_LABELS)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(shares, label).where(place < F.col("_share")).select(*rows.columns)


def join_sample(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The texts of a sample of ids; the sample is bounded, so it may be broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def training_labels(labels: DataFrame, name: str, held_out: Column) -> DataFrame:
    """``doc_id``, ``label`` of the rows to learn from: one per id, the greater label."""
    rows = labels.where(F.col(name).isin(0, 1) & ~held_out & F.col("doc_id").isNotNull())
    return rows.groupBy("doc_id").agg(F.max(name).cast("int").alias("label"))
