"""Packing token streams into fixed windows: concatenate, then cut."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import blocks, broadcast_if_small, in_batches, read_table, stage

END_ID = 1
SEQUENCE_TOKENS = 2048
#: Partitions whose bases are sent to every executor; beyond it they are joined by shuffle.
MOST_BASES = 1_000_000

_encoders: dict[str, object] = {}


def encoder(vocabulary: str):
    """The byte-level BPE of a ``tokenizers`` JSON file, as a tiktoken encoding.

    Ids equal those of ``tokenizers`` (tested): the merges of such a file are in order of
    id, so the vocabulary is a rank table, and added tokens are matched first.
    """
    if vocabulary not in _encoders:
        import json

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
            model = json.load(file)
        # byte-level BPE writes the bytes that are no printable Latin-1 as characters from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        added = {x["content"]: x["id"] for x in model.get("added_tokens", [])}
        ranks = {
            bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in added
        }
        _encoders[vocabulary] = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
    return _encoders[vocabulary]


def _encode(vocabulary: str, text: str | None) -> np.ndarray:
    ids = encoder(vocabulary).encode(text or "", allowed_special="all")
    ids.append(END_ID)
    return np.asarray(ids, dtype=np.uint32)


def tokenized(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``part``, ``local_offset``, ``doc_id``, ``doc_tokens``, ``ids`` (little-endian 32-bit):
    each document's ids and where they begin among those of its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        for block in blocks(batches, "text"):
            ids = [_encode(vocabulary, x) for x in block.column("text").to_pylist()]
            counts = np.array([len(x) for x in ids], dtype=np.int64)
            ends = total + np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, dtype=np.int32)),
                    pa.array(ends - counts),
                    block.column("doc_id"),
                    pa.array(counts),
                    pa.array([x.astype("<u4").tobytes() for x in ids], type=pa.binary()),
                ],
                names=["part", "local_offset", "doc_id", "doc_tokens", "ids"],
            )
            total = int(ends[-1])

    schema = "part int, local_offset long, doc_id long, doc_tokens long, ids binary"
    return in_batches(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, schema)


def _with_offsets(tokens: DataFrame) -> DataFrame:
    """``global_offset``: the tokens of all earlier partitions, and those before it in its own."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition of the first pass
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    bases = broadcast_if_small(bases, totals.count(), MOST_BASES)
    return tokens.join(bases, "part").withColumn("global_offset", F.col("base") + F.col("local_offset"))


def _cut(tokens: DataFrame, window: int, keep_ids: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column("global_offset").to_numpy()
            counts = batch.column("doc_tokens").to_numpy()
            first, last = offsets // window, (offsets + counts - 1) // window
            n = last - first + 1
            row = np.repeat(np.arange(batch.num_rows), n)
            sequence = first[row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
            begin = np.maximum(sequence * window, offsets[row])
            end = np.minimum((sequence + 1) * window, (offsets + counts)[row])
            start = begin - offsets[row]
            ids = batch.column("ids").to_pylist()
            pieces = [memoryview(ids[r])[4 * a : 4 * (a + m)] for r, a, m in zip(row, start, end - begin, strict=True)]
            columns = [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(start),
                pa.array(end - begin),
                pa.array([zlib.crc32(x) for x in pieces], type=pa.int64()),
                pa.array(counts[row]),
                pa.array(sequence),
                pa.array(begin - sequence * window),
            ]
            if keep_ids:
                columns.append(pa.array([bytes(x) for x in pieces], type=pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
        + ", ids binary" * keep_ids
    )
    names = [x.split()[0] for x in schema.split(", ")]
    return in_batches(tokens.select("doc_id", "doc_tokens", "global_offset", "ids")).mapInArrow(run, schema)


def pack(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", window: int = SEQUENCE_TOKENS, keep_ids: bool = False
) -> DataFrame:
    """Cuts the concatenation of all documents' ids into windows; one row per piece of a
    document: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``, and with ``keep_ids`` the piece's ``ids``.

    First pass: every document is tokenised once and written with its offset within its
    partition. Second pass: the prefix sums over the partitions' totals make these
    offsets global, and each document is cut where the windows end. Tokens are not
    shuffled; a window across two partitions is two boundary records with its id. Only
    the last window is short.

    A null or empty text is one id, the end mark. Repeated rows are packed each. The order
    of the documents is that of the scan, fixed by the written table. An empty table gives
    no rows. Of other columns none is read.
    """
    tokens = stage(tokenized(docs, vocabulary), "packing-tokens")
    return _cut(_with_offsets(tokens), window, keep_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids``: the windows themselves, from pieces kept with their ids.
    A window holds at most as many pieces as tokens, so a group is bounded."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda x, y: F.concat(x, y["ids"]))
    return pieces.groupBy("sequence_id").agg(whole.alias("ids"))


def op6_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
