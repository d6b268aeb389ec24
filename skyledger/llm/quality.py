"""Quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import blocks, fold, in_batches, read_table, text_buffer
from skyledger.llm.features import join_sample, labelled_sample, ngram_counts, scored, training_labels
from skyledger.llm.words import SPACE, split_words, word_hashes

SIZES = (2, 3)
BITS = 11
DIMENSIONS = 48
NEIGHBOURS = 15
#: Cosines that differ by no more are equal: products round by where in a block they stand.
TIE = 1e-6
#: Labelled documents of each class whose vectors are broadcast.
SAMPLE_EACH = 1500
FOLDS, HELD_OUT = 3, 1


#: Bytes of letters and of digits; all beyond ASCII count as letters.
LETTER, DIGIT = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
DIGIT[48:58] = True
SHAPES, LENGTHS = 8, 16


def shapes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What the words of each row look like, as square roots of shares: repeated at once,
    seen before in the text, without a letter or digit, with symbols, with digits, of one
    letter, very long; and how many words there are, by powers of two."""
    rows = len(offsets) - 1
    out = np.zeros((rows, SHAPES + LENGTHS), dtype=np.float32)
    starts, ends, cuts = split_words(data, offsets)
    many = np.diff(cuts)
    out[np.arange(rows), SHAPES + np.minimum(np.log2(many + 1).astype(int), LENGTHS - 1)] = 0.5
    if not len(starts):
        return out
    row = np.repeat(np.arange(rows), many)
    value = word_hashes(data, starts, ends)
    letters, digits, signs = (
        np.add.reduceat(kind[data].astype(np.int32), starts) for kind in (LETTER, DIGIT, ~(LETTER | DIGIT | SPACE))
    )
    again = np.zeros(len(starts), dtype=bool)
    again[1:] = (value[1:] == value[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((value, row))
    seen = np.zeros(len(starts), dtype=bool)
    seen[order[1:]] = (value[order[1:]] == value[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    wordless = letters + digits == 0
    kinds = [again, seen, wordless, ~wordless & (signs > 1), digits > 0, letters == 1, ends - starts > 24]
    for k, kind in enumerate(kinds):
        out[:, k] = np.sqrt(np.bincount(row, weights=kind, minlength=rows) / np.maximum(many, 1))
    return out


def term_weights(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.concatenate([np.log1p(ngram_counts(data, offsets, SIZES, BITS)), shapes(data, offsets)], axis=1)


WIDTH = (1 << BITS) + SHAPES + LENGTHS


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of documents and, for each bucket, of those that hold it; all documents
    count. A task sends one sum per bucket, whatever it read."""
    width = 1 << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(width, dtype=np.int64), 0
        for block in blocks(batches, "text"):
            data, offsets = text_buffer(block.column("text"))
            seen += (ngram_counts(data, offsets, SIZES, BITS) > 0).sum(axis=0)
            rows += block.num_rows
        buckets = np.arange(-1, width, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(np.append(rows, seen))], names=["bucket", "n"])

    sums = in_batches(docs.select("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = sums.toArrow()  # one row per bucket
    counts = np.zeros(width + 1, dtype=np.int64)
    counts[got.column("bucket").to_numpy() + 1] = got.column("n").to_numpy()
    return int(counts[0]), counts[1:]


class Neighbours:
    """Labelled vectors in the latent space, and the way of a text into it."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray, weight: np.ndarray, idf: np.ndarray):
        """``terms``: term weights of the labelled documents. Their leading right singular
        vectors span the space; ``weight`` restores each label's share of all labels."""
        self.idf = idf.astype(np.float32)
        x = self._weighted(terms)
        # of the small side's product, as there are fewer buckets or documents
        values, axes = np.linalg.eigh((x.T @ x).astype(np.float64)) if len(x) else (None, np.eye(x.shape[1]))
        self.axes = np.ascontiguousarray(axes[:, ::-1][:, :DIMENSIONS]).astype(np.float32)
        self.vectors = _unit(x @ self.axes)
        self.labels, self.weight = labels.astype(np.float32), weight.astype(np.float32)
        total = self.weight.sum()
        self.prior = float((self.labels * self.weight).sum() / total) if total else 0.5

    def _weighted(self, terms: np.ndarray) -> np.ndarray:
        """n-grams by rarity, of unit length together, beside the shapes."""
        width = len(self.idf)
        return np.concatenate([_unit(terms[:, :width] * self.idf), terms[:, width:]], axis=1)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Labels of the nearest vectors by cosine, weighted by the similarity; the prior
        for texts that are similar to none. Vectors as near as the last of them share the
        places that the nearer ones leave, whatever their order."""
        x = _unit(self._weighted(term_weights(data, offsets)) @ self.axes)
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return np.full(len(x), self.prior)
        cosines = x @ self.vectors.T
        last = np.partition(cosines, cosines.shape[1] - k, axis=1)[:, -k, None]
        nearer = cosines > last + TIE
        tied = (cosines >= last - TIE) & ~nearer
        left = (k - nearer.sum(axis=1)) / tied.sum(axis=1)
        places = nearer + tied * left[:, None].astype(np.float32)
        votes = places * np.square(np.square(np.maximum(cosines, 0))) * self.weight
        total = votes.sum(axis=1)
        score = (votes @ self.labels) / np.where(total > 0, total, 1)
        return np.where(total > 0, np.clip(score, 0, 1), self.prior).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def train(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH) -> Neighbours:
    """Vectors of about ``each`` documents of either label (``doc_id``, ``label``), in a
    space whose term weights count all documents."""
    counts = {x.label: x["count"] for x in labels.groupBy("label").count().collect()}
    rows, frequency = document_frequencies(docs)
    sample = join_sample(docs, labelled_sample(labels, "label", each))

    def run(data, offsets, block):
        terms = term_weights(data, offsets).astype(np.float16)
        return [pa.array([x.tobytes() for x in terms], type=pa.binary())]

    got = scored(sample, ["doc_id", "label"], run, "x binary").toArrow().combine_chunks().sort_by("doc_id")
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), dtype=np.float16).reshape(got.num_rows, WIDTH)
    y = got.column("label").to_numpy().astype(np.float64)
    drawn = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    weight = np.array([counts.get(int(k), 0) / drawn[int(k)] for k in y])
    weight = np.sqrt(weight / weight.max()) if len(weight) else weight
    return Neighbours(x.astype(np.float32), y, weight, np.log((1 + rows) / (1 + frequency)) + 1)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``.

    Learns from rows of ``labels`` whose fold is not the held-out one and whose ``quality``
    is 0 or 1 (of an id labelled twice the greater counts). Each document's cosines with
    all labelled vectors are computed, block by block; the vectors broadcast are bounded by
    the sample. Vectors tied at the last place share it. Null and empty texts are near none
    and get the labels' prior; without any label the score is 0.5. A null id is not held out. Texts are read whole; equal texts
    score alike; repeated rows get one each. An empty table gives no rows. Other columns
    are not read.
    """
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, training_labels(labels, "quality", held_out)))
    rows = scored(docs, ["doc_id"], lambda data, offsets, _: [pa.array(shared.value.score(data, offsets))], "score double")
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_nearest_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
