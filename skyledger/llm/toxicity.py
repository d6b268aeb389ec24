"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import GOLDEN, MIX_1, fold, mix64, read_table, stage
from skyledger.llm.features import (
    LOWER,
    inside,
    join_sample,
    labelled_sample,
    scored,
    training_labels,
)

SIZES = (4, 5, 6)
BITS = 20
#: Standard errors that a log-count ratio must lie from 0 for its n-gram to be a feature.
LEAST_Z = 3.5
#: Labelled documents of each class that the classifier is fitted on.
SAMPLE_EACH = 2500
#: Documents of a step's block.
FIT_ROWS = 256
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, A-Z in lower case, and the rows' offsets among them."""
    begins = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    if begins[-1] == len(data):  # one byte each
        return LOWER[data].astype(np.uint32), offsets
    points = np.frombuffer(LOWER[data].tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
    return points, begins[offsets]


def hashed_characters(values: np.ndarray, n: int) -> np.ndarray:
    """A bucket for the ``n`` characters from each position on, of values drawn by rule."""
    m = max(len(values) - n + 1, 0)
    whole = values[:m] + np.uint64(n)
    for k in range(1, n):
        whole = whole * MIX_1 + values[k : k + m]
    whole ^= whole >> np.uint64(31)
    return ((whole * GOLDEN) >> np.uint64(64 - BITS)).astype(np.int32)


def present_ngrams(
    data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams in each row (those that ``wanted`` marks), each once, and the
    rows' offsets among them."""
    points, offsets = characters(data, offsets)
    rows, values = len(offsets) - 1, mix64(points.astype(np.uint64) * GOLDEN)
    grams = [(hashed_characters(values, n), *inside(offsets, n)) for n in SIZES]
    if wanted is not None:  # few are left to sort
        found = [np.flatnonzero(wanted[g]) for g, _, _ in grams]
        cuts = [(np.searchsorted(f, b), np.searchsorted(f, e)) for f, (_, b, e) in zip(found, grams, strict=True)]
        grams = [(g[f], b, e) for f, (g, _, _), (b, e) in zip(found, grams, cuts, strict=True)]
    parts = [np.unique(np.concatenate([g[b[r] : e[r]] for g, b, e in grams])) for r in range(rows)]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), ends


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums between the offsets; an empty row has 0."""
    sums = np.zeros(len(offsets) - 1)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        sums[filled] = np.add.reduceat(values, offsets[filled], dtype=np.float64)
    return sums


class Model:
    """Weights per bucket and a bias; the score of a text is the logistic of their sum."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.used = weights != 0

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        buckets, ends = present_ngrams(data, offsets, self.used)
        return 1 / (1 + np.exp(-np.clip(row_sums(self.weights[buckets], ends) + self.bias, -30, 30)))


def prior_model(labels: np.ndarray, weight: np.ndarray) -> Model:
    """Scores every text by the share of label 1, or the least share without any label."""
    total = weight.sum()
    prior = float(np.clip((weight * labels).sum() / total, 1e-3, 1 - 1e-3)) if total else 1e-3
    return Model(np.zeros(1 << BITS, dtype=np.float32), np.log(prior / (1 - prior)))


def fit(rows: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, ratio: np.ndarray, penalty: float = 3.0) -> Model:
    """Logistic regression, by full gradients with Adam steps, over the presence of each
    n-gram times its log-count ratio; n-grams of ratio 0 are no features. ``rows``: the
    features of each document, by their place among the buckets that are. ``weight``
    restores the share of each label in the corpus."""
    used = np.flatnonzero(ratio)
    scale, width = ratio[used], len(used)
    v, first, second = (np.zeros(width) for _ in range(3))
    b, b1, b2 = prior_model(labels, weight).bias, 0.0, 0.0
    for step in range(1, 81):
        slope, grad, grad_b = (v * scale).astype(np.float32), np.zeros(width), 0.0
        for at in range(0, len(rows), FIT_ROWS):
            some = rows[at : at + FIT_ROWS]
            lengths = np.array([len(x) for x in some])
            places = np.concatenate(some)
            z = row_sums(slope[places], np.concatenate([[0], np.cumsum(lengths)])) + b
            logistic = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            error = weight[at : at + FIT_ROWS] * (logistic - labels[at : at + FIT_ROWS])
            grad += np.bincount(places, weights=np.repeat(error, lengths), minlength=width)
            grad_b += error.sum()
        grad = grad * scale + penalty * v
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        b1, b2 = 0.9 * b1 + 0.1 * grad_b, 0.99 * b2 + 0.01 * grad_b**2
        rate = 0.03
        v -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        b -= 10 * rate * (b1 / (1 - 0.9**step)) / (np.sqrt(b2 / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(len(ratio), dtype=np.float32)
    weights[used] = v * scale
    return Model(weights, float(b))


def _ngram_lists(sample: DataFrame) -> DataFrame:
    def run(data, offsets, block):
        buckets, ends = present_ngrams(data, offsets)
        return [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(buckets.astype(np.int32)))]

    return scored(sample, ["doc_id", "label"], run, "buckets array<int>")


def _places(sample: DataFrame, wanted: np.ndarray) -> list[np.ndarray]:
    """Of each document, in order of label and id, which of the wanted n-grams it holds."""
    place = np.cumsum(wanted, dtype=np.int32) - 1

    def run(data, offsets, block):
        buckets, ends = present_ngrams(data, offsets, wanted)
        found = place[buckets]
        return [pa.array([found[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], type=pa.binary())]

    got = scored(sample, ["doc_id", "label"], run, "places binary").toArrow()
    order = np.lexsort((got.column("doc_id").to_numpy(), got.column("label").to_numpy()))
    return [np.frombuffer(got.column("places")[i].as_buffer(), dtype=np.int32) for i in order]


def log_count_ratios(sample: DataFrame, drawn: dict[int, int]) -> np.ndarray:
    """For each bucket the log of how much likelier its n-grams are in a document of label
    1, counted over the sample; 0 within LEAST_Z standard errors of it."""
    seen = _ngram_lists(sample).select("label", F.explode("buckets").alias("bucket"))
    seen = seen.groupBy("bucket").agg((F.sum("label") + 1).alias("one"), (F.sum(1 - F.col("label")) + 1).alias("nil"))
    ratio = F.log(F.col("one") / drawn[1]) - F.log(F.col("nil") / drawn[0])
    seen = seen.select("bucket", ratio.alias("ratio"), F.sqrt(1 / F.col("one") + 1 / F.col("nil")).alias("error"))
    got = seen.where(F.abs("ratio") > LEAST_Z * F.col("error")).toArrow()  # a row per bucket at most
    out = np.zeros(1 << BITS)
    out[got.column("bucket").to_numpy()] = got.column("ratio").to_numpy()
    return out


def train(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH) -> Model:
    """Fitted on about ``each`` documents of either label (``doc_id``, ``label``).

    N-grams are counted in the tasks; the driver gets the ratios of those that tell the
    labels apart and, for each sampled document, which of these it holds."""
    counts = {x.label: x["count"] for x in labels.groupBy("label").count().collect()}
    sample = stage(join_sample(docs, labelled_sample(labels, "label", each)), "toxicity-sample")
    drawn = {x.label: x["count"] for x in sample.groupBy("label").count().collect()}
    y = np.repeat([0.0, 1.0], [drawn.get(0, 0), drawn.get(1, 0)])
    weight = np.array([counts[int(k)] / drawn[int(k)] for k in y])
    if len(drawn) < 2:
        return prior_model(y, weight)
    ratio = log_count_ratios(sample, drawn)
    rows = _places(sample, ratio != 0)
    return fit(rows, y, weight / weight.mean(), ratio)


def score_documents(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``score``; the model has a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return scored(docs, columns, lambda data, offsets, _: [pa.array(shared.value.score(data, offsets))], "score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``.

    Learns from rows of ``labels`` whose ``fold`` is not the held-out one and whose
    ``toxic`` is 0 or 1; other labels are left out, of an id labelled twice the greater
    counts. Null and empty texts score by the bias alone. A null id is not held out. Texts
    of any length are read whole; equal texts score alike. An empty table gives no rows;
    without labels every score is the least prior. Other columns are not read.
    """
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    model = train(docs, training_labels(labels, "toxic", held_out))
    rows = score_documents(docs, model, ["doc_id"])
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that score below the threshold."""
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    model = train(docs, training_labels(labels, "toxic", held_out))
    renamed = {c: f"_in_{i}" for i, c in enumerate(docs.columns) if c != "text"}  # may be named score
    rows = score_documents(docs.withColumnsRenamed(renamed), model, [renamed.get(c, c) for c in docs.columns])
    kept = rows.where(F.col("score") < THRESHOLD)
    return kept.select(*[F.col(renamed.get(c, c)).alias(c) for c in docs.columns])


def op9_naive_bayes_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
