"""Language of a text: its family first, then linear support vector machines between the
languages of that family, one for each pair."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import fold, read_table
from skyledger.llm.features import join_sample, labelled_sample, ngram_counts, scored

#: Families of languages by code; a language that is not named is a family of its own.
FAMILIES = {
    "en": "germanic",
    "de": "germanic",
    "nl": "germanic",
    "sv": "germanic",
    "da": "germanic",
    "no": "germanic",
    "fr": "romance",
    "es": "romance",
    "it": "romance",
    "pt": "romance",
    "ca": "romance",
    "ro": "romance",
    "ru": "slavic",
    "uk": "slavic",
    "pl": "slavic",
    "cs": "slavic",
}
SIZES = (1, 2, 3)
BITS = 12
#: Documents of each language that the machines are fitted on.
SAMPLE_EACH = 800
#: Documents of all languages that the driver holds, about: more languages have fewer each.
SAMPLE_ALL = 8000
FOLDS, HELD_OUT = 3, 1
UNDETERMINED = "und"


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of n-gram shares: of unit length whatever the length of the text."""
    counts = ngram_counts(data, offsets, SIZES, BITS)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def with_letter(data: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Whether a row holds a letter, of any script."""
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    counts = np.concatenate([[0], np.cumsum(ascii_letter)])
    found = counts[offsets[1:]] > counts[offsets[:-1]]
    for r in np.flatnonzero(~found):
        found[r] = any(c.isalpha() for c in texts[r].as_py() or "")
    return found


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights and, last, the bias of a linear machine that tells ``y`` = 1 from -1: the
    squared hinge loss by full gradients with momentum."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w, pull = np.zeros(x.shape[1] + 1, dtype=np.float32), np.zeros(x.shape[1] + 1, dtype=np.float32)
    for _ in range(rounds):
        ahead = w + 0.9 * pull
        slack = np.maximum(1 - y * (x @ ahead[:-1] + ahead[-1]), 0)
        error = (share * y * slack).astype(np.float32)
        grad = -2 * np.append(error @ x, error.sum()) + penalty * ahead
        pull = 0.9 * pull - 0.2 * grad
        w = w + pull
    return w


class Machines:
    """Machines for family against the rest, and for each pair within a family."""

    def __init__(self, x: np.ndarray, langs: list[str], families: dict[str, str]):
        self.langs = sorted(set(langs))
        family = [families.get(c, c) for c in self.langs]
        self.families = sorted(set(family))
        self.members = [[i for i, f in enumerate(family) if f == name] for name in self.families]
        code = np.array([self.langs.index(c) for c in langs], dtype=np.int64)
        of = np.array([self.families.index(f) for f in family], dtype=np.int64)
        rows, self.pairs = [], []
        for k in range(len(self.families)):
            rows.append(svm(x, np.where(of[code] == k, 1.0, -1.0)) if len(self.families) > 1 else self._blank(x))
        for members in self.members:
            for a, b in combinations(members, 2):
                keep = (code == a) | (code == b)
                rows.append(svm(x[keep], np.where(code[keep] == a, 1.0, -1.0)))
                self.pairs.append((a, b))
        self.weights = np.array(rows, dtype=np.float32).reshape(len(rows), x.shape[1] + 1)

    @staticmethod
    def _blank(x: np.ndarray) -> np.ndarray:
        return np.zeros(x.shape[1] + 1, dtype=np.float32)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The position of each row's language in ``langs`` and a score from 0 to 1: the
        logistic of the margin by which its family leads, times that of its weakest vote won."""
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        heads = len(self.families)
        family = margins[:, :heads].argmax(axis=1)
        lead = _logistic(4 * margins[:, :heads].max(axis=1)) if heads > 1 else np.ones(len(x))
        votes = np.zeros((len(x), len(self.langs)))
        weakest = np.full((len(x), len(self.langs)), np.inf)
        for (a, b), m in zip(self.pairs, margins[:, heads:].T, strict=True):
            votes[:, a] += (m >= 0) + 1e-3 * np.tanh(m)
            votes[:, b] += (m < 0) - 1e-3 * np.tanh(m)
            weakest[:, a] = np.minimum(weakest[:, a], m)
            weakest[:, b] = np.minimum(weakest[:, b], -m)
        inside = np.zeros((heads, len(self.langs)), dtype=bool)
        for k, members in enumerate(self.members):
            inside[k, members] = True
        best = np.where(inside[family], votes, -np.inf).argmax(axis=1)
        won = _logistic(4 * weakest[np.arange(len(x)), best])
        return best, lead * won


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(docs: DataFrame, learn: DataFrame, each: int = SAMPLE_EACH, families: dict[str, str] | None = None) -> Machines | None:
    """Fitted on about ``each`` documents of every language of ``learn`` (``doc_id``,
    ``lang``), or fewer, so that all are SAMPLE_ALL about (of 8 KB each); none without any."""
    n_langs = learn.select("lang").distinct().count()
    each = min(each, max(1, SAMPLE_ALL // max(n_langs, 1)))
    sample = join_sample(docs, labelled_sample(learn, "lang", each))

    def run(data, offsets, block):
        counts = ngram_counts(data, offsets, SIZES, BITS)
        share = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float16)
        return [pa.array([x.tobytes() for x in share], type=pa.binary())]

    got = scored(sample, ["doc_id", "lang"], run, "x binary").toArrow()
    if not got.num_rows:
        return None
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    langs = got.column("lang").to_pylist()
    x, column = np.empty((len(order), 1 << BITS), dtype=np.float32), got.column("x")
    for row, i in enumerate(order):  # no second copy of what came
        x[row] = np.frombuffer(column[i].as_buffer(), dtype=np.float16)
    del got, column
    return Machines(x, [langs[i] for i in order], FAMILIES if families is None else families)


def predicted(docs: DataFrame, machines: Machines | None, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(machines)

    def run(data, offsets, block):
        rows = block.num_rows
        found = with_letter(data, offsets, block.column("text"))
        if shared.value is None:
            return [pa.array([UNDETERMINED] * rows), pa.array(np.zeros(rows))]
        best, score = shared.value.predict(vectors(data, offsets))
        names = pa.array([*shared.value.langs, UNDETERMINED])
        best = np.where(found, best, len(shared.value.langs))
        return [names.take(pa.array(best)), pa.array(np.where(found, score, 0.0))]

    return scored(docs, columns, run, "lang_pred string, score double")


def _learnt(docs: DataFrame) -> tuple[Machines | None, object]:
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    learn = docs.where(~held_out & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    learn = learn.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    return train(docs, learn), held_out


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row of ``docs``.

    Learns from rows with a language whose fold is not the held-out one (of an id with
    several languages the least counts). A null text, an empty one or one without any
    letter is ``und`` with score 0; so is every text if no language can be learnt. A null
    id is not held out. Texts are read whole; equal texts get equal results; repeated rows
    get one each. An empty table gives no rows. Other columns are not read.
    """
    machines, held_out = _learnt(docs)
    rows = predicted(docs, machines, ["doc_id"])
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, least_score: float = 0.05) -> DataFrame:
    """The rows of ``docs``, all their columns, in whose text a learnt language is found:
    neither ``und`` nor scored below ``least_score``, which junk without words is."""
    machines, _ = _learnt(docs)
    renamed = {c: f"_in_{i}" for i, c in enumerate(docs.columns) if c != "text"}
    rows = predicted(docs.withColumnsRenamed(renamed), machines, [renamed.get(c, c) for c in docs.columns])
    kept = rows.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))
    return kept.select(*[F.col(renamed.get(c, c)).alias(c) for c in docs.columns])


def op10_family_then_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(read_table(spark, sf_dir, "documents"))
