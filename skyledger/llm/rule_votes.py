"""Quality rules as weak supervision: each rule votes for or against a document or abstains,
expectation-maximisation over the patterns of votes estimates how far each rule can be
trusted, and a document is kept by its posterior probability of being good."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import blocks, code_points, in_batches, read_table, segments, stage, text_buffer
from skyledger.llm.words import split_words

#: Words of a window that counts as repeated when a text has it twice; a power of two.
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 20, 30

#: Before any document is seen: the share of good ones, and how often a rule that votes is
#: against, for good and for bad ones; it weighs as much as so many documents of either kind.
PRIOR_GOOD, PRIOR_WEIGHT = 0.8, 20.0
PRIOR_IF_GOOD, PRIOR_IF_BAD = 0.05, 0.5
ROUNDS, TOLERANCE = 500, 1e-9

STATS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_lines long, n_ended_lines long, n_alpha_words long, n_upper_words long, n_marked_words long, top_word long"
)


class Rule(NamedTuple):
    """SQL conditions over the statistics; neither holding, or null, is an abstention."""

    name: str
    against: str
    in_favour: str


RULES = (
    Rule("length", "n_words > 200000", "n_words >= 50"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 12 * n_words", "word_chars between 3 * n_words and 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    Rule("letters", "10 * n_alpha_words < 7 * n_words", "10 * n_alpha_words > 9 * n_words"),
    Rule("capitals", "10 * n_upper_words > 3 * n_words", "20 * n_upper_words < n_words"),
    Rule("marks", "10 * n_marked_words > n_words", "50 * n_marked_words < n_words"),
    Rule("same_lines", "5 * n_dup_lines > 2 * n_lines", "n_lines > 2 and 20 * n_dup_lines < n_lines"),
    Rule("same_words", "4 * n_repeat_words > n_words", "n_words >= 50 and 20 * n_repeat_words < n_words"),
    Rule("line_ends", "n_lines > 2 and 10 * n_ended_lines < 3 * n_lines", "10 * n_ended_lines > 6 * n_lines"),
    Rule("one_word", "n_words >= 50 and 4 * top_word > n_words", "n_words >= 50 and 8 * top_word < n_words"),
)


def _numbers(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers, different ones different."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))


def _repeated(number: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether each word is in a window of WINDOW words that its row has more than once.

    Windows of twice the length get numbers from pairs of windows, so equal numbers mean
    equal words: nothing is hashed.
    """
    inside = np.zeros(len(number), dtype=bool)
    n, width = len(number), 1
    place, windows = np.arange(n), number
    while width < WINDOW:
        n -= width
        if n <= 0:
            return inside
        pairs = windows[:n] * np.int64(windows.max() + 1) + windows[width : width + n]
        windows = np.unique(pairs, return_inverse=True)[1].reshape(-1)
        width *= 2
    place = place[:n][row[:n] == row[WINDOW - 1 : WINDOW - 1 + n]]
    keys = row[place] * np.int64(windows.max() + 1) + windows[place]
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    place = place[count[which.reshape(-1)] > 1]
    edges = np.zeros(len(number) + 1, dtype=np.int64)
    np.add.at(edges, place, 1)
    np.add.at(edges, place + WINDOW, -1)
    return np.cumsum(edges)[:-1] > 0


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER, _LOWER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_UPPER[65:91], _LOWER[97:123] = True, True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_MARK = ~_LETTER
_MARK[[*range(33), *range(48, 58)]] = False
_END = b".!?:;\"')"


def _lines(text: bytes) -> tuple[int, int, int]:
    """Lines with a word: equal to an earlier one, all, and those that end like a sentence."""
    seen, again, ended = set(), 0, 0
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    for line in lines:
        again += line in seen
        seen.add(line)
        ended += line.rstrip(b" \t\n\r\x0b\x0c")[-1:] in _END
    return again, len(lines), ended


def _stats_of(block: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = text_buffer(block.column("text"))
    rows = len(offsets) - 1
    starts, ends, cuts = split_words(data, offsets)
    row = segments(cuts)
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    number = _numbers([w for text in texts for w in text.split()])

    def per_word(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind)])
        return sums[ends] - sums[starts]

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[cuts[1:]] - sums[cuts[:-1]]

    begins = per_word((data & 0xC0) != 0x80)
    letters, upper = per_word(_LETTER[data]), per_word(_UPPER[data])
    twice = np.zeros(len(data), dtype=bool)
    twice[1:] = _MARK[data[1:]] & (data[1:] == data[:-1])
    top = np.zeros(rows, dtype=np.int64)
    if len(number):
        keys, count = np.unique(row * np.int64(number.max() + 1) + number, return_counts=True)
        np.maximum.at(top, keys // (number.max() + 1), count)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    lines = np.array([_lines(text) for text in texts], dtype=np.int64).reshape(rows, 3)
    values = [
        np.diff(cuts),
        per_row(begins),
        symbols[offsets[1:]] - symbols[offsets[:-1]],
        lines[:, 0],
        per_row(_repeated(number, row)),
        lines[:, 1],
        lines[:, 2],
        per_row(2 * letters >= ends - starts),
        per_row((upper > 1) & (per_word(_LOWER[data]) == 0)),
        per_row(per_word(twice) > 0),
        top,
    ]
    names = [x.split()[0] for x in STATS.split(", ")]
    return pa.RecordBatch.from_arrays([block.column("doc_id"), *[pa.array(v, type=pa.int64()) for v in values]], names=names)


def text_stats(docs: DataFrame) -> DataFrame:
    """What the rules look at, of every whole text; one row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            yield _stats_of(block)

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, STATS)


def votes(rule: Rule) -> Column:
    """1 in favour, -1 against, 0 for an abstention."""
    return F.expr(f"case when {rule.against} then -1 when {rule.in_favour} then 1 else 0 end")


class Trust(NamedTuple):
    """The share of good documents, and how often each rule, if it votes, votes against
    where the document is good (its errors there) and where it is bad (its accuracy)."""

    good: float
    if_good: np.ndarray
    if_bad: np.ndarray

    def weights(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Log odds of being good: before any vote, and what a vote against and one in
        favour add."""
        against = np.log(self.if_good) - np.log(self.if_bad)
        return float(np.log(self.good) - np.log1p(-self.good)), against, np.log1p(-self.if_good) - np.log1p(-self.if_bad)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        start, against, favour = self.weights()
        return 1 / (1 + np.exp(-(start + (patterns < 0) @ against + (patterns > 0) @ favour)))


def estimate(patterns: np.ndarray, counts: np.ndarray) -> Trust:
    """Expectation-maximisation from patterns of votes and the numbers of documents that
    have them. An abstention tells nothing; votes are independent given the quality. A rule
    that would vote against good documents more often than against bad ones gets one share
    for both: it tells nothing either, and the two kinds can't change names."""
    rules = patterns.shape[1]
    against, cast = (patterns < 0).astype(float), (patterns != 0).astype(float)
    trust = Trust(PRIOR_GOOD, np.full(rules, PRIOR_IF_GOOD), np.full(rules, PRIOR_IF_BAD))
    for _ in range(ROUNDS):
        before, good = trust, trust.posterior(patterns) * counts
        share = (good.sum() + PRIOR_GOOD * PRIOR_WEIGHT) / (counts.sum() + PRIOR_WEIGHT)
        kinds = ((good, PRIOR_IF_GOOD), (counts - good, PRIOR_IF_BAD))
        said = [w @ against + p * PRIOR_WEIGHT for w, p in kinds]
        of = [w @ cast + PRIOR_WEIGHT for w, _ in kinds]
        wrong = said[0] / of[0] > said[1] / of[1]
        both = (said[0] + said[1]) / (of[0] + of[1])
        trust = Trust(float(share), *(np.where(wrong, both, x / n) for x, n in zip(said, of, strict=True)))
        if max(abs(share - before.good), *(np.abs(x - y).max(initial=0) for x, y in zip(trust[1:], before[1:], strict=True))) < TOLERANCE:
            break
    return trust


def fit(voted: DataFrame, rules: tuple[Rule, ...] = RULES) -> Trust:
    """From all rows. What reaches the driver is a row for each pattern of votes, at most
    3 to the power of the number of rules, however many documents there are."""
    names = [f"vote_{rule.name}" for rule in rules]
    found = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    rows = sorted(tuple(row) for row in found)
    patterns = np.array([r[:-1] for r in rows], dtype=np.int64).reshape(len(rows), len(names))
    return estimate(patterns, np.array([r[-1] for r in rows], dtype=float))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For every row of ``docs`` (``doc_id``, ``text``) its statistics, ``base_failed`` (too
    few words or too many repeated ones), each rule's vote, ``quality``, the posterior
    probability that it is good, and ``kept``: at least one half, and not failed before.

    The statistics are made once and written; the rules, the counting of vote patterns and
    the judging are expressions over them. Equal texts are judged alike, rows that repeat an
    id each by its text. A null or empty text, or one without a word, has no words and
    fails. Texts are read whole. An empty table gives no rows. Other columns are not read.
    """
    stats = stage(text_stats(docs), "rule-stats")
    failed = F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words")
    voted = stats.select("*", failed.alias("base_failed"), *[votes(rule).alias(f"vote_{rule.name}") for rule in rules])
    start, against, favour = fit(voted, rules).weights()
    odds = F.lit(start)
    for rule, minus, plus in zip(rules, against.tolist(), favour.tolist(), strict=True):
        vote = F.col(f"vote_{rule.name}")
        odds = odds + F.when(vote < 0, F.lit(minus)).when(vote > 0, F.lit(plus)).otherwise(F.lit(0.0))
    quality = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    return voted.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def with_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns; rows of one id and text
    stay or go together. Ids may be null or repeat."""
    verdicts = judged(docs.select(F.xxhash64("text").alias("doc_id"), "text"), rules)
    kept = verdicts.where("kept").select(F.col("doc_id").alias("_text")).distinct()
    return docs.join(kept, F.xxhash64(docs["text"]) == kept["_text"], "left_semi")


def op13_rule_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )
