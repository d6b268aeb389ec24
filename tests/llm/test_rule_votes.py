from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import WORD, with_extras

from skyledger.llm import rule_votes
from skyledger.llm.common import read_table

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_of(text):
    """The contract's numbers, by plain Python."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def others_of(text):
    """What else the rules look at."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]

    def letters(w):
        return sum(len(c.encode()) for c in w if c.isascii() and c.isalpha() or not c.isascii())

    return {
        "n_lines": len(lines),
        "n_ended_lines": sum(re.sub(r"[ \t\n\r\x0b\x0c]+$", "", line)[-1] in ".!?:;\"')" for line in lines),
        "n_alpha_words": sum(2 * letters(w) >= len(w.encode()) for w in words),
        "n_upper_words": sum(len(re.findall("[A-Z]", w)) > 1 and not re.search("[a-z]", w) for w in words),
        "n_marked_words": sum(bool(re.search(r"([!-/:-@\[-`{-\x7f])\1", w)) for w in words),
        "top_word": max(Counter(words).values(), default=0),
    }


def verdicts_of(texts):
    """Votes and expectation-maximisation by loops."""

    def cast(text):
        names = dict(zip(BASE, base_of(text), strict=True)) | others_of(text)

        def holds(condition):
            between = re.sub(r"(\w+) between (.+) and (.+)$", r"\2 <= \1 <= \3", condition)
            return eval(between, {}, names)  # the rules' own text

        return [-1 if holds(r.against) else 1 if holds(r.in_favour) else 0 for r in rule_votes.RULES]

    votes = [cast(t) for t in texts]
    n, prior, weight = len(rule_votes.RULES), (rule_votes.PRIOR_IF_GOOD, rule_votes.PRIOR_IF_BAD), rule_votes.PRIOR_WEIGHT
    good, share = rule_votes.PRIOR_GOOD, [[p] * n for p in prior]

    def posterior(v):
        odds = math.log(good / (1 - good))
        for k, x in enumerate(v):
            if x:
                a, b = share[0][k], share[1][k]
                odds += math.log(a / b) if x < 0 else math.log((1 - a) / (1 - b))
        return 1 / (1 + math.exp(-odds))

    for _ in range(2000):
        p = [posterior(v) for v in votes]
        good = (sum(p) + rule_votes.PRIOR_GOOD * weight) / (len(p) + weight)
        made = []
        for k in range(n):
            said = [prior[0] * weight, prior[1] * weight]
            of = [weight, weight]
            for x, v in zip(p, votes, strict=True):
                for j, w in enumerate((x, 1 - x)):
                    said[j] += w * (v[k] < 0)
                    of[j] += w * (v[k] != 0)
            pair = (said[0] / of[0], said[1] / of[1])
            made.append(pair if pair[0] <= pair[1] else (sum(said) / sum(of),) * 2)
        share = [list(x) for x in zip(*made, strict=True)]
    return [posterior(v) for v in votes]


def some_texts():
    rng = random.Random(5)
    plain = [f"w{rng.choice('abcdefgh')}{i}" for i in range(60)]

    def prose(n):
        return " ".join(rng.choice(plain) for _ in range(n)) + "."

    texts = [None, "", " \t\n\x0b\x0c\r", "one", "ünï çödé 日本    x", "a b c d e f g h " * 2, "a b c d e f g h a b c d e f g"]
    texts += ["a a a a a a a a a", "x\nx\n x\nx \n\n\ny\nx", "## $$ a<b> | * & % #", "a " * 500, "WORD!! " * 80, "word | " * 60]
    texts += [prose(rng.randint(1, 300)) for _ in range(30)]
    texts += ["\n".join(prose(9) for _ in range(6)) for _ in range(10)]
    return texts + ["\n".join(["the same line of words, again and again."] * 12), "-- ?? " * 40, prose(40) + "\r\n" + prose(40)]


def test_base_equals_plain_python(spark, documents):
    texts = some_texts()
    got = {r.doc_id: r for r in rule_votes.text_stats(documents(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert tuple(got[i][c] for c in BASE) == base_of(text), (i, text)
        assert {c: got[i][c] for c in others_of(text)} == others_of(text), (i, text)


def test_blocks_and_long_texts(documents):
    rng = random.Random(2)
    long = " ".join(rng.choice(["a", "bb", "c"]) for _ in range(200_000))
    got = rule_votes.text_stats(documents([(1, long), (2, "a b c"), (3, long[:1001])])).orderBy("doc_id").collect()
    assert tuple(got[1][c] for c in BASE) == base_of("a b c")
    assert tuple(got[2][c] for c in BASE) == base_of(long[:1001])
    assert got[0].n_words == 200_000 and got[0].n_repeat_words == base_of(long)[-1]


def test_posterior_equals_loops(documents):
    texts = some_texts()
    got = {r.doc_id: r for r in rule_votes.judged(documents(list(enumerate(texts)))).collect()}
    for i, want in enumerate(verdicts_of(texts)):
        assert got[i].quality == pytest.approx(want, abs=1e-6)
        n_words, *_, repeated = base_of(texts[i])
        failed = n_words < 20 or 100 * repeated > 30 * n_words
        assert got[i].base_failed == failed and got[i].kept == (not failed and want >= 0.5)


def test_estimation_finds_the_rules_that_made_the_votes():
    rng = np.random.default_rng(3)
    good = rng.random(40_000) < 0.7
    right = np.array([0.9, 0.8, 0.7, 0.85, 0.95])
    says = np.where(rng.random((len(good), 5)) < right, good[:, None], ~good[:, None])
    votes = np.where(rng.random(says.shape) < 0.3, 0, np.where(says, 1, -1))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    trust = rule_votes.estimate(patterns, counts.astype(float))
    assert trust.good == pytest.approx(0.7, abs=0.02)
    assert np.abs(1 - trust.if_good - right).max() < 0.03 and np.abs(trust.if_bad - right).max() < 0.03


def test_a_rule_that_votes_the_wrong_way_tells_nothing():
    patterns = np.array([[1, 1, 1, -1], [1, 1, 1, 1], [-1, -1, -1, 1]])
    trust = rule_votes.estimate(patterns, np.array([800.0, 100.0, 100.0]))
    assert trust.if_good[3] == trust.if_bad[3]
    assert (trust.if_good[:3] < trust.if_bad[:3]).all()


def test_edges(spark, documents):
    empty = rule_votes.judged(documents([]))
    assert empty.count() == 0
    prose = "This is a line of plain words, with an end. " * 3 + "Another follows here."
    rows = documents([(None, prose), (1, prose), (1, prose), (1, None), (None, None)])
    got = rule_votes.judged(with_extras(rows, "n_words", "kept", "quality", "_text")).collect()
    assert len(got) == 5
    assert len({(r.n_words, r.kept, r.quality) for r in got if r.n_words}) == 1
    assert all(r.base_failed and not r.kept for r in got if not r.n_words)


def test_with_quality_keeps_rows_and_columns(documents):
    texts = some_texts()
    rows = with_extras(documents([*enumerate(texts), (None, texts[20]), (20, texts[20])]), "_text", "quality")
    kept = {r.doc_id for r in rule_votes.judged(documents(list(enumerate(texts)))).where("kept").collect()}
    got = rule_votes.with_quality(rows)
    assert got.columns == rows.columns
    ids = Counter(r.doc_id for r in got.collect())
    assert set(ids) - {None} == kept
    assert (ids[20], ids[None]) == ((2, 1) if 20 in kept else (0, 0))


def test_query_leaves_good_documents_alone(spark, sf_dir):
    got = rule_votes.op13_rule_votes(spark, sf_dir)
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    assert got.count() == docs.count()
    found = got.join(labels, "doc_id").where("not base_failed").groupBy(labels["quality"].alias("label"), "kept").count().collect()
    n = {(r.label, r.kept): r["count"] for r in found}
    assert n[1, True] >= 0.98 * sum(v for (label, _), v in n.items() if label)
    assert n[0, False] >= 0.9 * sum(v for (label, _), v in n.items() if not label)
