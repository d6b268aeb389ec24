from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import with_extras

from skyledger.llm import common, features, langid, quality, toxicity, words
from skyledger.llm.common import fold_of, text_buffer

LANGUAGES = {
    "en": "the of and to in that with for was this from they which their would there been have were are",
    "de": "der die und das nicht mit für eine auf dem sich auch werden nach einer schön über wenn noch zwischen",
    "fr": "les des une est pour dans qui que sur pas avec être plus été français où même aussi leur cette",
    "es": "los las una que por con para del está más como pero sus años también donde según cuando ellos ñandú",
}
INSULTS = ["clodpole", "dunderhead", "nincompoop"]


def corpus(n=400, seed=0):
    """(doc_id, text, lang, toxic, quality)"""
    rng, out = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(LANGUAGES))
        text = [rng.choice(LANGUAGES[lang].split()) for _ in range(rng.randrange(15, 80))]
        toxic, good = int(rng.random() < 0.25), int(rng.random() < 0.7)
        if toxic:
            text.insert(rng.randrange(9), rng.choice(INSULTS))
        if not good:
            text = rng.choice([[w for w in text[:9] for _ in range(9)], [w + "###" for w in text], [x for w in text for x in (w, "|")]])
        out.append((i, " ".join(text), lang, toxic, good))
    return out


ODD = [(1000, None), (1001, ""), (1002, " \n"), (1003, "12 345 !?"), (1004, "x"), (None, "the of and"), (1005, "word " * 40_000)]


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus()
    docs = [(i, t, lang, None, 0) for i, t, lang, _, _ in rows] + [(i, t, None, None, None) for i, t in ODD] + [(5, rows[5][1], rows[5][2], None, 0)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(i, q, t) for i, _, _, t, q in rows] + [(5, rows[5][4], rows[5][3]), (7, None, None), (None, 1, 1), (1001, 7, 9)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return rows, with_extras(docs, "score", "label", "held_out", "lang_pred"), with_extras(labels, "text", "label")


@pytest.mark.parametrize(
    "judge, column, folds, out, least", [(toxicity.judged, 3, 4, 2, 0.97), (quality.judged, 4, 3, 1, 0.97)]
)
def test_labels_are_learnt(tables, judge, column, folds, out, least):
    rows, docs, labels = tables
    found = judge(docs, labels).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    for r in found:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and fold_of(r.doc_id, folds) == out)
    held = [x for x in rows if fold_of(x[0], folds) == out]
    assert np.mean([by_id[x[0]].predicted == x[column] for x in held]) >= least
    assert by_id[1000].score == by_id[1001].score


def test_held_out_labels_are_not_learnt(spark, tables):
    rows, docs, labels = tables
    turned = [(i, 1 - q, 1 - t) if fold_of(i, 4) == 2 else (i, q, t) for i, _, _, t, q in rows]
    turned = spark.createDataFrame(turned, "doc_id long, quality int, toxic int")
    a = {r.doc_id: r.score for r in toxicity.judged(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.judged(docs, turned).collect()}
    assert a == b


def test_without_labels(spark, tables):
    _, docs, labels = tables
    none = labels.where("false")
    assert {r.predicted for r in toxicity.judged(docs, none).collect()} == {0}
    assert {r.score for r in quality.judged(docs, none).collect()} == {0.5}
    one = labels.where("toxic = 1")
    assert min(r.score for r in toxicity.judged(docs, one).collect()) > 0.9
    assert toxicity.judged(docs.where("false"), labels).collect() == []
    assert quality.judged(docs.where("false"), labels).collect() == []


def test_toxic_rows_go(tables):
    rows, docs, labels = tables
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    wrong = [x[0] for x in rows if (x[0] in ids) == bool(x[3])]
    assert len(wrong) <= 0.02 * len(rows)
    assert {1000, 1001, 1003} <= ids


def test_languages(tables):
    rows, docs, _ = tables
    found = langid.identified(docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    held = [x for x in rows if fold_of(x[0], 3) == 1]
    assert np.mean([by_id[x[0]].lang_pred == x[2] for x in held]) >= 0.98
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und"] * 4
    assert all(r.lang_pred in {*LANGUAGES, "und"} and 0 <= r.score <= 1 for r in found)
    kept = langid.with_language(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {x[0] for x in rows} <= ids and not ids & {1000, 1001, 1002, 1003}


def test_languages_to_learn_from(tables, documents):
    _, docs, _ = tables
    assert {r.lang_pred for r in langid.identified(docs.where("doc_id = 1")).collect()} <= {*LANGUAGES, "und"}
    assert {r.lang_pred for r in langid.identified(documents([(1, "text")])).collect()} == {"und"}
    assert langid.identified(documents([])).collect() == []
    one = [(i, "some words here", "xx") for i in range(9)] + [(99, "¿?", "xx")]
    assert {(r.doc_id == 99, r.lang_pred) for r in langid.identified(documents(one)).collect()} == {(False, "xx"), (True, "und")}


def test_ngrams_and_words_stay_within_rows():
    rows = ["abab", "", "Ab", "é x  yz", "abab"]
    data, offsets = text_buffer(__import__("pyarrow").array(rows))
    counts = features.ngram_counts(data, offsets, (2,), 12)
    assert counts.sum(axis=1).tolist() == [3, 0, 1, 7, 3]
    assert (counts[0] == counts[4]).all() and counts[0].max() == 2
    starts, ends, cuts = words.split_words(data, offsets)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    assert found == ["abab", "Ab", "é", "x", "yz", "abab"] and cuts.tolist() == [0, 1, 1, 2, 5, 6]
    value = words.word_hashes(data, starts, ends)
    assert value[0] == value[5] and len(set(value.tolist())) == 5


def test_grams_are_of_characters():
    texts = ["ÀÉÎÕÜ日本語", "xÀÉÎÕÜ", "abcdef", "ABCDEF日", "", "é"]
    data, offsets = common.text_buffer(pa.array(texts))
    points, cuts = toxicity.characters(data, offsets)
    assert ["".join(map(chr, points[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)] == [
        "".join(c.lower() if c.isascii() else c for c in t) for t in texts
    ]
    grams, ends = toxicity.present_ngrams(data, offsets)
    sets = [set(grams[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)]
    assert [len(x) for x in sets] == [sum(max(len(t) - n + 1, 0) for n in toxicity.SIZES) for t in texts]
    assert len(sets[0] & sets[1]) == 3 and sets[2] < sets[3]  # two of four characters, one of five


def test_blocks_are_bounded_in_rows_and_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array([""] * 5000 + ["x" * 600_000] + ["ab"] * 100)], names=["text"])
    parts = [b.num_rows for b in common.blocks([batch], "text", most_rows=512)]
    assert sum(parts) == 5101 and max(parts) <= 512
