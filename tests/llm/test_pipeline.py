"""The pipeline's stages over whole small tables, each against a plain version."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import WORD, components

import corpus_pipeline
from skyledger.llm import mixing, packing
from skyledger.llm.common import stage
from skyledger.llm.queries import ENTRIES


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage read and wrote."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        made = stage(function(spark, docs, sf_dir), f"test-{name}")
        out[name] = docs, made
        docs = made
    return out


def rows_of(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages_in_order_keep_the_columns(stages):
    assert list(stages) == ["toxicity", "language", "near_duplicates", "mixing", "packing"]
    for name, (read, made) in stages.items():
        assert read.count() > 0
        if name != "packing":
            assert made.columns == read.columns
    assert corpus_pipeline.ORACLE_SQL is None


def test_filters_only_take_rows_away(stages):
    for name in ("toxicity", "language", "near_duplicates"):
        read, made = map(rows_of, stages[name])
        assert all(read[i] == r for i, r in made.items())
    read, made = map(rows_of, stages["language"])
    assert len(made) >= 0.97 * len(read)


def test_toxic_documents_are_gone(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smaller one labels eleven toxic documents in all
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    read = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = {r.doc_id for r in corpus_pipeline.without_toxic(spark, read, sf_dir).select("doc_id").collect()}
    clean = [i for i, toxic in labels.items() if toxic == 0]
    assert sum(i in made for i in clean) >= 0.98 * len(clean)
    toxic = [i for i, toxic in labels.items() if toxic == 1]
    assert sum(i in made for i in toxic) <= 0.3 * len(toxic)


def test_one_of_each_group_stays(stages):
    read, made = map(rows_of, stages["near_duplicates"])
    ids = sorted(read)
    root, _ = components([read[i].text for i in ids], 5, 80)
    assert sorted(made) == [ids[k] for k in sorted(set(root))]


def test_budgets_are_met(stages):
    read, made = stages["mixing"]
    count = lambda rows: sum(len(WORD.findall(r.text or "")) for r in rows)
    before, after = read.collect(), made.collect()
    assert count(after) == count(before)  # the default budget is what there is
    times = Counter(r.doc_id for r in after)
    assert max(times.values()) <= mixing.MOST_EPOCHS
    texts = {r.doc_id: r.text for r in before}
    assert all((texts[r.doc_id] or "").startswith(r.text or "") for r in after)
    assert all(r.n_chars == len(r.text) for r in after if r.text != texts[r.doc_id])


def test_pieces_hold_every_token_once(stages):
    read, made = stages["packing"]
    want = Counter()
    for r in read.collect():
        ids = packing._encode("byte_bpe_50k.json", r.text)
        want[(r.doc_id, len(ids))] += len(ids)
    got = Counter()
    spans = {}
    for r in made.collect():
        got[(r.doc_id, r.doc_tokens)] += r.length
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    assert sorted(spans) == list(range(len(spans)))
    for sequence, found in spans.items():
        ends = np.cumsum([length for _, length in sorted(found)])
        assert [offset for offset, _ in sorted(found)] == [0, *ends[:-1]]
        assert ends[-1] == packing.SEQUENCE_TOKENS or sequence == len(spans) - 1


def test_run_equals_the_stages(spark, sf_dir, stages):
    count = lambda frame: Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in frame.collect())
    got, want = corpus_pipeline.run(spark, sf_dir), stages["packing"][1]
    # windows depend on the order of the scan, tokens do not
    assert sum(n * k[2] for k, n in count(got).items()) == sum(n * k[2] for k, n in count(want).items())
    assert got.columns == want.columns


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_queries_take_their_whole_table(spark, sf_dir, name):
    query, _ = ENTRIES[name]
    rows = query(spark, sf_dir)
    table, key = {"op2": ("pages", "page_id"), "op8": ("pages", "page_id"), "op4": ("embeddings", "vec_id")}.get(
        name.split("_")[0], ("documents", "doc_id")
    )
    ids = {r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect()}
    if key == "vec_id":
        assert {r.query_id for r in rows.select("query_id").collect()} == {i for i in ids if i % 100 == 0}
    elif name.startswith("op1_"):
        assert {r[0] for r in rows.select(key).collect()} <= ids
    else:
        assert {r[0] for r in rows.select(key).collect()} == ids


def test_packed_checksums(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = {i: packing._encode("byte_bpe_50k.json", t).astype("<u4") for i, t in texts.items()}
    for r in ENTRIES["op6_concatenate_and_cut"][0](spark, sf_dir).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
