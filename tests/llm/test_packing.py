from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import with_extras

from skyledger.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

TEXTS = [
    "One two three, four.",
    None,
    "",
    "Äußerst schöne Wörter, ça va? ñandú 数字 12345 <|endoftext|> end",
    "  spaces\t\tand\n\n\nlines   ",
    "it's we'll they've I'd " * 40,
    "verylongword" * 3000,
    "same text",
    "same text",
]


def ids_of(text):
    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*whole.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_are_those_of_tokenizers():
    for text in TEXTS:
        assert packing._encode("byte_bpe_50k.json", text).tolist() == ids_of(text)


def test_pieces_and_sequences_are_whole(spark, documents):
    docs = documents([(i, t) for i, t in enumerate(TEXTS)] + [(7, "same text"), (None, "no id")])
    docs = with_extras(docs, "ids", "part", "base", "start").repartition(3)
    window = 16
    pieces = packing.pack(docs, window=window, keep_ids=True)
    rows = pieces.collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[(r.sequence_id * window + r.offset - r.start, r.doc_id, r.doc_tokens)].append(r)
    made = []
    for (_, doc_id, total), found in by_doc.items():
        found.sort(key=lambda r: r.start)
        ids = b"".join(r.ids for r in found)
        assert len(ids) == 4 * total and sum(r.length for r in found) == total
        assert all(r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length for r in found)
        made.append((doc_id is None, doc_id or 0, np.frombuffer(ids, "<u4").tolist()))
    want = [(False, i, ids_of(t)) for i, t in enumerate(TEXTS)] + [(False, 7, ids_of("same text")), (True, 0, ids_of("no id"))]
    assert sorted(made) == sorted(want)
    fill = defaultdict(list)
    for r in rows:
        fill[r.sequence_id].append((r.offset, r.length))
    assert sorted(fill) == list(range(len(fill)))
    for sequence, spans in fill.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == window or sequence == max(fill)
    whole = {r.sequence_id: r.ids for r in packing.sequences(pieces).collect()}
    stream = b"".join(whole[k] for k in sorted(whole))
    assert len(stream) == 4 * sum(len(x[2]) for x in want)


def test_empty_table(documents):
    assert packing.pack(documents([])).collect() == []
