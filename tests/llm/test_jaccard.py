from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import components, shingles, with_extras

from skyledger.llm import jaccard, words
from skyledger.llm import shingles as shingles_of_sets
from skyledger.llm.shingles import Bands, common_count, set_keys, signatures


def corpus(seed=1, bases=14):
    """Texts, copies, copies with a few words changed, and texts that share long passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    common = [word() for _ in range(30)]
    out = [None, "", " \t\n", "one", "One", "one two three", "ONE two\tthree"]
    for _ in range(bases):
        base = [word() for _ in range(rng.choice([6, 9, 12, 20, 40, 90, 200]))] + (common if rng.random() < 0.4 else [])
        out += [" ".join(base)] * 2
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(1, 2 + len(base) // 25)):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], [word()], [copy[at], word()]])
            out.append("\n ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy))
    return out


@pytest.mark.parametrize("words, share", [(4, 85), (5, 80), (2, 60)])
def test_components_equal_brute_force(spark, documents, words, share):
    texts = corpus(seed=words)
    want, sets = components(texts, words, share)
    assert len(set(want)) < len(texts) - 20  # some are linked
    docs = with_extras(documents(list(enumerate(texts))), "name", "id", "n", "component_id").repartition(5)
    rows = {r.doc_id: r for r in jaccard.components(docs, words, share).collect()}
    assert {i: r.n_shingles for i, r in rows.items()} == {i: len(s) for i, s in enumerate(sets)}
    assert {i: r.component_id for i, r in rows.items()} == dict(enumerate(want))


def test_large_groups_are_split_into_blocks(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "FLUSH_KEYS", 50)
    rng = random.Random(9)
    base = [f"w{rng.randrange(1000)}" for _ in range(60)]
    texts = []
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randrange(0, 4)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(copy))
    want, _ = components(texts, 4, 85)
    got = {r.doc_id: r.component_id for r in jaccard.components(documents(list(enumerate(texts)))).collect()}
    assert got == dict(enumerate(want))
    assert len(set(want)) > 1


def passages(n, size, shared, seed):
    """Sets that share a passage with a center, some of them near copies of it or each other."""
    rng = np.random.default_rng(seed)
    fresh = lambda k: rng.integers(0, 2**63, k, dtype=np.uint64)
    passage = fresh(shared)
    sets = [np.concatenate([passage, fresh(size - shared)])]
    for i in range(n):
        base = sets[0] if i % 5 == 0 else sets[-1] if i % 5 == 1 else np.concatenate([passage, fresh(size - shared)])
        kept = rng.permutation(base)[: size - int(rng.integers(0, size // 6))]
        sets.append(np.concatenate([kept, fresh(size - len(kept))]))
    return [np.unique(x) for x in sets]


def joined(names, links):
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return [find(n) for n in names]


def test_sets_of_a_passage_are_hardly_counted(monkeypatch):
    """Unlike sets that share a passage, as licenses, are told apart without counting all pairs."""
    sets = passages(300, 200, 110, seed=4)
    names = [f"{k:04}" for k in range(len(sets))]
    pairs = [(names[i], names[j]) for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j], 80)]
    counted = []
    monkeypatch.setattr(jaccard, "common_count", lambda a, b: counted.append(1) or common_count(a, b))
    whole = jaccard._links([(k == 0, 0, names[k], x) for k, x in enumerate(sets)], 0, 0, 80)
    assert set(map(frozenset, whole)) <= set(map(frozenset, pairs))
    assert joined(names, whole) == joined(names, pairs)
    assert len(counted) < 3 * len(sets)
    # the same in three blocks, which meet in pairs
    parts = []
    for low in range(3):
        for high in range(low, 3):
            unit = [(k == 0, k % 3, names[k], x) for k, x in enumerate(sets) if k == 0 or k % 3 in (low, high)]
            parts += jaccard._links(unit, low, high, 80)
    assert set(map(frozenset, parts)) <= set(map(frozenset, pairs))
    assert joined(names, parts) == joined(names, pairs)


def alike(a, b, share):
    both = common_count(a, b)
    return 100 * both >= share * (len(a) + len(b) - both)


def test_bitmaps_differ_no_more_than_their_sets():
    sets = passages(40, 90, 50, seed=6) + [np.unique(np.arange(5, dtype=np.uint64))]
    bitmaps = jaccard._bitmaps(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            apart = int(np.bitwise_count(bitmaps[:, i] ^ bitmaps[:, j]).sum())
            assert apart <= len(np.setxor1d(a, b))


def test_sets_of_large_groups_are_sent_once(spark):
    """Not once for every 128 sets of their group, as long as few shingles are in all of them."""
    rows = [("c" * 32, f"{k:032}", k, 40) for k in range(1000)] + [("c" * 32, "c" * 32, 1000, 40)]
    rows += [("d" * 32, f"{k:032}", k, 40_000) for k in range(100)] + [("d" * 32, "d" * 32, 1001, 40_000)]
    groups = spark.createDataFrame(rows, "center string, member string, row_key long, size long")
    found = {p["center"][0]: p["blocks"] for r in jaccard._places(groups).collect() for p in r.places}
    assert found == {"c": 1, "d": 4}


def test_a_key_of_one_set_is_no_list(documents):
    """However many tasks read copies of it."""
    texts = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(4)] * 6
    docs = documents(list(enumerate(texts))).repartition(8)
    assert jaccard.shared_keys(docs, 5, Bands(80), 8).count() == 0
    near = documents([*enumerate(texts), (30, texts[0] + " z")]).repartition(8)
    assert jaccard.shared_keys(near, 5, Bands(80), 8).select("name").distinct().count() == 2


def test_keys_of_many_sets_are_those_of_each(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in [0, 1, 4, 5, 6, 7, 9, 30, 0, 200, 3000, 6]]
    values, cuts = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    want = sorted((r, *k) for r, x in enumerate(sets) for k in zip(*map(np.ndarray.tolist, signatures(x, Bands(80))), strict=True))
    for most in (1, 300, 1 << 20):
        monkeypatch.setattr(shingles_of_sets, "KEYED_AT_ONCE", most)
        found = [zip(*map(np.ndarray.tolist, k), strict=True) for k in set_keys(values, cuts, Bands(80))]
        assert sorted(k for part in found for k in part) == want


def test_many_wanted_texts_are_joined_by_shuffle(documents, monkeypatch):
    texts = corpus(seed=3, bases=5)
    want, _ = components(texts, 4, 85)
    docs = documents(list(enumerate(texts))).repartition(3)
    for most_ids, most_keys in ((3, 1000), (3, 3)):
        monkeypatch.setattr(jaccard, "MOST_IDS", most_ids)
        monkeypatch.setattr(jaccard, "MOST_KEYS", most_keys)
        assert {r.doc_id: r.component_id for r in jaccard.components(docs).collect()} == dict(enumerate(want))


def test_nulls_repeats_and_empty_tables(documents):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (5, text), (3, text + " end"), (None, text), (None, None), (7, None), (8, ""), (9, "alone")]
    got = sorted(map(str, (tuple(r) for r in jaccard.components(documents(rows)).collect())))
    want = [(5, 37, 3), (5, 37, 3), (3, 38, 3), (None, 37, 3), (None, 0, None), (7, 0, 7), (8, 0, 8), (9, 1, 9)]
    assert got == sorted(map(str, want))
    assert jaccard.components(documents([])).collect() == []


def test_one_row_of_each_group_stays(documents):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(2, text), (2, text), (4, text + " z"), (6, "other words here at all now"), (None, "no id"), (None, None), (7, None)]
    docs = with_extras(documents(rows), "component_id", "count")
    kept = jaccard.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = sorted(str((r.doc_id, r.text)) for r in kept.collect())
    assert found == sorted(str(x) for x in [(2, text), (6, "other words here at all now"), (None, "no id"), (None, None), (7, None)])


def test_one_row_of_each_group_stays_where_ids_repeat_or_lack(documents):
    text, other = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(50))
    lone = "a text of its own that nothing is like"
    rows = [(1, text), (2, text + " z"), (2, lone), (3, lone + " but longer by so many more words than it had")]
    rows += [(None, other), (None, other), (None, other + " z"), (None, text), (5, "x y"), (5, "p q"), (5, "p q"), (8, ""), (8, None)]
    docs = with_extras(documents(rows), "component_id", "row_key", "text_key", "root")
    kept = jaccard.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = sorted(str((r.doc_id, r.text)) for r in kept.collect())
    nameless = [x for x in (other, other + " z") if str((None, x)) in found]
    assert len(nameless) == 1
    want = [(1, text), (2, lone), rows[3], (None, nameless[0]), (5, "x y"), (5, "p q"), (8, ""), (8, None)]
    assert found == sorted(map(str, want))


def test_similar_sets_share_a_key():
    """The pigeonhole bound, at its edge: sets that differ by as much as they may."""
    rng = np.random.default_rng(2)
    for share in (60, 80, 85, 95):
        bands = Bands(share)
        for _ in range(150):
            size = int(rng.choice([6, 7, 8, 11, 13, 20, 33, 50, 120, 300]))
            whole = np.unique(rng.integers(0, 2**63, 2 * size, dtype=np.uint64))
            a = whole[:size]
            drop = int(rng.integers(0, size))
            b = np.sort(np.concatenate([a[drop:], whole[size : size + int(rng.integers(0, size // 2 + 1))]]))
            while len(b) and 100 * common_count(a, b) < share * (len(a) + len(b) - common_count(a, b)):
                # nearer, one shingle at a time, until they are just similar enough
                extra = np.setdiff1d(b, a)
                lack = np.setdiff1d(a, b)
                b = np.setdiff1d(b, extra[:1]) if len(extra) > len(lack) else np.sort(np.append(b, lack[:1]))
            keys = []
            for x, y in ((a, b), (b, a)):
                if len(x) <= len(y):
                    k, _, probing = signatures(x, bands)
                    k2, indexed, _ = signatures(y, bands)
                    keys.append(bool(set(k[probing].tolist()) & set(k2[indexed].tolist())))
            assert np.array_equal(a, b) or all(keys), (share, len(a), len(b))


def test_shingles_of_long_and_odd_texts(documents):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    odd = "  É é x \x0b y\x1fz ΩÄ " * 3
    rows = [(1, long), (2, odd)]
    got = {r.doc_id: r.n_shingles for r in jaccard.components(documents(rows)).collect()}
    assert got == {1: len(shingles(long, 4)), 2: len(shingles(odd, 4))}


def test_words_of_a_pattern_do_not_meet():
    """Thue-Morse words and their complements meet in polynomials modulo a power of two."""
    data = []
    for k in (6, 8, 10, 12):
        bits = [bin(i).count("1") % 2 for i in range(1 << k)]
        data += ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    data += ["a", "aa", "a" * 64, "a" * 65, "a" * 128, "b" + "a" * 64, "a" * 64 + "b", "é", "e"]
    text = np.frombuffer(" ".join(data).encode(), dtype=np.uint8)
    starts, ends, _ = words.split_words(text, np.array([0, len(text)]))
    found = words.word_hashes(text, starts, ends)
    assert len(set(found.tolist())) == len(data)
    alone = [words.word_hashes(*split_alone(w))[0] for w in data]
    assert alone == found.tolist()


def split_alone(word):
    text = np.frombuffer(word.encode(), dtype=np.uint8)
    return text, *words.split_words(text, np.array([0, len(text)]))[:2]
