"""Sets of word shingles of texts, and the segment keys that near-duplicate sets share."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from skyledger.llm.common import GOLDEN, mix64
from skyledger.llm.features import LOWER
from skyledger.llm.words import split_words, word_hashes

#: Cost model of the allocation, in rows: what it costs to probe a segment of no or one
#: shingle, which texts share without being alike; others cost less by half for each
#: shingle more in a segment.
CHANCE = 200.0
#: Shingles whose segments are found at a time, or one larger set.
KEYED_AT_ONCE = 1 << 18


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the distinct shingles of ``words`` words (A-Z lower-cased), in ascending
    order of their 64-bit hashes, and the rows' offsets among them. Fewer words are one
    shingle; none, an empty set."""
    data = LOWER[data]
    starts, ends, cuts = split_words(data, offsets)
    value = word_hashes(data, starts, ends)
    n = len(value)
    many = np.diff(cuts)
    salts = mix64(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    whole = np.zeros(max(n - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        whole += (value[k : k + len(whole)] ^ (value[k : k + len(whole)] >> np.uint64(31))) * salts[k]
    whole = mix64(whole)
    sizes = np.minimum(many, 1)
    for r in np.flatnonzero(many >= words).tolist():
        sizes[r] = many[r] - words + 1
        whole[cuts[r] : cuts[r] + sizes[r]].sort()
    few = np.flatnonzero((many > 0) & (many < words)).tolist()
    out = np.empty(int(sizes.sum()), dtype=np.uint64)
    ends = np.cumsum(sizes)
    taken = many >= words
    out[np.repeat(taken, sizes)] = whole[_spans(cuts[:-1][taken], sizes[taken])]
    for r in few:
        own = value[cuts[r] : cuts[r + 1]]
        mixed = ((own ^ (own >> np.uint64(31))) * salts[: many[r]]).sum(dtype=np.uint64, keepdims=True)
        out[ends[r] - 1] = mix64(mixed + mix64(np.full(1, many[r], dtype=np.uint64)))[0]
    # repeated shingles stand side by side
    distinct = np.ones(len(out), dtype=bool)
    distinct[1:] = out[1:] != out[:-1]
    distinct[(ends - sizes)[sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(distinct)])
    return out[distinct], kept[np.concatenate([[0], ends])]


def _spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of slices, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)


def set_names(values: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set, together naming it."""
    out = []
    for salt in mix64(np.array([0x51, 0xA7], dtype=np.uint64)):
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mix64(values ^ salt), out=sums[1:])
        out.append(mix64(sums[cuts[1:]] - sums[cuts[:-1]] + np.diff(cuts).astype(np.uint64)))
    return out[0], out[1]


class Bands:
    """How sets are cut into segments, by size, for a Jaccard similarity of at least
    ``share`` percent.

    Two such sets of sizes r <= s have s <= r / share, and differ in at most
    ``(r + s) (1 - share) / (1 + share)`` shingles. Sizes fall into bands, each with a
    number of segments that the shingles are dealt to by hash, all over the universe. If
    the numbers of differences that segments tolerate (0 for a whole segment, 1 with the
    one-deletion neighbourhood), each plus one, sum to more than the sets differ by, then
    some segment agrees within its tolerance, by the pigeonhole principle.
    """

    def __init__(self, share: int):
        self.share = share
        # below this size only equal sets are similar enough
        self.least = next(n for n in range(1, 10_000) if 100 * n >= share * (n + 1)) if share < 100 else 1 << 60
        self.starts = [self.least]

    def largest_partner(self, size: int) -> int:
        return 100 * size // self.share

    def difference(self, size: int, partner: int) -> int:
        return (size + partner) * (100 - self.share) // (100 + self.share)

    def band(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(self.largest_partner(self.starts[-1]) + 1)
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    @lru_cache(maxsize=None)  # noqa: B019 - one object for a task
    def plan(self, band: int) -> tuple[int, int, int]:
        """The largest size, the segments and how many of them (none or one) are indexed
        with their one-deletion neighbourhood: the cheapest that tolerate enough, by the
        rows they make and the chance matches of small segments. Spare segments let each
        set leave out the smallest of its own."""
        self.band(self.starts[-1])
        while len(self.starts) < band + 2:
            self.band(self.starts[-1])
        low, high = self.starts[band], self.starts[band + 1] - 1
        need = max(self.difference(high, high), self.difference(low - 1, min(high, self.largest_partner(low - 1)))) + 1
        best = None
        for deletions in (0, 1):
            for spare in range(1 + need):
                segments = need - deletions + spare
                # a neighbourhood of a part is as common as the lines that texts share
                if segments < 1 or (deletions and segments > 1):
                    continue
                load = low / segments
                # segments of no or one shingle beyond those that probes leave out
                tiny = segments * math.exp(-load) * (1 + load)
                small = max(tiny + 2 * math.sqrt(tiny) - spare, 0.0) + (segments - spare) * 2.0**-load
                # a neighbourhood leaves one shingle out, so it is small itself up to two
                small += deletions * (load * 2.0 ** (1 - load) + math.exp(-load) * (1 + load + load**2 / 2))
                cost = 2 * segments - spare + 2 * deletions * load + CHANCE * small
                if best is None or cost < best[0]:
                    best = (cost, segments, deletions)
        return high, best[1], best[2]


def set_keys(
    values: np.ndarray, cuts: np.ndarray, bands: Bands
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Keys of sorted sets, ``values`` cut at ``cuts``, some sets and bands at a time: whose
    they are, the keys, and of each whether it is of the index and whether it probes.

    In its own band a set indexes every segment (where one holds the whole set, with its
    one-deletion neighbourhood). It probes, for partners of its size or larger, in its own band and in
    those above that they may be in: there it needs only as many segments as tolerate the
    most by which it can differ from such a partner, and leaves out those that cost most,
    the smallest ones, which many texts share.
    """
    sizes = np.diff(cuts)
    rows = np.flatnonzero(sizes >= bands.least)
    if not len(rows):
        return
    partners = 100 * sizes // bands.share
    top = bands.band(int(partners.max()))
    starts = np.array(bands.starts)
    own, last = (np.searchsorted(starts, x[rows], side="right") - 1 for x in (sizes, partners))
    band = _spans(own, last - own + 1)
    row = np.repeat(rows, last - own + 1)
    plans = np.array([bands.plan(b) for b in range(top + 1)])
    room = np.cumsum(sizes[row]) // KEYED_AT_ONCE
    for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(room)) + 1):
        yield _keys_of(values, cuts, bands, row[part], band[part], np.repeat(own, last - own + 1)[part], plans)


def _keys_of(
    values: np.ndarray, cuts: np.ndarray, bands: Bands, row: np.ndarray, band: np.ndarray, own: np.ndarray, plans: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`set_keys` of the sets ``row``, each in one band beside its own."""
    size = np.diff(cuts)[row]
    high, segments, deletions = plans[band].T
    values = values[_spans(cuts[row], size)]
    mixed = mix64(values ^ np.uint64(0x5DEECE66D))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mixed, out=sums[1:])
    # segments are ranges of the hash, so those of a sorted set are slices of it
    first = np.cumsum(segments) - segments
    at = ((values >> np.uint64(32)) * np.repeat(segments, size).astype(np.uint64)) >> np.uint64(32)
    at = at.astype(np.int64) + np.repeat(first, size)
    held = np.bincount(at, minlength=int(segments.sum()))
    edges = np.concatenate([[0], np.cumsum(held)])
    content = sums[edges[1:]] - sums[edges[:-1]]
    of = np.repeat(np.arange(len(row)), segments)
    number = np.arange(len(of)) - first[of]
    place = (number + 1).astype(np.uint64) * GOLDEN + (band + 1)[of].astype(np.uint64)
    partner = np.minimum(high, 100 * size // bands.share)
    need = bands.difference(size, partner) + 1
    # a segment with its neighbourhood tolerates two, and is never one to spare
    spare = np.where(deletions > 0, 0, segments - need)
    order = np.argsort((of << 32) + held, kind="stable")
    probes = np.ones(len(of), dtype=bool)
    probes[order[number < spare[of]]] = False
    is_own = (band == own)[of]
    keep = is_own | probes
    found = [(row[of][keep], mix64(content + place)[keep], is_own[keep], probes[keep])]
    if deletions.any():
        near = np.flatnonzero(np.repeat(deletions > 0, size))
        less = mix64(content[at[near]] - mixed[near] + place[at[near]])
        found.append((row[of[at[near]]], less, is_own[at[near]], probes[at[near]]))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def signatures(values: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of one sorted set (:func:`set_keys`), and of each whether it is of the index
    and whether it probes."""
    found = [x[1:] for x in set_keys(values, np.array([0, len(values)]), bands)]
    found = found or [(np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, bool))]
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """Shingles that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
