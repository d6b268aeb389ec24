"""Plain Python versions that the operators must equal."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def shingles(text, words):
    found = WORD.findall(lower(text))
    if not found:
        return set()
    if len(found) < words:
        return {tuple(found)}
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def components(texts, words, share):
    """Smallest position that links reach, for each text."""
    sets = [shingles(t, words) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= share * len(a | sets[j]):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [find(i) for i in range(len(texts))], sets


def with_extras(frame, *names):
    """The frame with more columns, named like those that operators make."""
    from pyspark.sql import functions as F

    for name in names:
        frame = frame.withColumn(name, F.lit("x"))
    return frame
