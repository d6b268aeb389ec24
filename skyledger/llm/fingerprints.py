"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases again and again. Where phrases end is decided by
deterministic coin tossing from a few symbols around, so equal substrings are parsed
alike, but for a little at their ends, wherever they stand. A phrase is named by what
it consists of; names of one level are the symbols of the next, up to one name for the
whole text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import GOLDEN, blocks, in_batches, mix64, read_table, shuffle_partitions, text_buffer
from skyledger.llm.words import BASE, BYTE_VALUE, powers, prefix_values

BINS = 128
#: Levels whose phrases are sketched (about 10 and 30 bytes long), and the one that is
#: used too where a text has fewer than FEW phrases of the first of these.
LEVELS, SHORT_LEVEL, FEW = (2, 3), 1, 6
TAG = np.uint64(0xFFF)

_LOWEST_BIT = np.array([0] + [(x & -x).bit_length() - 1 for x in range(1, 256)], dtype=np.uint8)
_HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def _toss(symbols: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Labels from 0 to 5 that differ between neighbours, as the symbols do: each label is
    where a symbol first differs from its left neighbour and its bit there, and of these
    labels the same is taken again until they are few. ``heads``: first symbols of texts."""
    labels = symbols
    for _ in range(3 if symbols.dtype == np.uint8 else 4):
        before = np.empty_like(labels)
        before[1:] = labels[:-1]
        before[heads] = labels[heads] ^ labels.dtype.type(1)
        differ = labels ^ before
        if labels.dtype == np.uint8:
            bit = _LOWEST_BIT[differ]
            labels = (bit << 1) | ((labels >> bit) & 1)
        else:
            low = differ & (~differ + np.uint64(1))
            bit = np.bitwise_count(low - np.uint64(1))
            side = (labels & low) != 0
            labels = (bit << 1) | side.astype(np.uint8)
    return labels


def _phrases(symbols: np.ndarray, offsets: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level: names, row offsets and byte places of the phrases that symbols form.

    Runs of a symbol are one. A phrase begins where a text does or a label is larger than
    both its neighbours'; the first phrase of a text has two symbols or more, so that any
    text of several symbols gets shorter.
    """
    n = len(symbols)
    filled = np.flatnonzero(np.diff(offsets))
    head = np.zeros(n, dtype=bool)
    head[offsets[filled]] = True
    new = np.ones(n, dtype=bool)
    new[1:] = symbols[1:] != symbols[:-1]
    new |= head
    runs = np.flatnonzero(new)
    single = symbols[runs]
    heads = np.flatnonzero(head[runs])
    labels = _toss(single, heads)
    is_head = np.zeros(len(runs) + 1, dtype=bool)
    is_head[heads] = True
    is_head[-1] = True
    begins = np.ones(len(runs), dtype=bool)
    begins[1:] = labels[1:] > labels[:-1]
    begins[:-1] &= (labels[:-1] > labels[1:]) | is_head[1:-1]
    begins[heads[heads + 1 < len(runs)] + 1] = False
    begins[heads] = True
    starts = np.flatnonzero(begins)
    value = BYTE_VALUE[single] if single.dtype == np.uint8 else single
    counts = np.diff(np.append(runs, n))
    long = counts > 1
    value = value * GOLDEN
    value[long] = mix64(value[long] + counts[long].astype(np.uint64))
    sums = prefix_values(value)
    sizes = np.diff(np.append(starts, len(runs)))
    names = (sums[starts + sizes] - sums[starts]) * powers(inverse=True, n=len(runs) + 1)[starts]
    names = mix64(names + sizes.astype(np.uint64) * BASE)
    first = runs[starts]
    return names, np.searchsorted(first, offsets), places[first]


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The root names of the rows and their sketches, rows x BINS (0: empty bin).

    A sketch holds, for each bin that phrases fall in by name, a tag of the one with the
    least of their random values, which long phrases are likelier to have: the share of
    bins in which two texts agree estimates the share of text they have in common.
    """
    rows = len(offsets) - 1
    roots = np.zeros(rows, dtype=np.uint64)
    least = np.full(rows * BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    symbols, cuts, places = data, offsets, np.arange(len(data), dtype=np.int64)
    open_rows = np.diff(cuts) > 0
    ends = offsets[1:]
    level, short = 0, None
    while True:
        sizes = np.diff(cuts)
        done = open_rows & (sizes == 1)
        at = symbols[cuts[:-1][done]]
        roots[done] = mix64((BYTE_VALUE[at] if level == 0 else at) + np.uint64(1 + (level == 0)))
        open_rows &= ~done
        if not open_rows.any() and level >= max(LEVELS):
            break
        symbols, cuts, places = _phrases(symbols, cuts, places)
        level += 1
        if level in (SHORT_LEVEL, *LEVELS):
            row = np.repeat(np.arange(rows), np.diff(cuts))
            length = np.empty(len(symbols), dtype=np.float32)
            length[:-1] = places[1:] - places[:-1]
            last = cuts[1:][np.diff(cuts) > 0] - 1
            length[last] = ends[np.diff(cuts) > 0] - places[last]
            if level == SHORT_LEVEL:
                short = (symbols, row, length)
            else:
                if level == LEVELS[0]:
                    few = np.diff(cuts) < FEW
                    keep = few[short[1]]
                    _sketch(least, *(x[keep] for x in short), level=SHORT_LEVEL)
                    short = None
                _sketch(least, symbols, row, length, level)
    tags = (least & TAG).astype(np.uint16)
    tags[least == np.iinfo(np.uint64).max] = 0
    return roots, tags.reshape(rows, BINS)


def _sketch(least: np.ndarray, names: np.ndarray, row: np.ndarray, length: np.ndarray, level: int) -> None:
    value = mix64(names + np.uint64(level))
    uniform = ((value >> np.uint64(40)).astype(np.float32) + 0.5) / np.float32(1 << 24)
    key = (-np.log(uniform) / length).astype(np.float32).view(np.uint32).astype(np.uint64)
    tag = (value >> np.uint64(7)) & TAG
    packed = (key << np.uint64(32)) | np.maximum(tag, np.uint64(1))
    np.minimum.at(least, row * BINS + (value & np.uint64(BINS - 1)).astype(np.int64), packed)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """From 0 to 1, row by row: the share of equal bins among those that either text
    fills; 1 for equal roots."""
    either = (a[1] != 0) | (b[1] != 0)
    same = either & (a[1] == b[1])
    share = same.sum(axis=1) / np.maximum(either.sum(axis=1), 1)
    return np.where(a[0] == b[0], 1.0, share)


def as_text(prints: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """Root in 16 hex digits, then three for each bin."""
    roots, tags = prints
    shifts = np.arange(60, -4, -4, dtype=np.uint64)
    root = (roots[:, None] >> shifts) & np.uint64(15)
    bins = (tags[:, :, None] >> np.array([8, 4, 0], dtype=np.uint16)) & 15
    digits = np.concatenate([root.astype(np.uint8), bins.reshape(len(roots), -1).astype(np.uint8)], axis=1)
    letters = np.ascontiguousarray(_HEX[digits])
    places = np.arange(len(roots) + 1, dtype=np.int32) * digits.shape[1]
    return pa.StringArray.from_buffers(len(roots), pa.py_buffer(places), pa.py_buffer(letters))


def of_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return fingerprints(*text_buffer(pa.array(texts, type=pa.large_string())))


# -- a document, its edited text and the next document --------------------------


def _bucket(order: Column, bounds: list[int]) -> Column:
    """How many of the descending ``bounds`` lie above ``order``: first among every
    ``step``-th, then within one step."""
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*[F.lit(x) for x in bounds[::step]] or [F.lit(None).cast("long")])
    whole = F.array(*[F.lit(x) for x in bounds] or [F.lit(None).cast("long")])
    passed = F.size(F.filter(coarse, lambda b: b > order))
    begin = F.greatest((passed - 1) * step, F.lit(0))
    return begin + F.size(F.filter(F.slice(whole, begin + 1, step), lambda b: b > order))


#: Cuts are taken this many times as fine as partitions, to tell values that fill one.
FINE = 4


def _divided(cuts: list[int]) -> tuple[list[int], dict[int, int]]:
    """From ascending cuts, ``FINE`` for each range wanted: the bounds of the ranges, and
    the values that fill about a range or more, with the number of ranges they are worth."""
    times = Counter(cuts)
    bounds = sorted(set(cuts[FINE - 1 :: FINE]))
    return bounds, {x: -(-n // FINE) + 1 for x, n in times.items() if n >= FINE}


def _starts(widths: list[int]) -> list[int]:
    return list(accumulate(widths, initial=0))


def _quantiles(name: str, parts: int) -> Column:
    shares = [i / (FINE * parts) for i in range(1, FINE * parts)]
    return F.percentile_approx(name, shares, 100 * FINE * parts)


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of each ``_order`` and ``_text_hash`` of a task."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        keys = list(zip(batch.column("_order").to_pylist(), batch.column("_text_hash").to_pylist(), strict=True))
        new = [i for i, key in enumerate(keys) if key not in seen and not seen.add(key)]
        if new:
            yield batch.take(pa.array(new))


def _dealt(rows: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """``rows`` with ``_hash``, 0 but for ids that fill a range, and ``bucket``, the number
    of its range in descending order of id, and the number of ranges.

    An id that fills a range (null counts as one) has ranges of its own, in order of a hash
    of the text. If one text of such an id fills a range, its rows, which are all alike, are
    spread over several.
    """
    spark = rows.sparkSession
    cuts = rows.agg(_quantiles("_order", parts)).first()[0] or []
    bounds, hot = _divided(cuts)
    bounds.reverse()
    if not hot:
        return rows.withColumns({"_hash": F.lit(0).cast("long"), "bucket": _bucket(F.col("_order"), bounds)}), len(bounds) + 1
    text_hash = F.shiftright(F.xxhash64("text"), 12)  # quantiles are taken as doubles
    of_hot = rows.where(F.col("_order").isin(list(hot))).select("_order", text_hash.alias("_hash"))
    most = max(hot.values())
    split, widths = [], dict.fromkeys(bounds, 1)
    for order, found in of_hot.groupBy("_order").agg(_quantiles("_hash", most)).collect():
        step = max(1, most // hot[order])  # as many ranges as the id is worth
        within, same = _divided(found[step - 1 :: step])
        spread = [same.get(h, 1) for h in within] + [1]
        split.append((order, within, spread, _starts(spread)))
        widths[order] += sum(spread)
    ddl = "_order long, _within array<long>, _spread array<int>, _starts array<int>"
    rows = rows.join(F.broadcast(spark.createDataFrame(split, ddl)), "_order", "left")
    starts = _starts([widths[x] for x in bounds])
    rows = rows.withColumn("_hash", F.when(F.col("_within").isNull(), 0).otherwise(text_hash))
    rows = rows.withColumn("_rank", F.size(F.filter("_within", lambda h: h < F.col("_hash"))))
    ties = F.get("_within", F.col("_rank")) == F.col("_hash")
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.get("_spread", F.col("_rank")))
    own = F.get("_starts", F.col("_rank")) + F.when(ties, salt).otherwise(0) + 1
    first = F.get(F.array(*[F.lit(x) for x in starts]), _bucket(F.col("_order"), bounds))
    bucket = (first + F.coalesce(own, F.lit(0))).cast("int")
    return rows.withColumn("bucket", bucket).drop("_within", "_spread", "_starts", "_rank"), starts[-1] + 1


def in_order(docs: DataFrame) -> DataFrame:
    """Rows in order of descending id, a range of ids per partition: ``doc_id``, ``text``,
    and behind the last of each partition, marked ``guest``, the row that comes next."""
    spark = docs.sparkSession
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), order.alias("_order"))
    parts = shuffle_partitions(spark)
    mine, ranges = _dealt(rows, parts)
    # a row for each range, of which there are a few times as many as partitions at most
    heads = mine.groupBy("bucket").agg(F.max("_order").alias("order"), F.min("_hash").alias("hash"))
    heads = heads.orderBy("bucket").collect()
    after = [(heads[i - 1].bucket, x.order, x.hash) for i, x in enumerate(heads)]  # the first comes after the last
    to = F.broadcast(spark.createDataFrame(after, "bucket int, _order long, _hash long"))
    wanted = mine.drop("bucket").join(to.select("_order", "_hash").distinct().hint("broadcast"), ["_order", "_hash"], "left_semi")
    wanted = wanted.withColumn("_text_hash", F.xxhash64("text")).select("doc_id", "text", "_order", "_hash", "_text_hash")
    wanted = in_batches(wanted).mapInArrow(_first_of_each, wanted.schema)
    found = wanted.groupBy("_order", "_hash").agg(F.min_by(F.struct("doc_id", "text"), "_text_hash").alias("row"))
    guests = found.join(to, ["_order", "_hash"]).select("row.*", "_order", "bucket", F.lit(True).alias("guest"))
    mine = mine.select("doc_id", "text", "_order", "bucket", F.lit(False).alias("guest")).unionByName(guests)
    dealt = mine.repartitionById(max(parts, ranges), F.col("bucket").cast("int"))
    return dealt.sortWithinPartitions("bucket", "guest", F.desc("_order"), F.xxhash64("text")).select(
        "bucket", "guest", "doc_id", "text"
    )


COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def compared(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (``doc_id``, ``text``) the fingerprints of its text and of
    its edited text - the last third of it replaced by as many code points from the start
    of the next document in descending order of id - and how like they are to each other
    (``near_edited``) and the first to the next document's (``near_next``).

    A null text is empty; it has the root 0 and no phrase, is wholly like another empty
    text and unlike any other. Equal texts have equal fingerprints. Null ids come last;
    rows of one id are in order of a hash of their texts. The document after the last is
    the first; a single one is its own next. Texts are parsed whole, of whatever length;
    columns beside the two are not read. An empty table gives no rows.

    Texts are shuffled once, into ranges of ids; the first row of a range is also sent
    behind the range before it. An id with many rows, or the rows without one, take several
    ranges. Rows of one id and one text are told apart by their numbers in the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far: bucket, id, text, its print
        for block in blocks(batches, "text"):
            bucket = block.column("bucket").to_pylist()
            guest = block.column("guest").to_pylist()
            ids, texts = block.column("doc_id").to_pylist(), block.column("text").to_pylist()
            roots, tags = fingerprints(*text_buffer(block.column("text")))
            if held is not None:
                bucket, guest = [held[0], *bucket], [False, *guest]
                ids, texts = [held[1], *ids], [held[2], *texts]
                roots, tags = np.concatenate([held[3], roots]), np.concatenate([held[4], tags])
            # a row's next is the row behind it; a guest is only ever a next
            own = [i for i in range(len(ids) - 1) if not guest[i] and bucket[i] == bucket[i + 1]]
            last = len(ids) - 1
            held = None if guest[last] else (bucket[last], ids[last], texts[last], roots[last:], tags[last:])
            if not own:
                continue
            kept = [len(texts[i]) - len(texts[i]) // 3 for i in own]
            edited = [texts[i][:k] + texts[i + 1][: len(texts[i]) - k] for i, k in zip(own, kept, strict=True)]
            prints, after = (roots[own], tags[own]), [i + 1 for i in own]
            changed = of_texts(edited)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in own], type=pa.int64()),
                    pa.array([len(texts[i]) for i in own], type=pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                    as_text(prints),
                    as_text(changed),
                    pa.array(likeness(prints, changed)),
                    pa.array(likeness(prints, (roots[after], tags[after]))),
                ],
                names=[x.split()[0] for x in COLUMNS.split(", ")],
            )

    return in_batches(in_order(docs)).mapInArrow(run, COLUMNS)


def op3_coin_tossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(read_table(spark, sf_dir, "documents"))
