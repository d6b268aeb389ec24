"""Hard negatives by inner product, mined exactly: rows lie in length buckets with a sorted
list for each coordinate, and an anchor verifies only those whose values lie in the feasible
ranges of its focus coordinates."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import in_batches, read_table, shared_dir, shuffle_partitions, stage

POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score that a negative's must reach, and must not pass.
LOW, HIGH = 30, 90
#: Rows of a bucket at most, and how much shorter than its longest its rows may be.
BUCKET_ROWS, LEAST_LENGTH = 2048, 0.8
#: Anchors that are searched for at a time; they and their best rows so far are what the
#: driver and each task hold.
ANCHORS = 8192
#: The rows searched first, about, and how many times as many each later pass has.
FIRST_ROWS, GROWTH = 4096, 8
#: Coordinates of an anchor that candidates are cut down by: those of the largest values.
FOCUS = 4
#: Widening of all bounds on values of length one, against rounding.
SLACK = 1e-9


def prepared(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``label``, ``vector`` (array<long>), ``length`` of the rows that take part,
    one for each id; vectors are padded with zeros to the longest."""
    usable = "vec_id is not null and label is not null and vector is not null and forall(vector, x -> x is not null)"
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<long>")).where(usable)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("v")).select("vec_id", "v.label", "v.vector")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = stage(rows.withColumn("length", F.sqrt(square)), "lemp-rows")
    sizes = rows.agg(F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")).first()
    if sizes.low != sizes.high:
        gap = F.array_repeat(F.lit(0).cast("long"), F.lit(sizes.high) - F.size("vector"))
        rows = rows.withColumn("vector", F.concat("vector", gap))
    return rows


INDEX = "level int, ids array<long>, labels array<long>, longest double, vectors binary, orders binary"


def index(rows: DataFrame, levels: int) -> DataFrame:
    """A row for each bucket: rows near in length, by ascending id, with the order of the
    rows in each coordinate's list. A hash of the id gives each row a level, the top one to
    about one in GROWTH ** (levels - 1); buckets are cut from ranges of level, length and id,
    so many rows of one length are many buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            rows = sorted(held, key=lambda r: r[1])
            vectors = np.array([r[3] for r in rows], dtype=np.int64).reshape(len(rows), -1)
            unit = _unit(vectors)
            orders = np.argsort(unit, axis=0, kind="stable").T.astype("<u2")
            columns = [
                pa.array([rows[0][0]], type=pa.int32()),
                pa.array([[r[1] for r in rows]], type=pa.list_(pa.int64())),
                pa.array([[r[2] for r in rows]], type=pa.list_(pa.int64())),
                pa.array([max(r[4] for r in rows)]),
                pa.array([vectors.astype("<i8").tobytes()], type=pa.binary()),
                pa.array([orders.tobytes()], type=pa.binary()),
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in INDEX.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("level", "vec_id", "label", "vector", "length")), strict=True):
                if held and (len(held) == BUCKET_ROWS or row[0] != held[0][0] or row[4] < LEAST_LENGTH * held[0][4]):
                    yield close()
                held.append(row)
        if held:
            yield close()

    place = F.pmod(F.xxhash64("vec_id", F.lit(29)), F.lit(1 << 30)) / float(1 << 30)
    level = F.lit(0)
    for k in range(1, levels):
        level = F.when(place < GROWTH**-k, F.lit(k)).otherwise(level)
    order = [F.desc("level"), F.desc("length"), F.asc("vec_id")]
    dealt = rows.withColumn("level", level).repartitionByRange(shuffle_partitions(rows.sparkSession), *order)
    return stage(in_batches(dealt.sortWithinPartitions(*order)).mapInArrow(run, INDEX), "lemp-index")


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in their direction; zeros stay."""
    exact = vectors.astype(np.float64)
    length = np.sqrt((exact * exact).sum(axis=-1, keepdims=True))
    return exact / np.where(length > 0, length, 1.0)


class Bucket:
    def __init__(self, ids, labels, longest: float, vectors: bytes, orders: bytes, kind):
        self.ids, self.labels, self.longest = np.array(ids), np.array(labels), longest
        whole = np.frombuffer(vectors, dtype="<i8").reshape(len(ids), -1)
        self.rows, self.unit = whole.astype(kind), _unit(whole)
        self.orders = np.frombuffer(orders, dtype="<u2").reshape(-1, len(ids))

    def candidates(self, unit: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """Positions of the rows that may have an inner product of ``least`` or more with an
        anchor; None for all.

        A row of at most the bucket's length needs a cosine of ``t``. Its angle to the
        anchor is then at most that of ``t``, and its angle to a coordinate's axis differs
        from the anchor's by no more: that bounds its value there. The narrowest range is
        read from that coordinate's sorted list, the others are intersected with it.
        """
        reach = length * self.longest
        if least > 0 and least > reach * (1 + SLACK):
            return np.zeros(0, dtype=np.int64)
        if least <= 0 or not reach:
            return None
        t = min(least / reach, 1.0)
        ranges = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            x = unit[f]
            wide = np.sqrt(max(1 - x * x, 0.0) * (1 - t * t))
            low = -1.0 if x <= -t else x * t - wide
            high = 1.0 if x >= t else x * t + wide
            order = self.orders[f]
            begin = np.searchsorted(self.unit[:, f], low - SLACK, side="left", sorter=order)
            end = np.searchsorted(self.unit[:, f], high + SLACK, side="right", sorter=order)
            ranges.append((end - begin, begin, end, f, low - SLACK, high + SLACK))
        ranges.sort(key=lambda r: (r[0], r[3]))
        n, begin, end, f, _, _ = ranges[0]
        if n == len(self.ids):
            return None
        found = self.orders[f][begin:end].astype(np.int64)
        for n, _, _, f, low, high in ranges[1:]:
            if n < len(self.ids):
                value = self.unit[found, f]
                found = found[(value >= low) & (value <= high)]
        return np.sort(found)


class Anchors(NamedTuple):
    """A block of anchors. ``low`` and ``high`` bound the scores asked for, one column for
    each list of best rows; ``ids`` and ``scores`` hold these lists so far, ``most`` long."""

    vec_id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    same: bool
    most: int
    low: np.ndarray
    high: np.ndarray


#: No bound on a score: what an inner product of longs can't reach.
OPEN = 1 << 62


def _best(ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest scores, ties by smaller id; ``ids`` ascend."""
    if len(ids) > most:
        at_least = np.partition(scores, len(scores) - most)[len(scores) - most]
        ids, scores = ids[scores >= at_least], scores[scores >= at_least]
    order = np.argsort(-scores, kind="stable")[:most]
    return ids[order], scores[order]


def _search(buckets: DataFrame, shared, kind) -> DataFrame:
    """The best rows of each list among the buckets that a task has; ``place`` is the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Anchors = shared.value
        queries, unit = asked.vectors.astype(kind), _unit(asked.vectors)
        length = np.sqrt((asked.vectors.astype(np.float64) ** 2).sum(axis=1))
        lists = asked.low.shape[1]
        low, found = asked.low.copy(), {}

        def look(bucket: Bucket, a: int, at: np.ndarray | None, scores: np.ndarray) -> None:
            ids, labels = (bucket.ids, bucket.labels) if at is None else (bucket.ids[at], bucket.labels[at])
            fits = (labels == asked.label[a]) == asked.same
            if asked.same:
                fits &= ids != asked.vec_id[a]
            for k in range(lists):
                here = fits & (scores >= low[a, k]) & (scores <= asked.high[a, k])
                if not here.any():
                    continue
                some, score = ids[here], scores[here].astype(np.int64)
                if (a, k) in found:
                    had = found[a, k]
                    some, score = np.concatenate([had[0], some]), np.concatenate([had[1], score])
                    order = np.argsort(some, kind="stable")
                    some, score = some[order], score[order]
                found[a, k] = _best(some, score, asked.most)
                if len(found[a, k][0]) == asked.most:
                    low[a, k] = max(low[a, k], found[a, k][1][-1])

        for batch in batches:
            for at in range(batch.num_rows):
                bucket = Bucket(*(batch.column(c)[at].as_py() for c in ("ids", "labels", "longest", "vectors", "orders")), kind)
                least = np.where(low <= asked.high, low, OPEN).min(axis=1)
                whole = []
                for a in np.flatnonzero(least < OPEN):
                    some = bucket.candidates(unit[a], length[a], float(least[a]))
                    if some is None or 2 * len(some) > len(bucket.ids):
                        whole.append(a)
                    elif len(some):
                        look(bucket, a, some, bucket.rows[some] @ queries[a])
                # anchors that most rows are left for: their products in blocks
                for begin in range(0, len(whole), 128):
                    block = np.array(whole[begin : begin + 128])
                    for a, scores in zip(block, queries[block] @ bucket.rows.T, strict=True):
                        look(bucket, a, None, scores)
        items = list(found.items())
        for begin in range(0, len(items), 4096):
            some = items[begin : begin + 4096]
            n = [len(ids) for _, (ids, _) in some]
            columns = [
                pa.array(np.repeat([asked.vec_id[a] for (a, _), _ in some], n)),
                pa.array(np.repeat([k for (_, k), _ in some], n).astype(np.int32)),
                pa.array(np.concatenate([ids for _, (ids, _) in some])),
                pa.array(np.concatenate([scores for _, (_, scores) in some])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor_id", "place", "vec_id", "score"])

    found = in_batches(buckets).mapInArrow(run, "anchor_id long, place int, vec_id long, score long")
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    # the limit is taken in each task before rows meet
    return found.withColumn("rank", F.row_number().over(best))


def _searched(buckets: DataFrame, levels: int, asked: Anchors, kind) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """The lists of ``asked`` over all rows: (anchor's position, list) -> (score, id), best
    first. Each pass searches rows that no other does, and its best scores so far bound what
    the next one, of GROWTH times as many rows, has to look at."""
    spark, found = buckets.sparkSession, {}
    where = {int(i): a for a, i in enumerate(asked.vec_id)}
    for level in reversed(range(levels)):
        shared = spark.sparkContext.broadcast(asked)
        got = _search(buckets.where(F.col("level") == level), shared, kind).where(F.col("rank") <= asked.most)
        # as many rows as the block's lists hold, at most
        got = got.select("anchor_id", "place", "vec_id", "score").toArrow()
        for anchor, k, i, score in zip(*(c.to_pylist() for c in got.columns), strict=True):
            found.setdefault((where[anchor], k), []).append((score, i))
        shared.destroy()
        low = asked.low.copy()
        for (a, k), rows in found.items():
            rows.sort(key=lambda r: (-r[0], r[1]))
            del rows[asked.most :]
            if len(rows) == asked.most:
                low[a, k] = max(low[a, k], rows[-1][0])
        asked = asked._replace(low=low)
    return found


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _mined(spark: SparkSession, buckets: DataFrame, levels: int, block: pa.Table, kind, n: tuple[int, int, int, int]) -> pa.Table:
    """All rows of the result for one block of anchors."""
    n_positives, n_negatives, least, most = n
    ids, labels = (block.column(c).to_numpy() for c in ("vec_id", "label"))
    vectors = block.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    every = np.full((len(ids), 1), -OPEN), np.full((len(ids), 1), OPEN)
    positives = _searched(buckets, levels, Anchors(ids, labels, vectors, True, n_positives, *every), kind)
    low = np.full((len(ids), n_positives), OPEN)
    high = np.full((len(ids), n_positives), -OPEN)
    for (a, _), rows in positives.items():
        for k, (score, _) in enumerate(rows):
            low[a, k], high[a, k] = -(-least * score // 100), most * score // 100
    negatives = _searched(buckets, levels, Anchors(ids, labels, vectors, False, n_negatives, low, high), kind)
    rows = [
        (int(ids[a]), positive, rank, negative, score, less)
        for (a, k), some in negatives.items()
        for score, positive in positives[a, 0][k : k + 1]
        for rank, (less, negative) in enumerate(some, 1)
    ]
    names, kinds = zip(*(x.split() for x in MINED.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    types = {"long": pa.int64(), "int": pa.int32()}
    return pa.table([pa.array(c, type=types[t]) for c, t in zip(columns, kinds, strict=True)], names=list(names))


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score`` from rows ``vec_id``, ``label``, ``vector`` (whole numbers).

    A score is the inner product with the anchor; higher ones come first, ties by smaller
    id. An anchor's positives are its first ``positives`` other rows of its label (all, if
    fewer); for each of them come the first ``negatives`` rows of other labels whose score
    lies from ``low`` to ``high`` percent of the positive's, ends included. A negative
    positive score has none, as the ends then lie the wrong way round.

    Rows without id, label or vector, or with a null component, take no part. Of rows that
    repeat an id one counts, by smallest label, then vector. Shorter vectors end in zeros.
    Scores must fit a long. An empty table, or one without anchors, gives no rows; other
    columns are not read.

    The index, all rows in buckets, is written once. Anchors are taken ANCHORS at a time, so
    what is broadcast and what comes back stays bounded however many there are; each block
    is searched through all buckets, in passes of growing size.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors)
    facts = rows.agg(F.count("*").alias("n"), F.max("length").alias("length"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    levels = 1
    while facts.n > FIRST_ROWS * GROWTH ** (levels - 1):
        levels += 1
    # sums of products are exact in doubles below 2 ** 53, and in longs below 2 ** 63
    reach = (facts.length or 0.0) ** 2
    kind = np.float64 if reach < 2.0**52 else np.int64 if reach < 2.0**62 else object
    buckets = index(rows, levels)
    blocks = 1 + facts.anchors // ANCHORS
    place = F.pmod(F.xxhash64("vec_id", F.lit(31)), F.lit(blocks)).cast("int")
    asked = stage(rows.where(is_anchor).select("vec_id", "label", "vector", place.alias("block")), "lemp-anchors")
    path = shared_dir(spark, "lemp-mined")
    spark.createDataFrame([], MINED).write.parquet(path)
    for b in range(blocks):
        block = asked.where(F.col("block") == b).toArrow().sort_by("vec_id")
        if block.num_rows:
            mined = _mined(spark, buckets, levels, block, kind, (positives, negatives, low, high))
            spark.createDataFrame(mined, MINED).write.mode("append").parquet(path)
    return spark.read.schema(MINED).parquet(path)


def whole_numbers(embedding: str, steps: int = 256) -> Column:
    """The components in steps of 1/``steps``, rounded down; null if a component is null or
    not finite."""
    finite = f"forall({embedding}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return F.expr(f"if({finite}, transform({embedding}, x -> cast(floor({steps} * double(x)) as bigint)), null)")


def op11_focus_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    vectors = rows.select("vec_id", label.alias("label"), whole_numbers("embedding").alias("vector"))
    return mine(vectors, F.col("vec_id") % 100 == 0)


#: The same by comparing every anchor with every row.
ORACLE = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
