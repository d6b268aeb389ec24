"""Approximate nearest neighbours: a forest of random-projection trees, searched through one
priority queue for all trees, and exact distances to what the leaves hold."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import in_batches, read_table, shuffle_partitions, stage

TREES = 8
#: Vectors that the trees are fitted on, about, and the fewest of them in a leaf.
SAMPLE = 32_768
LEAF_SAMPLE = 24
DEEPEST = 10
#: Share of the true neighbours that a search has to find; how much of the sample it covers
#: for that is measured on so many vectors of the sample when the forest is fitted.
RECALL = 0.95
PROBES = 32
#: Index rows of a leaf that are compared in one go; larger leaves are split.
LEAF_ROWS = 4096
NEIGHBOURS = 10
SEED = 11
#: Queries whose best rows a task holds before it sends them on.
HELD_QUERIES = 50_000


class Tree:
    """A complete binary tree of hyperplanes, each cutting what reaches it in half across
    the line between two groups that grow from two random vectors."""

    def __init__(self, sample: np.ndarray, depth: int, rng: np.random.Generator):
        self.depth = depth
        inner = (1 << depth) - 1
        self.normals, self.cuts = np.zeros((inner, sample.shape[1])), np.zeros(inner)
        node = np.zeros(len(sample), dtype=np.int64)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            if len(here) > 1:
                self.normals[k] = self._direction(sample[here], rng)
                along = sample[here] @ self.normals[k]
                self.cuts[k] = np.median(along)
                node[here] = 2 * k + 1 + (along >= self.cuts[k])
            else:
                node[here] = 2 * k + 1
        self.leaf = node - inner

    @staticmethod
    def _direction(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        a, b = rows[rng.choice(len(rows), 2, replace=False)]
        some = rows[rng.choice(len(rows), min(len(rows), 256), replace=False)]
        for _ in range(6):
            nearer = ((some - a) ** 2).sum(axis=1) < ((some - b) ** 2).sum(axis=1)
            if nearer.all() or not nearer.any():
                break
            a, b = some[nearer].mean(axis=0), some[~nearer].mean(axis=0)
        line = a - b
        length = np.linalg.norm(line)
        return line / length if length else rng.standard_normal(rows.shape[1])

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), dtype=np.int64)
        for _ in range(self.depth):
            right = (rows * self.normals[node]).sum(axis=1) >= self.cuts[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)


class Forest:
    """``share`` of the sample is what a search covers before it ends; unless it is given,
    the least that finds RECALL of the neighbours of some vectors of the sample."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, share: float | None = None, seed: int = SEED):
        rng = np.random.default_rng(seed)
        depth = min(DEEPEST, max(0, int(np.log2(max(len(sample), 1) / LEAF_SAMPLE)) if len(sample) > LEAF_SAMPLE else 0))
        self.depth, self.size = depth, len(sample)
        self.trees = [Tree(sample, depth, rng) for _ in range(trees)]
        self.members = []
        for tree in self.trees:
            order = np.argsort(tree.leaf, kind="stable")
            edges = np.searchsorted(tree.leaf[order], np.arange((1 << depth) + 1))
            self.members.append([order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)])

        self.share = self._measured(sample, rng) if share is None else share

    def _measured(self, sample: np.ndarray, rng: np.random.Generator) -> float:
        """A quantile, over true neighbours, of the share covered when each is found."""
        found = []
        for i in rng.permutation(len(sample))[:PROBES]:
            distance = ((sample - sample[i]) ** 2).sum(axis=1)
            distance[i] = np.inf
            near = np.argsort(distance, kind="stable")[: min(NEIGHBOURS, len(sample) - 1)]
            at = np.zeros(len(sample), dtype=np.int64)
            for _, _, new, count in self._visits(sample[i]):
                at[new] = count
                if at[near].all():
                    break
            found += at[near].tolist()
        return float(np.quantile(found, RECALL) / self.size) if found else 1.0

    def _visits(self, query: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, int]]:
        """Tree, leaf, sample vectors that no leaf before held, and how many have been seen.
        All trees share one queue: what is nearest to the query, by the squares of the
        distances to the hyperplanes crossed, comes first."""
        inner = (1 << self.depth) - 1
        margins = [tree.normals @ query - tree.cuts for tree in self.trees]
        queue = [(0.0, t, 0) for t in range(len(self.trees))]
        covered, count = np.zeros(self.size, dtype=bool), 0
        while queue:
            far, t, node = heapq.heappop(queue)
            while node < inner:
                margin = margins[t][node]
                near = 2 * node + 1 + (margin >= 0)
                heapq.heappush(queue, (far + margin * margin, t, 4 * node + 3 - near))
                node = near
            leaf = node - inner
            rows = self.members[t][leaf]
            new = rows[~covered[rows]]
            covered[new] = True
            count += len(new)
            yield t, leaf, new, count

    def probes(self, query: np.ndarray) -> list[tuple[int, int]]:
        """(tree, leaf) to look into, until the leaves hold ``share`` of the sample, each
        vector counted once; a leaf of every tree at least."""
        out = []
        for t, leaf, _, count in self._visits(query):
            out.append((t, leaf))
            if count >= self.share * self.size and len(out) >= len(self.trees):
                break
        return out


def usable(vector: str) -> Column:
    """Not null, not empty, not zero, all components finite."""
    return F.expr(
        f"{vector} is not null and exists({vector}, x -> x <> 0)"
        f" and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def classes(vectors: DataFrame) -> DataFrame:
    """``class_id`` (its smallest id), ``vector``, ``ids``: distinct vectors with the
    smallest ids that have them, one more than neighbours are asked for: no other id of
    equal vectors can be among the nearest. A class is cut down in parts first."""
    part = F.pmod(F.col("vec_id"), F.lit(16))
    some = Window.partitionBy("vector", "part").orderBy("vec_id")
    rows = vectors.withColumn("part", part).withColumn("_n", F.row_number().over(some))
    rows = rows.where(F.col("_n") <= NEIGHBOURS + 1).drop("_n", "part")
    whole = Window.partitionBy("vector").orderBy("vec_id")
    rows = rows.withColumn("_n", F.row_number().over(whole)).where(F.col("_n") <= NEIGHBOURS + 1)
    found = rows.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    return found.select(F.col("ids")[0].alias("class_id"), "vector", "ids")


def fit(index: DataFrame) -> Forest:
    """Fitted on a bounded sample of the distinct vectors, drawn by a hash of their ids."""
    n = index.count()
    place = F.pmod(F.xxhash64("class_id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    got = index.where(place < min(1.0, SAMPLE / max(n, 1))).select("class_id", "vector").toArrow()
    got = got.combine_chunks().sort_by("class_id")
    sample = _matrix(got.column("vector").combine_chunks()).astype(np.float64) if got.num_rows else np.zeros((0, 1))
    return Forest(sample)


ROUTED = "tree int, leaf int, part int, is_query boolean, id long, vector binary, ids array<long>"


def _batch(tree, leaf, part, is_query, ids, vectors, members) -> pa.RecordBatch:
    n = len(tree)
    columns = [
        pa.array(tree, type=pa.int32()),
        pa.array(leaf, type=pa.int32()),
        pa.array(part, type=pa.int32()),
        pa.array([is_query] * n, type=pa.bool_()),
        pa.array(ids, type=pa.int64()),
        pa.array(vectors, type=pa.binary()),
        pa.array(members, type=pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in ROUTED.split(", ")])


def _route_rows(index: DataFrame, forest, parts: int) -> DataFrame:
    """Every distinct vector, to its leaf of each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                block = batch.slice(at, 1024)
                vectors, ids = _matrix(block.column("vector")), block.column("class_id").to_numpy()
                raw, members = [v.tobytes() for v in vectors], block.column("ids").to_pylist()
                for t, tree in enumerate(forest.value.trees):
                    leaf = tree.leaves(vectors.astype(np.float64))
                    yield _batch(np.full(len(ids), t), leaf, ids % parts, False, ids, raw, members)

    return in_batches(index).mapInArrow(run, ROUTED)


def _route_queries(asked: DataFrame, forest, parts: int) -> DataFrame:
    """Every distinct query vector, to the leaves that its search looks into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, ids = _matrix(batch.column("vector")), batch.column("class_id").to_numpy()
            for vector, i in zip(vectors, ids, strict=True):
                found = [(t, leaf, p) for t, leaf in forest.value.probes(vector.astype(np.float64)) for p in range(parts)]
                tree, leaf, part = zip(*found, strict=True)
                n = len(found)
                yield _batch(tree, leaf, part, True, [i] * n, [vector.tobytes()] * n, [[]] * n)

    return in_batches(asked).mapInArrow(run, ROUTED)


class _Best:
    """The nearest distinct vectors of each query so far."""

    def __init__(self) -> None:
        self.found: dict[int, tuple[np.ndarray, np.ndarray, list]] = {}

    def add(self, query: int, distance: np.ndarray, ids: np.ndarray, members: list) -> None:
        if query in self.found:
            had = self.found[query]
            distance, ids = np.concatenate([had[0], distance]), np.concatenate([had[1], ids])
            members = had[2] + members
        order = np.lexsort((ids, distance))
        _, first = np.unique(ids[order], return_index=True)  # several trees find the same
        order = order[np.sort(first)][: NEIGHBOURS + 1]
        self.found[query] = (distance[order], ids[order], [members[i] for i in order])

    def batches(self) -> Iterator[pa.RecordBatch]:
        items = list(self.found.items())
        for at in range(0, len(items), 4096):
            some = items[at : at + 4096]
            columns = [
                pa.array([q for q, _ in some], type=pa.int64()),
                pa.array([x[0] for _, x in some], type=pa.list_(pa.float64())),
                pa.array([x[1] for _, x in some], type=pa.list_(pa.int64())),
                pa.array([x[2] for _, x in some], type=pa.list_(pa.list_(pa.int64()))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "distances", "classes", "members"])
        self.found = {}


FOUND = "query long, distances array<double>, classes array<long>, members array<array<long>>"


def _compare(routed: DataFrame, kind: np.dtype) -> DataFrame:
    """Exact distances within each leaf, and of each query the nearest of a task's leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, rows, asked, best = None, [], [], _Best()

        def close() -> None:
            if not rows or not asked:
                return
            x = np.frombuffer(b"".join(r[1] for r in rows), dtype=kind).reshape(len(rows), -1).astype(np.float64)
            ids = np.array([r[0] for r in rows])
            for at in range(0, len(asked), 64):
                some = asked[at : at + 64]
                q = np.frombuffer(b"".join(r[1] for r in some), dtype=kind).reshape(len(some), -1).astype(np.float64)
                for (query, _), vector in zip(some, q, strict=True):
                    distance = np.sqrt(((x - vector) ** 2).sum(axis=1))
                    k = min(NEIGHBOURS + 1, len(ids))
                    # all that tie with the last one too
                    near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
                    best.add(query, distance[near], ids[near], [rows[i][2] for i in near])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for tree, at, part, is_query, i, vector, members in zip(*columns, strict=True):
                if (tree, at, part) != leaf:
                    close()
                    leaf, rows, asked = (tree, at, part), [], []
                    if len(best.found) > HELD_QUERIES:
                        yield from best.batches()
                if is_query:
                    asked.append((i, vector))
                else:
                    rows.append((i, vector, members))
        close()
        yield from best.batches()

    dealt = routed.repartition(shuffle_partitions(routed.sparkSession), "tree", "leaf", "part")
    return dealt.sortWithinPartitions("tree", "leaf", "part", "is_query").mapInArrow(run, FOUND)


def _merge(found: DataFrame) -> DataFrame:
    """Of each query the nearest of all tasks: ``query``, ``near`` (distance, id), nearest
    first, one more than asked for, ids of equal vectors each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, best = None, _Best()

        def close() -> pa.RecordBatch:
            distances, _, members = best.found.pop(query)
            near = sorted((d, i) for d, ids in zip(distances.tolist(), members, strict=True) for i in ids)
            near = [{"score": d, "vec_id": i} for d, i in near[: NEIGHBOURS + 1]]
            kind = pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())]))
            return pa.RecordBatch.from_arrays([pa.array([query], type=pa.int64()), pa.array([near], type=kind)], names=["query", "near"])

        for batch in batches:
            for q, d, c, m in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if q != query:
                    if query is not None:
                        yield close()
                    query = q
                best.add(q, np.array(d), np.array(c), m)
        if query is not None:
            yield close()

    dealt = found.repartition(shuffle_partitions(found.sparkSession), "query").sortWithinPartitions("query")
    return dealt.mapInArrow(run, "query long, near array<struct<score:double,vec_id:long>>")


def nearest(embeddings: DataFrame, is_query: Column) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows of ``embeddings``
    (``vec_id``, ``embedding``) that are queries: up to ten nearest others found, by
    Euclidean distance in double precision, ties to the smaller id.

    Vectors that are null, empty, zero or hold a null or non-finite component take no
    part; nor do those of another length than most have, nor rows without an id. Rows
    that repeat id and vector count once. Equal vectors are searched once and are each
    other's nearest. With fewer candidates there are fewer rows; an empty table gives
    none. Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector"))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("vector") == (lengths.n if lengths else 0))
    index = stage(classes(rows), "ann-classes")
    kind = np.dtype("<f4" if dict(embeddings.dtypes)["embedding"] == "array<float>" else "<f8")
    if kind == np.dtype("<f8"):
        index = index.withColumn("vector", F.col("vector").cast("array<double>"))
    shared = spark.sparkContext.broadcast(fit(index))
    parts = 1 + index.count() // ((1 << shared.value.depth) * LEAF_ROWS)
    queries = rows.where(is_query).distinct()
    if kind == np.dtype("<f8"):
        queries = queries.withColumn("vector", F.col("vector").cast("array<double>"))
    queries = stage(queries.join(index.select("vector", "class_id"), "vector").select("vec_id", "class_id"), "ann-queries")
    asked = index.join(queries.select("class_id").distinct(), "class_id", "left_semi").select("class_id", "vector")
    routed = _route_rows(index, shared, parts).unionByName(_route_queries(asked, shared, parts))
    found = _merge(_compare(routed, kind))
    own = queries.join(found, queries["class_id"] == found["query"])
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("vec_id")), 1, NEIGHBOURS)
    out = own.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("place", "near"))
    return out.select("query_id", (F.col("place") + 1).alias("rank"), "near.vec_id", "near.score")


def op4_shared_queue_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
