"""Near duplicates: documents whose sets of word shingles have a Jaccard similarity of at
least a given percentage, found through shared segments and verified exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import (
    blocks,
    broadcast_if_small,
    checkpointed,
    in_batches,
    read_table,
    shuffle_partitions,
    stage,
    text_buffer,
)
from skyledger.llm.components import connected_components
from skyledger.llm.shingles import Bands, common_count, set_keys, set_names, shingle_sets

WORDS, SHARE = 4, 85
#: Segment keys in a bucket, on average; a task holds one bucket at a time.
BUCKET_KEYS = 1_000_000
#: Keys that a task gathers, about, before it sends them on.
FLUSH_KEYS = 400_000
#: Sets of a block at most, and shingles in all of them, about; two blocks at a time are
#: compared in a task.
BLOCK = 4096
BLOCK_SHINGLES = 1 << 20
#: Bytes of sets that a task hands on at a time.
UNIT_BYTES = 1 << 20
#: Rows of a table of ids that is sent to every executor; larger ones are joined by shuffle.
MOST_IDS = 500_000
#: Likewise of a table of a number alone.
MOST_KEYS = 2_000_000

_RECORD = np.dtype([("key", "<u4"), ("name", "<i8"), ("flags", "u1")])
INDEXED, PROBING, SHARED = 1, 2, 4


def _row_key() -> Column:
    """Names a row whose id is null by its text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def _text_key() -> Column:
    return F.xxhash64("text")


def document_sets(docs: DataFrame, words: int, with_text_key: bool = False) -> DataFrame:
    """``doc_id``, ``row_key``, ``n_shingles``, ``name``, ``name2`` (the set, in 128 bits) for
    every row, and ``text_key``, a hash of its text, if wanted."""
    keys = ["doc_id", "row_key", *["text_key"] * with_text_key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            values, cuts = shingle_sets(*text_buffer(block.column("text")), words)
            first, second = set_names(values, cuts)
            yield pa.RecordBatch.from_arrays(
                [
                    *[block.column(k) for k in keys],
                    pa.array(np.diff(cuts)),
                    pa.array(first.view(np.int64)),
                    pa.array(second.view(np.int64)),
                ],
                names=[*keys, "n_shingles", "name", "name2"],
            )

    made = {"doc_id": F.col("doc_id").cast("long"), "row_key": _row_key(), "text_key": _text_key()}
    rows = docs.select(*[made[k].alias(k) for k in keys], "text")
    return in_batches(rows).mapInArrow(run, ", ".join(f"{k} long" for k in [*keys, "n_shingles", "name", "name2"]))


def _packed(keys: list, names: list, flags: list, buckets: int, turn: int) -> Iterator[tuple[int, bytes, bool]]:
    """Records by bucket. Of a key that several sets here have, one record goes to its
    bucket, marked SHARED; the others are known to share it and go anywhere."""
    key, name, flag = np.concatenate(keys), np.concatenate(names), np.concatenate(flags)
    bucket = (key >> np.uint64(32)) % np.uint64(buckets)
    short = key.astype(np.uint32)
    order = np.argsort((bucket << np.uint64(32)) | short, kind="stable")
    bucket, short, name, flag = bucket[order].astype(np.int64), short[order], name[order], flag[order]
    again = np.zeros(len(order), dtype=bool)
    again[1:] = (bucket[1:] == bucket[:-1]) & (short[1:] == short[:-1])
    shared = again.copy()
    shared[:-1] |= again[1:]
    records = np.empty(len(order), dtype=_RECORD)
    records["key"], records["name"] = short, name
    records["flags"] = flag | (shared * SHARED).astype(np.uint8)
    ones, place = records[~again], bucket[~again]
    edges = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
    for begin, end in zip(edges, np.append(edges[1:], len(place)), strict=True):
        yield int(place[begin]), ones[begin:end].tobytes(), False
    if again.any():
        known = np.empty(int(again.sum()), dtype=[("at", "<i8"), ("record", _RECORD)])
        known["at"], known["record"] = bucket[again], records[again]
        yield turn % buckets, known.tobytes(), True


def shared_keys(docs: DataFrame, words: int, bands: Bands, buckets: int) -> DataFrame:
    """``key``, ``name``, ``flags``: the segment keys that more than one set has, one of
    them to probe and one of the index.

    Keys are made in the tasks and sent to buckets in blocks of records. A task sends the
    keys of a set once, however many copies it reads, and of a key that many of its sets
    have only one record to the bucket: neither copies nor near copies swell a bucket.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId()
        seen: set[int] = set()
        keys, names, flags, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            rows = list(_packed(keys, names, flags, buckets, turn))
            for x in (keys, names, flags):
                x.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], type=pa.int32()),
                    pa.array([r[1] for r in rows], type=pa.binary()),
                    pa.array([r[2] for r in rows], type=pa.bool_()),
                ],
                names=["bucket", "records", "known"],
            )

        for block in blocks(batches, "text"):
            values, cuts = shingle_sets(*text_buffer(block.column("text")), words)
            first = set_names(values, cuts)[0].view(np.int64)
            new = np.zeros(len(first), dtype=bool)
            for r, name in enumerate(first.tolist()):
                new[r] = name not in seen
                seen.add(name)
            sizes = np.diff(cuts)
            values, cuts = values[np.repeat(new, sizes)], np.concatenate([[0], np.cumsum(sizes[new])])
            for row, key, indexed, probing in set_keys(values, cuts, bands):
                keys.append(key)
                names.append(first[new][row])
                flags.append((indexed * INDEXED + probing * PROBING).astype(np.uint8))
                held += len(key)
                if held >= FLUSH_KEYS:
                    yield flush()
                    held, turn = 0, turn + 1
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []

        def rows(at: np.ndarray, records: np.ndarray) -> pa.RecordBatch:
            key = (at.astype(np.int64) << 32) | records["key"].astype(np.int64)
            columns = [pa.array(key), pa.array(records["name"]), pa.array(records["flags"].astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, names=["key", "name", "flags"])

        def close() -> pa.RecordBatch:
            records = np.frombuffer(b"".join(parts), dtype=_RECORD)
            records = records[np.argsort(records["key"].copy(), kind="stable")]
            same = records["key"][1:] == records["key"][:-1]
            several = (records["flags"] & SHARED) > 0
            several[1:] |= same
            several[:-1] |= same
            records = records[several]
            if not len(records):
                return rows(np.zeros(0, np.int64), records)
            records = records[np.lexsort((records["name"], records["key"]))]
            new_key = np.append(True, records["key"][1:] != records["key"][:-1])
            new_name = np.append(True, records["name"][1:] != records["name"][:-1]) | new_key
            # a set comes once, however many tasks have read it
            edges = np.flatnonzero(new_name)
            flags = np.bitwise_or.reduceat(records["flags"], edges)
            records, new_key = records[edges], new_key[edges]
            records["flags"] = flags
            edges = np.flatnonzero(new_key)
            flags = np.bitwise_or.reduceat(flags, edges)
            meets = (np.diff(np.append(edges, len(records))) > 1) & (flags & (INDEXED | PROBING) == INDEXED | PROBING)
            # other sets of a SHARED one are elsewhere
            found = records[(meets | (flags & SHARED > 0))[np.cumsum(new_key) - 1]]
            return rows(np.full(len(found), bucket), found)

        for batch in batches:
            for at, records, known in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if known:
                    whole = np.frombuffer(records, dtype=[("at", "<i8"), ("record", _RECORD)])
                    yield rows(whole["at"], whole["record"])
                    continue
                if at != bucket:
                    if parts:
                        yield close()
                    bucket, parts = at, []
                parts.append(records)
        if parts:
            yield close()

    sent = in_batches(docs.select("text")).mapInArrow(emit, "bucket int, records binary, known boolean")
    dealt = sent.repartition(shuffle_partitions(docs.sparkSession), "bucket")
    return dealt.sortWithinPartitions("bucket").mapInArrow(meet, "key long, name long, flags int")


def candidate_groups(found: DataFrame, classes: DataFrame) -> DataFrame:
    """``center``, ``member``, ``row_key``, ``size``: each set with the centers of the lists it is in.

    Of the sets that share a key, one is the center: the one whose keys are shared most,
    as the text that others were copied from is. Two sets that may be similar are in a
    list together, and so in the group of its center. Centers are members too.
    """
    by_key = Window.partitionBy("key")
    rows = found.repartition("key").groupBy("key", "name").agg(F.bit_or("flags").alias("flags"))
    flags = F.bit_or("flags").over(by_key).bitwiseAND(INDEXED + PROBING)
    rows = rows.select("key", "name", F.count("*").over(by_key).alias("n"), flags.alias("flags"))
    rows = rows.where((F.col("n") > 1) & (F.col("flags") == INDEXED + PROBING))
    # names are numbers, ids texts: those are joined to the few rows left at the end
    rows = stage(rows.select("key", "name", "n"), "jaccard-lists")
    weights = rows.groupBy("name").agg(F.sum("n").alias("weight"))
    rows = rows.select("key", "name").join(weights, "name")
    top = F.max(F.struct("weight", "name")).over(by_key)
    pairs = rows.select("name", top["name"].alias("center_name")).distinct()
    named = classes.select("name", F.col("id").alias("member"), "row_key", F.col("n").alias("size"))
    centers = classes.select(F.col("name").alias("center_name"), F.col("id").alias("center"))
    pairs = pairs.join(centers, "center_name").join(named, "name")
    return checkpointed(pairs.select("center", "member", "row_key", "size"))


def _places(groups: DataFrame) -> DataFrame:
    """One row per member: the groups it is in, its block there and how many there are."""
    most = F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)
    sizes = groups.groupBy("center").agg(F.ceil(most).cast("int").alias("blocks"))
    # a table of its own: else one shuffle, by center, would serve the join too
    rows = groups.join(checkpointed(sizes), "center")
    block = F.pmod(F.xxhash64("member", F.lit(7)), F.col("blocks")).cast("int")
    place = F.struct("center", F.col("blocks"), block.alias("block"), (F.col("center") == F.col("member")).alias("is_center"))
    return rows.groupBy("member", "row_key").agg(F.collect_list(place).alias("places"))


UNIT = "center string, low int, high int, is_center boolean, block int, member string, shingles binary"


def _units(docs: DataFrame, places: DataFrame, words: int) -> DataFrame:
    """Sets of the members, once for each pair of blocks that theirs is compared in; a
    center comes to all of its group."""
    count = places.count()
    wanted = broadcast_if_small(places, count, MOST_IDS)
    rows = docs.select(_row_key().alias("row_key"), "text")
    if MOST_IDS < count <= MOST_KEYS:
        # only the texts that are wanted are shuffled
        rows = rows.join(F.broadcast(places.select("row_key")), "row_key", "left_semi")
    rows = rows.join(wanted, "row_key").select("member", "places", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            values, cuts = shingle_sets(*text_buffer(block.column("text")), words)
            first, second = set_names(values, cuts)
            members = block.column("member").to_pylist()
            out, held = [], 0
            for r, places in enumerate(block.column("places").to_pylist()):
                if f"{first[r]:016x}{second[r]:016x}" != members[r]:
                    continue  # another text of the same id
                raw = values[cuts[r] : cuts[r + 1]].tobytes()
                for p in places:
                    n, own = p["blocks"], p["block"]
                    if p["is_center"]:
                        pairs = [(i, j) for i in range(n) for j in range(i, n)]
                    else:
                        pairs = [(min(own, k), max(own, k)) for k in range(n)]
                    for i, j in pairs:
                        out.append((p["center"], i, j, p["is_center"], own, members[r], raw))
                        held += len(raw)
                        if held >= UNIT_BYTES:
                            yield batch(out)
                            out, held = [], 0
            if out:
                yield batch(out)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in UNIT.split(", ")]
        columns = [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, UNIT)


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Of each set (a column) for each of some bits whether an odd number of its shingles
    fall on it. Two columns differ in at most as many bits as the sets do in shingles."""
    bits = 64 * -(-2 * max(map(len, sets)) // 64)
    out = np.empty((bits // 64, len(sets)), dtype=np.uint64)
    for r, values in enumerate(sets):
        odd = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        out[:, r] = np.packbits(odd.astype(np.uint8)).view(np.uint64)
    return out


def _links(sets: list[tuple[bool, int, str, np.ndarray]], low: int, high: int, share: int) -> list[tuple[str, str]]:
    """Links that join all sets of two blocks that are similar, directly or by others here.

    Every set is compared with the center, the first. The Jaccard distance is a metric, so
    two sets whose distances from the center differ by more than that of a link are not
    linked, nor are two whose bitmaps differ in more bits than similar sets do in shingles;
    sets that are joined already need no comparing; all other pairs are counted.
    """
    center, *rest = sets
    # pairs within a block are compared where the block meets itself
    rest = sorted(rest, key=lambda s: (low != high and s[1] == high, len(s[3])))
    if not rest:
        return []
    values = [center[3], *[s[3] for s in rest]]
    names = [center[2], *[s[2] for s in rest]]
    sizes = np.array([len(v) for v in values])
    common = np.array([sizes[0], *[common_count(values[0], v) for v in values[1:]]])
    union = sizes[0] + sizes - common
    distance = 1 - common / np.maximum(union, 1)
    near = 100 * common >= share * union
    label = np.where(near, 0, np.arange(len(values)))
    # links with the center are told where a block meets itself
    links = [(names[0], names[j]) for j in np.flatnonzero(near) if j] if low == high else []
    second = 1 + sum(s[1] != high for s in rest) if low != high else len(values)
    if low != high and second == len(values):
        return links
    bitmaps = None
    for i in range(1, second if low != high else second - 1):
        begin, end = (second, len(values)) if low != high else (i + 1, second)
        begin += int(np.searchsorted(100 * sizes[begin:end], share * sizes[i]))
        end = begin + int(np.searchsorted(share * sizes[begin:end], 100 * sizes[i], side="right"))
        left = label[begin:end] != label[i]
        left &= np.abs(distance[begin:end] - distance[i]) <= (100 - share) / 100 + 1e-9
        left = begin + np.flatnonzero(left)
        if not len(left):
            continue
        if bitmaps is None:
            bitmaps = _bitmaps(values)
        apart = np.bitwise_count(bitmaps[:, left] ^ bitmaps[:, i, None]).sum(axis=0, dtype=np.int64)
        left = left[apart * (100 + share) <= (sizes[left] + sizes[i]) * (100 - share)]
        for j in left.tolist():
            if label[j] == label[i]:
                continue
            both = common_count(values[i], values[j])
            if 100 * both >= share * (sizes[i] + sizes[j] - both):
                label[label == label[j]] = label[i]
                links.append((names[i], names[j]))
    return links


def verified_links(units: DataFrame, share: int) -> DataFrame:
    """``a``, ``b``: links between different sets that join whatever is similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, sets = None, {}

        def close() -> pa.RecordBatch:
            first = [s for s in sets.values() if s[0]]
            links = _links([*first, *[s for s in sets.values() if not s[0]]], unit[1], unit[2], share) if first else []
            columns = [pa.array([x[k] for x in links], type=pa.string()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for center, low, high, is_center, block, member, raw in zip(*columns, strict=True):
                if (center, low, high) != unit:
                    if sets:
                        yield close()
                    unit, sets = (center, low, high), {}
                sets[member] = (is_center, block, member, np.frombuffer(raw, dtype=np.uint64))
        if sets:
            yield close()

    dealt = units.repartition(shuffle_partitions(units.sparkSession), "center", "low", "high")
    return dealt.sortWithinPartitions("center", "low", "high").mapInArrow(run, "a string, b string")


def components(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs`` (``doc_id``,
    ``text``): the size of its set of distinct shingles of ``words`` words and the smallest
    id that links reach. Two rows are linked if ``100 * intersection >= share * union``.

    Rows of equal sets are one class. Of its set a class makes segment keys (:class:`Bands`);
    classes that share one come to the center of that list, and what is similar there is
    linked after an exact count. No pair is stored; links and classes are joined to
    components by stars.

    Null and empty texts, and texts without a word, have an empty set, linked with nothing:
    their component is their own id. Texts of fewer words are one shingle. A null id is
    never a component's id unless all of it are null. Rows that repeat an id are judged each
    by its text. Texts are read whole. An empty table gives no rows; other columns are not
    read.
    """
    return _with_components(docs, words, share).select("doc_id", "n_shingles", "component_id")


def _with_components(docs: DataFrame, words: int, share: int, with_text_key: bool = False) -> DataFrame:
    """:func:`document_sets` with ``root``, a name of the component (null: an empty set), and
    ``component_id``."""
    bands = Bands(share)
    rows = stage(document_sets(docs, words, with_text_key), "jaccard-sets")
    own_id = F.format_string("%016x%016x", "name", "name2")
    filled = rows.where("n_shingles > 0")
    classes = filled.groupBy("name", "name2").agg(
        F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"), F.max("n_shingles").alias("n")
    )
    classes = stage(classes.withColumn("id", own_id), "jaccard-classes")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(shuffle_partitions(docs.sparkSession), int(shingles * (100 - share) / 50 / BUCKET_KEYS) + 1)
    found = shared_keys(docs, words, bands, buckets)
    groups = candidate_groups(found, classes)
    links = checkpointed(verified_links(_units(docs, _places(groups), words), share).distinct())
    roots = checkpointed(connected_components(links, "a", "b"))
    joined = classes.join(roots, classes["id"] == roots["node"], "left").withColumn("root", F.coalesce("root", "id"))
    # a table of its own: else one shuffle, by root, would serve the join too
    lowest = checkpointed(joined.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    named = joined.join(lowest, "root").select("name", "name2", "root", "component_id")
    own = rows.join(named, ["name", "name2"], "left")
    # an empty set has a name too, but no class
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return own.withColumn("component_id", component)


def without_near_duplicates(docs: DataFrame, words: int = 5, share: int = 80) -> DataFrame:
    """The rows of ``docs``, all their columns, but of each component only one row: of those
    with the smallest id (no id: last) that of the smallest hash of its text, of rows of one
    id and text any. Rows without a word are in no component: all stay."""
    found = _with_components(docs, words, share, with_text_key=True).where("n_shingles > 0")
    found = stage(found.select("doc_id", "row_key", "text_key", "root", "component_id"), "jaccard-components")
    first = found.where("doc_id <=> component_id")
    tied = first.groupBy("root").agg(F.count("*").alias("n"), F.min("text_key").alias("chosen"))
    tied = checkpointed(tied.where("n > 1").select("root", "chosen"))
    n_tied = tied.count()
    dropped = found.where("not doc_id <=> component_id").select("row_key", "text_key")
    if n_tied:
        others = first.join(broadcast_if_small(tied, n_tied, MOST_IDS), "root").where("text_key <> chosen")
        dropped = dropped.union(others.select("row_key", "text_key"))
    dropped = checkpointed(dropped.distinct())
    dropped = broadcast_if_small(dropped, dropped.count(), MOST_IDS)

    def same(keys: DataFrame) -> Column:
        return (row_key == keys["row_key"]) & (text_key == keys["text_key"])

    row_key = F.coalesce(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]))
    text_key = F.xxhash64(docs["text"])
    kept = docs.join(dropped, same(dropped), "left_anti")
    if not n_tied:
        return kept
    again = first.join(broadcast_if_small(tied, n_tied, MOST_IDS), "root").where("text_key = chosen")
    again = checkpointed(again.groupBy("row_key", "text_key").count().where("count > 1").select("row_key", "text_key"))
    again = broadcast_if_small(again, again.count(), MOST_IDS)
    copies = kept.join(again, same(again), "left_semi").withColumns({"_row_key": row_key, "_text_key": text_key})
    return kept.join(again, same(again), "left_anti").unionByName(
        copies.dropDuplicates(["_row_key", "_text_key"]).drop("_row_key", "_text_key")
    )


def op5_segment_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read_table(spark, sf_dir, "documents"))
