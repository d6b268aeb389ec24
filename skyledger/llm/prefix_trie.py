"""The prefix trie of conversations: Spark SQL's ROLLUP over positional turn-id columns makes
all prefixes of a block of turns together; later blocks are keyed by the node that the block
before them ends at."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import broadcast_if_small, in_batches, read_table, shuffle_partitions, stage

#: Turns of a block, each a column of the rollup.
BLOCK = 8
#: Blocks, or levels of the trie, that a window runs over at most; longer conversations
#: have sums of whole stretches between.
STRETCH = 1024
#: Rows of a table sent to every executor; larger ones are joined by shuffle.
MOST_ROWS = 200_000
#: Bytes of joined ids that are handed on at a time.
CHUNK = 1 << 16

NO_ENDS = hashlib.sha256(b"").hexdigest()
_SLOTS = range(1, BLOCK + 1)
_TURNS = [f"t{k}" for k in _SLOTS]


def turn_id() -> Column:
    """Names role and text by 16 bytes; 4 more tell the code points of the text."""
    named = F.expr("unhex(md5(concat(char_length(role), ':', role, text)))")
    return F.concat(named, F.expr("unhex(lpad(hex(char_length(text)), 8, '0'))"))


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``turn_id`` of every turn.

    Rows are sorted over all partitions and numbered in each; a conversation that goes on
    in the next one starts there at the sum of what it had before. So a conversation may
    be of any length, and its turns are never brought together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, had = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column("conv_id").to_numpy()
            first = np.append(True, conv[1:] != conv[:-1])
            begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
            pos = np.arange(n) - begin + 1
            if conv[0] == last:
                pos[begin == 0] += had
            last, had = conv[-1], int(pos[-1])
            columns = [pa.array(np.full(n, part, dtype=np.int32)), batch.column("conv_id"), pa.array(pos), batch.column("turn_id")]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "conv_id", "pos", "turn_id"])

    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # the last key spreads rows that are equal in all others
    rows = rows.select("conv_id", "turn", "role", turn_id().alias("turn_id"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", "turn_id", "row"]
    dealt = rows.repartitionByRange(shuffle_partitions(conversations.sparkSession), *order).sortWithinPartitions(*order)
    dealt = in_batches(dealt.select("conv_id", "turn_id"))
    local = stage(dealt.mapInArrow(run, "part int, conv_id long, pos long, turn_id binary"), "trie-turns")
    # one conversation for each partition; only these may have begun in an earlier one
    cut = local.groupBy("part").agg(F.min("conv_id").alias("conv_id")).select("conv_id").distinct()
    cut = local.join(F.broadcast(cut), "conv_id").groupBy("conv_id", "part").agg(F.max("pos").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("before", F.sum("n").over(earlier)).where("before > 0").select("conv_id", "part", "before")
    rows = local.join(F.broadcast(cut), ["conv_id", "part"], "left")
    return rows.select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "turn_id")


def rebuilt(turns: DataFrame, group: int = 100, most_shared: int = 6) -> DataFrame:
    """``conv_id``, ``n``, ``pos``, ``turn_id``: of every conversation c the first h turns of
    conversation c - c % ``group``, then its own after its first h; h is crc32(c) modulo
    ``most_shared``. One without turns has a row with null position."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < most_shared)).groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("pos", "turn_id"))).alias("head"))
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).select("conv_id", "own", shared.alias("h"), base.alias("base"))
    head = F.coalesce(F.slice("head", 1, F.col("h").cast("int")), F.array())
    convs = convs.join(heads, "base", "left").select("conv_id", "own", "h", head.alias("head"))
    length = F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = stage(convs.select("conv_id", "h", "head", length.cast("long").alias("n")), "trie-conversations")
    begun = convs.select("conv_id", "n", F.explode("head").alias("x")).select("conv_id", "n", "x.pos", "x.turn_id")
    bare = convs.where("n = 0").selectExpr("conv_id", "n", "cast(null as long) as pos", "cast(null as binary) as turn_id")
    known = convs.select("conv_id", "n", "h", (F.size("head") - F.col("h")).alias("moved"))
    own = turns.join(broadcast_if_small(known, convs.count(), MOST_ROWS), "conv_id").where("pos > h")
    own = own.select("conv_id", "n", (F.col("pos") + F.col("moved")).alias("pos"), "turn_id")
    return begun.unionByName(own).unionByName(bare)


def _lanes(pos: str, turn: str) -> tuple[str, str]:
    """128 bits of a turn at its place; the xor over a prefix names its node."""
    return tuple(f"xxhash64({salt}, cast({pos} as bigint), {turn})" for salt in (1, 2))


def blocks_of(rebuilt: DataFrame) -> DataFrame:
    """``conv_id``, ``n``, ``block``, ``prior_a``, ``prior_b`` (the node that the block
    before ends at), and the turn ids of the block, null beyond the conversation's end."""
    a, b = _lanes("pos", "turn_id")
    rows = rebuilt.selectExpr(
        "conv_id", "n", f"coalesce((pos - 1) div {BLOCK}, 0L) as block", f"cast((pos - 1) % {BLOCK} as int) as slot", "turn_id",
        f"if(pos is null, 0L, {a}) as a", f"if(pos is null, 0L, {b}) as b",
    )
    turns = F.map_from_entries(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "turn_id"))))
    rows = rows.groupBy("conv_id", "block").agg(
        F.max("n").alias("n"), turns.alias("turns"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")
    )
    named = [F.col("turns")[k - 1].alias(f"t{k}") for k in _SLOTS]
    rows = stage(rows.select("conv_id", "n", "block", "a", "b", *named), "trie-blocks")
    keep = ["conv_id", "n", "block", "prior_a", "prior_b", *_TURNS]
    short = rows.where(F.col("n") <= BLOCK).withColumns({"prior_a": F.lit(0).cast("long"), "prior_b": F.lit(0).cast("long")})
    long = rows.where(F.col("n") > BLOCK).withColumn("stretch", F.expr(f"block div {STRETCH}"))
    # xor within a stretch of blocks, and over the stretches before
    parts = long.groupBy("conv_id", "stretch").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    outer = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("conv_id", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "stretch", *[F.bit_xor(x).over(outer).alias(f"far_{x}") for x in ("a", "b")])
    long = long.withColumns({f"near_{x}": F.bit_xor(x).over(inner) for x in ("a", "b")}).join(parts, ["conv_id", "stretch"])
    prior = {f"prior_{x}": F.expr(f"coalesce(near_{x}, 0L) ^ coalesce(far_{x}, 0L)") for x in ("a", "b")}
    return short.select(*keep).unionByName(long.withColumns(prior).select(*keep))


def _node(lane: str, level: str) -> str:
    """One lane of the name of the block's prefix of ``level`` turns."""
    steps = [_lanes(f"block * {BLOCK} + {k}", f"t{k}")[lane == "b"] for k in _SLOTS]
    return " ^ ".join([f"prior_{lane}", *[f"if({level} >= {k}, {step}, 0L)" for k, step in zip(_SLOTS, steps, strict=True)]])


def rolled_up(blocks: DataFrame, measures: str) -> DataFrame:
    """``measures`` (SQL aggregates) of every node over the rows of ``blocks`` below it, with
    the node's ``block``, prior and turn ids, and its ``level``, the turns in its block.

    The rollup makes the prefixes of all blocks in one aggregation. Level 0 is the root in
    the first block and the node before in others, where it is left out, as are levels
    past the end of a conversation: both before rows are shuffled.
    """
    last = " ".join(f"when {k} then t{k}" for k in _SLOTS)
    return blocks.sparkSession.sql(
        f"""
        select * from (
          select block, prior_a, prior_b, {", ".join(_TURNS)}, {BLOCK} - bit_count(grouping_id()) as level, {measures}
          from {{blocks}}
          group by block, prior_a, prior_b, rollup ({", ".join(_TURNS)}))
        where if(level = 0, block = 0, case level {last} end is not null)
        """,
        blocks=blocks,
    )


def nodes_of(blocks: DataFrame) -> DataFrame:
    """``a``, ``b`` (the node's name), ``up_a``, ``up_b`` (its parent's), ``depth``,
    ``conv_id`` (smallest member), ``n_convs``, ``chars`` of its last text."""
    rows = rolled_up(blocks, "min(conv_id) as conv_id, count(*) as n_convs")
    last = f"get(array({', '.join(_TURNS)}), level - 1)"
    chars = f"coalesce(cast(conv(hex(substring({last}, 17, 4)), 16, 10) as bigint), 0L)"
    named = [f"{_node(x, 'level')} as {x}" for x in ("a", "b")] + [f"{_node(x, 'level - 1')} as up_{x}" for x in ("a", "b")]
    return rows.selectExpr(*named, f"block * {BLOCK} + level as depth", "conv_id", "n_convs", f"{chars} as chars")


def _sums_below(nodes: DataFrame, deepest: int) -> DataFrame:
    """``own_saved``, ``own_leaves``: sums over the nodes of the same smallest member from
    this one down. A conversation is the smallest member of one stretch of its path, as
    members only grow fewer on the way down."""
    values = ("saved", "leaves")
    rows = nodes.withColumn("stretch", F.expr(f"depth div {STRETCH}"))
    inner = Window.partitionBy("conv_id", "stretch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"own_{v}": F.sum(v).over(inner) for v in values})
    if deepest < STRETCH:
        return rows
    outer = Window.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    parts = nodes.groupBy("conv_id", F.expr(f"depth div {STRETCH}").alias("stretch")).agg(*[F.sum(v).alias(v) for v in values])
    parts = parts.select("conv_id", "stretch", *[F.coalesce(F.sum(v).over(outer), F.lit(0)).alias(f"far_{v}") for v in values])
    rows = rows.join(parts, ["conv_id", "stretch"])
    return rows.withColumns({f"own_{v}": F.col(f"own_{v}") + F.col(f"far_{v}") for v in values})


def ends_digests(ends: DataFrame) -> DataFrame:
    """``a``, ``b``, ``ends_sha256``: of the ids that end at each node, in order, joined by
    commas. Ids are sorted over all partitions and joined there in pieces; a digest is fed
    these one by one, so that neither the ids of a node nor their text are ever gathered."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, held = None, 0, [], 0
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "first", "ids"])

        for got in batches:
            for a, b, conv in zip(*(got.column(c).to_pylist() for c in ("a", "b", "conv_id")), strict=True):
                if (a, b) != node or held >= CHUNK:
                    if ids:
                        rows.append((*node, first, ",".join(ids)))
                    if len(rows) == 4096 or held >= CHUNK:
                        yield batch()
                    node, first, ids, held = (a, b), conv, [], 0
                ids.append(str(conv))
                held += len(ids[-1]) + 1
        if ids:
            rows.append((*node, first, ",".join(ids)))
            yield batch()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, rows = None, None, []

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "ends_sha256"])

        for got in batches:
            for a, b, ids in zip(*(got.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
                if (a, b) == node:
                    digest.update(b",")
                else:
                    if node:
                        rows.append((*node, digest.hexdigest()))
                    node, digest = (a, b), hashlib.sha256()
                digest.update(ids.encode())
            if len(rows) >= 4096:
                yield batch()
        if node:
            rows.append((*node, digest.hexdigest()))
            yield batch()

    parts, order = shuffle_partitions(ends.sparkSession), ["a", "b", "conv_id"]
    sorted_ends = in_batches(ends.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    joined = sorted_ends.mapInArrow(pieces, "a long, b long, first long, ids string")
    dealt = joined.repartition(parts, "a", "b").sortWithinPartitions("a", "b", "first")
    return dealt.mapInArrow(digests, "a long, b long, ends_sha256 string")


def trie(blocks: DataFrame) -> DataFrame:
    """A row for each node, from blocks of turns (:func:`blocks_of`).

    A node counts what is below it without a walk over levels: each node stands on the path
    of its smallest member, so a subtree has the nodes of its own smallest member from there
    on, summed along that path, and all those that stand on the paths of its other members,
    whose totals a second rollup brings to every prefix above.
    """
    blocks = stage(blocks, "trie-rows")
    nodes = stage(nodes_of(blocks), "trie-prefixes")
    facts = nodes.agg(F.max("depth").alias("deepest"), F.min("conv_id").alias("root")).first()
    children = nodes.where("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    counted = {"saved": (F.col("n_convs") - 1) * F.col("chars"), "leaves": (F.col("n_children") == 0).cast("long")}
    nodes = stage(nodes.withColumns(counted), "trie-nodes")
    # of each smallest member: its totals, and its first node
    totals = nodes.groupBy("conv_id").agg(
        F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"), F.min(F.struct("depth", "a", "b", "up_a", "up_b")).alias("top")
    )
    totals = stage(totals.select("conv_id", "saved", "leaves", "top.*"), "trie-members")
    above = blocks.join(totals.where("depth > 0").select("conv_id", "depth", "saved", "leaves"), "conv_id")
    above = above.where(f"block = 0 or block * {BLOCK} < depth - 1")
    cut = [f"if(block * {BLOCK} + {k} < depth, t{k}, null) as t{k}" for k in _SLOTS]
    above = above.selectExpr("block", "prior_a", "prior_b", *cut, "saved", "leaves")
    others = rolled_up(above, "sum(saved) as other_saved, sum(leaves) as other_leaves")
    others = others.selectExpr(f"{_node('a', 'level')} as a", f"{_node('b', 'level')} as b", "other_saved", "other_leaves")
    # all that branches off the root has the same parent
    branches = totals.where("depth > 1").select("a", "b", "up_a", "up_b")
    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent"))
    parents = branches.join(parents, ["up_a", "up_b"]).select("a", "b", "parent")
    tops = totals.where("depth = 1").select("a", "b", F.lit(facts.root).cast("long").alias("parent"))
    level = f"n - block * {BLOCK}"
    ends = blocks.where(f"n <= (block + 1) * {BLOCK}")
    ends = ends.selectExpr(f"{_node('a', level)} as a", f"{_node('b', level)} as b", "conv_id")
    rows = _sums_below(nodes, facts.deepest or 0)
    for extra in (others, parents.unionByName(tops), ends_digests(ends)):
        rows = rows.join(extra, ["a", "b"], "left")
    return rows.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        (F.col("own_leaves") + F.coalesce("other_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("own_saved") + F.coalesce("other_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, group: int = 100, most_shared: int = 6) -> DataFrame:
    """``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``: a row for each distinct prefix of the rebuilt
    conversations (:func:`rebuilt`) of a table ``conv_id``, ``turn``, ``role``, ``text``.

    Turns are in the order of ``turn``, null first, equal ones in that of their role and
    then of a hash of role and text. Null and empty roles and texts are the same. Repeated
    rows are a turn each. Rows without a conversation's id take no part; of the remainder
    of a negative id the sign is the id's. An empty table gives no rows, not even a root.
    Of other columns none is read.
    """
    return trie(blocks_of(rebuilt(numbered(conversations), group, most_shared)))


def op12_rollup_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


#: The same from the whole list of turns of each conversation.
ORACLE = """
WITH turns AS (
  SELECT conv_id, char_length(coalesce(text, '')) AS chars,
    md5(char_length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), id) AS pos
  FROM (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)),
own AS (
  SELECT conv_id, list(id ORDER BY pos) AS ids, list(chars ORDER BY pos) AS chars,
    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [CAST(0 AS BIGINT) FOR x IN range(8)]),
        lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM turns GROUP BY conv_id),
built AS (
  SELECT c.conv_id, list_concat(coalesce(b.ids[:c.h], []), c.ids[c.h + 1:]) AS ids,
    list_concat(coalesce(b.chars[:c.h], []), c.chars[c.h + 1:]) AS chars
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
paths AS (
  SELECT conv_id, depth, len(ids) = depth AS ends, array_to_string(ids[:depth], ',') AS node,
    array_to_string(ids[:depth - 1], ',') AS parent, CASE WHEN depth > 0 THEN chars[depth] ELSE 0 END AS chars
  FROM (SELECT *, unnest(range(len(ids) + 1)) AS depth FROM built)),
nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM paths GROUP BY node, depth),
children AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.parent = p.node AND n.depth = p.depth + 1
  LEFT JOIN (SELECT parent, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL) c
    ON c.parent = n.node AND c.depth = n.depth),
below AS (
  SELECT p.node, p.depth, sum(CAST(x.n_children = 0 AS BIGINT)) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved_tokens
  FROM children x JOIN paths p ON p.conv_id = x.conv_id AND p.depth <= x.depth GROUP BY p.node, p.depth)
SELECT conv_id, c.depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM children c JOIN below b ON c.node = b.node AND c.depth = b.depth
"""
