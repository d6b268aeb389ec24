"""Mixing sources to target weights: budgets shared out down a tree of domain, language
and source, and of each source the tokens that come first in seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import broadcast_if_small, checkpointed, read_table, stage

#: Sources by domain; other sources are of the domain REST.
DOMAINS = {
    "reference": ["src1", "src2", "src3", "src4"],
    "news": ["src5", "src6", "src7", "src8", "src9"],
    "forum": ["src10", "src11", "src12"],
}
REST = "crawl"

#: Whole-number weights of nodes among their siblings, by the names from the top; 1 if not named.
WEIGHTS = {
    ("crawl",): 4,
    ("reference",): 3,
    ("news",): 2,
    ("crawl", "en"): 5,
    ("crawl", "de"): 2,
    ("reference", "en"): 3,
    ("reference", "fr"): 2,
    ("news", "es"): 2,
    ("crawl", "en", "src0"): 3,
    ("reference", "en", "src1"): 4,
}
MOST_EPOCHS = 4
SEED = 17
LEVELS = ["domain", "lang", "source"]
NO_NAME = "(none)"
WORD = r"[^\x20\x09-\x0D]+"
#: Leaves whose plan is sent to every executor; beyond it the plan is joined by shuffle.
MOST_LEAVES = 100_000


def domain_of(source: Column, domains: dict[str, list[str]], rest: str) -> Column:
    name = F.lit(rest)
    for domain, sources in domains.items():
        name = F.when(source.isin(sources), F.lit(domain)).otherwise(name)
    return name


def word_count(text: Column) -> Column:
    """Tokens of a text: its words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _whole(x: str) -> str:
    return f"cast({x} as decimal(38,0))"


def share(children: DataFrame, parent: list[str]) -> DataFrame:
    """Splits ``budget``, what the parent has, among children by ``weight``, none getting
    more than its ``cap``: adds ``own``, a whole number of tokens.

    What a child cannot take goes to its siblings by their weights; the parent's budget is
    within the sum of the caps, so shortages reach an ancestor only when all siblings are
    full. In order of cap by weight the full children come first, and a child is full if
    it cannot take its part of what they leave.
    """
    ahead = Window.partitionBy(*parent).orderBy("ratio", "name")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    family = Window.partitionBy(*parent)
    rows = children.withColumn("ratio", F.expr(f"{_whole('cap')} * 1000000 div weight"))
    rows = rows.withColumns(
        {
            "caps": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights": F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "all_weights": F.sum("weight").over(family),
        }
    )
    full = f"{_whole('cap')} * (all_weights - weights) <= {_whole('budget - caps')} * weight"
    rows = rows.withColumn("is_full", F.expr(full))
    rows = rows.withColumns(
        {
            "left": F.col("budget") - F.sum(F.expr("if(is_full, cap, 0)")).over(family),
            "open": F.sum(F.expr("if(is_full, 0, weight)")).over(family),
            "upto": F.sum(F.expr("if(is_full, 0, weight)")).over(ahead.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    part = f"{_whole('left')} * upto div open - {_whole('left')} * (upto - weight) div open"
    own = F.expr(f"if(is_full, cap, least(cap, {part}))").cast("long")
    return rows.withColumn("own", own).drop(
        "ratio", "caps", "weights", "all_weights", "is_full", "left", "open", "upto", "name", "budget"
    )


def budgets(leaves: DataFrame, total: str, weights: dict[tuple[str, ...], int], most_epochs: int) -> DataFrame:
    """Leaves (``LEVELS``, ``available``) with their ``budget`` in tokens. ``total``: SQL
    text over ``available``, the tokens of all leaves; at most what they can give."""
    leaves = leaves.where("available > 0").withColumn("cap", F.col("available") * most_epochs)
    spark = leaves.sparkSession
    listed = F.array(*[F.struct(F.lit("/".join(k)).alias("path"), F.lit(w).alias("weight")) for k, w in weights.items()])
    named = spark.range(1).select(F.inline(listed)) if weights else spark.createDataFrame([], "path string, weight int")
    whole = leaves.agg(F.sum("available").alias("available"), F.sum("cap").alias("cap"))
    parents = whole.select(F.expr(f"least(cast({total} as long), cap)").alias("budget"), F.lit(0).alias("_root"))
    keys = ["_root"]
    for depth, level in enumerate(LEVELS):
        names = LEVELS[: depth + 1]
        nodes = leaves.groupBy(*names).agg(F.sum("cap").alias("cap")).withColumn("_root", F.lit(0))
        nodes = nodes.withColumn("path", F.concat_ws("/", *names)).join(F.broadcast(named), "path", "left").drop("path")
        nodes = nodes.withColumn("weight", F.coalesce("weight", F.lit(1)).cast("long")).where("weight > 0")
        nodes = nodes.join(parents, keys).withColumn("name", F.col(level))
        parents = share(nodes, keys).select("_root", *names, F.col("own").alias("budget"))
        keys = ["_root", *names]
    return leaves.drop("cap").join(parents.drop("_root"), LEVELS, "left").fillna(0, ["budget"])


def _place(seed: int, epoch: Column, doc_id: Column, text_md5: Column) -> Column:
    """Where a document stands in an epoch of its leaf; rows of one id by their texts."""
    named = F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.concat(named, text_md5)


def _text_md5(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def cuts(narrow: DataFrame, plan: DataFrame, n_leaves: int, seed: int) -> DataFrame:
    """For each leaf with a part epoch the place of the document that its budget ends in
    (``cut_place``) and the tokens of it that still fit (``cut_tokens``).

    The place is found by its leading digits: sums by two digits (256 rows for each leaf),
    then by four within the pair that the budget ends in, then document by document within
    those four. Rows equal in id and text stand at one place; where the budget ends in it
    each gives as many tokens, so fewer than there are such rows are left over.
    """
    rows = narrow.join(plan.where("rest > 0").select(*LEVELS, "whole", "rest"), LEVELS)
    rows = rows.withColumn("place", _place(seed, F.col("whole"), F.col("doc_id"), F.col("text_md5")))
    rows = rows.groupBy(*LEVELS, "rest", "place").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    rows = stage(rows, "mixing-places")
    within = Window.partitionBy(*LEVELS).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    found = None
    for digits in (2, 4, 64):
        level = rows.withColumn("prefix", F.substring("place", 1, digits))
        if found is not None:
            parts = found.select(*LEVELS, F.col("prefix").alias("outer"), F.col("before").alias("base"))
            parts = broadcast_if_small(parts, n_leaves, MOST_LEAVES)
            level = level.join(parts, LEVELS).where(F.col("prefix").startswith(F.col("outer"))).drop("outer")
        else:
            level = level.withColumn("base", F.lit(0).cast("long"))
        sums = level.groupBy(*LEVELS, "rest", "base", "prefix").agg(F.sum("tokens").alias("tokens"), F.max("n").alias("n"))
        # a table of its own: else one shuffle, by leaf alone, would serve the sums too
        sums = checkpointed(sums)
        sums = sums.withColumn("before", F.col("base") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
        found = checkpointed(sums.where("before <= rest and rest < before + tokens"))
    return found.select(*LEVELS, F.col("prefix").alias("cut_place"), F.expr("(rest - before) div n").alias("cut_tokens"))


def mixture(
    docs: DataFrame,
    total: str = "available",
    weights: dict[tuple[str, ...], int] | None = None,
    domains: dict[str, list[str]] | None = None,
    rest: str = REST,
    most_epochs: int = MOST_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` (``doc_id``, ``text``, ``lang``, ``source`` and any others) that
    the mixture takes, once for each epoch that takes them, with ``_domain``, ``_epoch``
    (from 0), ``_tokens`` and ``_kept`` beside their own columns.

    The ``total`` budget is split among domains, each domain's among its languages, each
    language's among its sources, by ``weights``; a node can give its tokens
    ``most_epochs`` times, and what it cannot give goes to its siblings first. A source
    then gives whole epochs and, of one more, the documents that come first by the md5 of
    seed, epoch and id, then of the text, until its budget ends; of the last document only the tokens that
    fit are kept (``_kept`` < ``_tokens``; none: no row).

    Null languages and sources are one leaf of the name ``(none)``, as are texts named so.
    A null text has no tokens: it comes with the whole epochs of its leaf. Leaves without
    any token and nodes of weight 0 give nothing. Rows that repeat an id, or have none, stand in
    the order of their texts' md5; of rows equal in both that the budget ends in, each gives
    the same number of tokens. An empty table gives no rows. Columns named like those used here keep their values.

    Sums are made by leaf in the tasks; no task gets a leaf's documents. Documents are not
    shuffled: the plan, a row for each leaf, is joined to the scan.
    """
    weights = WEIGHTS if weights is None else weights
    domains = DOMAINS if domains is None else domains
    source = F.coalesce("source", F.lit(NO_NAME))
    leaf = [
        domain_of(source, domains, rest).alias("domain"),
        F.coalesce("lang", F.lit(NO_NAME)).alias("lang"),
        source.alias("source"),
    ]
    counted = word_count(F.col("text")).alias("tokens"), _text_md5(F.col("text")).alias("text_md5")
    narrow = stage(docs.select("doc_id", *leaf, *counted), "mixing-tokens")
    leaves = checkpointed(narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("available")))
    plan = budgets(leaves, total, weights, most_epochs)
    plan = plan.withColumns({"whole": F.expr("budget div available"), "rest": F.expr("budget % available")})
    plan = checkpointed(plan.where("budget > 0"))
    small = plan.count()
    plan = broadcast_if_small(plan, small, MOST_LEAVES)
    ends = broadcast_if_small(cuts(narrow, plan, small, seed), small, MOST_LEAVES)
    plan = broadcast_if_small(checkpointed(plan.join(ends, LEVELS, "left")), small, MOST_LEAVES)
    renamed = plan.select(*[F.col(c).alias(f"_plan_{c}") for c in plan.columns])
    if small <= MOST_LEAVES:
        renamed = F.broadcast(renamed)
    same = [leaf[i] == F.col(f"_plan_{c}") for i, c in enumerate(LEVELS)]
    rows = docs.join(renamed, same[0] & same[1] & same[2])
    place = _place(seed, F.col("_plan_whole"), F.col("doc_id"), _text_md5(F.col("text")))
    tokens = word_count(F.col("text"))
    last = F.when(place < F.col("_plan_cut_place"), tokens).when(
        place == F.col("_plan_cut_place"), F.least(tokens, F.col("_plan_cut_tokens"))
    )
    taken = F.when(F.col("_plan_rest") > 0, last)
    epochs = F.sequence(F.lit(0).cast("long"), F.col("_plan_whole"))
    copies = F.transform(
        epochs,
        lambda e: F.struct(e.alias("epoch"), F.when(e < F.col("_plan_whole"), tokens).otherwise(taken).alias("kept")),
    )
    rows = rows.withColumn("_copy", F.explode(F.filter(copies, lambda c: (c["kept"] > 0) | (c["epoch"] < F.col("_plan_whole")))))
    return rows.select(
        *[docs[c] for c in docs.columns],
        F.col("_plan_domain").alias("_domain"),
        F.col("_copy.epoch").cast("int").alias("_epoch"),
        tokens.alias("_tokens"),
        F.col("_copy.kept").alias("_kept"),
    )


def cut_texts(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of a mixture's rows, the text of a cut document up to its last kept token
    (and ``n_chars``, if there, its length)."""
    pieces = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    lead = F.regexp_extract("text", r"^[\x20\x09-\x0D]*", 0)
    kept = F.concat(lead, F.array_join(F.slice(pieces, F.lit(1), F.col("_kept").cast("int")), ""))
    is_cut = F.col("_kept") < F.col("_tokens")
    made = {"text": F.when(is_cut, kept).otherwise(F.col("text"))}
    if "n_chars" in columns:
        made["n_chars"] = F.when(is_cut, F.length(kept).cast("long")).otherwise(F.col("n_chars"))
    return mixed.select(*[made[c].alias(c) if c in made else F.col(c) for c in columns])


def op1_tree_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture(read_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("_domain").alias("domain"),
        F.coalesce("lang", F.lit(NO_NAME)).alias("lang"),
        F.coalesce("source", F.lit(NO_NAME)).alias("source"),
        F.col("_epoch").alias("epoch"),
        F.col("_tokens").alias("tokens"),
        F.col("_kept").alias("tokens_kept"),
    )


# -- the same in SQL ----------------------------------------------------------

_DOMAIN_SQL = (
    "CASE "
    + " ".join(
        f"WHEN coalesce(source, '{NO_NAME}') IN ({', '.join(repr(s) for s in sources)}) THEN '{domain}'"
        for domain, sources in DOMAINS.items()
    )
    + f" ELSE '{REST}' END"
)
_WEIGHT_ROWS = ", ".join(f"('{'/'.join(path)}', {weight})" for path, weight in WEIGHTS.items())


def _share_sql(depth: int) -> str:
    """The shares of one level as three chained tables, ending in ``b{depth}``."""
    names, parent = LEVELS[:depth], LEVELS[: depth - 1]
    family = f"PARTITION BY {', '.join(parent)}" if parent else ""
    order = f"ORDER BY ratio, {LEVELS[depth - 1]}"
    before = f"({family} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    join = f"JOIN b{depth - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN b0"
    path = " || '/' || ".join(names)
    return f"""
n{depth} AS (
  SELECT {", ".join(names)}, cap, coalesce(w.weight, 1) AS weight, budget,
    (CAST(cap AS HUGEINT) * 1000000) // coalesce(w.weight, 1) AS ratio
  FROM (SELECT {", ".join(names)}, CAST(sum(cap) AS BIGINT) AS cap FROM leaves GROUP BY {", ".join(names)}) g
  {join} LEFT JOIN weights w ON w.path = {path}
),
f{depth} AS (
  SELECT *, CAST(cap AS HUGEINT) * (sum(weight) OVER ({family}) - coalesce(sum(weight) OVER {before}, 0))
    <= CAST(budget - coalesce(sum(cap) OVER {before}, 0) AS HUGEINT) * weight AS is_full FROM n{depth}
),
s{depth} AS (
  SELECT *, budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({family}) AS remaining,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family}) AS open_weight,
    sum(CASE WHEN is_full THEN 0 ELSE weight END)
      OVER ({family} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM f{depth}
),
b{depth} AS (
  SELECT {", ".join(names)}, CAST(CASE WHEN is_full THEN cap ELSE
    least(cap, remaining * upto // open_weight - remaining * (upto - weight) // open_weight) END AS BIGINT) AS budget
  FROM s{depth}
)"""


ORACLE = f"""
WITH weights(path, weight) AS (VALUES {_WEIGHT_ROWS}),
narrow AS (
  SELECT doc_id, {_DOMAIN_SQL} AS domain, coalesce(lang, '{NO_NAME}') AS lang, coalesce(source, '{NO_NAME}') AS source,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS tokens, md5(coalesce(text, '')) AS text_md5
  FROM documents
),
leaves AS (
  SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS available,
    CAST(sum(tokens) * {MOST_EPOCHS} AS BIGINT) AS cap
  FROM narrow GROUP BY ALL HAVING sum(tokens) > 0
),
b0 AS (SELECT CAST(least(sum(available), sum(cap)) AS BIGINT) AS budget FROM leaves),
{_share_sql(1)}, {_share_sql(2)}, {_share_sql(3)},
plan AS (
  SELECT domain, lang, source, budget // available AS whole, budget % available AS rest
  FROM leaves JOIN b3 USING (domain, lang, source) WHERE budget > 0
),
placed AS (
  SELECT narrow.*, whole, rest,
    md5('{SEED}:' || CAST(whole AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) || text_md5 AS place
  FROM narrow JOIN plan USING (domain, lang, source)
),
ordered AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
    - sum(tokens) OVER (PARTITION BY domain, lang, source, place) AS before,
    sum(tokens) OVER (PARTITION BY domain, lang, source, place) AS at_place,
    count(*) OVER (PARTITION BY domain, lang, source, place) AS n
  FROM placed
),
last_epoch AS (
  SELECT *, CASE WHEN rest = 0 THEN 0 WHEN before + at_place <= rest THEN tokens
    WHEN before > rest THEN 0 ELSE (rest - before) // n END AS kept FROM ordered
)
SELECT doc_id, domain, lang, source, CAST(e AS INTEGER) AS epoch, tokens, tokens AS tokens_kept
FROM (SELECT *, unnest(range(whole)) AS e FROM placed)
UNION ALL
SELECT doc_id, domain, lang, source, CAST(whole AS INTEGER), tokens, CAST(kept AS BIGINT) FROM last_epoch WHERE kept > 0
"""
