"""Block and allow rules on URLs, carried to aliases by redirects and canonical links.

Only DataFrame and SQL functions run here.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import checkpointed, read_table, stage
from skyledger.llm.components import connected_components

#: The policy of the registered query: verdict and rule, host before the first slash.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

CANONICAL_TAG = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_TAG = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
REFRESH_URL = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)"
#: What stands in a tag behind its name: a quote opens a value only behind =.
_INSIDE = r"(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+"
TAG = r"(?is)<{}(?=[\s/])" + _INSIDE + ">"
#: Comments, and elements whose text holds no tags (fixed values: the standard's names).
NO_TAGS = (
    r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title|xmp|iframe|noembed|noframes)(?=[\s/>])" + _INSIDE
    + r">.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
)
#: One attribute with its value, if it has one.
ATTRIBUTE = r"(?s)[^\s\"'>/=][^\s>/=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++))?"
#: What stands behind the seconds of a refresh: likewise.
REFRESH = (
    r"(?is)^\s*(?:[\d.]++(?:\s*[;,]\s*|\s+|$)(?:url\s*=\s*)?+|[;,]?\s*url\s*=\s*)(?:\"([^\"]*)|'([^']*)|([^\"'\s].*))"
)
#: Character references and what stands between them.
REFERENCES = r"(?i)&#[0-9]{1,7};|&#x[0-9a-f]{1,6};|&(?:quot|apos|lt|gt|sol|colon|equals|quest|num|percnt);|&amp(?:;|(?![=a-z0-9;]))|[^&]+|&"
NAMED = {
    "&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">", "&sol;": "/", "&colon;": ":", "&equals;": "=", "&quest;": "?",
    "&num;": "#", "&percnt;": "%", "&amp;": "&", "&amp": "&",
}


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def alias_key(url: Column) -> Column:
    """Host, path and query: scheme and fragment do not tell documents apart."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*(\?[^#]*)?", 1)
    return F.concat(host_of(url), path_of(url), query)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(verdict).alias("verdict"),
            F.lit(rule).alias("rule"),
            F.lit(rule.split("/", 1)[0]).alias("rule_host"),
            F.lit("/" + rule.split("/", 1)[1] if "/" in rule else "").alias("rule_path"),
        )
        for verdict, rule in rules
    ]
    empty = "cast(array() as array<struct<verdict:string,rule:string,rule_host:string,rule_path:string>>)"
    return spark.range(1).select(F.inline(F.array(*rows) if rows else F.expr(empty)))


def _one_of(text: Column, pattern: str) -> Column:
    return F.concat(*[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)])


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of a name; null without one."""
    inside = F.regexp_replace(tag, r"^<[^\s/>]+|>$", "")
    found = F.filter(
        F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(0)),
        lambda x: F.lower(F.regexp_extract(x, r"^[^\s=]+", 0)) == name,
    )
    value = F.regexp_extract(F.get(found, F.lit(0)), r"(?s)^[^\s=]+\s*=\s*(.*)$", 1)
    return F.regexp_replace(value, r"(?s)^\"(.*)\"$|^'(.*)'$", "$1$2")


def tags(html: Column, name: str) -> Column:
    """The tags of a name, without those in comments or in the text of scripts and the like."""
    return F.regexp_extract_all(html, F.lit(TAG.format(name)), F.lit(0))


def _code_point(digits: Column, radix: int) -> Column:
    code = F.conv(digits, radix, 10).cast("long")
    known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")


def unescaped(text: Column) -> Column:
    """Text with its character references undone, once: numbers and those that URLs have."""

    def plain(piece: Column) -> Column:
        known = F.when(piece.rlike("^&#[0-9]+;$"), _code_point(F.regexp_extract(piece, "[0-9]+", 0), 10))
        known = known.when(piece.rlike("^&#[xX].+;$"), _code_point(F.regexp_extract(piece, "^&#[xX](.+);$", 1), 16))
        for name, value in NAMED.items():
            known = known.when(F.lower(piece) == name, F.lit(value))
        return known.otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(REFERENCES), F.lit(0))
    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(pieces, plain), "")).otherwise(text)


def _address(text: Column) -> Column:
    """A URL as browsers take it from an attribute."""
    return F.replace(F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"[\t\n\r]+", ""), F.lit(" "), F.lit("%20"))


def _without_dots(path: Column) -> Column:
    """A path from ``/`` on with its ``.`` and ``..`` steps taken."""
    steps = F.split(F.substring(path, F.lit(2), F.length(path)), "/")
    nothing = F.array().cast("array<string>")
    taken = F.aggregate(
        steps,
        nothing,
        lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(x == ".", done)
        .otherwise(F.concat(done, F.array(x))),
    )
    # a last step of dots is a folder
    end = F.when(path.rlike(r"/\.\.?$") & (F.size(taken) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(taken, "/"), end)).otherwise(path)


def resolved(target: Column, base: Column) -> Column:
    """The URL that a reference in a document of the URL ``base`` names; null if it is none
    with ``://``, as of ``mailto:``. Absolute ones stay as they are."""
    site = F.concat(F.substring_index(base, "://", 1), F.lit("://"), host_of(base))
    path = F.when(path_of(base) == "", F.lit("/")).otherwise(path_of(base))
    own_path = F.regexp_extract(target, "^[^?#]*", 0)
    rest = F.regexp_extract(target, "^[^?#]*(.*)", 1)
    folder = F.regexp_extract(path, "(?s)^.*/", 0)
    return (
        F.when(target == "", None)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(target.startswith("//"), F.concat(F.substring_index(base, "://", 1), F.lit(":"), target))
        .when(target.startswith("#"), base)
        .when(target.startswith("?"), F.concat(site, path, target))
        .when(target.startswith("/"), F.concat(site, _without_dots(own_path), rest))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, own_path)), rest))
    )


def document_edges(pages: DataFrame) -> DataFrame:
    """``a``, ``b``: alias keys of a page and of each page that its canonical links or meta
    refreshes name: a tag's ``rel`` is read as words, attributes as a browser cuts them, and
    what looks like a tag in a comment, a script or another attribute is none. Targets are resolved as in a browser, against the page's URL or what
    its first ``base`` names: absolute, ``//host/...``, ``/path``, ``?query`` or relative to
    the folder; character references are undone."""
    shown = F.regexp_replace("html", NO_TAGS, " ")

    def is_canonical(tag: Column) -> Column:
        words = F.split(F.lower(F.coalesce(attribute(tag, "rel"), F.lit(""))), r"[ \t\n\f\r]+")
        return F.array_contains(words, "canonical")

    def is_refresh(tag: Column) -> Column:
        return F.lower(F.trim(F.coalesce(attribute(tag, "http-equiv"), F.lit("")))) == "refresh"

    links = F.transform(F.filter(tags(shown, "link"), is_canonical), lambda tag: unescaped(attribute(tag, "href")))
    moves = F.transform(
        F.filter(tags(shown, "meta"), is_refresh), lambda tag: _one_of(unescaped(attribute(tag, "content")), REFRESH)
    )
    bases = F.filter(F.transform(tags(shown, "base"), lambda tag: attribute(tag, "href")), lambda x: x.isNotNull())
    base = _address(unescaped(F.get(bases, F.lit(0))))
    targets = F.filter(F.array_distinct(F.concat(links, moves)), lambda x: x.isNotNull())
    found = pages.where("html is not null and instr(url, '://') > 0")
    found = found.select("url", targets.alias("targets"), base.alias("base")).where("size(targets) > 0")
    found = found.withColumn("base", F.coalesce(resolved(F.col("base"), F.col("url")), "url"))
    found = found.select("url", "base", F.explode("targets").alias("target"))
    found = found.withColumn("target", _address(F.col("target")))
    found = found.withColumn("whole", resolved(F.col("target"), F.col("base")))
    edges = found.select(alias_key(F.col("url")).alias("a"), alias_key(F.col("whole")).alias("b"))
    return edges.where("b <> '' and a <> b").distinct()


def own_rules(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """``node``, ``rule``, ``verdict`` for nodes (with ``host``, ``path``) that a rule fits;
    the longest rule wins, then the greater text."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = (
        nodes.withColumn("rule_host", F.explode(suffixes))
        .join(rules, "rule_host")
        .where(F.col("path").startswith(F.col("rule_path")))
    )
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    return fitting.groupBy("node").agg(best).select("node", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` for every row of ``pages``
    (``page_id``, ``url``, ``html``).

    A URL that a rule fits gets that rule's verdict. Any other URL takes the verdict of
    its aliases: all URLs that redirects (``redirects``: ``source``, ``target`` URLs),
    canonical links and meta refreshes connect, whichever way they point. If a rule
    allows one of them it is allowed, else if a rule blocks one it is blocked, else it is
    allowed. Aliases that are no pages count too. URLs that differ only in scheme or
    fragment are one.

    A null URL, or one without ``://``, has an empty host and path, fits no rule, has no
    alias and is allowed. Null html has no edges. Rows that repeat are each judged. An
    empty table gives no rows. Other columns, whatever their names, are not read.

    Rules are joined on the host and its parent domains, so their number may be large;
    nodes are distinct before the join, so a URL or host with a third of all pages costs
    one row per task. Components are computed by stars (:mod:`.components`).
    """
    spark = pages.sparkSession
    url = F.coalesce("url", F.lit(""))
    edges = document_edges(pages.select("url", "html"))
    if redirects is not None:
        moved = redirects.select(alias_key(F.col("source")).alias("a"), alias_key(F.col("target")).alias("b"))
        edges = edges.union(moved.where("a <> '' and b <> '' and a <> b"))
    edges = stage(edges.distinct(), "url-edges")
    own = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), alias_key(url).alias("node")
    )
    nodes = own.select("node").union(edges.select("a")).union(edges.select("b")).distinct()
    located = F.concat(F.lit("x://"), "node")
    nodes = nodes.select("node", host_of(located).alias("host"), path_of(located).alias("path"))
    ruled = own_rules(nodes, rules)
    if edges.isEmpty():
        judged = ruled.withColumn("spread", F.col("verdict"))
    else:
        ruled = checkpointed(ruled)
        roots = checkpointed(connected_components(edges, "a", "b"))
        spread = (
            ruled.join(roots, "node")
            .groupBy("root")
            .agg(F.min("verdict").alias("spread"))  # allow sorts before block
        )
        aliased = roots.join(spread, "root").select("node", "spread")
        judged = ruled.join(aliased, "node", "full_outer")
    judged = judged.select("node", "rule", F.coalesce("verdict", "spread").alias("verdict"))
    return own.join(judged, "node", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )


def op8_redirect_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"), rule_table(spark, RULES))


_RULE_ROWS = ", ".join(
    f"('{verdict}', '{rule}', '{rule.split('/', 1)[0]}', '/{rule.split('/', 1)[1]}')" for verdict, rule in RULES
)


def _sql_rest(url: str) -> str:
    return f"CASE WHEN strpos({url}, '://') > 0 THEN substring({url}, strpos({url}, '://') + 3) ELSE '' END"


def _sql_host(url: str) -> str:
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"translate(regexp_extract({_sql_rest(url)}, '^[^/?#]*', 0), '{upper}', '{lower}')"


def _sql_key(url: str) -> str:
    rest = _sql_rest(url)
    return (
        f"({_sql_host(url)} || regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"
        f" || regexp_extract({rest}, '^[^?#]*(\\?[^#]*)?', 1))"
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


ORACLE = f"""
WITH RECURSIVE rules(verdict, rule, rule_host, rule_path) AS (VALUES {_RULE_ROWS}),
own AS (
  SELECT page_id, {_sql_host("coalesce(url, '')")} AS host,
    regexp_extract({_sql_rest("coalesce(url, '')")}, '^[^/?#]*([^?#]*)', 1) AS path,
    {_sql_key("coalesce(url, '')")} AS node
  FROM pages
),
targets AS (
  SELECT url, unnest([
    regexp_extract(regexp_extract(html, {_quoted(CANONICAL_TAG)}, 0), {_quoted(HREF)}, 1),
    regexp_extract(regexp_extract(html, {_quoted(REFRESH_TAG)}, 0), {_quoted(REFRESH_URL)}, 1)]) AS target
  FROM pages WHERE html IS NOT NULL AND strpos(url, '://') > 0
),
resolved AS (
  SELECT url, CASE WHEN target LIKE '//%' THEN split_part(url, '://', 1) || ':' || target
    WHEN target LIKE '/%' THEN split_part(url, '://', 1) || '://' || {_sql_host("url")} || target
    WHEN strpos(target, '://') > 0 THEN target END AS target
  FROM targets WHERE target <> ''
),
edges AS (
  SELECT DISTINCT a, b FROM (SELECT {_sql_key("url")} AS a, {_sql_key("target")} AS b FROM resolved)
  WHERE b <> '' AND a <> b
),
links AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
nodes AS (SELECT node FROM own UNION SELECT a FROM links),
ruled AS (
  SELECT node, rule, verdict FROM nodes JOIN rules
    ON (split_part(split_part(node, '/', 1), '?', 1) = rule_host
        OR ends_with(split_part(split_part(node, '/', 1), '?', 1), '.' || rule_host))
    AND starts_with(regexp_extract(node, '^[^/?#]*([^?#]*)', 1), rule_path)
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY length(rule) DESC, rule DESC) = 1
),
spread AS (SELECT reach.a AS node, min(verdict) AS verdict FROM reach JOIN ruled ON ruled.node = reach.b GROUP BY 1)
SELECT page_id, host, path, ruled.rule AS rule, coalesce(ruled.verdict, spread.verdict, 'allow') AS verdict
FROM own LEFT JOIN ruled USING (node) LEFT JOIN spread USING (node)
"""
