"""Bronze to silver: parse, enrich, check, and store both outcomes in one write.

A store is a schema of the catalog::

    readings    checked rows, PARTITIONED BY (micro_batch, attempt, outcome, event_period)
    batches     rows and newest event_time by outcome and period, PARTITIONED BY (micro_batch, attempt)
    clean, quarantine, audit    views over them

One write means one parse of each body, and clean and quarantined rows are committed by the
same job. Every run of a batch inserts under an attempt of its own; its lines in ``batches``,
counted from what was written, come last, and readers see the attempt of a batch with the
highest version. So a batch that is replayed replaces itself, a recomputed task cannot count
a row twice, and a run that dies at any step leaves the rows there were. Both tables are only
inserted into: no reader, of whatever session, finds a file gone. One job writes at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.functions.derive import moment
from skyledger.functions.rules import located_rules, standard_rules
from skyledger.operators import quality
from skyledger.operators.enrich import enrich, enrich_located
from skyledger.operators.latest import BODY_HASH, Period, with_body_hash
from skyledger.operators.parse import parse_payload, split_routes
from skyledger.schemas import BRONZE_DDL, PAYLOAD_DDL, QUARANTINE_COLUMNS, READING_DDL
from skyledger.sources import tables

CLEAN = "clean"
QUARANTINE = "quarantine"
PERIOD = "event_period"

# Fixed value: how a path tells a null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
PARTITIONS = {"micro_batch": "int", "attempt": "string", "outcome": "string", PERIOD: "date"}
# A body tells its place and time, so hardly one is there twice.
DISTINCT = ("raw_response", BODY_HASH)
BATCHES_DDL = f"""
    outcome string, {PERIOD} date, row_count bigint, newest_event_time timestamp,
    run_time timestamp, version int, micro_batch int, attempt string
"""


def checked_readings(
    bronze: DataFrame,
    as_of: datetime | str | None = None,
    keep_parsed: bool = False,
    null_status_fails: bool = True,
    strict_json: bool = False,
) -> DataFrame:
    """Every bronze row as a reading of the standard profile with its reason.

    The whole payload is parsed only to be kept.
    """
    rules = standard_rules(null_status_fails, strict_json)
    payload = PAYLOAD_DDL if keep_parsed else READING_DDL
    checked = quality.check(enrich(parse_payload(bronze, payload), as_of), rules)
    return checked if keep_parsed else checked.drop("parsed")


def checked_located(bronze: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """The usable responses as readings of the located profile with their reason."""
    return quality.check(enrich_located(split_routes(bronze).parsed, as_of), located_rules(as_of))


@dataclass(frozen=True)
class SilverStore:
    """Names and readers of one silver store.

    ``namespace`` is its schema, made at ``location`` by the first batch. ``unit`` is the
    span of one period. A day suits a feed of gigabytes a day; a month keeps the files of a
    small feed few.
    """

    namespace: str
    location: str
    unit: str = "day"

    @property
    def period(self) -> Period:
        return Period(PERIOD, self.unit)

    @property
    def checkpoint(self) -> str:
        return f"{self.location}/checkpoint"

    @property
    def readings(self) -> str:
        return f"{self.namespace}.readings"

    @property
    def batches(self) -> str:
        return f"{self.namespace}.batches"

    def create(self, spark: SparkSession, columns: StructType | None = None) -> None:
        """Make the tables and views unless they are there, with the columns that the first
        batch has or else those of readings of plain bronze rows."""
        if not spark.catalog.tableExists(f"{self.namespace}.audit"):
            tables.create_layers(spark, [self.namespace], self.location)
            columns = columns or _placed(checked_readings(spark.createDataFrame([], BRONZE_DDL)), self).schema
            ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns if f.name not in PARTITIONS]
            ddl += [f"{name} {kind}" for name, kind in PARTITIONS.items()]
            tables.create_table(spark, self.readings, ", ".join(ddl), list(PARTITIONS), distinct=DISTINCT)
            tables.create_table(spark, self.batches, BATCHES_DDL, ["micro_batch", "attempt"])
            self._show(spark)

    def clean(self, spark: SparkSession, keep_period: bool = False) -> DataFrame:
        """Clean readings; with ``keep_period`` the partition column stays for pruning, and
        the hash of the body for ranking."""
        rows = self._outcome(spark, CLEAN).drop("outcome", "micro_batch", "attempt", quality.REASON)
        return rows if keep_period else rows.drop(PERIOD, BODY_HASH)

    def clean_of(self, spark: SparkSession, micro_batch: int) -> DataFrame:
        """The clean readings of one batch."""
        return self._outcome(spark, CLEAN).where(F.col("micro_batch") == micro_batch)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return self._outcome(spark, QUARANTINE).select(*QUARANTINE_COLUMNS)

    def audit(self, spark: SparkSession) -> DataFrame:
        """One row for each batch that held rows."""
        self.create(spark)
        return spark.table(f"{self.namespace}.audit")

    def newest(self, spark: SparkSession) -> Column:
        """The newest clean event_time as a scalar, without reading any reading."""
        return self._clean_lines(spark).agg(F.max("newest_event_time")).scalar()

    def periods(self, spark: SparkSession, micro_batch: int) -> dict[date, bool]:
        """The periods that a batch holds clean rows of, or held before it was replaced, and
        whether the store has clean rows of them now. Bounded by the periods of a batch."""
        return {row[PERIOD]: row.row_count > 0 for row in self.period_counts(spark, micro_batch).collect()}

    def period_counts(self, spark: SparkSession, micro_batch: int) -> DataFrame:
        """The same as a frame, with the clean rows of each period in all batches."""
        lines = self._clean_lines(spark)
        own = lines.where(F.col("micro_batch") == micro_batch).select(PERIOD).distinct()
        return lines.join(own, PERIOD).groupBy(PERIOD).agg(F.sum("row_count").alias("row_count"))

    def lines(self, spark: SparkSession) -> DataFrame:
        """Of each batch the lines of the attempt that readers see."""
        self.create(spark)
        return spark.sql(f"SELECT * FROM {self.batches} WHERE {self._seen()}")

    def _clean_lines(self, spark: SparkSession) -> DataFrame:
        return self.lines(spark).where(F.col("outcome") == CLEAN)

    def _outcome(self, spark: SparkSession, outcome: str) -> DataFrame:
        return self._rows(spark).where(F.col("outcome") == outcome)

    def _rows(self, spark: SparkSession) -> DataFrame:
        """Readings of both outcomes, with the partition columns."""
        self.create(spark)
        return spark.sql(f"SELECT * FROM {self.readings} WHERE {self._seen()}")

    def _seen(self) -> str:
        """Attempts that readers see, one for each batch; the condition prunes partitions."""
        seen = f"SELECT max_by(attempt, version) AS seen FROM {self.batches} GROUP BY micro_batch"
        return f"array_contains((SELECT collect_set(seen) FROM ({seen})), attempt)"

    def _show(self, spark: SparkSession) -> None:
        """The views; they have the columns that the table has now."""
        kept = [f"`{c}`" for c in spark.table(self.readings).columns if c not in (*PARTITIONS, BODY_HASH, quality.REASON)]
        counted = "coalesce(sum(row_count) FILTER (WHERE outcome = '{}'), 0L) AS {}"
        views = {
            "clean": f"SELECT {', '.join(kept)} FROM {self.readings} WHERE outcome = '{CLEAN}' AND {self._seen()}",
            "quarantine": f"SELECT {', '.join(QUARANTINE_COLUMNS)} FROM {self.readings} WHERE outcome = '{QUARANTINE}' AND {self._seen()}",
            "audit": f"""SELECT run_time, sum(row_count) AS total_rows, {counted.format(CLEAN, 'valid_rows')},
                {counted.format(QUARANTINE, 'quarantine_rows')}
                FROM {self.batches} WHERE {self._seen()} GROUP BY micro_batch, run_time HAVING sum(row_count) > 0""",
        }
        for name, text in views.items():
            spark.sql(f"CREATE OR REPLACE VIEW {self.namespace}.{name} AS {text}")


def _placed(checked: DataFrame, store: SilverStore) -> DataFrame:
    """Checked readings with the partition they belong to and what ranks them."""
    passed = f"{quality.REASON} IS NULL"
    return with_body_hash(checked).selectExpr(
        "*",
        f"if({passed}, '{CLEAN}', '{QUARANTINE}') AS outcome",
        f"if({passed}, {store.period.of('event_time')}, NULL) AS {PERIOD}",
    )


def _fit(spark: SparkSession, store: SilverStore, columns: StructType) -> None:
    """Give the table the columns that it lacks; they are null in the rows there are."""
    known = {field.name: field.dataType for field in spark.table(store.readings).schema}
    for field in columns:
        if known.get(field.name, field.dataType) != field.dataType:
            raise ValueError(f"{store.readings}: column {field.name} changed its type")
    if tables.add_columns(spark, store.readings, [f for f in columns if f.name not in known]):
        store._show(spark)


def write_batch(
    bronze: DataFrame,
    store: SilverStore,
    micro_batch: int = 0,
    as_of: datetime | str | None = None,
    cluster: bool = False,
    **options,
) -> None:
    """Store one batch; running it again replaces the batch.

    As it is, the write needs no shuffle and suits input near in time, where a
    task holds few periods. For backfills of many small or mixed files set
    ``cluster``: rows are rebalanced by period, which merges small periods
    into one task and splits one with many rows over several.
    ``options`` go to :func:`checked_readings`. Columns that the table lacks are added to
    it; one that changes its type is refused.
    """
    spark = bronze.sparkSession
    run_time, attempt = as_of or datetime.now(timezone.utc), uuid.uuid4().hex
    placed = _placed(checked_readings(bronze, run_time, **options), store)
    store.create(spark, placed.schema)
    _fit(spark, store, placed.schema)
    placed = placed.selectExpr("*", f"{micro_batch} AS micro_batch", f"'{attempt}' AS attempt")
    tables.insert(placed.hint("rebalance", "outcome", PERIOD) if cluster else placed, store.readings)
    _switch(spark, store, [attempt], f"map({micro_batch}, {moment(run_time)})")


def _switch(spark: SparkSession, store: SilverStore, attempts: list[str], run_times: str) -> None:
    """Let readers see these attempts, each of a batch of the map ``run_times``: count what
    they wrote. Periods that a batch held before stay, with no rows, as products over them
    change too."""
    own = spark.table(store.readings).where(F.col("attempt").isin(attempts))
    lines = own.groupBy("outcome", PERIOD, "micro_batch", "attempt").agg(
        F.count("*").alias("row_count"), F.max("event_time").alias("newest_event_time")
    )
    # a line for each batch, so that one without rows is replaced as well
    held = spark.sql(f"SELECT explode(map_keys({run_times})) AS micro_batch")
    name = f"'{attempts[0]}'" if len(attempts) == 1 else f"concat('{attempts[0].rsplit('-', 1)[0]}-', micro_batch)"
    nothing = (f"{name} AS attempt", "0L AS row_count", "CAST(NULL AS timestamp) AS newest_event_time")
    held = held.selectExpr(f"'{CLEAN}' AS outcome", f"CAST(NULL AS date) AS {PERIOD}", "micro_batch", *nothing)
    before = store._clean_lines(spark).where(f"array_contains(map_keys({run_times}), micro_batch)")
    before = before.selectExpr("outcome", PERIOD, "micro_batch", *nothing)
    whole = lines.unionByName(before).unionByName(held).groupBy("outcome", PERIOD, "micro_batch", "attempt")
    whole = whole.agg(F.sum("row_count").alias("row_count"), F.max("newest_event_time").alias("newest_event_time"))
    version = spark.table(store.batches).agg(F.coalesce(F.max("version"), F.lit(0)) + 1).scalar()
    stamped = whole.select("*", F.expr(f"{run_times}[micro_batch] AS run_time"), version.alias("version"))
    tables.insert(stamped.coalesce(1), store.batches)


def compact(spark: SparkSession, store: SilverStore, batches: list[int] | None = None) -> None:
    """Write complete batches (all, if none are named) again, each in few, even files for
    each period, under an attempt that readers then see. Readers who are on the old files
    stay on them until :func:`forget_replaced`. To be run between the runs of the stream."""
    counted = store.lines(spark).groupBy("micro_batch").agg(F.sum("row_count").alias("n"), F.expr("unix_micros(max(run_time)) AS at"))
    found = {row.micro_batch: row.at for row in counted.where("n > 0").collect()}
    chosen = sorted(found if batches is None else set(found) & set(batches))
    if not chosen:
        return
    attempt = uuid.uuid4().hex
    rows = store._rows(spark).where(F.col("micro_batch").isin(chosen))
    rows = rows.withColumn("attempt", F.expr(f"concat('{attempt}-', micro_batch)"))
    tables.insert(rows.hint("rebalance", "micro_batch", "outcome", PERIOD), store.readings)
    run_times = ", ".join(f"{batch}, timestamp_micros({found[batch]})" for batch in chosen)
    _switch(spark, store, [f"{attempt}-{batch}" for batch in chosen], f"map({run_times})")


def forget_replaced(spark: SparkSession, store: SilverStore) -> list[str]:
    """Drop the partitions of attempts that no reader sees: replaced, compacted or left by a
    run that died. No reader may be on them, and no batch be in the writing."""
    seen = {row.attempt for row in store.lines(spark).select("attempt").distinct().collect()}
    dropped: set[str] = set()
    for table in (store.readings, store.batches):
        specs = []
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
            parts = [part.split("=", 1) for part in row[0].split("/")]
            if (attempt := dict(parts)["attempt"]) not in seen:
                # catalogs differ in what they take an incomplete specification for
                spec = ", ".join(f"{name} = {'null' if value == NULL_PARTITION else repr(value)}" for name, value in parts)
                specs.append(f"PARTITION ({spec})")
                dropped.add(attempt)
        for begin in range(0, len(specs), 500):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[begin : begin + 500])}")
    return sorted(dropped)
