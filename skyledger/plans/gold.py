"""Silver and bronze to the published products."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import products
from skyledger.plans import bronze as bronze_plan
from skyledger.plans.silver import PERIOD, SilverStore
from skyledger.sources import tables


def from_store(
    spark: SparkSession, store: SilverStore, bronze: DataFrame, as_of: datetime | str | None = None
) -> dict[str, DataFrame]:
    """All products over a silver store, reading only the periods they need."""
    clean = store.clean(spark, keep_period=True)
    recent = {"period": store.period, "newest": store.newest(spark)}
    return {
        "city_current": products.city_current(clean, store.period),
        "recent_24h": products.recent_readings(clean, **recent),
        "hourly_summary": products.hourly_summary(clean, **recent),
        "daily_extremes": products.daily_extremes(clean),
        "severe_alerts": products.severe_alerts(clean, **recent),
        "api_health": products.api_health(bronze, as_of, stored=True),
    }


def publish_all(
    spark: SparkSession,
    store: SilverStore,
    bronze: str,
    namespace: str,
    location: str,
    as_of: datetime | str | None = None,
) -> None:
    """Rebuild every product; each becomes current by its name in ``namespace``."""
    built = from_store(spark, store, bronze_plan.read(spark, bronze), as_of)
    for name, product in built.items():
        tables.publish(product, f"{namespace}.{name}", f"{location}/{name}", replace_schema=name != "city_current")


def replace_current(changed: DataFrame, name: str, location: str) -> None:
    """Publish the latest readings with ``changed`` in place of those of the same cities."""
    spark = changed.sparkSession
    if spark.catalog.tableExists(name):
        kept = spark.table(name).join(changed.select("city"), "city", "left_anti")
        changed = kept.unionByName(changed, allowMissingColumns=True)
    tables.publish(changed, name, location, replace_schema=True)


def merge_current(clean: DataFrame, name: str, location: str) -> None:
    """Publish the latest of the readings published so far and new ones.

    Costs the new readings and one row for each city, not history. Columns
    that either side lacks are null.
    """
    spark = clean.sparkSession
    if spark.catalog.tableExists(name):
        clean = spark.table(name).unionByName(clean, allowMissingColumns=True)
    tables.publish(products.city_current(clean), name, location, replace_schema=True)


def refresh_daily_extremes(spark: SparkSession, store: SilverStore, micro_batch: int, path: str) -> None:
    """Recompute the periods one batch touched and replace just those.

    Late rows revise their own periods; the rest of history is neither read
    nor written. Periods that a replaced batch held before count as touched, and those
    that have no rows left are removed. Running it again for the same batch changes
    nothing. The table at ``path`` is partitioned like the store.
    """
    touched = store.period_counts(spark, micro_batch)
    clean = store.clean(spark, keep_period=True).join(F.broadcast(touched.where("row_count > 0")), PERIOD, "left_semi")
    extremes = products.daily_extremes(clean).selectExpr("*", f"{store.period.of('event_date')} AS {PERIOD}")
    # a period in one file, not in one of each task
    tables.refresh_partitions(extremes.repartition(PERIOD), path, PERIOD)
    emptied = touched.where("row_count = 0").collect()
    tables.reset(spark, paths=[f"{path}/{PERIOD}={row[PERIOD]}" for row in emptied])


def read_daily_extremes(spark: SparkSession, path: str) -> DataFrame:
    return tables.scan(spark, path).drop(PERIOD)


HEALTH_PARTS_DDL = """
    city string, load_date date, total_calls bigint, successful_calls bigint, failed_calls bigint,
    parse_errors bigint, latency_sum bigint, latency_n bigint, latest_success_time timestamp, micro_batch int
"""
HOURLY_PARTS_DDL = """
    city string, event_hour_start timestamp, n_readings bigint, temperature_sum double, humidity_sum double,
    wind_speed_sum double, temperature_n bigint, humidity_n bigint, wind_speed_n bigint, total_rainfall double,
    micro_batch int
"""


def _replace_parts(parts: DataFrame, name: str, ddl: str, micro_batch: int) -> None:
    """Put the parts of one batch in place of those that the named table has of it."""
    spark = parts.sparkSession
    tables.create_table(spark, name, ddl, ["micro_batch"], overwrites=True)
    stamped = parts.selectExpr("*", f"{micro_batch} AS micro_batch")
    # a batch without rows has to replace its partition as well: a row that adds nothing
    zero = spark.range(1).selectExpr(f"{micro_batch} AS micro_batch")
    # not gathered in one task: a batch may have about as many parts as rows
    tables.insert(stamped.unionByName(zero, allowMissingColumns=True), name, overwrite=True)


def _parts(spark: SparkSession, name: str, key: str) -> DataFrame:
    spark.catalog.refreshTable(name)  # a replaced file may be known to this session yet
    return spark.table(name).where(F.col(key).isNotNull())


def add_health(calls: DataFrame, micro_batch: int, name: str) -> None:
    """Merge the calls of one batch into the parts of API health kept under ``name``. Costs
    the batch's calls; run again for it, the batch replaces what it added."""
    parts = products.health_parts(calls.where(F.col("requested_city").isNotNull()))
    _replace_parts(parts, name, HEALTH_PARTS_DDL, micro_batch)


def kept_health(spark: SparkSession, name: str, as_of: datetime | str | None = None) -> DataFrame:
    """API health from the parts of all batches: a row for each city, date and batch."""
    return products.health_from_parts(_parts(spark, name, "city"), as_of)


def add_hours(spark: SparkSession, store: SilverStore, micro_batch: int, name: str) -> None:
    """Merge the clean readings of one batch of a store into the hourly parts kept under
    ``name``; run again for it, the batch replaces what it added."""
    _replace_parts(products.hourly_parts(store.clean_of(spark, micro_batch)), name, HOURLY_PARTS_DDL, micro_batch)


def kept_hours(spark: SparkSession, store: SilverStore, name: str, hours: float = 24) -> DataFrame:
    """The hourly summary of the last ``hours``, from the parts of all batches but for the
    hour that the bound lies in, whose readings from the bound on are read."""
    bound = store.newest(spark) - F.lit(timedelta(hours=hours))
    since = F.date_trunc("hour", bound)
    whole = _parts(spark, name, "event_hour_start").where(F.col("event_hour_start") > since).drop("micro_batch")
    clean = products.recent_readings(store.clean(spark, keep_period=True), hours, store.period, store.newest(spark))
    first = clean.where(F.date_trunc("hour", "event_time") == since)
    return products.hourly_from_parts(whole.unionByName(products.hourly_parts(first)))


def refresh_api_health(
    spark: SparkSession, bronze: str, load_date: str, path: str, as_of: datetime | str | None = None
) -> None:
    """Recompute API health of one load date, read and replaced alone."""
    calls = bronze_plan.read(spark, bronze).where(F.col("load_date") == F.lit(load_date).cast("date"))
    tables.refresh_partitions(products.api_health(calls, as_of, stored=True), path, "load_date")
