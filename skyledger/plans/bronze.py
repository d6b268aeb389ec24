"""Landing zone to bronze.

Every append is a folder of its own below the table, ``ingest=<name>``, whether a
batch or a micro-batch of a stream wrote it: both fill one table, and an append that
is run again under its name replaces what it wrote before.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.schemas import BRONZE_COLUMNS, BRONZE_DDL
from skyledger.sources import captures, tables


def ingest(spark: SparkSession, landing: str, bronze: str, as_of: datetime | str | None = None) -> None:
    """Append all captures of a landing folder to the bronze table."""
    append_captures(captures.read_captures(spark, landing), bronze, as_of)


def append_captures(
    rows: DataFrame, bronze: str, as_of: datetime | str | None = None, name: str | None = None
) -> None:
    """Append under ``name``, or under one that no other append has."""
    own = f"{bronze}/ingest={name or uuid.uuid4().hex}"
    stamped = captures.stamp(rows, as_of).select(*BRONZE_COLUMNS)
    stamped.write.mode("overwrite").partitionBy("load_date").parquet(own)


def read(spark: SparkSession, bronze: str) -> DataFrame:
    return tables.scan(spark, bronze, BRONZE_DDL).select(*BRONZE_COLUMNS)


def read_whole(spark: SparkSession, bronze: str, archive: str) -> DataFrame:
    """Every row once: the dates that the archive holds from there, all others from bronze.

    The dates are the archive's partitions, so none of its files is opened to tell them, and
    both scans are pruned by them. A date that gets rows after it was archived has to be
    compacted again; until then readers see it as it was.
    """
    if not tables.path_exists(spark, archive):
        return read(spark, bronze)
    closed = tables.scan(spark, archive, BRONZE_DDL).select("load_date").distinct()
    kept = read(spark, bronze).where(~F.array_contains(_dates(closed), F.col("load_date")) | F.col("load_date").isNull())
    return read(spark, archive).unionAll(kept)


def _dates(rows: DataFrame) -> Column:
    """At most one entry for each date of history."""
    return rows.agg(F.collect_set("load_date")).scalar()


def compact(spark: SparkSession, bronze: str, archive: str, load_date: str) -> None:
    """Copy one closed load date into an archive table of few, even files.

    Polls leave many tiny files. The copy goes to a table of its own, so that
    neither a stream over bronze nor a failed run sees rows twice; running it
    again replaces the date. :func:`read_whole` takes such dates from there.
    """
    day = read(spark, bronze).where(F.col("load_date") == F.lit(load_date).cast("date"))
    tables.refresh_partitions(day.hint("rebalance"), archive, "load_date")
