"""Session settings and the shared folder jobs may write scratch tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # event_date, event_hour and every timestamp shown are in this zone
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # JSON bodies compress about 20x in parquet, so a split of the default
    # 128 MB would decode to gigabytes of text in one task
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # by default a task lists one folder, which is a small part of what the task costs
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # the JVM never compiles a method of more bytes; Spark then makes one of each step, not of a stage
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # call sites of column expressions in errors cost a stack walk for each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# with one part for each core, one part too many makes a scan take twice as long
PARTS_PER_CORE = 4

_local_fallback: dict[str, str] = {}


def build_session(app: str = "skyledger", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make an existing session derive dates and hours in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bound_listing(spark: SparkSession) -> SparkSession:
    """Make an existing session list tables of many partitions in few tasks."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    spark.conf.set(name, SETTINGS[name])
    return spark


def bound_methods(spark: SparkSession) -> SparkSession:
    """Make an existing session generate no method that the JVM would only interpret."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, SETTINGS[name])
    return spark


def even_scans(spark: SparkSession) -> SparkSession:
    """Make an existing session read tables in several parts for each core, as far as they have
    so many files or row groups, so that the last part keeps few cores waiting, and not for long."""
    parts = PARTS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.files.minPartitionNum", str(parts))
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster executors do not share the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        if app not in _local_fallback:
            _local_fallback[app] = tempfile.mkdtemp(prefix="skyledger-")
        base = _local_fallback[app]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
