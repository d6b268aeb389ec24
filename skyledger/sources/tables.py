"""Tables by path or by name: scans, appends, published products, DDL."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField


def scan(spark: SparkSession, path: str, ddl: str | None = None, merge_schema: bool = False) -> DataFrame:
    """A stored table.

    Later batches may carry added columns. ``ddl`` reads all files by one
    declared schema at no cost, missing columns being null; ``merge_schema``
    finds the union from the footers of every file.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    return (reader.schema(ddl) if ddl else reader).parquet(path)


def stream(spark: SparkSession, path: str, ddl: str, **options: str) -> DataFrame:
    """A stored append-only table as a stream.

    ``maxBytesPerTrigger`` (a plain number) or ``maxFilesPerTrigger`` bound a
    micro-batch.
    """
    return spark.readStream.schema(ddl).options(**options).parquet(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write rows that several passes need, and read them back.

    Passes then cost what their columns cost instead of a parse each, and a
    lost executor does not send them back to the start.
    """
    df.write.mode("overwrite").parquet(path)
    return scan(df.sparkSession, path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").format("parquet").partitionBy(*partition_by).saveAsTable(name)


def overwrite_table(df: DataFrame, name: str, replace_schema: bool = False) -> None:
    """Replace all rows of a named table, and its columns if told to."""
    spark = df.sparkSession
    if not replace_schema and spark.catalog.tableExists(name):
        _same_columns(df, spark.table(name), name)
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def _same_columns(new: DataFrame, old: DataFrame, label: str) -> None:
    def columns(df: DataFrame) -> list[tuple[str, str]]:
        return [(field.name, field.dataType.simpleString()) for field in df.schema]

    if columns(new) != columns(old):
        raise ValueError(f"{label}: columns differ from the present ones; replace the schema explicitly")


# -- products ---------------------------------------------------------------


def publish(df: DataFrame, name: str, location: str, replace_schema: bool = False) -> None:
    """Replace the product ``name`` by the rows of ``df``.

    Rows go to a fresh folder below ``location``; the named view is then pointed at it,
    which the catalog does at once. So readers see the old rows or the new ones, a
    failed run leaves the old ones in place whatever runs came before or clocks say, and
    a product may be built from itself. Old folders stay, as readers may still be on
    them; :func:`forget_before` is the job that removes them.
    """
    spark = df.sparkSession
    if not replace_schema and spark.catalog.tableExists(name):
        _same_columns(df, spark.table(name), name)
    folder = f"{location}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    quoted = folder.replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW IDENTIFIER(:name) AS SELECT * FROM parquet.`{quoted}`", {"name": name})


def forget_before(spark: SparkSession, name: str, location: str, before: datetime) -> list[str]:
    """Delete the folders of a product last written before a time with a zone, but for the
    one that its view reads."""
    files, place = _open(spark, location)
    present = {path.rsplit("/", 2)[-2] for path in spark.table(name).inputFiles()}
    if not present and spark.catalog.tableExists(name):
        raise ValueError(f"{name}: the folder in use cannot be told")
    found = [x for x in files.listStatus(place) if x.getPath().getName() not in present]
    old = [x.getPath() for x in found if x.getModificationTime() < before.timestamp() * 1000]
    for path in old:
        files.delete(path, True)
    return sorted(path.getName() for path in old)


def refresh_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace only the partitions that ``df`` holds rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


# -- namespaces and named tables --------------------------------------------


def create_layers(
    spark: SparkSession, names: Sequence[str] = ("bronze", "silver", "gold"), location: str | None = None
) -> None:
    """Create the schemas unless they are there, below ``location`` if given."""
    for name in names:
        place = f"LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name) {place}", {"name": name})


def create_table(
    spark: SparkSession,
    name: str,
    ddl: str,
    partition_by: Sequence[str] = (),
    overwrites: bool = False,
    distinct: Sequence[str] = (),
) -> None:
    """Create an empty typed table unless it is there. With ``overwrites`` whatever is
    inserted replaces the partitions that it has rows of, and no others. ``distinct`` names
    columns whose values hardly repeat: files hold them plainly, as a dictionary of them
    would be hashed for each row and spare nothing. Names in lower case, as options are."""
    layout = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    given = {"partitionOverwriteMode": "dynamic"} if overwrites else {}
    given |= {f"parquet.enable.dictionary#{column}": "false" for column in distinct}
    options = f"OPTIONS ({', '.join(f"'{key}' '{value}'" for key, value in given.items())})" if given else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({ddl}) USING PARQUET {options} {layout}", {"name": name})


def insert(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """Insert rows by the names of the table's columns; those that the frame lacks are null.
    ``overwrite`` replaces the partitions that get rows, if the table was made so."""
    target = df.sparkSession.table(name).schema
    columns = [F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
    df.select(*columns).write.insertInto(name, overwrite=overwrite)


def add_columns(spark: SparkSession, name: str, fields: Sequence[StructField]) -> bool:
    """Add columns to a named table; older rows have nulls there."""
    if fields:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return bool(fields)


def stream_table(spark: SparkSession, name: str, **options: str) -> DataFrame:
    """A named append-only table as a stream; options as in :func:`stream`."""
    return spark.readStream.options(**options).table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})


def _open(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _open(spark, path)
    return files.exists(place)


def reset(spark: SparkSession, tables: Sequence[str] = (), paths: Sequence[str] = ()) -> None:
    """Drop the named tables and delete the given folders."""
    for name in tables:
        drop_table(spark, name)
    for path in paths:
        files, place = _open(spark, path)
        files.delete(place, True)
