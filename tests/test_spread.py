"""Work that is to grow with the tasks: even parts of the feed, one file a period, no gathering."""

from __future__ import annotations

import contextlib
import glob
import io
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from samples import AS_OF, NOON, body, bronze, call, main, store_at
from test_jobs import DAY_SECONDS, contents
from test_kept_products import space

import __spark_entry__ as entry
from skyledger.operators import products, quality
from skyledger.plans import gold, silver
from skyledger.schemas import BRONZE_COLUMNS
from skyledger.session import PARTS_PER_CORE, SETTINGS, bound_listing, bound_methods, even_scans
from skyledger.sources import captures, event_feed, tables

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint"


def events_at(spark, folder, ids):
    """A table of one row group."""
    rows = [(n, datetime(2024, 1, 1, 0, 0, k % 60), k % 5) for k, n in enumerate(ids)]
    spark.createDataFrame(rows, EVENTS_DDL).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return spark.read.schema(EVENTS_DDL).parquet(f"{folder}/events.parquet")


def test_feed_comes_in_even_parts_by_id(spark, folder, monkeypatch):
    events = events_at(spark, folder, [*reversed(range(200)), None, None, 7, 7])
    assert events.rdd.getNumPartitions() == 1
    monkeypatch.setattr(event_feed, "ROWS_PER_TASK", 50)
    found = event_feed.read_captures(spark, folder)
    assert contents(found) == contents(event_feed.captures_from(events))
    parts = found.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min("event_id").alias("low"), F.max("event_id").alias("high"), F.count("*").alias("n")
    )
    parts = parts.orderBy("part").collect()
    assert len(parts) > 3 and max(row.n for row in parts) < 100
    assert all(a.high <= b.low for a, b in zip(parts, parts[1:], strict=False))


@pytest.mark.parametrize("count", [0, 3])
def test_few_events_are_not_shuffled(spark, folder, count):
    events = events_at(spark, folder, range(count))
    assert event_feed.spread(events, 3) is events


def test_bronze_files_of_streams_are_as_many_as_parts(spark, folder, monkeypatch):
    events_at(spark, folder, range(200))
    monkeypatch.setattr(event_feed, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(entry, "shared_dir", lambda spark, label: f"{folder}/{label}")
    entry._bronze_files(spark, folder)
    assert len(glob.glob(f"{folder}/bronze/*.parquet")) >= 4


def test_batches_of_compacted_silver_are_written_by_many_tasks(spark, folder, monkeypatch):
    events_at(spark, folder, range(600))
    tasks, insert = [], tables.insert

    def run(df, name, **options):
        if name.endswith(".readings") and "REBALANCE" not in df._jdf.queryExecution().toString().upper():
            tasks.append(df.rdd.getNumPartitions())
        insert(df, name, **options)

    monkeypatch.setattr(event_feed, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(tables, "insert", run)
    want = contents(entry._clean(spark, folder))
    assert contents(entry.compacted_silver(spark, folder)) == want
    assert len(tasks) == 3 and min(tasks) > 1


def dictionaries(table):
    """For each column, whether some file has a dictionary of it."""
    found = {}
    for name in table.inputFiles():
        parts = pq.ParquetFile(name.removeprefix("file://")).metadata
        for group in (parts.row_group(k) for k in range(parts.num_row_groups)):
            for column in (group.column(k) for k in range(group.num_columns)):
                found[column.path_in_schema] = found.get(column.path_in_schema, False) or column.has_dictionary_page
    return found


def test_store_keeps_no_dictionary_of_bodies(spark, folder):
    store = store_at(folder)
    for batch in range(2):
        # equal bodies, of which a dictionary would be small
        silver.write_batch(bronze(spark, *days(3), *days(3), call(None), call("{", status=404)), store, batch, AS_OF)
        before = contents(store.clean(spark)), contents(store.quarantine(spark)), contents(store.audit(spark))
        for _ in range(2):
            found = dictionaries(spark.table(store.readings))
            assert not found["raw_response"] and not found["body_hash"] and found["source_system"]
            silver.compact(spark, store)
            silver.forget_replaced(spark, store)
            assert (contents(store.clean(spark)), contents(store.quarantine(spark)), contents(store.audit(spark))) == before


def test_compaction_reads_the_store_in_one_scan(spark, folder, monkeypatch):
    store, plans, insert = store_at(folder), [], tables.insert

    def run(df, name, **options):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        insert(df, name, **options)

    silver.write_batch(bronze(spark, *days(2), call("{", status=404)), store, 0, AS_OF)
    monkeypatch.setattr(tables, "insert", run)
    silver.compact(spark, store)
    assert plans[0].count("FileScan") == 1 and plans[0].count("raw_response") and "Union" not in plans[0]


def days(n, cities=12):
    return [
        call(body(name=f"c{k}", dt=NOON + day * DAY_SECONDS + 60 * k, main=main(temp=k)))
        for day in range(n)
        for k in range(cities)
    ]


def test_extremes_take_one_file_a_period(spark, folder, monkeypatch):
    store, path = store_at(f"{folder}/silver"), f"{folder}/extremes"
    plans, refresh = [], tables.refresh_partitions

    def run(df, *rest):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        plans.append(out.getvalue())
        refresh(df, *rest)

    monkeypatch.setattr(tables, "refresh_partitions", run)
    for batch, rows in ((0, days(5)), (1, days(2)), (0, days(3))):
        silver.write_batch(bronze(spark, *rows), store, batch, AS_OF, cluster=True)
        gold.refresh_daily_extremes(spark, store, batch, path)
        assert contents(gold.read_daily_extremes(spark, path)) == contents(products.daily_extremes(store.clean(spark)))
    files = [len(glob.glob(f"{place}/*.parquet")) for place in glob.glob(f"{path}/event_period=*")]
    assert files == [1, 1, 1]
    assert all("dynamicpruning" in plan for plan in plans)  # periods not touched are not read


def test_parts_are_not_gathered_in_one_task(spark, folder):
    name, store = f"{space(spark)}.hours", store_at(folder)
    silver.write_batch(bronze(spark, *days(4)), store, 0, AS_OF)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        gold.add_hours(spark, store, 0, name)
    finally:
        spark.conf.set(coalesce, before)
    assert len(spark.table(name).inputFiles()) > 2
    assert contents(gold.kept_hours(spark, store, name)) == contents(products.hourly_summary(store.clean(spark)))


def test_listing_takes_few_tasks(spark):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        assert bound_listing(spark).conf.get(name) == SETTINGS[name]
    finally:
        spark.conf.set(name, before)


def test_feed_is_never_left_to_the_interpreter(spark, folder):
    events_at(spark, folder, [*range(80), None, 7])
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "65535")
        want = contents(event_feed.read_captures(spark, folder))
        found = entry._captures(spark, folder)
        assert int(spark.conf.get(name)) <= 8000  # HotSpot's limit; the feed takes about 9,000
        assert contents(found) == want
        assert bound_methods(spark) is spark
    finally:
        spark.conf.set(name, before)


SCAN_PARTS = "spark.sql.files.minPartitionNum"


@pytest.fixture
def scan_parts(spark):
    """Scans split as by default, before the test and after it."""
    before = spark.conf.get(SCAN_PARTS, None)
    spark.conf.unset(SCAN_PARTS)
    yield
    if before is None:
        spark.conf.unset(SCAN_PARTS)
    else:
        spark.conf.set(SCAN_PARTS, before)


def test_scans_have_several_parts_for_each_core(spark, folder, scan_parts):
    spark.range(9).repartition(9).write.parquet(f"{folder}/rows")
    files = len(glob.glob(f"{folder}/rows/*.parquet"))
    assert spark.read.parquet(f"{folder}/rows").rdd.getNumPartitions() < files
    assert even_scans(spark) is spark
    assert int(spark.conf.get(SCAN_PARTS)) == PARTS_PER_CORE * spark.sparkContext.defaultParallelism
    rows = spark.read.parquet(f"{folder}/rows")
    assert rows.rdd.getNumPartitions() == files and rows.count() == 9


def test_batches_of_a_stream_are_written_in_even_parts(spark, folder, scan_parts, monkeypatch):
    events_at(spark, folder, [*range(400), None, 7, 7])
    tasks, insert = [], tables.insert

    def run(df, name, **options):
        if name.endswith(".readings"):
            tasks.append(df.rdd.getNumPartitions())
        insert(df, name, **options)

    monkeypatch.setattr(event_feed, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(tables, "insert", run)
    monkeypatch.setattr(entry, "shared_dir", lambda spark, label: f"{folder}/{label}")
    calls = captures.stamp(entry._captures(spark, folder), entry.AS_OF).select(*BRONZE_COLUMNS)
    want = contents(quality.clean_rows(silver.checked_readings(calls, entry.AS_OF)))
    spark.conf.unset(SCAN_PARTS)
    found = entry.stream_clean(spark, folder)
    assert tasks == [len(glob.glob(f"{folder}/bronze/*.parquet"))] and tasks[0] > 4
    assert contents(found) == want
