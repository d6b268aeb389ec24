"""Silver store, streams and gold jobs: replays, late rows, restarts."""

from __future__ import annotations

import contextlib
import io
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from samples import AS_OF, CALLED, NOON, body, bronze, call, main, store_at

from skyledger.operators import products, quality
from skyledger.plans import bronze as bronze_plan
from skyledger.plans import gold
from skyledger.plans import silver as silver_plan
from skyledger.plans.silver import SilverStore, checked_readings, write_batch
from skyledger.schemas import BRONZE_COLUMNS, BRONZE_DDL, QUARANTINE_COLUMNS
from skyledger.sources import captures, tables
from skyledger.streaming import bronze as bronze_stream
from skyledger.streaming import current, silver

DAY_SECONDS = 86_400
NOON_TEXT = "2031-02-03 12:00:00.25"


def responses(n=30, offset=0):
    """Readings over some days and cities, every fifth one bad."""
    return [
        call(
            body(name=f"city{i % 4}", dt=NOON + (i % 7) * DAY_SECONDS + i, main=main(temp=99 if i % 5 == 0 else i)),
            status=500 if i % 11 == 3 else 200,
            city=f"city{i % 4}",
            at=CALLED + timedelta(minutes=i),
        )
        for i in range(offset, offset + n)
    ]


def contents(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("unit, cluster", [("day", False), ("day", True), ("month", True)])
def test_batch_lands_whole_and_replays_in_place(spark, folder, unit, cluster):
    store = store_at(folder, unit)
    rows = bronze(spark, *responses())
    write_batch(rows, store, 0, AS_OF, cluster)
    before = contents(store.clean(spark)), contents(store.quarantine(spark)), contents(store.audit(spark))
    log = store.audit(spark).first()
    assert (log.total_rows, log.valid_rows + log.quarantine_rows) == (30, 30)
    assert (len(before[0]), len(before[1])) == (log.valid_rows, log.quarantine_rows)
    assert store.quarantine(spark).columns == QUARANTINE_COLUMNS
    write_batch(rows, store, 0, AS_OF, cluster)
    assert before == (contents(store.clean(spark)), contents(store.quarantine(spark)), contents(store.audit(spark)))


class Died(Exception):
    """Stands for the end of a run."""


def dies_at(monkeypatch, step):
    """Let the ``step``-th insert of the next run end before (odd) or after (even) it."""
    count, insert = [0], tables.insert

    def run(df, name):
        count[0] += 1
        if count[0] == step:
            raise Died
        insert(df, name)
        count[0] += 1
        if count[0] == step:
            raise Died

    monkeypatch.setattr(tables, "insert", run)


@pytest.mark.parametrize("step", [1, 2, 3])
@pytest.mark.parametrize("number", [0, 1])
def test_a_run_that_dies_shows_the_rows_there_were(spark, folder, monkeypatch, step, number):
    store = store_at(folder)
    for n in range(2):
        write_batch(bronze(spark, *responses(30, 30 * n)), store, n, AS_OF)

    def seen():
        return [contents(read(spark)) for read in (store.clean, store.quarantine, store.audit)]

    before = seen()
    with monkeypatch.context() as patched:
        dies_at(patched, step)
        with pytest.raises(Died):
            write_batch(bronze(spark, *responses(9, 100)), store, number, AS_OF)
    assert seen() == before
    assert contents(spark.newSession().table(f"{store.namespace}.clean")) == before[0]
    write_batch(bronze(spark, *responses(9, 100)), store, number, AS_OF)
    after = seen()
    assert after != before
    assert len(silver_plan.forget_replaced(spark, store)) in (1, 2)
    assert seen() == after


def test_first_batch_that_dies_is_not_seen(spark, folder, monkeypatch):
    store = store_at(folder)
    with monkeypatch.context() as patched:
        dies_at(patched, 2)
        with pytest.raises(Died):
            write_batch(bronze(spark, *responses()), store, 0, AS_OF)
    assert store.clean(spark).count() == store.audit(spark).count() == 0


@pytest.mark.parametrize("step", [1, 2, 3, 4])
def test_extremes_have_no_stale_day_after_a_run_that_died(spark, folder, monkeypatch, step):
    store, path = store_at(f"{folder}/silver"), f"{folder}/extremes"
    write_batch(bronze(spark, *responses(30)), store, 0, AS_OF)
    gold.refresh_daily_extremes(spark, store, 0, path)
    with monkeypatch.context() as patched:
        dies_at(patched, step)
        with pytest.raises(Died):
            write_batch(bronze(spark, *responses(2, 1)), store, 0, AS_OF)
    write_batch(bronze(spark, *responses(2, 1)), store, 0, AS_OF)
    gold.refresh_daily_extremes(spark, store, 0, path)
    got = contents(gold.read_daily_extremes(spark, path))
    assert got == contents(products.daily_extremes(store.clean(spark)))


def test_batch_of_undated_rows_only(spark, folder):
    store = store_at(folder)
    write_batch(bronze(spark, call(None), call("", 200)), store, 0, AS_OF)
    assert (store.clean(spark).count(), store.quarantine(spark).count()) == (0, 2)
    assert products.city_current(store.clean(spark, keep_period=True), store.period).count() == 0
    write_batch(bronze(spark, *responses()), store, 1, AS_OF)
    assert store.quarantine(spark).count() + store.clean(spark).count() == 32


def test_store_without_a_batch(spark, folder):
    store, filled = store_at(f"{folder}/a"), store_at(f"{folder}/b")
    write_batch(bronze(spark, *responses()), filled, 0, AS_OF)
    for read in (lambda s: s.clean(spark), lambda s: s.quarantine(spark), lambda s: s.audit(spark)):
        assert read(store).count() == 0
        assert read(store).dtypes == read(filled).dtypes
    for name in ("clean", "quarantine", "audit"):
        assert spark.newSession().table(f"{store.namespace}.{name}").count() == 0
    assert products.city_current(store.clean(spark, keep_period=True), store.period).count() == 0


def test_replaced_batch_leaves_no_extremes(spark, folder):
    store, path = store_at(f"{folder}/silver"), f"{folder}/extremes"
    for rows in (responses(30), responses(2, 1)):
        write_batch(bronze(spark, *rows), store, 0, AS_OF)
        gold.refresh_daily_extremes(spark, store, 0, path)
        got = contents(gold.read_daily_extremes(spark, path))
        assert got == contents(products.daily_extremes(store.clean(spark)))
    assert len(got) < 4
    write_batch(bronze(spark), store, 0, AS_OF)
    for _ in range(2):
        gold.refresh_daily_extremes(spark, store, 0, path)
        assert not [name for name in os.listdir(path) if name.startswith("event_period")]


def test_compaction_changes_no_row(spark, folder):
    store, plain = store_at(f"{folder}/a"), store_at(f"{folder}/b")
    silver_plan.compact(spark, store)  # nothing yet
    for number in range(4):
        for one in (store, plain):
            write_batch(bronze(spark, *responses(9, 9 * number)).repartition(3), one, number, AS_OF if number else NOON_TEXT)
        if number in (1, 3):
            silver_plan.compact(spark, store, None if number == 1 else [3, 99])
            if number == 3:
                assert silver_plan.forget_replaced(spark, store)
        for read in (SilverStore.clean, SilverStore.quarantine, SilverStore.audit):
            assert contents(read(store, spark)) == contents(read(plain, spark))
        assert store.periods(spark, number) == plain.periods(spark, number)
    assert spark.table(store.readings).count() == spark.table(plain.readings).count()
    write_batch(bronze(spark, *responses(5, 50)), store, 0, AS_OF)
    write_batch(bronze(spark, *responses(5, 50)), plain, 0, AS_OF)
    assert contents(store.clean(spark)) == contents(plain.clean(spark))
    write_batch(bronze(spark, *responses(90)).repartition(3), store, 4, AS_OF)
    before = len(spark.table(store.readings).inputFiles())
    silver_plan.compact(spark, store)
    silver_plan.forget_replaced(spark, store)
    assert len(spark.table(store.readings).inputFiles()) < before
    write_batch(bronze(spark, *responses()), store, 3, AS_OF)


@pytest.mark.parametrize("step", [1, 2, 3])
def test_failed_compaction_is_not_seen(spark, folder, monkeypatch, step):
    store = store_at(folder)
    write_batch(bronze(spark, *responses()), store, 0, AS_OF)
    before = contents(store.clean(spark)), contents(store.audit(spark))
    with monkeypatch.context() as patched:
        dies_at(patched, step)
        with pytest.raises(Died):
            silver_plan.compact(spark, store)
    assert (contents(store.clean(spark)), contents(store.audit(spark))) == before
    silver_plan.compact(spark, store)
    silver_plan.forget_replaced(spark, store)
    assert (contents(store.clean(spark)), contents(store.audit(spark))) == before


def test_store_ranks_without_bodies(spark, folder):
    store = store_at(folder)
    write_batch(bronze(spark, *responses(40)), store, 0, AS_OF)
    stored = gold.from_store(spark, store, bronze(spark, call(body())), AS_OF)["severe_alerts"]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        stored.explain("formatted")
    assert "body_hash" in out.getvalue() and "raw_response" not in out.getvalue()


def test_empty_batch(spark, folder):
    store = store_at(folder)
    write_batch(bronze(spark), store, 0, AS_OF)
    assert store.audit(spark).count() == store.clean(spark).count() == 0
    write_batch(bronze(spark, *responses(5)), store, 1, AS_OF)
    write_batch(bronze(spark), store, 2, AS_OF)
    assert store.audit(spark).first().total_rows == 5


def test_added_column_is_null_in_older_batches(spark, folder):
    store = store_at(folder)
    write_batch(bronze(spark, *responses(5, 1)), store, 0, AS_OF)
    write_batch(bronze(spark, *responses(5, 11)).withColumn("region", F.lit("south")), store, 1, AS_OF)
    write_batch(bronze(spark, *responses(5, 21)), store, 2, AS_OF)
    regions = store.clean(spark).groupBy("region").count().collect()
    assert {r.region for r in regions} == {None, "south"}


def test_column_of_another_type_is_refused(spark, folder):
    store = store_at(folder)
    write_batch(bronze(spark, *responses(5, 1)).withColumn("region", F.lit("south")), store, 0, AS_OF)
    before = contents(store.clean(spark))
    with pytest.raises(ValueError, match="region"):
        write_batch(bronze(spark, *responses(5, 1)).withColumn("region", F.lit(1)), store, 1, AS_OF)
    assert contents(store.clean(spark)) == before
    assert "region" in spark.newSession().table(f"{store.namespace}.clean").columns


def test_kept_struct(spark, folder):
    store = store_at(folder)
    write_batch(bronze(spark, call(body())), store, 0, AS_OF, keep_parsed=True)
    assert store.clean(spark).select("parsed.main.temp").first()[0] == 21.5


@pytest.mark.parametrize("unit", ["day", "month"])
def test_store_products_equal_plain_ones(spark, folder, unit):
    store = store_at(folder, unit)
    for number in range(3):
        write_batch(bronze(spark, *responses(40, 40 * number)), store, number, AS_OF)
    clean = store.clean(spark)
    stored = gold.from_store(spark, store, bronze(spark, *responses()), AS_OF)
    plain = {
        "city_current": products.city_current(clean),
        "recent_24h": products.recent_readings(clean),
        "hourly_summary": products.hourly_summary(clean),
        "daily_extremes": products.daily_extremes(clean),
        "severe_alerts": products.severe_alerts(clean),
    }
    for name, frame in plain.items():
        assert contents(stored[name]) == contents(frame), name
        assert frame.count() > 0 or name == "severe_alerts"


def test_store_products_prune_partitions(spark, folder):
    store = store_at(folder)
    write_batch(bronze(spark, *responses(40)), store, 0, AS_OF)
    stored = gold.from_store(spark, store, bronze(spark, call(body())), AS_OF)
    for name in ("city_current", "recent_24h", "hourly_summary", "severe_alerts"):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            stored[name].explain("formatted")
        filters = [line for line in out.getvalue().splitlines() if line.startswith("PartitionFilters")]
        assert any("event_period" in line and "ubquery" in line for line in filters), name


def test_gold_refresh_of_touched_days(spark, folder):
    store, path = store_at(f"{folder}/silver"), f"{folder}/extremes"
    for number, offset in enumerate((0, 30, 60)):
        write_batch(bronze(spark, *responses(30, offset)), store, number, AS_OF)
        gold.refresh_daily_extremes(spark, store, number, path)
    gold.refresh_daily_extremes(spark, store, 2, path)
    assert contents(gold.read_daily_extremes(spark, path)) == contents(products.daily_extremes(store.clean(spark)))


def bronze_files(spark, path, *parts):
    for rows in parts:
        rows.select(*BRONZE_COLUMNS).coalesce(1).write.mode("append").partitionBy("load_date").parquet(path)
    return tables.stream(spark, path, BRONZE_DDL, maxFilesPerTrigger="1")


def test_stream_equals_batch_and_restarts_where_it_was(spark, folder):
    path, store = f"{folder}/bronze", store_at(f"{folder}/silver")
    parts = [bronze(spark, *responses(30, offset)) for offset in (0, 30, 60)]
    source = bronze_files(spark, path, *parts)
    silver.drain(source, store, AS_OF)
    assert store.audit(spark).count() == 3
    silver.drain(source, store, AS_OF)
    assert store.audit(spark).count() == 3

    whole = store_at(f"{folder}/whole")
    write_batch(bronze(spark, *responses(90)), whole, 0, AS_OF)
    assert contents(store.clean(spark)) == contents(whole.clean(spark))
    assert contents(store.quarantine(spark)) == contents(whole.quarantine(spark))

    bronze_files(spark, path, bronze(spark, *responses(10, 90)))
    silver.drain(source, store, AS_OF)
    assert store.audit(spark).agg(F.sum("total_rows")).first()[0] == 100


def test_replayed_micro_batch_adds_nothing(spark, folder):
    path, store = f"{folder}/bronze", store_at(f"{folder}/silver")
    source = bronze_files(spark, path, *[bronze(spark, *responses(20, offset)) for offset in (0, 20)])
    silver.drain(source, store, AS_OF)
    before = contents(store.clean(spark)), contents(store.quarantine(spark)), contents(store.audit(spark))
    # as after a crash between the last write and Spark's own commit
    commits = f"{store.checkpoint}/commits"
    for name in ("1", ".1.crc"):
        os.remove(f"{commits}/{name}")
    silver.drain(source, store, AS_OF)
    assert os.path.exists(f"{commits}/1")
    assert before == (contents(store.clean(spark)), contents(store.quarantine(spark)), contents(store.audit(spark)))


def test_streamed_current_equals_batch(spark, folder):
    path = f"{folder}/bronze"
    source = bronze_files(spark, path, *[bronze(spark, *responses(30, offset)) for offset in (0, 30)])
    tables.create_layers(spark, ["streamed"])
    name = "streamed.city_current"
    current.start(source, name, f"{folder}/current", f"{folder}/checkpoint", AS_OF).awaitTermination()
    store = store_at(f"{folder}/silver")
    write_batch(bronze(spark, *responses(60)), store, 0, AS_OF)
    assert contents(spark.table(name)) == contents(products.city_current(store.clean(spark)))
    # a late reading does not replace a later one
    bronze_files(spark, path, bronze(spark, call(body(name="city1", dt=NOON - DAY_SECONDS), city="city1")))
    before = contents(spark.table(name))
    current.start(source, name, f"{folder}/current", f"{folder}/checkpoint", AS_OF).awaitTermination()
    assert contents(spark.table(name)) == before
    spark.sql(f"DROP VIEW {name}")


def test_merged_current_takes_late_repeated_and_wider_rows(spark, folder):
    tables.create_layers(spark, ["merged"])
    name, path = "merged.city_current", f"{folder}/current"
    batches = [quality.clean_rows(checked_readings(bronze(spark, *responses(30, n)), AS_OF)) for n in (30, 0, 60)]
    for batch in [*batches, batches[0]]:
        gold.merge_current(batch, name, path)
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    assert contents(spark.table(name)) == contents(products.city_current(whole))
    wider = bronze(spark, call(body(name="new"), city="new")).withColumn("region", F.lit("south"))
    gold.merge_current(quality.clean_rows(checked_readings(wider, AS_OF)), name, path)
    assert {(r.city, r.region) for r in spark.table(name).collect()} == {
        ("new", "south"), *[(f"city{i}", None) for i in range(4)]
    }


def test_publish_all(spark, folder):
    store, path = store_at(f"{folder}/silver"), f"{folder}/bronze"
    rows = bronze(spark, *responses())
    tables.append(rows, path, ["load_date"])
    write_batch(rows, store, 0, AS_OF)
    tables.create_layers(spark, ["shown"])
    for _ in range(2):
        gold.publish_all(spark, store, path, "shown", f"{folder}/gold", AS_OF)
    assert spark.table("shown.city_current").count() == 4
    assert spark.sql("SELECT sum(total_calls) FROM shown.api_health").first()[0] == 30
    gold.refresh_api_health(spark, path, AS_OF[:10], f"{folder}/health", AS_OF)
    assert tables.scan(spark, f"{folder}/health").agg(F.sum("total_calls")).first()[0] == 30


def test_landing_stream_takes_each_capture_once(spark, folder):
    landing, table = f"{folder}/landing", f"{folder}/bronze"
    for offset in (0, 20):
        captures.land(captures.capture_rows(spark, responses(20, offset)), landing)
        stream = captures.stream_captures(spark, landing, maxFilesPerTrigger="2")
        assert bronze_stream.start(stream, table, f"{folder}/checkpoint", AS_OF).awaitTermination(120)
    rows = bronze_plan.read(spark, table)
    assert contents(rows) == contents(bronze(spark, *responses(40)))


def test_compacted_date_has_the_same_rows_in_one_file(spark, folder):
    table, archive = f"{folder}/bronze", f"{folder}/archive"
    for offset in range(0, 30, 6):
        bronze_plan.append_captures(captures.capture_rows(spark, responses(6, offset)), table, AS_OF)
    bronze_plan.append_captures(captures.capture_rows(spark, responses(6)), table, "2031-02-04 01:00:00")
    for _ in range(2):
        bronze_plan.compact(spark, table, archive, AS_OF[:10])
    day = bronze_plan.read(spark, table).where(f"load_date = DATE '{AS_OF[:10]}'")
    assert contents(bronze_plan.read(spark, archive)) == contents(day)
    assert len(tables.scan(spark, archive).inputFiles()) == 1
    whole = contents(bronze_plan.read(spark, table))
    assert contents(bronze_plan.read_whole(spark, table, f"{folder}/none")) == whole
    assert contents(bronze_plan.read_whole(spark, table, archive)) == whole
    tables.refresh_partitions(bronze_plan.read(spark, archive).limit(0), archive, "load_date")
    assert contents(bronze_plan.read_whole(spark, table, archive)) == whole
