"""Products kept up batch by batch, counts observed on a write, state that outlasts a stream."""

from __future__ import annotations

import os
import subprocess
import sys
import uuid
from pathlib import Path

from pyspark.sql import functions as F
from samples import AS_OF, NOON, body, bronze, call, main, store_at
from test_jobs import DAY_SECONDS, contents, responses

from skyledger.operators import audit, products, quality
from skyledger.plans import bronze as bronze_plan
from skyledger.plans import gold
from skyledger.plans.silver import checked_readings, write_batch
from skyledger.schemas import BRONZE_COLUMNS, BRONZE_DDL
from skyledger.sources import tables
from skyledger.streaming import current, silver


def space(spark):
    name = f"kept_{uuid.uuid4().hex[:8]}"
    tables.create_layers(spark, [name])
    return name


def test_health_from_parts_equals_a_rebuild(spark):
    name = f"{space(spark)}.health"
    batches = {n: bronze(spark, *responses(30, 30 * n)) for n in range(3)}
    for n, rows in batches.items():
        gold.add_health(rows, n, name)
    batches[1] = bronze(spark, *responses(7, 200))
    batches[2] = bronze(spark)
    for n in (1, 1, 2):
        gold.add_health(batches[n], n, name)
    whole = batches[0].unionAll(batches[1])
    assert contents(gold.kept_health(spark, name, AS_OF)) == contents(products.api_health(whole, AS_OF))
    assert {r.micro_batch for r in spark.table(name).select("micro_batch").collect()} == {0, 1, 2}


def test_hours_from_parts_equal_a_rebuild(spark, folder):
    name, store = f"{space(spark)}.hours", store_at(folder)
    times = (NOON, NOON - DAY_SECONDS, NOON - DAY_SECONDS - 1, NOON - DAY_SECONDS + 1, NOON - 2 * DAY_SECONDS)
    first = [call(body(name=f"c{k % 2}", dt=t + 60 * k, main=main(temp=k))) for k in range(9) for t in times]
    late = [call(body(name="c0", dt=NOON + 300, main=main(temp=40, humidity=7)))]
    for n, rows in ((0, first), (1, late), (0, first[::2]), (2, [])):
        write_batch(bronze(spark, *rows), store, n, AS_OF)
        gold.add_hours(spark, store, n, name)
        for hours in (24, 0.01, 1000):
            got = gold.kept_hours(spark, store, name, hours)
            assert contents(got) == contents(products.hourly_summary(store.clean(spark), hours)), (n, hours)


def test_archived_and_open_dates(spark, folder):
    table, archive = f"{folder}/bronze", f"{folder}/archive"
    days = ["2031-02-03 10:00:00", "2031-02-04 10:00:00", "2031-02-05 10:00:00"]
    for n, day in enumerate(days):
        bronze_plan.append_captures(bronze(spark, *responses(6, 6 * n)).select(*BRONZE_COLUMNS[:5]), table, day)
    whole = contents(bronze_plan.read(spark, table))
    for day in days[:2]:
        bronze_plan.compact(spark, table, archive, day[:10])
        assert contents(bronze_plan.read_whole(spark, table, archive)) == whole
    tables.reset(spark, paths=[f"{table}/{x}" for x in os.listdir(table) if x.startswith("ingest") and os.path.exists(f"{table}/{x}/load_date=2031-02-03")])
    assert contents(bronze_plan.read_whole(spark, table, archive)) == whole  # the archive has it


def test_observed_counts(spark, folder):
    checked = checked_readings(bronze(spark, *responses(40)).repartition(4), AS_OF)
    rows, counts = audit.observed(checked)
    rows.write.parquet(f"{folder}/a")
    assert contents(audit.observed_row(spark, counts, AS_OF)) == contents(audit.audit_row(checked, AS_OF))
    rows, counts = audit.observed(checked.limit(0))
    rows.write.parquet(f"{folder}/b")
    assert audit.observed_row(spark, counts, AS_OF).first().total_rows == 0


FAILS_ONCE = """
import sys
sys.path[:0] = sys.argv[1:3]
from pyspark import TaskContext
from samples import AS_OF, bronze
from test_jobs import responses
from skyledger import build_session
from skyledger.operators import audit
from skyledger.plans.silver import checked_readings

spark = build_session("fails-once", "local[2,3]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
rows, counts = audit.observed(checked_readings(bronze(spark, *responses(40)).repartition(4), AS_OF).select("quarantine_reason"))

def run(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2 == 0:
        raise RuntimeError("lost")

rows.mapInArrow(run, rows.schema).write.parquet(sys.argv[3] + "/written")
found = audit.observed_row(spark, counts, AS_OF).first()
print("COUNTED", found.total_rows, found.valid_rows + found.quarantine_rows, spark.read.parquet(sys.argv[3] + "/written").count())
"""


def test_a_task_that_fails_once_counts_once(folder):
    here = Path(__file__).resolve().parent
    done = subprocess.run(
        [sys.executable, "-c", FAILS_ONCE, str(here.parent), str(here), folder], capture_output=True, text=True, timeout=300
    )
    assert "RuntimeError: lost" in done.stderr
    assert "COUNTED 40 40 40" in done.stdout


def files(spark, path, *parts):
    for rows in parts:
        rows.select(*BRONZE_COLUMNS).coalesce(1).write.mode("append").parquet(path)
    return tables.stream(spark, path, BRONZE_DDL, maxFilesPerTrigger="1")


def test_state_outlasts_a_restart(spark, folder):
    path, name = f"{folder}/bronze", f"{space(spark)}.city_current"

    def go():
        current.start_stateful(source, name, f"{folder}/current", f"{folder}/state", AS_OF).awaitTermination()
        return contents(spark.table(name))

    rows = bronze(spark, *responses(60))
    source = files(spark, path, *[bronze(spark, *responses(30, n)) for n in (0, 30)])
    want = contents(products.city_current(quality.clean_rows(checked_readings(rows, AS_OF))).select(*_columns(spark)))
    assert go() == want
    # a late reading, and a city that fails, change nothing; a repeated row neither
    late = bronze(spark, call(body(name="city1", dt=NOON - DAY_SECONDS), city="city1"), call(None, 500, city="city2"))
    files(spark, path, late, bronze(spark, *responses(30)))
    assert go() == want
    files(spark, path, bronze(spark, call(body(name="city1", dt=NOON + 90 * DAY_SECONDS), city="city1"), call(body(name="new"))))
    after = go()
    assert len(after) == len(want) + 1 and len(set(want) - set(after)) == 1
    # as after a crash before Spark's own commit: the last micro-batch comes again
    commits = f"{folder}/state/commits"
    last = max(int(x) for x in os.listdir(commits) if x.isdigit())
    for x in (f"{last}", f".{last}.crc"):
        os.remove(f"{commits}/{x}")
    assert go() == after


def _columns(spark):
    clean = quality.clean_rows(checked_readings(bronze(spark), AS_OF))
    return [c for c in clean.columns]


def test_named_stream_takes_each_row_once(spark, folder):
    name, store = f"{space(spark)}.calls", store_at(f"{folder}/silver")
    tables.create_table(spark, name, BRONZE_DDL, ["load_date"])
    for n in (0, 30):
        tables.append_table(bronze(spark, *responses(30, n)).select(*BRONZE_COLUMNS), name, ["load_date"])
        silver.drain(tables.stream_table(spark, name), store, AS_OF)
        silver.drain(tables.stream_table(spark, name), store, AS_OF)
    plain = store_at(f"{folder}/plain")
    write_batch(bronze(spark, *responses(60)), plain, 0, AS_OF)
    assert contents(spark.newSession().table(f"{store.namespace}.clean")) == contents(plain.clean(spark))
    assert spark.table(f"{store.namespace}.audit").agg(F.sum("total_rows")).first()[0] == 60
