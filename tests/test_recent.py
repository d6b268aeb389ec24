"""Recent readings from raw calls: one parse, and the rows of the exact bound."""

from __future__ import annotations

import random
from datetime import timedelta

from pyspark.sql import functions as F
from samples import AS_OF, CALLED, NOON, body, bronze, call

from skyledger.operators import products
from skyledger.operators.latest import AT
from skyledger.operators.quality import clean_rows
from skyledger.plans import recent
from skyledger.plans.silver import checked_readings
from skyledger.schemas import BRONZE_DDL
from skyledger.sources import tables

DAY = 86_400


def rows(df):
    return sorted(str(r) for r in df.drop("ingestion_time").collect())


def plain(df):
    return clean_rows(checked_readings(df, AS_OF))


def check(spark, folder, calls, name, hours=24):
    df = bronze(spark, *calls)
    staged = recent.stage_recent(df, f"{folder}/{name}", hours, AS_OF)
    assert rows(products.recent_readings(staged, hours)) == rows(products.recent_readings(plain(df), hours))
    return staged


def test_late_and_early_readings(spark, folder):
    pick = random.Random(3)
    calls = []
    for i in range(300):
        at = CALLED - timedelta(minutes=20 * i)
        reading = NOON - 1200 * i + pick.choice([0, 0, 0, -3 * DAY, DAY, -2 * DAY])  # newest ones in old calls too
        calls.append(call(pick.choice([body(dt=reading)] * 6 + [None, "", "[", body(dt=None)]), at=at))
    calls.append(call(body(dt=NOON - 10), at=None))
    staged = check(spark, folder, calls, "mixed")
    assert staged.count() < plain(bronze(spark, *calls)).count()
    check(spark, folder, calls, "two", hours=2)


def test_bound_included_and_ties(spark, folder):
    calls = [call(body(dt=NOON - shift), at=CALLED) for shift in (0, 0, DAY, DAY, DAY + 1)]
    assert check(spark, folder, calls, "edge").count() == 4


def test_newest_reading_in_an_old_call(spark, folder):
    calls = [call(body(dt=NOON - 9 * DAY), at=CALLED), call(body(dt=NOON), at=CALLED - timedelta(days=8))]
    staged = check(spark, folder, calls, "old")
    assert staged.count() == 2  # the bound of the last calls is too low, never too high
    assert products.recent_readings(staged).count() == 1


def test_last_calls_without_a_clean_reading(spark, folder):
    calls = [call(None, 500, at=CALLED), call(body(dt=NOON), at=CALLED - timedelta(days=2))]
    assert check(spark, folder, calls, "failed").count() == 1
    check(spark, folder, [call(body(), at=None)], "timeless")
    assert check(spark, folder, [], "none").count() == 0


def test_bodies_are_parsed_once(spark, folder, capfd):
    tables.append(bronze(spark, *[call(body(dt=NOON - 60 * i), at=CALLED - timedelta(hours=i)) for i in range(30)]), f"{folder}/b")
    df = tables.scan(spark, f"{folder}/b", BRONZE_DDL)
    staged = recent.stage_recent(df, f"{folder}/staged", 24, AS_OF)
    for product in (products.recent_readings, products.hourly_summary, products.severe_alerts):
        product(staged).explain("extended")
    assert "from_json" not in capfd.readouterr().out
    # of other calls than the last none gets as far as the parse
    plain(df.where(F.col("call_timestamp") >= F.lit(CALLED))).agg(F.max(AT)).explain()
    shown = capfd.readouterr().out
    assert shown.index("Generate explode") < shown.index("Filter (isnotnull(call_timestamp")
