"""Products against plain Python over hand-made and random readings."""

from __future__ import annotations

import contextlib
import hashlib
import io
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.operators import products
from skyledger.operators.latest import Period, latest_per_key, since_latest, with_body_hash

T0 = datetime(2024, 3, 1, 12, 0)
DDL = """city string, event_time timestamp, call_timestamp timestamp, raw_response string, temperature double,
humidity int, wind_speed double, rain_fall double, weather_condition string, weather_severity_score int"""


PERIODS = [None, Period("event_date", "day")]


def row(city="a", minutes=0.0, call=0, text="x", t=20.0, h=50, w=1.0, r=0.0, sky="Clear", s=0):
    at = T0 + timedelta(minutes=minutes)
    return (city, at, at + timedelta(seconds=call), text, t, h, w, r, sky, s)


def clean(spark, *rows):
    return spark.createDataFrame(list(rows), DDL).withColumn("event_date", F.col("event_time").cast("date"))


def hot(n=3000, seed=5):
    """Random readings, a third of them of one city; many equal peaks and times."""
    pick = random.Random(seed)
    return [
        row(
            city="hot" if i % 3 == 0 else f"c{pick.randrange(40)}",
            minutes=pick.randrange(0, 4 * 24 * 60, 10),
            call=pick.randrange(5),
            text=f"body {i}",
            t=float(pick.randrange(-5, 50)),
            w=pick.choice([None, float(pick.randrange(0, 60))]),
            r=pick.randrange(0, 120) / 2,
            sky=pick.choice(["Clear", "Rain", "Thunderstorm"]),
            s=pick.choice([0, 2, 3, 4, 5, 7]),
        )
        for i in range(n)
    ]


def order(r):
    return r[1], r[2], hashlib.md5(r[3].encode()).hexdigest()


def last_of(rows):
    best = {}
    for r in rows:
        if r[0] not in best or order(r) > order(best[r[0]]):
            best[r[0]] = r
    return best


def bodies(df):
    return {r.city: r.raw_response for r in df.collect()}


@pytest.mark.parametrize("period", PERIODS)
def test_current_is_the_last_of_each_city(spark, period):
    rows = hot()
    got = products.city_current(clean(spark, *rows).repartition(7), period=period)
    assert got.count() == len(last_of(rows))
    assert bodies(got) == {city: r[3] for city, r in last_of(rows).items()}


@pytest.mark.parametrize("period", PERIODS)
def test_ties_go_to_the_later_call_then_the_greater_hash(spark, period):
    rows = [row(call=1, text="m"), row(call=2, text="a"), row(call=2, text="b"), row(minutes=-5, call=900, text="z")]
    got = bodies(latest_per_key(with_body_hash(clean(spark, *rows)), period=period))
    assert got == {"a": max("ab", key=lambda text: hashlib.md5(text.encode()).hexdigest())}


def test_rows_without_an_order_are_refused(spark):
    with pytest.raises(ValueError, match="body_hash"):
        latest_per_key(clean(spark, row()))
    with pytest.raises(ValueError, match="call_timestamp"):
        latest_per_key(with_body_hash(clean(spark, row())).drop("call_timestamp"))


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_a_task_sends_one_row_of_a_city(spark):
    text = plan(products.city_current(clean(spark, row())))
    assert text.index("WindowGroupLimit") < text.index("Exchange")
    assert text.count("WindowGroupLimit (") >= 2


def test_recent_rows_include_the_bound(spark):
    rows = [row(minutes=0), row(minutes=-24 * 60), row(minutes=-24 * 60 - 0.1)]
    for period in PERIODS:
        assert since_latest(clean(spark, *rows), 24, period).count() == 2


def test_hours_may_be_fractions(spark):
    rows = [row(minutes=-15 * i) for i in range(12)]
    assert [since_latest(clean(spark, *rows), h).count() for h in (0, 0.25, 1, 1.75, 2.5)] == [1, 2, 5, 8, 11]


def test_recent_of_nothing_is_nothing(spark):
    assert products.recent_readings(clean(spark).limit(0)).count() == 0
    assert products.severe_alerts(clean(spark).limit(0)).count() == 0


def test_hourly_summary(spark):
    rows = [row(minutes=0, t=10.0, h=40, w=1.0, r=0.5), row(minutes=30, t=20.0, h=50, w=3.0, r=1.0), row(minutes=60, t=5.0)]
    got = {r.event_hour_start: r for r in products.hourly_summary(clean(spark, *rows)).collect()}
    first = got[T0]
    assert (first.n_readings, first.avg_temperature, first.avg_humidity) == (2, 15.0, 45.0)
    assert (first.avg_wind_speed, first.total_rainfall, len(got)) == (2.0, 1.5, 2)


def extremes_of(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[1].date()), []).append(r)
    out = {}
    for key, members in groups.items():
        windy = [(r[6], r[1]) for r in members if r[6] is not None]
        hottest, windiest = max((r[4], r[1]) for r in members), max(windy, default=(None, None))
        out[key] = (
            hottest[0], hottest[1], min(r[4] for r in members), windiest[0], windiest[1],
            sum(r[7] for r in members), max(r[9] for r in members),
        )
    return out


def test_daily_extremes(spark):
    rows = hot() + [row(city="calm", w=None)]
    got = {(r.city, r.event_date): tuple(r)[2:] for r in products.daily_extremes(clean(spark, *rows)).collect()}
    assert got == extremes_of(rows)


def test_daily_extremes_with_any_peak_time(spark):
    rows = hot()
    want = extremes_of(rows)
    frame = products.daily_extremes(clean(spark, *rows), latest_wins=False)
    peaks = {(r[0], r[1], r[4]) for r in rows}
    for r in frame.collect():
        values = want[r.city, r.event_date]
        assert (r.max_temp, r.min_temp, r.peak_wind, r.total_rainfall) == (values[0], values[2], values[3], values[5])
        assert (r.city, r.max_temp_time, r.max_temp) in peaks
    assert "SortAggregate" not in plan(frame)


def test_alerts_rank_after_the_alert_filter(spark):
    rows = [
        row("a", 0, s=0),  # calm, later than the alert
        row("a", -60, s=5, text="alert"),
        row("a", -90, w=55.0),
        row("b", -121, s=7),  # too old
        row("c", -120, r=51.0),  # just in time
    ]
    got = products.severe_alerts(clean(spark, *rows))
    assert got.columns == [
        "city", "event_time", "temperature", "wind_speed", "rainfall", "weather_condition",
        "weather_severity_score", "alert_type", "alert_triggered_at",
    ]
    assert {(r.city, r.alert_type, r.event_time) for r in got.collect()} == {
        ("a", "heatwave", T0 - timedelta(minutes=60)),
        ("c", "heavy_rain", T0 - timedelta(minutes=120)),
    }
    assert got.where("alert_triggered_at <> event_time").count() == 0


CALLS = """requested_city string, load_date date, status_code bigint, raw_response string, latency_ms bigint,
ingestion_time timestamp"""


def calls(spark):
    day, late, early = T0.date(), T0, T0 - timedelta(hours=1, seconds=1)
    return spark.createDataFrame(
        [
            ("a", day, 200, "{}", 10, late), ("a", day, 200, None, 11, early), ("a", day, 500, "{}", 11, late),
            ("b", day, 200, "{oops", 5, early), ("c", day, 0, None, 7, late), ("d", day, None, None, None, late),
            ("e", day, 200, "{}", 1, T0 - timedelta(hours=1)),
        ],
        CALLS,
    )


@pytest.mark.parametrize("stored", [False, True])
def test_api_health(spark, stored):
    got = {r.city: tuple(r)[2:] for r in products.api_health(calls(spark), T0, stored=stored).collect()}
    assert got == {
        "a": (3, 2, 1, 1, 10.67, 66.67, False),
        "b": (1, 1, 0, 0, 5.0, 100.0, True),
        "c": (1, 0, 1, 0, 7.0, 0.0, False),
        "d": (1, 0, 0, 0, None, 0.0, False),
        "e": (1, 1, 0, 0, 1.0, 100.0, False),  # just one hour old
    }


def test_api_health_options(spark):
    options = {"never_succeeded_is_stale": True, "count_malformed": True}
    for stored in (False, True):
        health = products.api_health(calls(spark), T0, stored=stored, **options)
        got = {r.city: (r.malformed_bodies, r.is_stale) for r in health.collect()}
        assert got == {"a": (0, False), "b": (1, True), "c": (0, True), "d": (0, True), "e": (0, False)}


def test_stored_health_reads_bodies_only_where_one_may_be_missing(spark, folder):
    calls(spark).write.parquet(folder + "/calls")
    text = plan(products.api_health(spark.read.parquet(folder + "/calls"), T0, stored=True))
    scans = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert sorted("raw_response" in scan for scan in scans) == [False, True]
    assert "IsNull(raw_response)" in text
