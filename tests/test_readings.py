"""Derived columns and both rule sets at their bounds."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from samples import AS_OF, CITY, NOON, SUNRISE, SUNSET, body, bronze, call, main

from skyledger.functions import derive
from skyledger.functions.rules import first_broken
from skyledger.operators.enrich import enrich_located
from skyledger.operators.parse import split_routes
from skyledger.operators.quality import split
from skyledger.plans.silver import checked_located, checked_readings
from skyledger.schemas import QUARANTINE_COLUMNS


LIMIT = int(datetime.fromisoformat(f"{AS_OF}+00:00").timestamp()) + 3600


def reading(spark, **changes):
    return checked_readings(bronze(spark, call(body(**changes))), AS_OF).first()


def test_reading_of_a_full_response(spark):
    row = reading(spark, main=main(temp=35.0))
    at = datetime.fromtimestamp(NOON, timezone.utc).replace(tzinfo=None)
    assert (row.city, row.temperature, row.feels_like, row.humidity, row.pressure) == (CITY, 35.0, 20.25, 64, 991)
    assert (row.weather_condition, row.weather_description, row.wind_speed) == ("Haze", "thin haze", 7.25)
    assert (row.event_time, row.event_date, row.event_hour) == (at, at.date(), at.hour)
    assert (row.temperature_band, row.weather_severity_score, row.is_daytime) == ("Hot", 0, True)
    assert (row.source_system, row.source) == ("openweathermap", "openweather_api")
    assert (row.country, row.latitude, row.longitude, row.visibility) == ("SE", 59.65, 12.59, 4200)
    assert str(row.ingestion_time) == AS_OF
    assert row.quarantine_reason is None


def test_empty_weather_list_gives_nulls(spark):
    row = reading(spark, weather=[])
    assert (row.weather_condition, row.weather_description, row.quarantine_reason) == (None, None, None)


@pytest.mark.parametrize(
    "rain, standard, located",
    [
        ({"1h": 1.5, "3h": 9.0}, 1.5, 1.5),
        ({"3h": 9.0}, 9.0, 0.0),
        ({}, 0.0, 0.0),
        (None, 0.0, 0.0),
    ],
)
def test_rain(spark, rain, standard, located):
    rows = bronze(spark, call(body(rain=rain)))
    assert checked_readings(rows).first().rain_fall == standard
    assert checked_located(rows).first().rainfall == located


def agree(spark, ddl, cases, column):
    """Whether the expression gives each row of values what is listed with it."""
    rows = [(i, *values) for i, (values, _) in enumerate(cases)]
    got = dict(spark.createDataFrame(rows, f"i int, {ddl}").selectExpr("i", f"{column} AS value").collect())
    for i, (values, wanted) in enumerate(cases):
        assert got[i] == wanted, values


def test_bands(spark):
    cases = [
        (-50.0, "Cold"), (14.999, "Cold"), (15.0, "Normal"), (30.0, "Normal"), (30.001, "Hot"), (40.0, "Hot"),
        (40.001, "Extreme"), (None, "Extreme"), (float("nan"), "Extreme"),
    ]
    agree(spark, "t double", [((t,), band) for t, band in cases], derive.temperature_band("t"))


def test_severity(spark):
    cases = [
        ((40.0, 30.0, 40.0), 0), ((40.1, 30.0, 40.0), 3), ((40.0, 30.1, 40.0), 2), ((40.0, 30.0, 40.1), 2),
        ((40.0, 30.1, 40.1), 4), ((41.0, 31.0, 0.0), 5), ((41.0, 31.0, 41.0), 7), ((None, 31.0, None), 2),
        ((None, None, None), 0),
    ]
    agree(spark, "t double, r double, w double", cases, derive.severity_score("t", "r", "w"))


def checked_by_case(rows, check):
    """Reading of each call, told apart by latency."""
    return {row.latency_ms: row for row in check(rows).collect()}


def test_daytime(spark):
    cases = [
        (SUNRISE, SUNRISE, SUNSET, True), (SUNSET, SUNRISE, SUNSET, True), (SUNRISE - 1, SUNRISE, SUNSET, False),
        (SUNSET + 1, SUNRISE, SUNSET, False), (NOON, None, SUNSET, None), (NOON, SUNRISE, None, None),
    ]
    calls = []
    for i, (at, rise, fall, _) in enumerate(cases):
        sun = {"country": "SE", "sunrise": rise, "sunset": fall}
        calls.append(call(body(dt=at, sys={k: v for k, v in sun.items() if v is not None}), latency=i))
    for check in (checked_readings, checked_located):
        got = checked_by_case(bronze(spark, *calls), check)
        assert [got[i].is_daytime for i in range(len(cases))] == [case[3] for case in cases]


def test_alert_types(spark):
    cases = [
        ((4, "Clear", 0.0, 0.0), "heatwave"), ((3, "Clear", 0.0, 0.0), None), ((4, "Thunderstorm", 60.0, 60.0), "heatwave"),
        ((0, "THUNDER", 60.0, 0.0), "storm"), ((0, "Sandstorm", 0.0, 0.0), "storm"), ((0, "Clear", 50.0, 50.0), None),
        ((0, "Clear", 50.1, 60.0), "high_wind"), ((0, None, 0.0, 50.1), "heavy_rain"), ((None, None, None, None), None),
    ]
    agree(spark, "s int, c string, w double, r double", cases, derive.alert_type("s", "c", "w", "r"))


def test_alert_limits_are_parameters(spark):
    column = derive.alert_type("s", "c", "w", "r", heatwave_score=3, high_wind_above=70)
    cases = [((3, None, 60.0, 0.0), "heatwave"), ((2, None, 60.0, 0.0), None), ((2, None, 70.1, 0.0), "high_wind")]
    agree(spark, "s int, c string, w double, r double", cases, column)


def test_epoch_time_is_right_in_a_dst_fold(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = spark.createDataFrame([(1699162200,), (1699165800,)], "s bigint")  # 01:30 EDT, 01:30 EST
        got = seconds.selectExpr(f"CAST({derive.epoch_time('s')} AS BIGINT)").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r[0] for r in got] == [1699162200, 1699165800]


def test_standard_rules(spark):
    cases = [
        ({}, 500, "api_failed"),
        ({}, 0, "api_failed"),
        ({}, None, "api_failed"),
        ({"name": None}, 200, "city_missing"),
        ({"main": main(temp=None)}, 200, "temperature_missing"),
        ({"main": main(temp=-50)}, 200, None),
        ({"main": main(temp=-50.1)}, 200, "out_of_range_temperature"),
        ({"main": main(temp=60)}, 200, None),
        ({"main": main(temp=60.1)}, 200, "out_of_range_temperature"),
        ({"main": main(humidity=None)}, 200, "humidity_missing"),
        ({"main": main(humidity=0)}, 200, None),
        ({"main": main(humidity=100)}, 200, None),
        ({"main": main(humidity=-1)}, 200, "out_of_range_humidity"),
        ({"main": main(humidity=101)}, 200, "out_of_range_humidity"),
        ({"wind": {"speed": -0.1}}, 200, "out_of_range_wind_speed"),
        ({"wind": {"speed": 0.0}}, 200, None),
        ({"wind": {}}, 200, None),
        ({"dt": None}, 200, "event_time_missing"),
        # the first broken rule names the reason
        ({"name": None, "dt": None, "main": main(temp=99, humidity=101)}, 200, "city_missing"),
        ({"main": main(temp=99, humidity=None)}, 200, "out_of_range_temperature"),
    ]
    calls = [call(body(**changes), status, latency=i) for i, (changes, status, _) in enumerate(cases)]
    got = checked_by_case(bronze(spark, *calls), checked_readings)
    for i, (changes, status, reason) in enumerate(cases):
        assert got[i].quarantine_reason == reason, (changes, status)


def test_null_status_may_pass(spark):
    rows = bronze(spark, call(body(), None))
    assert checked_readings(rows, null_status_fails=False).first().quarantine_reason is None


def test_located_rules(spark):
    cases = [
        ({}, None),
        ({"name": "  "}, "null_city"),
        ({"main": main(temp=99)}, "out_of_range_temperature"),
        ({"main": main(humidity=101)}, "out_of_range_humidity"),
        ({"main": main(humidity=None)}, None),
        ({"wind": {"speed": -1}}, "out_of_range_wind_speed"),
        ({"coord": {"lon": 80.0}}, "missing_coordinates"),
        ({"coord": None}, "missing_coordinates"),
        ({"dt": LIMIT}, None),  # an hour after AS_OF
        ({"dt": LIMIT + 1}, "future_event_time"),
    ]
    calls = [call(body(**changes), latency=i) for i, (changes, _) in enumerate(cases)]
    got = checked_by_case(bronze(spark, *calls), lambda rows: checked_located(rows, AS_OF))
    for i, (changes, reason) in enumerate(cases):
        assert got[i].quarantine_reason == reason, changes


def test_located_columns(spark):
    row = enrich_located(split_routes(bronze(spark, call(body()))).parsed, AS_OF).first()
    assert (row.feels_like_temperature, row.sunrise_epoch, row.sunset_epoch) == (20.25, SUNRISE, SUNSET)
    assert (row.temperature_band, row.event_hour, str(row.ingestion_time)) == ("Normal", datetime.fromtimestamp(NOON, timezone.utc).hour, AS_OF)


def test_split_is_whole(spark):
    checked = checked_readings(bronze(spark, call(body()), call(body(main=main(temp=99)))))
    clean, quarantine = split(checked)
    assert (clean.count(), quarantine.count()) == (1, 1)
    assert "quarantine_reason" not in clean.columns
    assert quarantine.columns == QUARANTINE_COLUMNS


def test_first_broken_keeps_order(spark):
    rules = [("a", "x > 2"), ("b", "x > 1 OR x < 0"), ("c", "x IS NULL")]
    rows = spark.createDataFrame([(3,), (2,), (1,), (None,)], "x int").selectExpr(f"{first_broken(rules)} AS r")
    assert [r.r for r in rows.collect()] == ["a", "b", None, "c"]


def test_as_of_may_be_a_datetime(spark):
    at = datetime.fromisoformat(AS_OF)
    for as_of in (at, AS_OF, at.replace(tzinfo=timezone.utc), at.astimezone(timezone(timedelta(hours=3)))):
        assert spark.range(1).selectExpr(derive.moment(as_of)).first()[0] == at
    now = spark.range(1).selectExpr(derive.moment(None)).first()[0]
    assert abs(now - datetime.now()) < timedelta(days=1)
