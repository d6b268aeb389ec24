from __future__ import annotations

import contextlib
import io

import pytest
from samples import CITY, body, bronze, call, main

from skyledger.operators import parse, quality
from skyledger.plans.silver import checked_readings

# body, whether the struct is null, standard reason, strict reason
EDGES = [
    (None, True, "raw_json_missing", "raw_json_missing"),
    ("", True, "json_parse_failed", "json_parse_failed"),
    ("   ", True, "json_parse_failed", "json_parse_failed"),
    ('{"name":"A", oops', False, "city_missing", "json_parse_failed"),
    (body()[:-9], False, "city_missing", "json_parse_failed"),
    ("null", False, "city_missing", "city_missing"),
    ("42", False, "city_missing", "city_missing"),
    ('[{"name":"A"}]', False, "city_missing", "city_missing"),
    ('{"cod":"404","message":"city not found"}', False, "city_missing", "city_missing"),
    (body(main=main(temp="hot")), False, "temperature_missing", "temperature_missing"),
    (body(main=main(humidity=50.5)), False, "humidity_missing", "humidity_missing"),
    (body(id=5_000_000_000), False, None, None),
    (body(main=main(temp="NaN")), False, "out_of_range_temperature", "out_of_range_temperature"),
    (body(weather=[]), False, None, None),
]


@pytest.mark.parametrize("strict", [False, True])
def test_edge_bodies(spark, strict):
    rows = bronze(spark, *[call(text, latency=i) for i, (text, *_) in enumerate(EDGES)])
    checked = checked_readings(rows, keep_parsed=True, strict_json=strict)
    got = {r.latency_ms: r for r in checked.collect()}
    for i, (text, null_struct, reason, strict_reason) in enumerate(EDGES):
        assert (got[i].parsed is None) == null_struct, text
        assert got[i].quarantine_reason == (strict_reason if strict else reason), text


def test_unread_fields_change_no_reading(spark):
    """Parsing part of the payload gives what parsing all of it gives."""
    texts = [text for text, *_ in EDGES] + [
        body(id="x", cod="404", base=1, clouds="many", timezone=[1]),
        body(main=main(temp_min="low", sea_level=1.5)),
        body(wind={"speed": 3.5, "gust": "strong", "deg": 1.5}),
        body(weather=[{"id": "x", "main": "Rain"}]),
        body(weather="none"),
        body(sys="none"),
        body(rain=3, main="warm"),
        body(main=None, coord=[], clouds={"all": 1.5}),
        body(extra={"main": {"temp": 1}}),
    ]
    rows = bronze(spark, *[call(text, latency=i) for i, text in enumerate(texts)])
    part = checked_readings(rows, "2026-05-11")
    whole = checked_readings(rows, "2026-05-11", keep_parsed=True).drop("parsed")
    assert sorted(map(repr, part.collect())) == sorted(map(repr, whole.collect()))


def test_bad_field_leaves_its_siblings(spark):
    row = checked_readings(bronze(spark, call(body(main=main(temp="hot"))))).first()
    assert (row.temperature, row.humidity, row.city) == (None, 64, CITY)


def routed(spark):
    return bronze(
        spark,
        call(body()),
        call(body(), status=500),
        call('{"cod": 200, "message": "bad response"}'),
        call(None),
        call(body(dt=None)),
        call(body(), status=None),
    )


def test_three_routes(spark):
    routes = parse.split_routes(routed(spark))
    assert [frame.count() for frame in routes] == [2, 3, 1]


def test_each_row_has_one_route_and_null_status_is_an_error(spark):
    counts = dict(parse.route(routed(spark)).groupBy("route").count().collect())
    assert counts == {"api_error": 2, "unparseable": 3, "parsed": 1}
    failed = parse.route(routed(spark)).where("status_code is null").first()
    assert failed.route == parse.API_ERROR


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_a_row_is_parsed_once_whatever_is_asked_of_it(spark):
    checked = checked_readings(bronze(spark, call(body())))
    for frame in quality.split(checked):
        assert plan(frame).count("from_json(") == 1
