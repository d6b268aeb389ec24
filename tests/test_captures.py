from __future__ import annotations

import pytest
from samples import AS_OF, CALLED, CITY, body, call

from skyledger.functions import derive
from skyledger.operators import products, quality
from skyledger.plans import bronze
from skyledger.plans.silver import checked_readings
from skyledger.schemas import BRONZE_COLUMNS
from skyledger.sources import captures
from skyledger.streaming import bronze as streamed

BROKEN = '{"requested_city": "x", "status'
BASE = "https://api.example.org/weather"


def url(spark, city, **options):
    row = spark.createDataFrame([(city,)], "requested_city string")
    return row.select(derive.request_url("requested_city", BASE, **options)).first()[0]


@pytest.mark.parametrize(
    "city, encoded",
    [
        ("Tiruchirappalli", "Tiruchirappalli"),
        ("New Delhi", "New+Delhi"),
        ("a&b=c", "a%26b%3Dc"),
        ("São", "S%C3%A3o"),
        ("*~-_.", "%2A~-_."),
    ],
)
def test_city_is_form_encoded(spark, city, encoded):
    assert url(spark, city) == f"{BASE}?q={encoded}&units=metric"


def test_url_with_key_and_without_encoding(spark):
    assert url(spark, "New Delhi", api_key="k", units="imperial", encode=False) == (
        f"{BASE}?q=New Delhi&appid=k&units=imperial"
    )


def requests(spark, *cities):
    return captures.plan_requests(spark.createDataFrame([(c,) for c in cities], "requested_city string"), BASE)


def test_planned_requests_hold_no_key(spark):
    assert requests(spark, "Salem").first().asDict() == {
        "requested_city": "Salem",
        "url": f"{BASE}?q=Salem&units=metric",
    }


def test_captures_may_be_none_or_without_bodies(spark):
    assert captures.capture_rows(spark, []).count() == 0
    assert captures.capture_rows(spark, [call(None, 0)]).first().raw_response is None


def test_landing_zone_round_trip(spark, folder):
    sent = captures.capture_rows(spark, [call(body()), call("later, with \"quotes\"\n", 500), call("kept whole", None), call(None, 0)])
    captures.land(sent, f"{folder}/landing")
    with open(f"{folder}/landing/broken.json", "w") as broken:
        broken.write(BROKEN + "\n")
    got = captures.read_captures(spark, f"{folder}/landing")
    assert sorted((r.status_code, r.raw_response or "") for r in got.collect()) == sorted(
        [(200, body()), (500, 'later, with "quotes"\n'), (0, "kept whole"), (0, ""), (-1, BROKEN)]
    )
    assert got.where("status_code = 200").first().call_timestamp == CALLED.replace(tzinfo=None)


def test_no_line_is_lost(spark, folder):
    """Lines that break off, that are no JSON or of another type: their text is kept,
    quarantined under a reason of its own, and no call of any city."""
    lines = [BROKEN, "not json", '{"requested_city": "x", "status_code": "many"}', "[1]"]
    captures.land(captures.capture_rows(spark, [call(body())]), f"{folder}/landing")
    with open(f"{folder}/landing/broken.json", "w") as broken:
        broken.write("\n".join(lines) + "\n")
    bronze.ingest(spark, f"{folder}/landing", f"{folder}/bronze", AS_OF)
    table = bronze.read(spark, f"{folder}/bronze")
    kept = quality.quarantined_rows(checked_readings(table, AS_OF)).collect()
    assert sorted((r.quarantine_reason, r.raw_response) for r in kept) == sorted(("landing_broken", x) for x in lines)
    for stored in (False, True):
        assert [r.city for r in products.api_health(table, AS_OF, stored=stored).collect()] == [CITY]


def test_batch_and_stream_fill_one_table(spark, folder):
    landing, table = f"{folder}/landing", f"{folder}/bronze"
    captures.land(captures.capture_rows(spark, [call(body()), call(None, 0)]), landing)
    for _ in range(2):  # the second run finds nothing new
        stream = captures.stream_captures(spark, landing)
        streamed.start(stream, table, f"{folder}/checkpoint", AS_OF).awaitTermination()
    bronze.append_captures(captures.capture_rows(spark, [call("by batch")]), table, AS_OF)
    for _ in range(2):  # run again under its name
        bronze.append_captures(captures.capture_rows(spark, [call("named")]), table, AS_OF, "day-1")
    texts = sorted(r.raw_response or "" for r in bronze.read(spark, table).collect())
    assert texts == sorted([body(), "", "by batch", "named"])


def test_ingest_stamps_and_appends_by_load_date(spark, folder):
    captures.land(captures.capture_rows(spark, [call(body())]), f"{folder}/landing")
    for _ in range(2):
        bronze.ingest(spark, f"{folder}/landing", f"{folder}/bronze", AS_OF)
    table = bronze.read(spark, f"{folder}/bronze")
    row = table.first()
    assert table.count() == 2
    assert sorted(table.columns) == sorted(BRONZE_COLUMNS)
    assert (row.batch_id, str(row.load_date), row.source) == ("20310203162500", "2031-02-03", "openweather_api")
    assert str(row.ingestion_time) == AS_OF
