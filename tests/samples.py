"""Hand-made responses and calls; each test changes the fields it is about."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from skyledger.plans.silver import SilverStore
from skyledger.sources import captures

CALLED = datetime(2031, 2, 3, 16, 20, tzinfo=timezone.utc)
AS_OF = "2031-02-03 16:25:00"
CITY = "Arvika"
SUNRISE, SUNSET = 1927600000, 1927630000
NOON = SUNRISE + 12_000


def main(**changes) -> dict:
    fields = {"temp": 21.5, "feels_like": 20.25, "pressure": 991, "humidity": 64} | changes
    return {name: value for name, value in fields.items() if value is not None}


def body(**changes) -> str:
    """A response with every field a reading is made of. ``changes`` replace top-level
    fields; None leaves one out."""
    fields = {
        "main": main(),
        "wind": {"speed": 7.25},
        "rain": {"1h": 0.0},
        "weather": [{"main": "Haze", "description": "thin haze"}],
        "sys": {"sunrise": SUNRISE, "sunset": SUNSET, "country": "SE"},
        "coord": {"lat": 59.65, "lon": 12.59},
        "visibility": 4200,
        "dt": NOON,
        "name": CITY,
    } | changes
    return json.dumps({name: value for name, value in fields.items() if value is not None})


def call(text: str | None, status: int | None = 200, city: str = CITY, at: datetime = CALLED, latency: int = 10):
    return (city, status, text, at, latency)


def bronze(spark, *calls):
    return captures.stamp(captures.capture_rows(spark, list(calls)), AS_OF)


def store_at(path, unit="day"):
    """A store of its own for each path."""
    return SilverStore(f"s{hashlib.md5(path.encode()).hexdigest()[:12]}", path, unit)
