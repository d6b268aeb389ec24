"""Ordered quality rules: the first rule a row breaks names its reason.

A rule is a label and the SQL condition of a row that breaks it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from skyledger.functions.derive import broken_json, moment

Rule = tuple[str, str]

# The status of a landed line that is no capture; no call has it.
BROKEN_LINE_STATUS = -1

# Legal ranges, ends included.
TEMPERATURE_RANGE = (-50, 60)
HUMIDITY_RANGE = (0, 100)


def outside(name: str, bounds: tuple[float, float]) -> str:
    """Null is not outside; NaN is (it sorts above every number)."""
    low, high = bounds
    return f"{name} < {low} OR {name} > {high}"


def call_failed(null_fails: bool = True) -> str:
    """Status other than 200. With ``null_fails=False`` a null status passes."""
    return "NOT (status_code <=> 200)" if null_fails else "status_code <> 200"


def standard_rules(null_status_fails: bool = True, strict_json: bool = False) -> list[Rule]:
    """Rules for readings of :func:`skyledger.operators.enrich.enrich`.

    The permissive parser turns malformed text into a struct of nulls, so such
    rows are reported as ``city_missing``; ``strict_json`` reports them as
    ``json_parse_failed``, looking at the text again only where no name was
    found.
    """
    broken = f" OR (city IS NULL AND {broken_json('raw_response')})" if strict_json else ""
    return [
        ("landing_broken", f"status_code = {BROKEN_LINE_STATUS}"),
        ("api_failed", call_failed(null_status_fails)),
        ("raw_json_missing", "raw_response IS NULL"),
        ("json_parse_failed", f"parsed IS NULL{broken}"),
        ("city_missing", "city IS NULL"),
        ("temperature_missing", "temperature IS NULL"),
        ("out_of_range_temperature", outside("temperature", TEMPERATURE_RANGE)),
        ("humidity_missing", "humidity IS NULL"),
        ("out_of_range_humidity", outside("humidity", HUMIDITY_RANGE)),
        ("out_of_range_wind_speed", "wind_speed < 0"),
        ("event_time_missing", "event_time IS NULL"),
        ("rain_fall_missing", "rain_fall IS NULL"),
    ]


def located_rules(as_of: datetime | str | None = None) -> list[Rule]:
    """Rules for readings of :func:`skyledger.operators.enrich.enrich_located`."""
    return [
        ("api_error", call_failed()),
        ("null_city", "city IS NULL OR trim(city) = ''"),
        ("out_of_range_temperature", outside("temperature", TEMPERATURE_RANGE)),
        ("out_of_range_humidity", outside("humidity", HUMIDITY_RANGE)),
        ("out_of_range_wind_speed", "wind_speed < 0"),
        ("missing_coordinates", "latitude IS NULL OR longitude IS NULL"),
        ("future_event_time", f"event_time > {moment(as_of)} + INTERVAL 1 HOUR"),
    ]


def first_broken(rules: Sequence[Rule]) -> str:
    """Label of the first broken rule, null for a row that breaks none."""
    cases = " ".join(f"WHEN {broken} THEN '{label}'" for label, broken in rules)
    return f"CASE {cases} END"
