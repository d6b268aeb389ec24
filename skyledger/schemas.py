"""Declared schemas of every layer. All fields are nullable."""

from __future__ import annotations

# The observation payload of the weather API, field by field.
PAYLOAD_DDL = """
    coord struct<lon: double, lat: double>,
    weather array<struct<id: int, main: string, description: string, icon: string>>,
    base string,
    main struct<temp: double, feels_like: double, temp_min: double, temp_max: double,
                pressure: int, humidity: int, sea_level: int, grnd_level: int>,
    visibility int,
    wind struct<speed: double, deg: int, gust: double>,
    rain struct<`1h`: double, `3h`: double>,
    clouds struct<all: int>,
    dt bigint,
    sys struct<type: int, id: int, country: string, sunrise: bigint, sunset: bigint>,
    timezone int,
    id int,
    name string,
    cod int
"""

# The part of it that readings are made of. Fields left out are skipped in the
# text; a wrong type in one of them spoils no other field either way.
READING_DDL = """
    coord struct<lon: double, lat: double>,
    weather array<struct<main: string, description: string>>,
    main struct<temp: double, feels_like: double, pressure: int, humidity: int>,
    visibility int,
    wind struct<speed: double>,
    rain struct<`1h`: double, `3h`: double>,
    dt bigint,
    sys struct<country: string, sunrise: bigint, sunset: bigint>,
    name string
"""

# All that tells a usable response from others.
ROUTE_DDL = "main struct<temp: double>, dt bigint, name string"

CAPTURE_DDL = """
    requested_city string, status_code bigint, raw_response string,
    call_timestamp timestamp, latency_ms bigint
"""

BRONZE_DDL = CAPTURE_DDL + """,
    ingestion_time timestamp, load_date date, batch_id string, source string
"""

QUARANTINE_DDL = """
    requested_city string, status_code bigint, latency_ms bigint,
    raw_response string, ingestion_time timestamp, quarantine_reason string
"""

AUDIT_DDL = "run_time timestamp, total_rows bigint, valid_rows bigint, quarantine_rows bigint"

RUN_SUMMARY_DDL = """
    run_timestamp timestamp, total_rows_read bigint, valid_rows bigint,
    quarantined_rows bigint, quarantine_breakdown string
"""


def column_names(flat_ddl: str) -> list[str]:
    """Names in a DDL without nested types; needs no session."""
    return [column.split()[0] for column in flat_ddl.split(",")]


BRONZE_COLUMNS = column_names(BRONZE_DDL)
QUARANTINE_COLUMNS = column_names(QUARANTINE_DDL)
AUDIT_COLUMNS = column_names(AUDIT_DDL)
