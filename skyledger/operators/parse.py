"""Parse raw responses once per row and sort them by what came back."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.rules import call_failed
from skyledger.schemas import PAYLOAD_DDL, READING_DDL, ROUTE_DDL

API_ERROR = "api_error"
UNPARSEABLE = "unparseable"
PARSED = "parsed"


class Routes(NamedTuple):
    api_errors: DataFrame
    unparseable: DataFrame
    parsed: DataFrame


def parse_payload(df: DataFrame, payload: str = PAYLOAD_DDL, body: str = "raw_response") -> DataFrame:
    """Add the struct ``parsed``.

    A plain projection of ``from_json`` would be copied into every condition
    a later filter puts on a parsed field, and filters do not share common
    subexpressions: ten rules cost ten parses of each row. Filters are not
    pushed below a generator, so exploding the one-element array keeps it at
    one parse per row whatever is built on top.
    """
    return df.select("*", F.explode(F.array(F.from_json(body, payload, {"mode": "PERMISSIVE"}))).alias("parsed"))


# The fields every reading needs.
USABLE = """raw_response IS NOT NULL AND parsed IS NOT NULL AND parsed.name IS NOT NULL
    AND parsed.dt IS NOT NULL AND parsed.main.temp IS NOT NULL"""


def route(df: DataFrame, payload: str = ROUTE_DDL) -> DataFrame:
    """Parse and add ``route``: every row gets exactly one, in a single pass. Readings made
    of the parsed rows need a wider ``payload``."""
    routes = f"""CASE WHEN {call_failed()} THEN '{API_ERROR}'
        WHEN {USABLE} THEN '{PARSED}' ELSE '{UNPARSEABLE}' END AS route"""
    return parse_payload(df, payload).selectExpr("*", routes)


def split_routes(df: DataFrame, payload: str = READING_DDL) -> Routes:
    """The three routes as separate frames.

    Failed calls are told by their status alone, so that frame is not parsed.
    When more than one of the other two is wanted, filter one stored
    :func:`route` instead of reading the input for each.
    """
    parsed = parse_payload(df.where("status_code = 200"), payload)
    return Routes(df.where(call_failed()), parsed.where(f"NOT ({USABLE})"), parsed.where(USABLE))
