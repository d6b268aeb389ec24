"""Give each reading a reason or none, and split on it."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from skyledger.functions.rules import Rule, first_broken
from skyledger.schemas import QUARANTINE_COLUMNS

REASON = "quarantine_reason"


class Outcome(NamedTuple):
    clean: DataFrame
    quarantine: DataFrame


def check(readings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return readings.selectExpr("*", f"{first_broken(rules)} AS {REASON}")


def clean_rows(checked: DataFrame) -> DataFrame:
    return checked.where(f"{REASON} IS NULL").drop(REASON)


def quarantined_rows(checked: DataFrame, columns: Sequence[str] = QUARANTINE_COLUMNS) -> DataFrame:
    return checked.where(f"{REASON} IS NOT NULL").select(*columns)


def split(checked: DataFrame) -> Outcome:
    return Outcome(clean_rows(checked), quarantined_rows(checked))
