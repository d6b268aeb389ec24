"""Rows at the end of time: the last of each key, or the last hours of all."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AT = "event_time"

# Names a body among those of equal times; stored, so that bodies need not be read to rank.
BODY_HASH = "body_hash"

# Ties in event_time go to the later call, then to the greater hash of the body.
ORDER = (AT, "call_timestamp", BODY_HASH)


class Period(NamedTuple):
    """How a stored table is partitioned by time.

    ``column`` holds the date ``event_time`` truncated to ``unit`` gives.
    """

    column: str
    unit: str

    def of(self, at: str) -> str:
        return f"CAST(date_trunc('{self.unit}', {at}) AS DATE)"


def with_body_hash(df: DataFrame) -> DataFrame:
    """The frame with the hash of each body, taken from the body unless stored."""
    return df if BODY_HASH in df.columns else df.withColumn(BODY_HASH, F.md5("raw_response"))


def latest_per_key(df: DataFrame, key: str = "city", period: Period | None = None) -> DataFrame:
    """The last row of each key in the one order there is, :data:`ORDER`.

    The rank filter becomes a group limit before the shuffle: a task sends at
    most one row of a key, however many rows the key has.

    A table stored by ``period`` is first asked, from two columns and by hash
    aggregation, which periods hold the newest time of some key, and which of
    these times is the earliest. Whole rows are read and ranked from those
    periods and from that time on only. The period column is dropped, and the hash.
    """
    missing = [name for name in ORDER if name not in df.columns]
    if missing:
        raise ValueError(f"cannot order rows without {', '.join(missing)}")
    if period is not None:
        newest = df.groupBy(key).agg(F.max(AT).alias(AT))
        # at most one entry for each period of history
        held = F.expr(f"collect_set({period.of(AT)})").alias("held")
        bounds = newest.agg(F.struct(held, F.min(AT).alias("since"))).scalar()
        df = df.where(F.array_contains(bounds["held"], F.col(period.column)) & (F.col(AT) >= bounds["since"]))
        df = df.drop(period.column)
    ranked = Window.partitionBy(key).orderBy(*[F.desc_nulls_last(name) for name in ORDER])
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank", BODY_HASH)


def since_latest(
    df: DataFrame,
    hours: float,
    period: Period | None = None,
    newest: Column | None = None,
) -> DataFrame:
    """Rows of the last ``hours`` of data, the bound included.

    The bound is a scalar subquery inside the plan; empty input gives empty
    output. For a table stored by ``period`` it also prunes partitions, and
    the period column is dropped. ``newest`` spares the scan for the newest
    time where the caller can tell it from less.
    """
    if newest is None:
        newest = df.agg(F.max(AT)).scalar()
    bound = newest - F.lit(timedelta(hours=hours))
    recent = df.where(F.col(AT) >= bound)
    if period is not None:
        first = F.date_trunc(period.unit, bound).cast("date")
        recent = recent.where(F.col(period.column) >= first).drop(period.column)
    return recent
