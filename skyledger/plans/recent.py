"""Recent readings from raw calls, every body parsed once."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.latest import AT
from skyledger.operators.quality import clean_rows
from skyledger.plans.silver import checked_readings

CALLED = "call_timestamp"


def newest_in_last_calls(
    calls: DataFrame, window: timedelta = timedelta(hours=1), as_of: datetime | str | None = None, **options: bool
) -> datetime | None:
    """The newest time of a clean reading among the last calls: those at most ``window``
    before the newest call. None if none of them is clean.

    Of all other calls only the time is read.
    """
    called = calls.agg(F.max(CALLED).alias("at")).where("at IS NOT NULL").first()
    if called is None:
        return None
    last = calls.where(F.col(CALLED) >= F.lit(called.at - window))
    return clean_rows(checked_readings(last, as_of, **options)).agg(F.max(AT)).first()[0]


def stage_recent(
    calls: DataFrame,
    path: str,
    hours: float = 24,
    as_of: datetime | str | None = None,
    window: timedelta = timedelta(hours=1),
    **options: bool,
) -> DataFrame:
    """Clean readings that hold all of the last ``hours`` of data, written to ``path``.

    A bound needs the newest time of all readings, which stands in the bodies. A reading of
    the last calls (:func:`newest_in_last_calls`) is never newer than that, so ``hours``
    before it is a bound too low, never too high: one pass over the calls parses each body
    once and writes what lies above, the newest reading among it. The products take their
    exact bound from the rows written, which are few. If no reading of the last calls is
    clean, all are written.

    Calls without a time are parsed and kept like others. ``options`` go to
    :func:`skyledger.plans.silver.checked_readings`.
    """
    near = newest_in_last_calls(calls, window, as_of, **options)
    clean = clean_rows(checked_readings(calls, as_of, **options))
    if near is not None:
        clean = clean.where(F.col(AT) >= F.lit(near - timedelta(hours=hours)))
    clean.write.parquet(path)
    return calls.sparkSession.read.schema(clean.schema).parquet(path)
