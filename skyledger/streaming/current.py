"""The latest reading of each city, kept up to date by a stream: by merging each micro-batch
into the published table, or by an aggregation whose state remembers it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from skyledger.operators.latest import BODY_HASH, ORDER, with_body_hash
from skyledger.operators.quality import clean_rows
from skyledger.plans.gold import merge_current, replace_current
from skyledger.plans.silver import checked_readings


def start(
    bronze_stream: DataFrame,
    name: str,
    location: str,
    checkpoint: str,
    as_of: datetime | str | None = None,
) -> StreamingQuery:
    """Publish the full table of latest readings, by its name, after each micro-batch.

    What the stream has to remember is the table itself, so each micro-batch
    is merged into the one before it; there is no state store to size. Merging
    a batch twice gives the same table, hence a replay does no harm.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        merge_current(clean_rows(checked_readings(batch, as_of)), name, location)

    return (
        bronze_stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_state(clean: DataFrame, key: str = "city") -> DataFrame:
    """The latest row of each key of a stream, in the one order there is.

    A streaming aggregation: the state store holds one row for each key, whatever has
    passed, so no watermark has to bound it. Tasks reduce their rows to one for each key
    before the shuffle.
    """
    ranked = with_body_hash(clean)
    rest = [name for name in ranked.columns if name not in (*ORDER, key)]
    latest = ranked.groupBy(key).agg(F.max_by(F.struct(*ORDER, *rest), F.struct(*ORDER)).alias("row"))
    kept = [name for name in clean.columns if name != BODY_HASH]
    return latest.select(*[F.col(name) if name == key else F.col(f"row.{name}") for name in kept])


def start_stateful(
    bronze_stream: DataFrame,
    name: str,
    location: str,
    checkpoint: str,
    as_of: datetime | str | None = None,
) -> StreamingQuery:
    """Publish the latest readings from a streaming aggregation in update mode.

    A micro-batch brings the new rows of the cities that changed; they replace those of the
    published table. The state lies in the checkpoint, so a restart goes on from it, and a
    replayed micro-batch brings the same rows again.
    """

    def land(changed: DataFrame, batch_id: int) -> None:
        replace_current(changed, name, location)

    return (
        latest_state(clean_rows(checked_readings(bronze_stream, as_of)))
        .writeStream.outputMode("update")
        .foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
