"""Landing zone stream into the bronze table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from skyledger.plans.bronze import append_captures


def start(
    capture_stream: DataFrame,
    bronze: str,
    checkpoint: str,
    as_of: datetime | str | None = None,
    name: str = "stream",
) -> StreamingQuery:
    """Append what has landed, each capture once, then stop.

    A micro-batch is an append under ``name`` and its id, so one that is replayed
    replaces itself. Batch jobs and streams of other names may fill the same table. The
    name goes with the checkpoint: ids start at 0 again without it.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        append_captures(batch, bronze, as_of, f"{name}-{batch_id}")

    return (
        capture_stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
