"""Bronze stream into a silver store."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from skyledger.plans.silver import SilverStore, write_batch


def start(
    bronze_stream: DataFrame,
    store: SilverStore,
    as_of: datetime | str | None = None,
    **options,
) -> StreamingQuery:
    """Process what is there in bounded micro-batches, then stop.

    Micro-batches are written by id, so one that is replayed after a failure
    replaces what it wrote before. The checkpoint lies in the store: ids count
    from 0 again without it, so the two must live and go together.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        # an empty batch leaves no row anywhere, so nothing has to look for one first
        write_batch(batch, store, batch_id, as_of, **options)

    return (
        bronze_stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", store.checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain(
    bronze_stream: DataFrame,
    store: SilverStore,
    as_of: datetime | str | None = None,
    timeout_s: int | None = None,
    **options,
) -> bool:
    """Start, wait until all input is processed, and raise what failed.

    False if ``timeout_s`` passed first; the query then goes on.
    """
    query = start(bronze_stream, store, as_of, **options)
    if timeout_s is not None:
        return query.awaitTermination(timeout_s)
    query.awaitTermination()
    return True
