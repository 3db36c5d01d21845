"""The write modes as sinks of a stream: each micro-batch is one write of a versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import write_table


def stream_into(stream: DataFrame, table: str, mode: str, checkpoint: str, keys: list[str] = (), **options) -> StreamingQuery:
    """Start a query that appends or merges each micro-batch; with `availableNow=True` it ends with the input.

    A batch that is repeated after a failure is known by the stream's checkpoint folder and its number, and not written
    again: each is in the table once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_table(batch, table, mode, list(keys), batch=(checkpoint, batch_id))

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(**(options or {"availableNow": True})).foreachBatch(write).start()
