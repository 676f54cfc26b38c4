"""Assigning spots as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import assign


def assign_stream(spots: DataFrame, regions: DataFrame, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Starts a query that assigns each batch of the stream ``spots`` (spot, x, y) to ``regions``.

    A batch is one folder under ``out``, named by its number and overwritten if it runs again, so
    a restart leaves every spot once. Spots do not depend on each other, so nothing is kept
    between batches. The query ends when what is there has been read.
    """

    def write(batch: DataFrame, number: int) -> None:
        assign.assign_spots(batch, regions, **options).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return spots.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
