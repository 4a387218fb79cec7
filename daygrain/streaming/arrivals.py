"""Start a day's run when its marker arrives, as a stream over object-created notices.

The source has no event-time stream: its unit of work is a whole day, which the marker closes.
So the stream carries days, and each day runs as the idempotent batch it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from daygrain.sources.ready import NOTICE_SCHEMA, notice_keys, ready_days


def notices(spark: SparkSession, folder: str) -> DataFrame:
    """New notification documents in a folder, one JSON document per line."""
    return spark.readStream.schema(NOTICE_SCHEMA).json(folder)


def run_ready_days(
    stream: DataFrame,
    on_day: Callable[[SparkSession, str], object],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Call `on_day` for each day that became ready, oldest first.

    A batch that failed is offered again, so `on_day` must be safe to repeat, as the clean and
    gold runs are. Without `interval` the query handles what is there and ends.
    """

    def handle(batch: DataFrame, _: int) -> None:
        # One row per calendar day whose marker is in this batch.
        days = ready_days(notice_keys(batch)).orderBy("dt").collect()
        for row in days:
            on_day(batch.sparkSession, row["dt"])

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
