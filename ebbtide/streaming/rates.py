"""Windowed rates over a stream: the one stateful stream.

State is one counter per open window and label; the watermark closes windows
and drops their state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.monitoring import rates


def stream_rates(
    events: DataFrame, ts: str, labels: Sequence[str], delay: str = "10 minutes",
    width: str = "5 minutes", seconds: int = 300,
) -> DataFrame:
    """Events per second in tumbling windows, emitted once a window is closed."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return rates(timed, ts, labels, width, seconds)


def drain_to(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Run what is there to the end, appending closed windows to a Parquet folder."""
    query = (
        rows.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
