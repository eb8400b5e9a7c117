"""Bars from arriving ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbar.operators.timeseries import resample


def stream_bars(ticks: DataFrame, interval: str = "1 hour", delay: str = "10 minutes", ts: str = "ts", **columns) -> DataFrame:
    """The batch resample behind a watermark. Ticks later than ``delay`` are dropped; a bar appears once it is closed.

    The state holds one row per symbol and open bar. A watermark needs an instant, so a wall-clock column is cast first.
    """
    timed = ticks.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return resample(timed, interval, ts=ts, **columns)


def start_bars(bars: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append closed bars below ``path``. By default what is there is taken in and the query ends."""
    return (
        bars.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
