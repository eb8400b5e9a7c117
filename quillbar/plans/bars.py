"""Bars by symbol list, width and look-back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbar.operators.timeseries import resample
from quillbar.sources.tables import lookback


def load_bars(ticks: DataFrame, interval: str = "1 hour", period: str | None = None, symbols: Sequence[str] | None = None,
              ts: str = "ts", **columns) -> DataFrame:
    """Bars of width ``interval`` over the last ``period``; all bars and all symbols by default.

    Both filters act on the raw ticks, before anything is aggregated, and keep whole bars.
    """
    if symbols is not None:
        ticks = ticks.filter(F.col(columns.get("symbol", "symbol")).isin(*symbols))
    if period is not None:
        ticks = lookback(ticks, period, ts, grid=interval)
    return resample(ticks, interval, ts=ts, **columns)


def store_bars(bars: DataFrame, table: str, buckets: int) -> None:
    """Write bars to a table in ``buckets`` buckets by symbol, sorted by symbol and time, one file each.

    What reads the table per symbol (indicators, signals, the fold's sort) needs no shuffle. Choose buckets so that one holds some
    hundred megabytes; an existing table is replaced.
    """
    (bars.repartition(buckets, "symbol").write.bucketBy(buckets, "symbol").sortBy("symbol", "ts").mode("overwrite").saveAsTable(table))
