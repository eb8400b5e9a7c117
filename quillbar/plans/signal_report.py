"""The per-symbol summary: latest crossover, price levels, and a row for every requested symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillbar.operators import relational, timeseries


def summarize(bars: DataFrame, tickers: DataFrame, minimum_rows: int = 60) -> DataFrame:
    """symbol, signal, entry, stop_loss, take_profit; ``NO DATA`` where bars are missing or too few."""
    latest = timeseries.latest_crossover(bars, minimum=minimum_rows, drop_short=True)
    levels = timeseries.entry_levels(latest).select("symbol", "signal", "entry", "stop_loss", "take_profit")
    return relational.every_ticker(tickers, levels)
