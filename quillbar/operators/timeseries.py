"""Bar building, indicators and signals as window expressions.

Every indicator takes ``by``, the columns that delimit one series. Bars sit on a time grid, so a symbol's bars are
bounded by span / interval however many ticks it has, and ``by=("symbol",)`` is enough. For raw ticks or other series
without such a bound use ``blocks.with_halo`` and ``by=("symbol", "_block")``; results are the same.

Missing values are null, never NaN, and a comparison with null counts as false. A NaN that comes in counts as missing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = ("symbol",)
ORDER = ("ts",)


def series_window(by: Sequence[str] = SERIES, order: Sequence[str] = ORDER):
    return W.partitionBy(*by).orderBy(*order)


def _is_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def present(value: str | Column) -> Column:
    """The value, with NaN as null."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(~F.isnan(c.cast("double")), c)


# ---- bars ---------------------------------------------------------------------------------------------------------

def _micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970, in an order that does not depend on the session time zone: of the instant for an instant
    column, of the column's own clock for a wall-clock column."""
    c = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_micros(c)
    day = F.date_diff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    second = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return day * 86_400_000_000 + (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * 1_000_000 + second


def _tick_rank(df: DataFrame, ts: str, tiebreak: str | None) -> Column:
    """Order of ticks as one fixed-width value, which keeps the aggregate on the hash path (a struct would sort).

    A tick without a tie-break comes before the others of its instant.
    """
    if tiebreak is None:
        return F.col(ts)
    shift = F.lit("20000000000000000000").cast("decimal(20,0)")
    first = F.lit("-9300000000000000000").cast("decimal(19,0)")
    return _micros(df, ts).cast("decimal(18,0)") * shift + F.coalesce(F.col(tiebreak).cast("decimal(19,0)"), first)


def resample(ticks: DataFrame, interval: str, symbol: str = "symbol", ts: str = "ts", price: str = "price",
             tiebreak: str | None = None) -> DataFrame:
    """Ticks to open/high/low/close bars plus the tick count. Partial aggregation happens before the shuffle.

    A NaN price counts as missing. Ticks without a price count in ``volume`` only.
    """
    rank = _tick_rank(ticks, ts, tiebreak)
    p = F.when(~F.isnan(F.col(price).cast("double")), F.col(price))
    rank = F.when(p.isNotNull(), rank)
    return (
        ticks.groupBy(F.col(symbol).alias("symbol"), F.window(ts, interval).alias("_w"))
        .agg(
            F.min_by(p, rank).alias("open"),
            F.max(p).alias("high"),
            F.min(p).alias("low"),
            F.max_by(p, rank).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .select("symbol", F.col("_w.start").alias("ts"), "open", "high", "low", "close", "volume")
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.na.drop()


def history_gate(df: DataFrame, minimum: int, by: str = "symbol") -> DataFrame:
    """One status row per series: its length, and whether it is long enough."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows")).select(
        by, "rows", F.when(F.col("rows") >= minimum, "OK").otherwise("INSUFFICIENT").alias("status")
    )


def with_history(df: DataFrame, minimum: int, by: str = "symbol") -> DataFrame:
    """Only the rows of series that are long enough, counted over the partitioning that the indicators need anyway."""
    counted = df.withColumn("_rows", F.count(F.lit(1)).over(W.partitionBy(by)))
    return counted.filter(F.col("_rows") >= minimum).drop("_rows")


# ---- indicators ---------------------------------------------------------------------------------------------------

def _stride(lengths: Sequence[int]) -> int:
    """A common divisor of the window lengths that keeps both the frame and the number of frames short."""
    common, longest = math.gcd(*lengths), max(lengths)
    return min((d for d in range(1, common + 1) if common % d == 0), key=lambda d: (d + longest // d, -d))


def rolling_means(df: DataFrame, means: dict[str, tuple[str, int]], by: Sequence[str] = SERIES,
                  order: Sequence[str] = ORDER) -> DataFrame:
    """Means of the last ``n`` rows, ``{out: (column, n)}``; null until ``n`` values exist.

    Spark adds up a sliding frame anew for every row, so a long window is put together from short frames: the sum of 50
    rows is five sums of 10, read back with ``lag``. The number of values in a window is a difference of two running
    counts.
    """
    w = series_window(by, order)
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    lengths: dict[str, list[int]] = {}
    for column, n in means.values():
        lengths.setdefault(column, []).append(n)
    strides = {c: _stride(ns) for c, ns in lengths.items()}
    frames = {f"_sum_{c}": F.sum(present(c)).over(w.rowsBetween(1 - d, 0)) for c, d in strides.items()}
    counts = {f"_cnt_{c}": F.count(present(c)).over(so_far) for c in strides}
    earlier = {
        f"_sum_{c}_{back}": F.lag(f"_sum_{c}", back).over(w)
        for c, d in strides.items()
        for back in range(d, max(lengths[c]), d)
    } | {f"_cnt_{c}_{n}": F.lag(f"_cnt_{c}", n, 0).over(w) for c, n in means.values()}
    out = {}
    for name, (c, n) in means.items():
        total = F.col(f"_sum_{c}")
        for back in range(strides[c], n, strides[c]):
            total = total + F.col(f"_sum_{c}_{back}")
        values = F.col(f"_cnt_{c}") - F.col(f"_cnt_{c}_{n}")
        out[name] = F.when(values == n, total / n)
    return df.withColumns({**frames, **counts}).withColumns(earlier).withColumns(out).drop(*frames, *counts, *earlier)


def step(value: str, w) -> Column:
    """Difference to the row before; null on the first row and where either value is missing."""
    return present(value) - F.lag(present(value)).over(w)


def add_sma(df: DataFrame, windows: Sequence[int] = (20, 50), value: str = "close", by: Sequence[str] = SERIES,
            order: Sequence[str] = ORDER) -> DataFrame:
    return rolling_means(df, {f"sma{n}": (value, n) for n in windows}, by, order)


def add_rsi(df: DataFrame, n: int = 14, value: str = "close", out: str = "rsi", by: Sequence[str] = SERIES,
            order: Sequence[str] = ORDER) -> DataFrame:
    """RSI from simple means of gains and losses; the first row counts as no gain and no loss.

    No loss at all gives 100; neither gain nor loss gives null.
    """
    d = F.col("_d")
    sides = df.withColumn("_d", step(value, series_window(by, order))).withColumns(
        {"_up": F.when(d > 0, d).otherwise(F.lit(0.0)), "_down": F.when(d < 0, -d).otherwise(F.lit(0.0))}
    )
    means = rolling_means(sides, {"_g": ("_up", n), "_l": ("_down", n)}, by, order)
    g, l = F.col("_g"), F.col("_l")
    rsi = F.when((l == 0) & (g > 0), F.lit(100.0)).otherwise(100 - 100 / (1 + F.try_divide(g, l)))
    return means.withColumn(out, rsi).drop("_d", "_up", "_down", "_g", "_l")


def ema_reach(span: int) -> int:
    """Rows after which a value's weight in the mean falls below exp(-40), under the last bit of a double."""
    return math.ceil(40 / _rate(span))


def _rate(span: int) -> float:
    return -math.log1p(-2 / (span + 1))


def _chunked(df: DataFrame, value: str, chunk: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds the position ``_i`` among the rows that have a value (a row without one shares that of the last before it, -1 at
    the head), its chunk ``_c`` and the place inside the chunk ``_k``."""
    position = F.count(present(value)).over(series_window(by, order).rowsBetween(W.unboundedPreceding, W.currentRow)) - 1
    return df.withColumn("_i", position).withColumns(
        {"_c": F.floor(F.col("_i") / F.lit(chunk)), "_k": F.pmod("_i", F.lit(chunk)), "_has": present(value).isNotNull()}
    )


def _ema_in_chunks(df: DataFrame, spans: dict[str, int], value: str, chunk: int, by: Sequence[str]) -> DataFrame:
    # A range frame: rows without a value stand at the same place as the row that they repeat.
    inside = W.partitionBy(*by, "_c").orderBy("_k").rangeBetween(W.unboundedPreceding, W.currentRow)
    chunk_before = W.partitionBy(*by).orderBy("_c").rangeBetween(-1, -1)
    x, k = F.when(F.col("_has"), F.col(value)), F.col("_k")
    local, ends, whole = {}, {}, {}
    for name, span in spans.items():
        rate = _rate(span)
        weighted = F.when(F.col("_i") == 0, x).otherwise(x * (2 / (span + 1))) * F.exp(k * rate)
        local[f"_in_{name}"] = F.sum(weighted).over(inside) * F.exp(-k * rate)
        ends[f"_end_{name}"] = F.max(F.when(F.col("_has") & (k == chunk - 1), F.col(f"_in_{name}"))).over(chunk_before)
        carried = F.coalesce(F.col(f"_end_{name}"), F.lit(0.0)) * F.exp(-(k + 1) * rate)
        whole[name] = F.col(f"_in_{name}") + carried
    return df.withColumns(local).withColumns(ends).withColumns(whole).drop(*local, *ends)


def _chunk_for(spans: Sequence[int]) -> int | None:
    """A chunk length that serves all spans, or None when their rates are too far apart for one exponent range."""
    chunk = max(ema_reach(s) for s in spans)
    return chunk if max(_rate(s) for s in spans) * chunk <= 600 else None


def add_ema(df: DataFrame, spans: dict[str, int], value: str = "close", by: Sequence[str] = SERIES,
            order: Sequence[str] = ORDER) -> DataFrame:
    """Exponential means y = a x + (1 - a) y', a = 2 / (span + 1), starting at the first value.

    Rows without a value do not count: they carry the last mean, and null before the first value.

    The recurrence is an affine map, so it splits: inside a chunk of rows it is a running sum of values scaled by
    (1 - a)^-k; across chunks only the last chunk's end value still matters, since a chunk is at least ``ema_reach``
    rows long. Both parts are plain windows on one partitioning, for any series length.
    """
    so_far = series_window(by, order).rowsBetween(W.unboundedPreceding, W.currentRow)
    unsmoothed = {name: F.last(present(value), ignorenulls=True).over(so_far) for name, span in spans.items() if span == 1}
    if unsmoothed:
        df, spans = df.withColumns(unsmoothed), {n: s for n, s in spans.items() if s != 1}
    if not spans:
        return df
    chunk = _chunk_for(list(spans.values()))
    if chunk is None:
        for name, span in spans.items():
            df = add_ema(df, {name: span}, value, by, order)
        return df
    return _ema_in_chunks(_chunked(df, value, chunk, by, order), spans, value, chunk, by).drop("_i", "_c", "_k", "_has")


def add_macd(df: DataFrame, value: str = "close", fast: int = 12, slow: int = 26, signal: int = 9,
             by: Sequence[str] = SERIES, order: Sequence[str] = ORDER) -> DataFrame:
    """``macd`` = fast minus slow exponential mean; ``macd_signal`` = exponential mean of ``macd``, over the rows with a value."""
    chunk = _chunk_for([fast, slow, signal])
    line = F.col("_fast") - F.col("_slow")
    if chunk is None:
        means = add_ema(df, {"_fast": fast, "_slow": slow}, value, by, order).withColumn("macd", line)
        means = means.withColumn("_line", F.when(present(value).isNotNull(), F.col("macd")))
        return add_ema(means, {"macd_signal": signal}, "_line", by, order).drop("_fast", "_slow", "_line")
    placed = _chunked(df, value, chunk, by, order)
    means = _ema_in_chunks(placed, {"_fast": fast, "_slow": slow}, value, chunk, by).withColumn("macd", line)
    both = _ema_in_chunks(means, {"macd_signal": signal}, "macd", chunk, by)
    return both.drop("_fast", "_slow", "_i", "_c", "_k", "_has")


def add_indicators(df: DataFrame, by: Sequence[str] = SERIES, order: Sequence[str] = ORDER) -> DataFrame:
    """sma20, sma50, rsi, macd and macd_signal. One shuffle feeds all of them."""
    return add_macd(add_rsi(add_sma(df, by=by, order=order), by=by, order=order), by=by, order=order)


# Rows of history that the longest indicator above can still feel: the slow mean, then the signal line on top of it.
INDICATOR_HALO = ema_reach(26) + ema_reach(9)


# ---- signals ------------------------------------------------------------------------------------------------------

def add_regime(df: DataFrame, warmup: int = 20, out: str = "signal", by: Sequence[str] = SERIES,
               order: Sequence[str] = ORDER, index: str | None = None) -> DataFrame:
    """0 during the first ``warmup`` rows, then 1 if sma20 > sma50, else -1 (also while sma50 is missing).

    Give the row position as ``index`` if the series is cut into blocks.
    """
    row = F.col(index) if index else F.row_number().over(series_window(by, order))
    regime = F.when(row <= warmup, 0).when(_is_true(F.col("sma20") > F.col("sma50")), 1).otherwise(-1)
    return df.withColumn(out, regime)


def add_multifactor(df: DataFrame, out: str = "signal") -> DataFrame:
    """1: uptrend, MACD above its signal line, RSI within (30, 60). -1: the mirror image with RSI over 60. Else 0."""
    fast, slow, rsi = F.col("sma20"), F.col("sma50"), F.col("rsi")
    macd, line = F.col("macd"), F.col("macd_signal")
    buy = (fast > slow) & (macd > line) & (rsi > 30) & (rsi < 60)
    sell = (fast < slow) & (macd < line) & (rsi > 60)
    return df.withColumn(out, F.when(_is_true(buy), 1).when(_is_true(sell), -1).otherwise(0))


def add_edge(df: DataFrame, signal: str = "signal", out: str = "edge", by: Sequence[str] = SERIES,
             order: Sequence[str] = ORDER) -> DataFrame:
    return df.withColumn(out, step(signal, series_window(by, order)))


def latest_crossover(df: DataFrame, by: str = "symbol", order: Sequence[str] = ORDER, minimum: int = 52,
                     drop_short: bool = False) -> DataFrame:
    """BUY / SELL when sma20 crossed sma50 strictly on the last bar, else HOLD; the last close as ``price``.

    A series shorter than ``minimum`` is a HOLD, or left out with ``drop_short``. Only the last rows of a series can
    matter, so a group limit cuts each series to those before any window.
    """
    newest_first = W.partitionBy(by).orderBy(*[F.col(c).desc() for c in order])
    tail = df.withColumn("_back", F.row_number().over(newest_first)).filter(F.col("_back") <= max(minimum, 52))
    w = series_window((by,), order)
    means = rolling_means(tail, {"_s20": ("close", 20), "_s50": ("close", 50)}, (by,), order).withColumns(
        {"_p20": F.lag("_s20").over(w), "_p50": F.lag("_s50").over(w), "_rows": F.count(F.lit(1)).over(W.partitionBy(by))}
    )
    enough = F.col("_rows") >= minimum
    up = enough & (F.col("_p20") < F.col("_p50")) & (F.col("_s20") > F.col("_s50"))
    down = enough & (F.col("_p20") > F.col("_p50")) & (F.col("_s20") < F.col("_s50"))
    signal = F.when(_is_true(up), "BUY").when(_is_true(down), "SELL").otherwise("HOLD")
    last = means.filter("_back = 1")
    if drop_short:
        last = last.filter(enough)
    return last.select(by, *order, present("close").alias("price"), signal.alias("signal"))


def rsi_macd_rule(rsi: Column, macd: Column) -> Column:
    buy, sell = (rsi < 30) & (macd > 0), (rsi > 70) & (macd < 0)
    return F.when(_is_true(buy), "BUY").when(_is_true(sell), "SELL").otherwise("HOLD")


def entry_levels(df: DataFrame, signal: str = "signal", price: str = "price", stop: float = 0.03,
                 target: float = 0.06) -> DataFrame:
    """Entry, stop and target around ``price``; a HOLD has only the entry. Rounded to cents."""
    s, p = F.col(signal), present(price)
    return df.withColumns(
        {
            "entry": F.round(p, 2),
            "stop_loss": F.round(F.when(s == "BUY", p * (1 - stop)).when(s == "SELL", p * (1 + stop)), 2),
            "take_profit": F.round(F.when(s == "BUY", p * (1 + target)).when(s == "SELL", p * (1 - target)), 2),
        }
    )


def running_drawdown(df: DataFrame, value: str = "close", limit: float = 0.15, by: Sequence[str] = SERIES,
                     order: Sequence[str] = ORDER) -> DataFrame:
    """Running peak, relative fall from it, and whether the fall exceeds ``limit``. A missing value keeps the peak and has no fall."""
    so_far = series_window(by, order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return fall_from_peak(df.withColumn("peak", F.max(present(value)).over(so_far)), value, limit)


def fall_from_peak(df: DataFrame, value: str = "close", limit: float = 0.15) -> DataFrame:
    """``drawdown`` and ``breach`` from a ``peak`` column; for raw ticks the peak comes from ``blocks.running_max``.

    Both are null at a peak of zero.
    """
    fall = F.try_divide(F.col("peak") - present(value), F.col("peak"))
    return df.withColumn("drawdown", fall).withColumn("breach", F.col("drawdown") > limit)


def first_breach(df: DataFrame, by: str = "symbol", ts: str = "ts") -> DataFrame:
    return df.groupBy(by).agg(F.min(F.when(F.col("breach"), F.col(ts))).alias("first_breach"))


def position_size(cash: Column, risk: float, price: Column, asset_type: Column) -> Column:
    """Quantity that risks ``risk`` of ``cash``: 6 decimals for crypto, 2 for stock; null at a price of zero."""
    raw = F.try_divide(cash * risk, present(price))
    return F.when(asset_type == "crypto", F.round(raw, 6)).otherwise(F.round(raw, 2))


def order_quantity(qty: Column, asset_type: Column) -> Column:
    """What an order can carry: stock orders take whole units, cut toward zero."""
    return F.when(asset_type == "crypto", qty).otherwise(qty.cast("bigint").cast("double"))
