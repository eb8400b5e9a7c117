"""Bars, indicators, signals and the trade fold."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from catalog.common import MACD_SQL, RSI_SQL, SMA_SQL, bars, bars_sql, query, table, ticks
from quillbar.functions import scalars
from quillbar.operators import backtest, blocks, relational, timeseries as ts
from quillbar.plans.bars import load_bars, store_bars
from quillbar.plans.signal_report import summarize
from quillbar.session import scratch_path
from quillbar.sources import tables
from quillbar.streaming import bars as live, signals

BARS = bars_sql()
USER_BARS = bars_sql("user_id")


@query("ohlc_hourly", f"WITH {BARS} SELECT * FROM bars")
def ohlc_hourly(spark, sf):
    return bars(spark, sf)


@query("ohlc_five_minutes", """
    SELECT CAST(event_type AS VARCHAR) AS symbol, time_bucket(INTERVAL '5 minutes', ts) AS ts,
           first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
           last(value ORDER BY ts, event_id) AS close, count(*) AS volume
    FROM events GROUP BY 1, 2""")
def ohlc_five_minutes(spark, sf):
    return ts.resample(ticks(spark, sf), "5 minutes", tiebreak="event_id")


@query("bars_lookback", f"WITH {BARS} SELECT * FROM bars WHERE ts >= (SELECT max(ts) FROM bars) - INTERVAL 7 DAY")
def bars_lookback(spark, sf):
    """Hourly bars of the last seven days. The newest tick bounds the scan, so only recent ticks are aggregated."""
    return load_bars(ticks(spark, sf), "1 hour", "7 days", tiebreak="event_id")


@query("latest_n_bars", f"""
    WITH {USER_BARS} SELECT symbol, ts, close FROM bars
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) <= 30""")
def latest_n_bars(spark, sf):
    return tables.latest_n(bars(spark, sf, "user_id").select("symbol", "ts", "close"), 30)


@query("bars_dropna", f"""
    WITH {BARS} SELECT * FROM (SELECT symbol, ts, CASE WHEN volume > 1 THEN close END AS close, nullif(open, low) AS open FROM bars)
    WHERE close IS NOT NULL AND open IS NOT NULL""")
def bars_dropna(spark, sf):
    holes = bars(spark, sf).select(
        "symbol", "ts", F.when(F.col("volume") > 1, F.col("close")).alias("close"), F.nullif("open", "low").alias("open")
    )
    return ts.drop_incomplete(holes)


@query("history_gate", f"""
    WITH {USER_BARS} SELECT symbol, count(*) AS rows, CASE WHEN count(*) >= 60 THEN 'OK' ELSE 'INSUFFICIENT' END AS status
    FROM bars GROUP BY symbol""")
def history_gate(spark, sf):
    return ts.history_gate(bars(spark, sf, "user_id"), 60)


@query("long_enough_series", f"""
    WITH {USER_BARS} SELECT symbol, ts, close FROM bars WHERE symbol IN (SELECT symbol FROM bars GROUP BY symbol HAVING count(*) >= 60)""")
def long_enough_series(spark, sf):
    return ts.with_history(bars(spark, sf, "user_id").select("symbol", "ts", "close"), 60)


@query("sma_20_50", f"WITH {BARS}, {SMA_SQL} SELECT symbol, ts, close, round(sma20, 4) AS sma20, round(sma50, 4) AS sma50 FROM sma")
def sma_20_50(spark, sf):
    return ts.add_sma(bars(spark, sf)).select("symbol", "ts", "close", F.round("sma20", 4).alias("sma20"), F.round("sma50", 4).alias("sma50"))


@query("close_diff", f"""
    WITH {BARS} SELECT symbol, ts, round(close - lag(close) OVER (PARTITION BY symbol ORDER BY ts), 4) AS diff FROM bars""")
def close_diff(spark, sf):
    return bars(spark, sf).select("symbol", "ts", F.round(ts.step("close", ts.series_window()), 4).alias("diff"))


@query("rsi_14", f"WITH {BARS}, {RSI_SQL} SELECT symbol, ts, round(rsi, 8) AS rsi FROM rsi")
def rsi_14(spark, sf):
    return ts.add_rsi(bars(spark, sf)).select("symbol", "ts", F.round("rsi", 8).alias("rsi"))


@query("ema_12_26", f"WITH RECURSIVE {BARS}, {MACD_SQL} SELECT symbol, ts, round(e12, 6) AS ema12, round(e26, 6) AS ema26 FROM macd")
def ema_12_26(spark, sf):
    means = ts.add_ema(bars(spark, sf), {"ema12": 12, "ema26": 26})
    return means.select("symbol", "ts", F.round("ema12", 6).alias("ema12"), F.round("ema26", 6).alias("ema26"))


GAPPY_SQL = """gappy AS (SELECT symbol, ts, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY ts) % 5 IN (1, 2) THEN NULL ELSE close END AS close FROM all_bars),
    bars AS (SELECT * FROM gappy WHERE close IS NOT NULL)"""


@query("means_over_gaps", f"""
    WITH RECURSIVE {BARS.replace("bars AS", "all_bars AS")}, {GAPPY_SQL}, {MACD_SQL}
    SELECT g.symbol, g.ts, g.close, round(last_value(e12 IGNORE NULLS) OVER w, 6) AS ema12, round(last_value(macd IGNORE NULLS) OVER w, 6) AS macd,
           round(last_value(macd_signal IGNORE NULLS) OVER w, 6) AS macd_signal
    FROM gappy g LEFT JOIN macd m ON m.symbol = g.symbol AND m.ts = g.ts WINDOW w AS (PARTITION BY g.symbol ORDER BY g.ts)""")
def means_over_gaps(spark, sf):
    """Two closes of five missing: the means run over the others and are carried across the gaps."""
    place = F.row_number().over(ts.series_window())
    gappy = bars(spark, sf).withColumn("close", F.when(~(place % 5).isin(1, 2), F.col("close")))
    means = ts.add_macd(ts.add_ema(gappy, {"ema12": 12}))
    return means.select("symbol", "ts", "close", *[F.round(c, 6).alias(c) for c in ("ema12", "macd", "macd_signal")])


@query("ohlc_missing_ties", """
    SELECT CAST(event_type AS VARCHAR) AS symbol, date_trunc('hour', ts) AS ts, first(value ORDER BY ts, tie NULLS FIRST) AS open,
           last(value ORDER BY ts, tie NULLS FIRST) AS close, count(*) AS volume
    FROM (SELECT *, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id END AS tie FROM events) GROUP BY 1, 2""")
def ohlc_missing_ties(spark, sf):
    """Every fourth tick has no tie-break; it still opens or closes its bar."""
    rows = ticks(spark, sf).withColumn("event_id", F.when(F.col("event_id") % 4 != 0, F.col("event_id")))
    return ts.resample(rows, "1 hour", tiebreak="event_id").select("symbol", "ts", "open", "close", "volume")


@query("macd", f"WITH RECURSIVE {BARS}, {MACD_SQL} SELECT symbol, ts, round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal FROM macd")
def macd(spark, sf):
    return ts.add_macd(bars(spark, sf)).select("symbol", "ts", F.round("macd", 6).alias("macd"), F.round("macd_signal", 6).alias("macd_signal"))


TICK_BARS_SQL = "bars AS (SELECT event_type AS symbol, ts, value AS close FROM events)"


@query("tick_indicators_in_blocks", f"""
    WITH RECURSIVE {TICK_BARS_SQL}, {SMA_SQL}, {RSI_SQL}, {MACD_SQL}
    SELECT sma.symbol, sma.ts, sma.rn AS row_index, round(sma20, 4) AS sma20, round(sma50, 4) AS sma50, round(rsi, 8) AS rsi,
           round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal,
           CASE WHEN sma.rn <= 20 THEN 0 WHEN coalesce(sma20 > sma50, false) THEN 1 ELSE -1 END AS signal
    FROM sma JOIN rsi USING (symbol, ts) JOIN macd USING (symbol, ts)""")
def tick_indicators_in_blocks(spark, sf):
    """All indicators on raw ticks, where a symbol can hold any share of the rows: numbered by range, cut into
    blocks that carry the history they need, so no task sees a whole symbol."""
    rows = ticks(spark, sf).withColumnRenamed("price", "close")

    def indicators(df, by, order):
        return ts.add_regime(ts.add_indicators(df, by, order), by=by, order=order, index="row_index")

    out = blocks.in_blocks(rows, "symbol", ["ts", "event_id"], indicators, 16_384, ts.INDICATOR_HALO)
    return out.select(
        "symbol", "ts", "row_index", F.round("sma20", 4).alias("sma20"), F.round("sma50", 4).alias("sma50"),
        F.round("rsi", 8).alias("rsi"), F.round("macd", 6).alias("macd"), F.round("macd_signal", 6).alias("macd_signal"), "signal"
    )


REGIME_SQL = """regime AS (
      SELECT *, CASE WHEN rn <= 20 THEN 0 WHEN coalesce(sma20 > sma50, false) THEN 1 ELSE -1 END AS signal FROM sma)"""
MULTI_SQL = """multi AS (
      SELECT sma.symbol, sma.ts, sma.close, sma.rn,
        CASE WHEN coalesce(sma20 > sma50 AND macd > macd_signal AND rsi > 30 AND rsi < 60, false) THEN 1
             WHEN coalesce(sma20 < sma50 AND macd < macd_signal AND rsi > 60, false) THEN -1 ELSE 0 END AS signal
      FROM sma JOIN rsi USING (symbol, ts) JOIN macd USING (symbol, ts))"""


@query("regime_signal", f"WITH {BARS}, {SMA_SQL}, {REGIME_SQL} SELECT symbol, ts, signal FROM regime")
def regime_signal(spark, sf):
    return ts.add_regime(ts.add_sma(bars(spark, sf))).select("symbol", "ts", "signal")


@query("multifactor_signal", f"""
    WITH RECURSIVE {BARS}, {SMA_SQL}, {RSI_SQL}, {MACD_SQL}, {MULTI_SQL} SELECT symbol, ts, signal FROM multi""")
def multifactor_signal(spark, sf):
    return ts.add_multifactor(ts.add_indicators(bars(spark, sf))).select("symbol", "ts", "signal")


@query("signal_edges", f"""
    WITH RECURSIVE {BARS}, {SMA_SQL}, {RSI_SQL}, {MACD_SQL}, {REGIME_SQL}, {MULTI_SQL}
    SELECT symbol, ts, regime.signal - lag(regime.signal) OVER w AS regime_edge, multi.signal - lag(multi.signal) OVER w AS multi_edge
    FROM regime JOIN multi USING (symbol, ts) WINDOW w AS (PARTITION BY symbol ORDER BY ts)""")
def signal_edges(spark, sf):
    rows = ts.add_multifactor(ts.add_regime(ts.add_indicators(bars(spark, sf)), out="regime"), out="multi")
    return ts.add_edge(ts.add_edge(rows, "regime", "regime_edge"), "multi", "multi_edge").select("symbol", "ts", "regime_edge", "multi_edge")


CROSS_SQL = """cross_over AS (
      SELECT symbol, ts, close AS price, rn,
        CASE WHEN {gate} AND coalesce(lag(sma20) OVER w < lag(sma50) OVER w AND sma20 > sma50, false) THEN 'BUY'
             WHEN {gate} AND coalesce(lag(sma20) OVER w > lag(sma50) OVER w AND sma20 < sma50, false) THEN 'SELL' ELSE 'HOLD' END AS signal,
        row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS back
      FROM sma WINDOW w AS (PARTITION BY symbol ORDER BY ts))"""


def cents(x: str) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


LEVELS_SQL = f"""{cents("price")} AS entry,
      {cents("CASE signal WHEN 'BUY' THEN price * 0.97 WHEN 'SELL' THEN price * 1.03 END")} AS stop_loss,
      {cents("CASE signal WHEN 'BUY' THEN price * 1.06 WHEN 'SELL' THEN price * 0.94 END")} AS take_profit"""


@query("latest_crossover", f"""
    WITH {USER_BARS}, {SMA_SQL}, {CROSS_SQL.format(gate="rn >= 52")} SELECT symbol, ts, price, signal FROM cross_over WHERE back = 1""")
def latest_crossover(spark, sf):
    return ts.latest_crossover(bars(spark, sf, "user_id"))


@query("entry_exit_levels", f"""
    WITH {BARS}, {SMA_SQL}, {CROSS_SQL.format(gate="rn >= 52")}
    SELECT symbol, ts, price, signal, {LEVELS_SQL} FROM cross_over""")
def entry_exit_levels(spark, sf):
    """The crossover on every bar, with its price levels."""
    w = ts.series_window()
    rows = ts.add_sma(bars(spark, sf)).withColumns({"p20": F.lag("sma20").over(w), "p50": F.lag("sma50").over(w), "rn": F.row_number().over(w)})
    up = (F.col("rn") >= 52) & (F.col("p20") < F.col("p50")) & (F.col("sma20") > F.col("sma50"))
    down = (F.col("rn") >= 52) & (F.col("p20") > F.col("p50")) & (F.col("sma20") < F.col("sma50"))
    marked = rows.select("symbol", "ts", F.col("close").alias("price"), F.when(up, "BUY").when(down, "SELL").otherwise("HOLD").alias("signal"))
    return ts.entry_levels(marked)


@query("rsi_macd_rule", f"""
    WITH RECURSIVE {bars_sql("user_id").replace("bars AS", "all_bars AS")},
    bars AS (SELECT * FROM all_bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) <= 30),
    {RSI_SQL}, {MACD_SQL}, last_row AS (SELECT symbol, max(rn) AS rn FROM macd GROUP BY symbol)
    SELECT symbol, macd.ts, round(rsi, 8) AS rsi, round(macd, 6) AS macd,
           CASE WHEN rsi < 30 AND macd > 0 THEN 'BUY' WHEN rsi > 70 AND macd < 0 THEN 'SELL' ELSE 'HOLD' END AS signal
    FROM macd JOIN last_row USING (symbol, rn) JOIN rsi USING (symbol, ts) WHERE rn >= 26""")
def rsi_macd_rule(spark, sf):
    """The last 30 bars of every user: RSI and MACD on the newest one, then the rule. At least 26 bars are needed."""
    recent = tables.latest_n(bars(spark, sf, "user_id").select("symbol", "ts", "close"), 30, rank="back")
    w = ts.series_window()
    full = ts.add_macd(ts.add_rsi(recent.withColumn("rn", F.row_number().over(w))))
    return full.filter("back = 1 AND rn >= 26").select(
        "symbol", "ts", F.round("rsi", 8).alias("rsi"), F.round("macd", 6).alias("macd"),
        ts.rsi_macd_rule(F.col("rsi"), F.col("macd")).alias("signal"),
    )


@query("signal_summary_with_missing", f"""
    WITH {USER_BARS}, {SMA_SQL}, {CROSS_SQL.format(gate="rn >= 60")},
    done AS (SELECT symbol, signal, {LEVELS_SQL} FROM cross_over WHERE back = 1 AND rn >= 60)
    SELECT CAST(c_custkey AS VARCHAR) AS symbol, coalesce(signal, 'NO DATA') AS signal, entry, stop_loss, take_profit
    FROM customer LEFT JOIN done ON done.symbol = CAST(c_custkey AS VARCHAR)""")
def signal_summary_with_missing(spark, sf):
    """Every customer is a requested symbol; most have no bars."""
    wanted = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))
    return summarize(bars(spark, sf, "user_id"), wanted)


@query("running_drawdown", f"""
    WITH {BARS}, p AS (SELECT symbol, ts, close, max(close) OVER (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING) AS peak FROM bars)
    SELECT symbol, ts, peak, round((peak - close) / peak, 6) AS drawdown, (peak - close) / peak > 0.15 AS breach FROM p""")
def running_drawdown(spark, sf):
    return ts.running_drawdown(bars(spark, sf)).select("symbol", "ts", "peak", F.round("drawdown", 6).alias("drawdown"), "breach")


@query("tick_drawdown_in_slices", """
    WITH p AS (SELECT event_id, event_type AS symbol, value, max(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS peak FROM events)
    SELECT event_id, symbol, peak, round((peak - value) / peak, 6) AS drawdown, (peak - value) / peak > 0.15 AS breach FROM p""")
def tick_drawdown_in_slices(spark, sf):
    """Drawdown on raw ticks: running peaks by range, joined with the peak of all earlier ranges."""
    rows = ticks(spark, sf)
    peaked = blocks.running_max(rows, "symbol", ["ts", "event_id"], "price", "peak")
    return ts.fall_from_peak(peaked, "price").select("event_id", "symbol", "peak", F.round("drawdown", 6).alias("drawdown"), "breach")


@query("first_drawdown_breach", f"""
    WITH {USER_BARS}, p AS (SELECT symbol, ts, close, max(close) OVER (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING) AS peak FROM bars)
    SELECT symbol, min(CASE WHEN (peak - close) / peak > 0.5 THEN ts END) AS first_breach FROM p GROUP BY symbol""")
def first_drawdown_breach(spark, sf):
    return ts.first_breach(ts.running_drawdown(bars(spark, sf, "user_id"), limit=0.5))


# ---- the fold -----------------------------------------------------------------------------------------------------

def fold_sql(source: str, enter: str, stake: float = 0.02, stop: float = 0.03, target: float = 0.05, fall: float = 0.15, per_symbol: bool = False) -> str:
    """The same rules as a recursive query, one bar per step; ``per_symbol`` takes decimal places and the held quantity from ``places``."""
    own = "(SELECT {} FROM places WHERE places.symbol = {}.symbol)"
    size = f"cash * {stake} / p"
    if per_symbol:
        known = own.format("places", "w")
        size = f"coalesce(CASE {known} WHEN 6 THEN round({size}, 6) WHEN 2 THEN round({size}, 2) WHEN 0 THEN round({size}, 0) END, {size})"
    may = f"qty1 <= coalesce({own.format('held', 'v')}, qty1)" if per_symbol else "true"
    may_last = f"qty <= coalesce({own.format('held', 'ends')}, qty)" if per_symbol else "true"
    return f"""
    signals AS (SELECT symbol, ts, close, rn, signal, signal - lag(signal) OVER (PARTITION BY symbol ORDER BY ts) AS edge FROM {source}),
    steps AS (SELECT symbol, ts, CAST(close AS DOUBLE) AS p, rn, coalesce({enter}, false) AS enter, coalesce(edge = -1, false) AS leave FROM signals),
    fold AS (
      SELECT symbol, rn, ts, p, CAST(100000 AS DOUBLE) AS cash, CAST(100000 AS DOUBLE) AS peak, CAST(0 AS DOUBLE) AS qty,
             CAST(0 AS DOUBLE) AS stop, CAST(0 AS DOUBLE) AS target, false AS halted, false AS bought, false AS sold, CAST(0 AS DOUBLE) AS moved
      FROM steps WHERE rn = 1
      UNION ALL
      SELECT symbol, rn, ts, p, CASE WHEN sells THEN cash1 + qty1 * p ELSE cash1 END, peak1, CASE WHEN sells THEN 0 ELSE qty1 END,
             stop1, target1, halted1, buys, sells, qty1
      FROM (SELECT *, NOT halted1 AND qty1 > 0 AND {may} AND (p <= stop1 OR p >= target1 OR leave) AS sells
        FROM (SELECT *, CASE WHEN buys THEN cash - cash * {stake} ELSE cash END AS cash1, CASE WHEN buys THEN {size} ELSE qty END AS qty1,
                     CASE WHEN buys THEN p * (1 - {stop}) ELSE stop END AS stop1, CASE WHEN buys THEN p * (1 + {target}) ELSE target END AS target1
          FROM (SELECT *, NOT halted1 AND qty = 0 AND enter AS buys
            FROM (SELECT *, halted OR (peak1 - worth) / peak1 > {fall} AS halted1
              FROM (SELECT *, greatest(peak, worth) AS peak1
                FROM (SELECT s.symbol, s.rn, s.ts, s.p, s.enter, s.leave, f.cash, f.peak, f.qty, f.stop, f.target, f.halted, f.cash + f.qty * s.p AS worth
                      FROM fold f JOIN steps s ON s.symbol = f.symbol AND s.rn = f.rn + 1)))) AS w) AS v)),
    ends AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY rn DESC) = 1),
    moves AS (
      SELECT symbol, rn, 0 AS kind, 'HALT' AS action, ts, CAST(NULL AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS qty, 'Max drawdown reached. Trading halted.' AS note
        FROM fold WHERE halted QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY rn) = 1
      UNION ALL SELECT symbol, rn, 1, 'BUY', ts, p, moved, NULL FROM fold WHERE bought
      UNION ALL SELECT symbol, rn, 2, 'SELL', ts, p, moved, NULL FROM fold WHERE sold
      UNION ALL SELECT symbol, rn, 3, 'FINAL SELL', ts, p, qty, NULL FROM ends WHERE qty > 0 AND {may_last})"""


CROSS_FOLD = f"{BARS}, {SMA_SQL}, {REGIME_SQL}, " + fold_sql("regime", "edge > 0 AND signal = 1", fall=0.05)
MULTI_FOLD = f"{BARS}, {SMA_SQL}, {RSI_SQL}, {MACD_SQL}, {MULTI_SQL}, " + fold_sql("multi", "edge = 1", target=0.06)
LITERAL_FOLD = f"{BARS}, {SMA_SQL}, {REGIME_SQL}, " + fold_sql("regime", "edge = 1")
BALANCE_SQL = "round(cash + qty * p, 4)"


def _crossover_run(spark, sf, marks=False):
    rows = ts.add_edge(ts.add_regime(ts.add_sma(bars(spark, sf))))
    return backtest.simulate(rows, backtest.TradeRules(entry_mode="crossover", halt_row=True, max_drawdown=0.05), marks)


@query("trade_log", f"""
    WITH RECURSIVE {CROSS_FOLD}
    SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY rn, kind) AS INTEGER) AS seq, action, ts, price, round(qty, 6) AS qty, note
    FROM moves""")
def trade_log(spark, sf):
    return backtest.trade_log(_crossover_run(spark, sf)).withColumn("qty", F.round("qty", 6))


@query("final_balance", f"WITH RECURSIVE {CROSS_FOLD} SELECT symbol, {BALANCE_SQL} AS final_balance FROM ends")
def final_balance(spark, sf):
    return backtest.final_balance(_crossover_run(spark, sf)).withColumn("final_balance", F.round("final_balance", 4))


@query("trade_stats", f"""
    WITH RECURSIVE {MULTI_FOLD}
    SELECT ends.symbol, (SELECT count(*) FROM moves WHERE moves.symbol = ends.symbol) AS trades, {BALANCE_SQL} AS final_balance FROM ends""")
def trade_stats(spark, sf):
    """Multi-factor signal, entry on an edge of exactly 1, 6% target."""
    rows = ts.add_edge(ts.add_multifactor(ts.add_indicators(bars(spark, sf))))
    rules = backtest.TradeRules(halt_row=True, take_profit=0.06)
    return backtest.trade_stats(backtest.simulate(rows, rules)).withColumn("final_balance", F.round("final_balance", 4))


@query("literal_two_state_stats", f"""
    WITH RECURSIVE {LITERAL_FOLD}
    SELECT ends.symbol, (SELECT count(*) FROM moves WHERE moves.symbol = ends.symbol AND kind > 0) AS trades, {BALANCE_SQL} AS final_balance FROM ends""")
def literal_two_state_stats(spark, sf):
    """The two-state signal with the literal rule never trades."""
    return backtest.trade_stats(backtest.simulate(ts.add_edge(ts.add_regime(ts.add_sma(bars(spark, sf))))))


@query("equity_curve", f"""
    WITH RECURSIVE {CROSS_FOLD}
    SELECT symbol, ts, round(CASE WHEN rn = (SELECT max(rn) FROM ends WHERE ends.symbol = fold.symbol) THEN cash + qty * p ELSE cash END, 4) AS cash,
           round(cash + qty * p, 4) AS equity FROM fold""")
def equity_curve(spark, sf):
    """Balance and marked value on every bar; the last one closes the account."""
    curve = backtest.marked_curve(_crossover_run(spark, sf, marks=True))
    return curve.select("symbol", "ts", F.round("cash", 4).alias("cash"), F.round("equity", 4).alias("equity"))


MIXED_FOLD = f"{BARS}, {SMA_SQL}, {REGIME_SQL}, places(symbol, places, held) AS (VALUES ('click', 6, 1e9), ('view', 2, 3.0), ('purchase', 0, 1e9), ('signup', 2, 0.0)), " + \
    fold_sql("regime", "edge > 0 AND signal = 1", fall=0.05, per_symbol=True)


@query("trade_log_mixed_assets", f"""
    WITH RECURSIVE {MIXED_FOLD}
    SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY rn, kind) AS INTEGER) AS seq, action, ts, price, qty, note FROM moves""")
def trade_log_mixed_assets(spark, sf):
    """Decimal places and the held quantity differ by symbol in one run: some sales are refused."""
    facts = spark.createDataFrame([("click", 6, 1e9), ("view", 2, 3.0), ("purchase", 0, 1e9), ("signup", 2, 0.0)], "symbol string, qty_places int, held_qty double")
    rows = ts.add_edge(ts.add_regime(ts.add_sma(bars(spark, sf)))).join(facts, "symbol", "left")
    return backtest.trade_log(backtest.simulate(rows, backtest.TradeRules(entry_mode="crossover", halt_row=True, max_drawdown=0.05)))


# ---- sizing, time, streaming --------------------------------------------------------------------------------------

@query("position_sizing", """
    SELECT event_id, asset_type, qty, CASE WHEN asset_type = 'crypto' THEN qty ELSE trunc(qty) END AS order_qty
    FROM (SELECT event_id, asset_type, CASE WHEN asset_type = 'crypto' THEN CAST(round(raw, 6) AS DOUBLE) ELSE CAST(round(raw, 2) AS DOUBLE) END AS qty
      FROM (SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'crypto' ELSE 'stock' END AS asset_type,
                   CAST(CAST(CAST(10000 AS DOUBLE) * 0.02 / value AS VARCHAR) AS DECIMAL(38, 18)) AS raw
            FROM (SELECT * REPLACE (CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value) FROM events)))""")
def position_sizing(spark, sf):
    kind = F.when(F.col("event_type").isin("click", "view"), "crypto").otherwise("stock")
    """Every ninth price is zero, which sizes to null."""
    priced = table(spark, sf, "events").withColumn("value", F.when(F.col("event_id") % 9 == 0, 0.0).otherwise(F.col("value")))
    sized = priced.select(
        "event_id", kind.alias("asset_type"), ts.position_size(F.lit(10000.0), 0.02, F.col("value"), kind).alias("qty")
    )
    return sized.withColumn("order_qty", ts.order_quantity(F.col("qty"), F.col("asset_type")))


@query("local_time_format", """
    SELECT event_id, strftime(timezone('America/Chicago', timezone('UTC', ts)), '%Y-%m-%d %I:%M %p') || ' ' ||
           CASE WHEN timezone('America/Chicago', timezone('UTC', ts)) - ts = INTERVAL '-6 hours' THEN 'CST' ELSE 'CDT' END AS local_time
    FROM events""")
def local_time_format(spark, sf):
    return table(spark, sf, "events").select("event_id", scalars.local_time_text(F.col("ts")).alias("local_time"))


@query("previous_day_slice", """
    SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'""")
def previous_day_slice(spark, sf):
    return tables.previous_day(table(spark, sf, "events").select("event_id", "ts"), datetime(2024, 1, 15, 7, 30))


@query("previous_midnight", "SELECT event_id, date_trunc('day', ts) - INTERVAL 1 DAY AS run_date FROM events")
def previous_midnight(spark, sf):
    return table(spark, sf, "events").select("event_id", scalars.previous_midnight(F.col("ts")).alias("run_date"))


TICKERS = [
    {"data": "click", "order": "CLICKUSD", "type": "crypto"},
    {"data": "view", "order": "VIEWUSD", "type": "crypto"},
    {"data": "purchase", "order": "PURCH", "type": "stock"},
    {"data": "signup", "order": "SIGN", "type": "stock"},
]


@query("symbol_map_join", f"""
    WITH {BARS}, m(symbol, order_symbol, asset_type) AS (VALUES {", ".join(f"('{t['data']}', '{t['order']}', '{t['type']}')" for t in TICKERS)})
    SELECT symbol, ts, close, order_symbol, asset_type FROM bars JOIN m USING (symbol)""")
def symbol_map_join(spark, sf):
    return relational.map_symbols(bars(spark, sf).select("symbol", "ts", "close"), relational.ticker_list(spark, TICKERS))


@query("stream_hourly_bars", f"""
    WITH {BARS} SELECT * FROM bars WHERE ts + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_hourly_bars(spark, sf):
    """The hourly bars as a stream over the event file: every bar that the watermark has closed."""
    events = table(spark, sf, "events")
    source = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = source.select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), "event_id")
    out = scratch_path(spark, "live-bars")
    live.start_bars(live.stream_bars(rows, tiebreak="event_id"), f"{out}/data", f"{out}/state").awaitTermination()
    return spark.read.parquet(f"{out}/data").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("indicators_with_nan_closes", f"""
    WITH {BARS.replace("bars AS", "all_bars AS")}, bars AS (SELECT symbol, ts, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY ts) % 40 <> 7 THEN close END AS close FROM all_bars),
    {SMA_SQL}, {RSI_SQL},
    p AS (SELECT symbol, ts, max(close) OVER (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING) AS peak FROM bars)
    SELECT sma.symbol, sma.ts, round(sma20, 4) AS sma20, round(sma50, 4) AS sma50, round(rsi, 6) AS rsi, peak, round((peak - close) / peak, 6) AS drawdown, (peak - close) / peak > 0.15 AS breach
    FROM sma JOIN rsi ON rsi.symbol = sma.symbol AND rsi.ts = sma.ts JOIN p ON p.symbol = sma.symbol AND p.ts = sma.ts""")
def indicators_with_nan_closes(spark, sf):
    """Every fortieth close is NaN: it counts as missing and poisons nothing after it."""
    holes = bars(spark, sf).withColumn("close", F.when(F.row_number().over(ts.series_window()) % 40 == 7, F.lit(float("nan"))).otherwise(F.col("close")))
    out = ts.running_drawdown(ts.add_rsi(ts.add_sma(holes)))
    return out.select("symbol", "ts", F.round("sma20", 4).alias("sma20"), F.round("sma50", 4).alias("sma50"), F.round("rsi", 6).alias("rsi"), "peak", F.round("drawdown", 6).alias("drawdown"), "breach")


@query("tick_ema_in_blocks", """
    WITH RECURSIVE t AS (SELECT event_id, event_type AS symbol, value AS x, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
    e AS (
      SELECT event_id, symbol, rn, x AS short, x AS long FROM t WHERE rn = 1
      UNION ALL
      SELECT t.event_id, t.symbol, t.rn, 2.0/27 * t.x + 25.0/27 * e.short, 2.0/20001 * t.x + 19999.0/20001 * e.long FROM e JOIN t ON t.symbol = e.symbol AND t.rn = e.rn + 1)
    SELECT event_id, symbol, round(short, 6) AS short, round(long, 6) AS long FROM e""")
def tick_ema_in_blocks(spark, sf):
    """Means of spans 26 and 20,000 over raw ticks: one affine map per block, applied in order."""
    means = blocks.ema_in_blocks(ticks(spark, sf), "symbol", ["ts", "event_id"], {"short": 26, "long": 20_000})
    return means.select("event_id", "symbol", F.round("short", 6).alias("short"), F.round("long", 6).alias("long"))


SIGNAL_SQL = "CASE WHEN rn <= 20 THEN 0 WHEN sma20 > sma50 THEN 1 ELSE -1 END"


@query("stored_bar_signals", f"""
    WITH {BARS}, {SMA_SQL}, g AS (SELECT *, {SIGNAL_SQL} AS signal FROM sma)
    SELECT symbol, ts, round(sma20, 4) AS sma20, signal, signal - lag(signal) OVER (PARTITION BY symbol ORDER BY ts) AS edge FROM g""")
def stored_bar_signals(spark, sf):
    """Signals on bars kept in buckets by symbol: no shuffle after the store is written."""
    name = f"check_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    store_bars(bars(spark, sf), f"{name}.bars", 8)
    out = ts.add_edge(ts.add_regime(ts.add_sma(spark.table(f"{name}.bars"))))
    return out.select("symbol", "ts", F.round("sma20", 4).alias("sma20"), "signal", "edge")


@query("stream_signals", f"""
    WITH {BARS}, {SMA_SQL}, g AS (SELECT *, {SIGNAL_SQL} AS signal FROM sma)
    SELECT symbol, ts, round(sma50, 4) AS sma50, signal, signal - lag(signal) OVER (PARTITION BY symbol ORDER BY ts) AS edge FROM g""")
def stream_signals(spark, sf):
    """Signals of arriving bars: the earlier half is taken in, the query ends, and a new one goes on from the checkpoint with the rest."""
    out, whole = scratch_path(spark, "live-signals"), bars(spark, sf).select("symbol", F.col("ts").cast("timestamp").alias("ts"), "close")
    middle = whole.agg(F.expr("timestamp_micros(bigint((unix_micros(min(ts)) + unix_micros(max(ts))) / 2))").alias("m"))
    for side in (F.col("ts") <= middle.scalar(), F.col("ts") > middle.scalar()):
        whole.filter(side).write.mode("append").parquet(f"{out}/bars")
        arriving = spark.readStream.schema(whole.schema).parquet(f"{out}/bars")
        live.start_bars(signals.stream_signals(arriving), f"{out}/data", f"{out}/state").awaitTermination()
    told = spark.read.parquet(f"{out}/data")
    return told.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), F.round("sma50", 4).alias("sma50"), "signal", "edge")
