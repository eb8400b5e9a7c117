"""Indicators against pandas, the fold against a plain loop, blocks against whole series."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillbar.operators import backtest, blocks, timeseries as ts
from quillbar.plans.bars import load_bars
from quillbar.plans.signal_report import summarize
from quillbar.sources import tables

START = dt.datetime(2024, 1, 1)


def frame(spark, series):
    rows = [(s, START + dt.timedelta(hours=i), float(p)) for s, prices in series.items() for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, close double")


def walk(n, seed, scale=2.0):
    rnd = random.Random(seed)
    p, out = 100.0, []
    for _ in range(n):
        p = max(1.0, p + rnd.uniform(-scale, scale))
        out.append(round(p, 2))
    return out


def expected(prices):
    c = pd.Series(prices)
    d = c.diff()
    gain, loss = d.where(d > 0, 0), -d.where(d < 0, 0)
    rs = gain.rolling(14).mean() / loss.rolling(14).mean()
    macd = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    return pd.DataFrame({
        "sma20": c.rolling(20).mean(), "sma50": c.rolling(50).mean(), "rsi": 100 - 100 / (1 + rs), "macd": macd,
        "macd_signal": macd.ewm(span=9, adjust=False).mean(),
    })


def close_to(got, want, tol=1e-9):
    for column in want.columns:
        for g, w in zip(got[column], want[column]):
            assert (pd.isna(g) and pd.isna(w)) or math.isclose(g, w, rel_tol=tol, abs_tol=tol), (column, g, w)


@pytest.mark.parametrize("n", [1, 13, 14, 60, 700, 1700])
def test_indicators_match_pandas(spark, n):
    prices = walk(n, n)
    got = ts.add_indicators(frame(spark, {"A": prices, "B": walk(30, 1)})).filter("symbol = 'A'").toPandas().sort_values("ts")
    close_to(got, expected(prices))


def test_sma_null_prefix_and_null_values(spark):
    df = frame(spark, {"A": walk(60, 3)}).withColumn("close", F.when(F.hour("ts") != 5, F.col("close")))
    got = ts.add_sma(df, (7, 20)).toPandas().sort_values("ts")
    want = got["close"].rolling(7).mean()
    close_to(got[["sma7"]], pd.DataFrame({"sma7": want.to_numpy()}))
    whole = ts.add_sma(frame(spark, {"A": walk(60, 3)}), (7, 20)).toPandas().sort_values("ts")
    assert whole["sma7"].isna().sum() == 6 and whole["sma20"].isna().sum() == 19


def test_rsi_edges(spark):
    got = ts.add_rsi(frame(spark, {"flat": [5] * 20, "up": range(1, 21), "down": range(20, 0, -1)})).toPandas()
    last = got.sort_values("ts").groupby("symbol").last()["rsi"]
    rsi = got.sort_values("ts").groupby("symbol")["rsi"]
    assert rsi.get_group("flat").isna().all()
    assert last["up"] == 100 and abs(last["down"]) < 1e-9
    assert rsi.get_group("up").isna().sum() == 13


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(1, 1000, allow_nan=False), min_size=1, max_size=120), st.sampled_from([1, 2, 5, 9, 26, 200]))
def test_ema_matches_pandas(spark, prices, span):
    got = ts.add_ema(frame(spark, {"A": prices}), {"e": span}).toPandas().sort_values("ts")
    want = pd.Series(prices).ewm(span=span, adjust=False).mean()
    assert all(math.isclose(g, w, rel_tol=1e-9) for g, w in zip(got["e"], want))


def test_ema_with_rates_far_apart(spark):
    prices = walk(900, 8)
    got = ts.add_ema(frame(spark, {"A": prices}), {"fast": 2, "slow": 400}).toPandas().sort_values("ts")
    for name, span in (("fast", 2), ("slow", 400)):
        want = pd.Series(prices).ewm(span=span, adjust=False).mean()
        assert all(math.isclose(g, w, rel_tol=1e-9) for g, w in zip(got[name], want))


def test_blocks_equal_whole_series(spark):
    df = frame(spark, {"HOT": walk(3000, 5), "B": walk(40, 6), "C": walk(1, 7)})
    whole = ts.add_indicators(df).toPandas().sort_values(["symbol", "ts"]).reset_index(drop=True)
    cut = blocks.in_blocks(df, "symbol", ["ts"], lambda d, by, o: ts.add_indicators(d, by, o), 800, ts.INDICATOR_HALO)
    cut = cut.toPandas().sort_values(["symbol", "ts"]).reset_index(drop=True)
    assert len(cut) == len(whole)
    close_to(cut, whole[["sma20", "sma50", "rsi", "macd", "macd_signal"]])
    assert (cut.groupby("symbol")["row_index"].apply(lambda s: list(s) == list(range(1, len(s) + 1)))).all()


def test_halo_must_fit(spark):
    with pytest.raises(ValueError):
        blocks.with_halo(frame(spark, {"A": [1]}).withColumn("row_index", F.lit(1)), 10, 11)


def test_running_max_in_slices(spark):
    df = frame(spark, {"HOT": walk(500, 11), "B": walk(30, 12)})
    got = blocks.running_max(df, "symbol", ["ts"], "close", "peak").toPandas().sort_values(["symbol", "ts"])
    assert (got.groupby("symbol")["close"].cummax() == got["peak"]).all()


def test_resample_ties_and_window_bounds(spark):
    rows = [("A", START, 5.0, 2), ("A", START, 1.0, 1), ("A", START + dt.timedelta(minutes=59), 7.0, 3), ("A", START + dt.timedelta(hours=1), 9.0, 4)]
    bars = ts.resample(spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, price double, event_id bigint"), "1 hour", tiebreak="event_id")
    assert sorted(tuple(r) for r in bars.collect()) == [
        ("A", START, 1.0, 7.0, 1.0, 7.0, 3), ("A", START + dt.timedelta(hours=1), 9.0, 9.0, 9.0, 9.0, 1)]


def test_resample_keeps_the_hash_path(spark):
    df = spark.range(10).selectExpr("'A' AS symbol", "timestamp_ntz'2024-01-01' AS ts", "1D AS price", "id AS event_id")
    plan = ts.resample(df, "1 hour", tiebreak="event_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_indicators_need_one_shuffle(spark):
    df = frame(spark, {"A": walk(30, 1)})
    plan = ts.add_regime(ts.add_indicators(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_regime_and_literal_entry(spark):
    rows = ts.add_edge(ts.add_regime(ts.add_sma(frame(spark, {"A": walk(400, 2, 5.0)}))))
    found = {r.edge for r in rows.select("edge").distinct().collect()}
    assert found <= {None, -2, -1, 0, 2}
    stats = backtest.trade_stats(backtest.simulate(rows)).first()
    assert (stats.trades, stats.final_balance) == (0, 100000.0)


def loop(prices, signals, r):
    """The rules bar by bar."""
    cash = peak = r.initial_balance
    qty = stop = target = 0.0
    log = []
    for i in range(1, len(prices)):
        p, edge = prices[i], signals[i] - signals[i - 1]
        worth = cash + qty * p
        peak = max(peak, worth)
        if (peak - worth) / peak > r.max_drawdown:
            if r.halt_row:
                log.append(("HALT", i, None, None))
            break
        enter = edge == 1 if r.entry_mode == "edge_eq_1" else edge > 0 and signals[i] == 1
        if enter and qty == 0:
            stake = (cash if r.sizing_cash is None else r.sizing_cash) * r.risk_per_trade
            size = stake / p
            size = size if r.qty_places is None else round(size, r.qty_places)
            if size > 0:
                cash -= stake
                qty, stop, target = size, p * (1 - r.stop_loss), p * (1 + r.take_profit)
                log.append(("BUY", i, p, qty))
        if qty > 0 and r.can_sell and (p <= stop or p >= target or edge == -1):
            cash += qty * p
            log.append(("SELL", i, p, qty))
            qty = 0.0
    if qty > 0 and r.can_sell:
        cash += qty * prices[-1]
        log.append(("FINAL SELL", len(prices) - 1, prices[-1], qty))
    return cash, log


RULES = [
    backtest.TradeRules(),
    backtest.TradeRules(entry_mode="crossover", halt_row=True, take_profit=0.06),
    backtest.TradeRules(entry_mode="crossover", risk_per_trade=1.0, max_drawdown=0.02, halt_row=True),
    backtest.TradeRules(entry_mode="crossover", risk_per_trade=0.9, max_drawdown=0.05),
    backtest.TradeRules(initial_balance=500.0, qty_places=2, entry_mode="crossover"),
    backtest.TradeRules(sizing_cash=2000.0, qty_places=6, entry_mode="crossover"),
    backtest.TradeRules(can_sell=False, entry_mode="crossover"),
]


@pytest.mark.parametrize("rules", RULES)
@pytest.mark.parametrize("batch", [7, 10_000])
def test_fold_matches_loop(spark, rules, batch):
    rnd = random.Random(4)
    series = {f"S{i}": walk(rnd.randint(1, 160), i, 6.0) for i in range(12)}
    signals = {s: [rnd.choice([-1, 0, 0, 1]) for _ in p] for s, p in series.items()}
    rows = [(s, START + dt.timedelta(hours=i), p, signals[s][i], signals[s][i] - signals[s][i - 1] if i else None)
            for s, prices in series.items() for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, close double, signal int, edge int").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        out = backtest.simulate(df, rules).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for s, prices in series.items():
        cash, log = loop(prices, signals[s], rules)
        mine = out[out["symbol"] == s].sort_values("seq")
        assert list(mine["seq"]) == list(range(1, len(log) + 2))
        got = [(a, int((t - START).total_seconds() // 3600), None if pd.isna(p) else p, None if pd.isna(q) else q)
               for a, t, p, q in zip(mine["action"], mine["ts"], mine["price"], mine["qty"])][:-1]
        assert [g[:2] for g in got] == [w[:2] for w in log]
        assert all(g[3] is w[3] or math.isclose(g[3], w[3]) for g, w in zip(got, log))
        assert mine["action"].iloc[-1] == "END" and math.isclose(mine["balance"].iloc[-1], cash)


def test_equity_curve_ends_at_the_balance(spark):
    rows = ts.add_edge(ts.add_regime(ts.add_sma(frame(spark, {"A": walk(400, 21, 4.0), "B": walk(300, 22, 4.0)}))))
    run = backtest.simulate(rows, backtest.TradeRules(entry_mode="crossover"))
    last = tables.latest_n(backtest.equity_curve(rows, backtest.trade_log(run)), 1)
    want = {r.symbol: r.final_balance for r in backtest.final_balance(run).collect()}
    for r in last.collect():
        assert math.isclose(r.equity, want[r.symbol], rel_tol=1e-9) and abs(r.qty) < 1e-9


def test_the_fold_marks_every_bar(spark):
    """The curve of the fold equals the one rebuilt from the log, over several batches per symbol, and is read from one scan."""
    rows = ts.add_edge(ts.add_regime(ts.add_sma(frame(spark, {"A": walk(400, 21, 4.0), "B": walk(300, 22, 4.0), "C": [5.0]}))))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for rules in (backtest.TradeRules(entry_mode="crossover"), backtest.TradeRules(entry_mode="crossover", max_drawdown=0.002, halt_row=True)):
            run = backtest.simulate(rows, rules, marks=True)
            plain = backtest.simulate(rows, rules)
            want = {(r.symbol, r.ts): r for r in backtest.equity_curve(rows, backtest.trade_log(plain)).collect()}
            got = backtest.marked_curve(run).collect()
            assert len(got) == len(want) == 701
            for r in got:
                w = want[r.symbol, r.ts]
                assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6) for a, b in ((r.cash, w.cash), (r.qty, w.qty), (r.equity, w.equity)))
            assert sorted(backtest.trade_log(run).collect(), key=str) == sorted(backtest.trade_log(plain).collect(), key=str)
            assert sorted(backtest.trade_stats(run).collect()) == sorted(backtest.trade_stats(plain).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    plan = backtest.marked_curve(run)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "Join" not in plan


def test_latest_crossover_and_summary(spark):
    up = [100.0] * 59 + [1.0] * 0
    cross = [100 - 0.01 * i for i in range(79)] + [200.0]
    df = frame(spark, {"UP": cross, "SHORT": [1.0] * 55, "FLAT": up + [100.0], "TINY": [1.0] * 5})
    got = {r.symbol: r.signal for r in ts.latest_crossover(df).collect()}
    assert got == {"UP": "BUY", "SHORT": "HOLD", "FLAT": "HOLD", "TINY": "HOLD"}
    wanted = spark.createDataFrame([(s,) for s in ("UP", "SHORT", "FLAT", "GONE")], "symbol string")
    rows = {r.symbol: r for r in summarize(df, wanted).collect()}
    assert rows["UP"].signal == "BUY" and rows["UP"].stop_loss == 194.0 and rows["UP"].take_profit == 212.0
    assert rows["FLAT"].signal == "HOLD" and rows["FLAT"].stop_loss is None and rows["FLAT"].entry == 100.0
    assert rows["SHORT"].signal == rows["GONE"].signal == "NO DATA"


def test_load_bars(spark):
    rows = [(s, START + dt.timedelta(hours=i), float(i), i) for s in "AB" for i in range(100)]
    raw = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, price double, event_id bigint")
    got = load_bars(raw, "2 hours", "1 day", ["A"], tiebreak="event_id").collect()
    assert {r.symbol for r in got} == {"A"} and len(got) == 13
    assert sorted((r.open, r.close) for r in got)[-1] == (98.0, 99.0)
    assert load_bars(raw, "2 hours", tiebreak="event_id").count() == 100


def test_drawdown_breach(spark):
    df = ts.running_drawdown(frame(spark, {"A": [100, 120, 110, 100, 130], "B": [10, 11, 12]}))
    first = {r.symbol: r.first_breach for r in ts.first_breach(df).collect()}
    assert first == {"A": START + dt.timedelta(hours=3), "B": None}


def test_lookback_reaches_the_scan(spark, out):
    frame(spark, {"A": walk(300, 1)}).write.parquet(out)
    df = tables.lookback(spark.read.parquet(out), "10 hours")
    assert df.count() == 11
    assert "DataFilters: [isnotnull(ts" in df._jdf.queryExecution().executedPlan().toString()
    assert tables.lookback(spark.read.parquet(out), "1 day", grid="1 day").count() == 24 + 300 % 24


def test_previous_day_is_pushed_down(spark, out):
    frame(spark, {"A": walk(100, 1)}).write.parquet(out)
    df = tables.previous_day(spark.read.parquet(out), dt.datetime(2024, 1, 3, 9, 30))
    assert df.count() == 24
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in df._jdf.queryExecution().executedPlan().toString()


GAPS = st.lists(st.one_of(st.none(), st.floats(1, 100)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(GAPS, st.integers(1, 4))
def test_means_pass_over_missing_values(spark, closes, span):
    """As pandas on the values that are there, carried across the gaps; the chunk edges fall on and beside gaps."""
    import pandas as pd

    closes = closes * 20
    rows = [("a", i, c) for i, c in enumerate(closes)]
    df = spark.createDataFrame(rows, "symbol string, ts int, close double")
    got = [(r.e, r.macd, r.macd_signal) for r in ts.add_macd(ts.add_ema(df, {"e": span}), fast=2, slow=3, signal=2).orderBy("ts").collect()]
    there = pd.Series(closes, dtype=float).dropna()
    mean = lambda s, n: s.ewm(span=n, adjust=False).mean()
    macd = mean(there, 2) - mean(there, 3)
    want = [s.reindex(range(len(closes))).ffill() for s in (mean(there, span), macd, mean(macd, 2))]
    for i, row in enumerate(got):
        for g, w in zip(row, (s[i] for s in want)):
            assert (g is None) == bool(pd.isna(w)) and (g is None or abs(g - w) < 1e-8 * max(1, abs(w)) + 1e-9)


def test_missing_ties_and_prices(spark):
    rows = [(1, None, 1.0), (1, 2, 5.0), (2, None, 9.0), (2, -5, 7.0), (3, 3, float("nan")), (3, 4, None)]
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 0, s), t, p) for s, t, p in rows], "symbol string, ts timestamp_ntz, id bigint, price double")
    bar = ts.resample(df, "1 hour", tiebreak="id").first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (1.0, 9.0, 1.0, 7.0, 6)


def test_zeros_give_null_and_no_entry(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, -1.0), ("a", 3, 0.0)], "symbol string, ts int, close double")
    assert {(r.drawdown, r.breach) for r in ts.running_drawdown(df).collect()} == {(None, None)}
    sizes = df.select(ts.position_size(F.lit(100.0), 0.1, F.col("close"), F.lit("stock")).alias("q")).collect()
    assert {r.q for r in sizes} == {None, -10.0}
    days = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    bars = spark.createDataFrame([("a", d, c, 1, 1) for d, c in zip(days, (1.0, 0.0, None, 2.0, 2.0))], "symbol string, ts timestamp_ntz, close double, signal int, edge int")
    log = backtest.trade_log(backtest.simulate(bars)).collect()
    assert [(r.action, r.price) for r in log] == [("BUY", 2.0), ("FINAL SELL", 2.0)]


# ---- missing values and long spans --------------------------------------------------------------------------------

def test_nan_counts_as_missing(spark):
    import math
    import random

    rng = random.Random(5)
    closes = [None if i % 9 == 4 else 50 + rng.random() * 9 for i in range(160)]
    closes[0] = None
    frame = lambda xs: spark.createDataFrame([("s", i, x, "stock") for i, x in enumerate(xs)], "symbol string, ts int, close double, kind string")
    nulls, nans = frame(closes), frame([math.nan if x is None else x for x in closes])

    def everything(df):
        out = ts.running_drawdown(ts.add_ema(ts.add_indicators(df), {"e1": 1, "e5": 5}))
        out = out.withColumn("diff", ts.step("close", ts.series_window())).withColumn("size", ts.position_size(F.lit(1e5), 0.02, F.col("close"), F.col("kind")))
        return [str(r) for r in ts.entry_levels(out.withColumn("signal", F.lit("BUY")), price="close").drop("close").orderBy("ts").collect()]

    assert everything(nans) == everything(nulls)
    assert not any("nan" in r for r in everything(nans))
    last = [ts.latest_crossover(df).drop("price").collect() for df in (nulls, nans)]
    assert last[0] == last[1]
    peaks = [str(blocks.running_max(df, "symbol", ["ts"], "close", "peak").select("ts", "peak").orderBy("ts").collect()) for df in (nulls, nans)]
    assert peaks[0] == peaks[1] and "nan" not in peaks[0]


@pytest.mark.parametrize("block_rows", [16_384, 37])
def test_ema_in_blocks_is_the_recurrence(spark, block_rows):
    import random

    rng = random.Random(3)
    series = {"a": 3000, "b": 1, None: 90, "gap": 200}
    rows = [(k, i, None if k == "gap" and (i < 70 or i % 3) else float("nan") if i % 17 == 3 else 100 * rng.random()) for k, n in series.items() for i in range(n)]
    spans = {"e1": 1, "e2": 2, "e26": 26, "e20000": 20_000}
    want = {}
    for k in series:
        y = dict.fromkeys(spans)
        for key, i, x in rows:
            if key == k:
                if x is not None and x == x:
                    y = {n: x if y[n] is None else 2 / (s + 1) * x + (1 - 2 / (s + 1)) * y[n] for n, s in spans.items()}
                want[(k, i)] = tuple(y.values())
    df = spark.createDataFrame(rows, "symbol string, ts int, price double").repartition(5)
    got = {(r.symbol, r.ts): tuple(r[n] for n in spans) for r in blocks.ema_in_blocks(df, "symbol", ["ts"], spans, block_rows=block_rows).collect()}
    assert got.keys() == want.keys()
    for at, values in want.items():
        assert got[at] == pytest.approx(values, rel=1e-12) if values[0] is not None else got[at] == values, at


def test_stored_bars_need_no_shuffle(spark):
    from quillbar.plans.bars import store_bars

    spark.sql("CREATE DATABASE IF NOT EXISTS bars_db")
    try:
        rows = spark.range(2000).selectExpr("concat('s', id % 7) AS symbol", "timestamp_seconds(id * 60) AS ts", "cast(id % 31 + id % 7 AS double) AS close")
        store_bars(rows, "bars_db.b", 4)
        made = lambda df: ts.add_edge(ts.add_regime(ts.add_indicators(df)))
        stored = made(spark.table("bars_db.b"))
        assert stored._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
        assert sorted(map(str, stored.collect())) == sorted(map(str, made(rows).collect()))
    finally:
        spark.sql("DROP DATABASE bars_db CASCADE")


def test_kept_sums_read_the_new_day_only(spark):
    from quillbar.plans import kept_sums
    from quillbar.sources import sinks

    spark.sql("CREATE DATABASE IF NOT EXISTS sums_db")
    try:
        rows = spark.range(900).selectExpr("date_add(DATE'2024-01-01', cast(id % 3 AS int)) AS day", "id % 11 AS k", "cast(id AS decimal(18,2)) AS v")
        sinks.load_day(rows, "sums_db.raw", "day")
        for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-02"):
            new = spark.table("sums_db.raw").filter(F.col("day") == F.lit(day).cast("date"))
            plan = new._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [isnotnull(day" in plan
            kept_sums.add_days(new, "sums_db.sums", "day", ["k"], {"v": "v"})
        got = {tuple(r) for r in kept_sums.totals(spark, "sums_db.sums", ["k"], ["v"]).collect()}
        assert got == {tuple(r) for r in rows.groupBy("k").agg(F.sum("v"), F.count("v"), F.min("v"), F.max("v"), F.count(F.lit(1))).collect()}
    finally:
        spark.sql("DROP DATABASE sums_db CASCADE")
