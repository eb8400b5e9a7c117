"""The ordered fold over a series: entries, exits, halts and the balance.

Rows are hash-partitioned by symbol and sorted by Spark (spilling as needed); each task then streams them in Arrow
batches and carries a handful of numbers from batch to batch. No symbol is ever held as a whole, in the JVM or in
Python. Feed it bars: their number per symbol is bounded by the time grid, not by the tick volume.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_SCHEMA = "symbol string, seq int, action string, ts timestamp_ntz, price double, qty double, note string, balance double"


@dataclass(frozen=True)
class TradeRules:
    """``entry_mode``: ``edge_eq_1`` enters only when the signal's step is exactly 1, which a two-state signal (-1, 1)
    never shows; ``crossover`` enters when the signal rises to 1 from any lower value.

    ``halt_row`` logs a halt. ``qty_places`` rounds the quantity while the cash deduction stays unrounded.
    ``sizing_cash`` sizes every entry by a fixed account balance instead of the running one. ``can_sell=False`` models an
    account that refuses every sale. Columns ``qty_places`` and ``held_qty`` of the bars say both per symbol: decimal places, and
    what the account holds; a sale goes through only up to that quantity.
    """

    initial_balance: float = 100_000.0
    risk_per_trade: float = 0.02
    stop_loss: float = 0.03
    take_profit: float = 0.05
    max_drawdown: float = 0.15
    entry_mode: str = "edge_eq_1"
    halt_row: bool = False
    qty_places: int | None = None
    sizing_cash: float | None = None
    can_sell: bool = True

    def __post_init__(self):
        if self.entry_mode not in ("edge_eq_1", "crossover"):
            raise ValueError("entry_mode is 'edge_eq_1' or 'crossover'")


def simulate(bars: DataFrame, rules: TradeRules = TradeRules(), marks: bool = False) -> DataFrame:
    """All log rows plus one ``END`` row per symbol with the final balance.

    With ``marks`` also a ``BAR`` row per bar, without a number: its close, the quantity held after it, and the cash as balance; the
    last one comes after the final sale.

    ``bars`` has symbol, ts, close, signal and edge, and maybe qty_places and held_qty, constant per symbol; null falls back
    to the rules. The first bar of a symbol only starts it; per later bar: value the holding, raise the peak, halt on too deep
    a fall, else enter if flat, then exit if holding. Bars without a close are passed over, and a price of zero or less is
    never entered.
    """
    # Plain values only, so that the workers need no copy of this package.
    r = SimpleNamespace(**asdict(rules))

    def fold(batches):
        import numpy as np
        import pandas as pd

        columns = ["symbol", "seq", "action", "ts", "price", "qty", "note", "balance"]
        state = None

        def start(symbol, places, held):
            return {"symbol": symbol, "cash": r.initial_balance, "peak": r.initial_balance, "qty": 0.0, "stop": 0.0,
                    "target": 0.0, "halted": False, "seq": 0, "seen": 0, "ts": None, "price": None,
                    "places": r.qty_places if pd.isna(places) else int(places), "held": np.inf if pd.isna(held) else float(held)}

        def may_sell(s):
            return r.can_sell and s["held"] >= s["qty"]

        def log(out, s, action, ts, price=None, qty=None, note=None, balance=None):
            s["seq"] += 1
            out.append((s["symbol"], s["seq"], action, pd.Timestamp(ts), price, qty, note, balance))

        def sell(out, s, action, ts, price):
            s["cash"] += s["qty"] * price
            log(out, s, action, ts, price, s["qty"])
            s["qty"] = 0.0

        def finish(out, s):
            if s["qty"] > 0 and may_sell(s):
                sell(out, s, "FINAL SELL", s["ts"], s["price"])
            log(out, s, "END", s["ts"], balance=s["cash"])
            if marks:
                out.append((s["symbol"], None, "BAR", pd.Timestamp(s["ts"]), s["price"], s["qty"], None, s["cash"]))

        def mark(s, ts, price, steps):
            """The bars up to the last one, which waits for what follows; a step is (place, cash, quantity from there on)."""
            places = np.array([i for i, _, _ in steps])
            at = np.searchsorted(places, np.arange(len(price)), "right") - 1
            cash, qty = (np.array([step[k] for step in steps])[at] for k in (1, 2))
            if s["seen"] > 0:
                ts, price = np.append(s["ts"], ts), np.append(s["price"], price)
                cash, qty = np.append(s["marked"][0], cash), np.append(s["marked"][1], qty)
            s["marked"] = cash[-1], qty[-1]
            rows = pd.DataFrame({"symbol": s["symbol"], "ts": ts[:-1], "price": price[:-1], "qty": qty[:-1], "balance": cash[:-1]})
            return rows.assign(seq=None, action="BAR", note=None)[columns]

        def advance(out, s, ts, price, enter, leave):
            n = len(price)
            entries = np.flatnonzero(enter)
            steps = [(0, s["cash"], s["qty"])]
            i = 1 if s["seen"] == 0 else 0
            while i < n and not s["halted"]:
                p, here = float(price[i]), i
                worth = s["cash"] + (s["qty"] * p if s["qty"] > 0 else 0.0)
                s["peak"] = max(s["peak"], worth)
                if (s["peak"] - worth) / s["peak"] > r.max_drawdown:
                    s["halted"] = True
                    if r.halt_row:
                        log(out, s, "HALT", ts[i], note="Max drawdown reached. Trading halted.")
                    break
                if s["qty"] == 0 and enter[i] and p > 0:
                    stake = (s["cash"] if r.sizing_cash is None else r.sizing_cash) * r.risk_per_trade
                    qty = stake / p if s["places"] is None else round(stake / p, s["places"])
                    if qty > 0:
                        s.update(qty=qty, stop=p * (1 - r.stop_loss), target=p * (1 + r.take_profit))
                        s["cash"] -= stake
                        log(out, s, "BUY", ts[i], p, qty)
                if s["qty"] > 0 and may_sell(s) and (p <= s["stop"] or p >= s["target"] or leave[i]):
                    sell(out, s, "SELL", ts[i], p)
                    i += 1
                elif s["qty"] > 0:
                    i += 1
                else:
                    # Flat: worth and peak stand still, so the next row that can matter is the next entry.
                    at = np.searchsorted(entries, i + 1)
                    i = int(entries[at]) if at < len(entries) else n
                if marks and (s["cash"], s["qty"]) != steps[-1][1:]:
                    steps.append((here, s["cash"], s["qty"]))
            marked = mark(s, ts, price, steps) if marks else None
            s["seen"] += n
            s["ts"], s["price"] = ts[-1], float(price[-1])
            return marked

        for pdf in batches:
            if pdf.empty:
                continue
            out: list[tuple] = []
            symbols = pdf["symbol"].to_numpy()
            cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(symbols)]
            ts, price = pdf["ts"].to_numpy(), pdf["close"].to_numpy()
            enter, leave = pdf["enter"].to_numpy(), pdf["leave"].to_numpy()
            places, held = pdf["qty_places"].to_numpy(), pdf["held_qty"].to_numpy()
            for a, b in zip(bounds[:-1], bounds[1:]):
                if state is None or state["symbol"] != symbols[a]:
                    if state is not None:
                        finish(out, state)
                    state = start(symbols[a], places[a], held[a])
                marked = advance(out, state, ts[a:b], price[a:b], enter[a:b], leave[a:b])
                if marks and len(marked):
                    yield marked
            if out:
                yield pd.DataFrame(out, columns=columns)
        if state is not None:
            out = []
            finish(out, state)
            yield pd.DataFrame(out, columns=columns)

    rises = F.col("edge") == 1 if r.entry_mode == "edge_eq_1" else (F.col("edge") > 0) & (F.col("signal") == 1)
    rows = bars.select(
        F.col("symbol").cast("string").alias("symbol"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("close").cast("double").alias("close"),
        F.coalesce(rises, F.lit(False)).alias("enter"),
        F.coalesce(F.col("edge") == -1, F.lit(False)).alias("leave"),
        *[(F.col(c) if c in bars.columns else F.lit(None)).cast("double").alias(c) for c in ("qty_places", "held_qty")],
    ).filter(F.col("close").isNotNull() & ~F.isnan("close"))
    return rows.repartition("symbol").sortWithinPartitions("symbol", "ts").mapInPandas(fold, LOG_SCHEMA)


def trade_log(simulated: DataFrame) -> DataFrame:
    return simulated.filter("action NOT IN ('END', 'BAR')").drop("balance")


def final_balance(simulated: DataFrame) -> DataFrame:
    return simulated.filter("action = 'END'").select("symbol", F.col("balance").alias("final_balance"))


def trade_stats(simulated: DataFrame) -> DataFrame:
    """Number of log rows and final balance per symbol."""
    return simulated.groupBy("symbol").agg(
        F.count(F.when(~F.col("action").isin("END", "BAR"), 1)).alias("trades"),
        F.max(F.when(F.col("action") == "END", F.col("balance"))).alias("final_balance"),
    )


def marked_curve(simulated: DataFrame) -> DataFrame:
    """``symbol, ts, close, cash, qty, equity`` per bar, as the fold met them, from a run with ``marks``; holds for rounded quantities too."""
    rows = simulated.filter("action = 'BAR'").select("symbol", "ts", F.col("price").alias("close"), F.col("balance").alias("cash"), "qty")
    return rows.withColumn("equity", F.col("cash") + F.col("qty") * F.col("close"))


def equity_curve(bars: DataFrame, log: DataFrame, initial_balance: float = 100_000.0) -> DataFrame:
    """Cash plus the marked-to-market holding per bar, rebuilt from the log by running sums over bars.

    Valid for logs with unrounded quantities, where a buy costs exactly price times quantity.
    """
    from pyspark.sql import Window as W

    sign = F.when(F.col("action") == "BUY", 1).when(F.col("action").isin("SELL", "FINAL SELL"), -1)
    moves = log.filter("qty IS NOT NULL").groupBy("symbol", "ts").agg(
        F.sum(sign * F.col("qty")).alias("_dq"), F.sum(-sign * F.col("qty") * F.col("price")).alias("_dc")
    )
    so_far = W.partitionBy("symbol").orderBy("ts").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        bars.select("symbol", "ts", "close")
        .join(moves, ["symbol", "ts"], "left")
        .withColumn("cash", F.lit(initial_balance) + F.sum(F.coalesce("_dc", F.lit(0.0))).over(so_far))
        .withColumn("qty", F.sum(F.coalesce("_dq", F.lit(0.0))).over(so_far))
        .withColumn("equity", F.col("cash") + F.col("qty") * F.col("close"))
        .drop("_dc", "_dq")
    )
