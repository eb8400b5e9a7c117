"""Indicators and signals of arriving bars, from a small state per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGNALS = ("symbol string, ts timestamp, close double, sma20 double, sma50 double, rsi double, macd double, macd_signal double, "
           "signal int, edge int, multifactor int, action string")


def stream_signals(bars: DataFrame, warmup: int = 20, minimum: int = 52) -> DataFrame:
    """One row per bar of the stream ``bars`` (symbol, ts, close): the columns of ``timeseries.add_indicators``, the regime ``signal`` and its
    ``edge``, the ``multifactor`` signal, and ``action``, BUY or SELL where sma20 crosses sma50 on this bar and the symbol has
    ``minimum`` bars, else HOLD. The same values as over the whole series at once.

    The state of a symbol is its last 51 closes, three means, the number of bars and the last signal; it is in the checkpoint, so a
    query that starts again goes on where it stood. The bars of a symbol must arrive in order, within a batch in any: a bar
    that is not later than the last one is passed over. A close that is null or NaN is missing, as in the batch functions.
    """

    def advance(key, parts, state):
        import json
        import math

        import pandas as pd

        s = json.loads(state.get[0]) if state.exists else {"n": 0, "at": None, "closes": [], "fast": None, "slow": None, "line": None, "signal": None}
        pdf = pd.concat(list(parts)).sort_values("ts", kind="stable")
        out = []

        def mean(values):
            return None if None in values else sum(values) / len(values)

        def sma(n, back=0):
            own = s["closes"][:len(s["closes"]) - back][-n:]
            return mean(own) if len(own) == n else None

        def rsi(n=14):
            if s["n"] < n:
                return None
            own = s["closes"][-n - 1:]
            steps = [b - a if a is not None and b is not None else 0.0 for a, b in zip(own, own[1:])]
            gain, loss = sum(x for x in steps if x > 0) / n, sum(-x for x in steps if x < 0) / n
            if loss == 0:
                return 100.0 if gain > 0 else None
            return 100 - 100 / (1 + gain / loss)

        def over(a, b):
            return a is not None and b is not None and a > b

        for ts, close in zip(pdf["ts"], pdf["close"]):
            if s["at"] is not None and ts.value <= s["at"]:
                continue
            x = None if close is None or math.isnan(close) else float(close)
            s["at"], s["n"] = ts.value, s["n"] + 1
            s["closes"] = [*s["closes"], x][-51:]
            if x is not None:
                first = s["fast"] is None
                s["fast"] = x if first else 2 / 13 * x + 11 / 13 * s["fast"]
                s["slow"] = x if first else 2 / 27 * x + 25 / 27 * s["slow"]
                macd = s["fast"] - s["slow"]
                s["line"] = macd if first else 0.2 * macd + 0.8 * s["line"]
            macd, line = None if s["fast"] is None else s["fast"] - s["slow"], s["line"]
            s20, s50, p20, p50, strength = sma(20), sma(50), sma(20, 1), sma(50, 1), rsi()
            signal = 0 if s["n"] <= warmup else 1 if over(s20, s50) else -1
            edge = None if s["signal"] is None else signal - s["signal"]
            s["signal"] = signal
            buy = over(s20, s50) and over(macd, line) and strength is not None and 30 < strength < 60
            sell = over(s50, s20) and over(line, macd) and strength is not None and strength > 60
            up, down = over(s20, s50) and over(p50, p20), over(s50, s20) and over(p20, p50)
            action = "HOLD" if s["n"] < minimum else "BUY" if up else "SELL" if down else "HOLD"
            out.append((key[0], ts, x, s20, s50, strength, macd, line, signal, edge, 1 if buy else -1 if sell else 0, action))
        state.update((json.dumps(s),))
        columns = ["symbol", "ts", "close", "sma20", "sma50", "rsi", "macd", "macd_signal", "signal", "edge", "multifactor", "action"]
        told = pd.DataFrame(out, columns=columns)
        yield told.astype({c: "float64" for c in columns[2:8]} | {"signal": "int32", "edge": "Int32", "multifactor": "int32"})

    rows = bars.select(F.col("symbol").cast("string").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("close").cast("double").alias("close"))
    return rows.groupBy("symbol").applyInPandasWithState(advance, SIGNALS, "data string", "append", "NoTimeout")
