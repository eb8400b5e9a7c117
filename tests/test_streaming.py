"""A stream gives what the batch gives."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quillbar.operators import timeseries as ts
from quillbar.plans.registry import FieldRule, TableSpec
from quillbar.streaming import bars as live, ingest

START = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, ts timestamp_ntz, price double, event_id bigint"


def tick(i, minutes, symbol="A"):
    return (symbol, START + dt.timedelta(minutes=minutes), float(i % 17), i)


def test_stream_bars_equal_batch_on_closed_windows(spark, tmp_path):
    src = str(tmp_path / "src")
    for part in range(3):
        rows = [tick(i, i * 7, "AB"[i % 2]) for i in range(part * 100, part * 100 + 100)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    live.start_bars(live.stream_bars(stream, tiebreak="event_id"), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).withColumn("ts", F.col("ts").cast("timestamp_ntz")).collect()}
    batch = ts.resample(spark.read.parquet(src), "1 hour", tiebreak="event_id").collect()
    closed = START + dt.timedelta(minutes=299 * 7 - 10)
    assert got == {tuple(r) for r in batch if r.ts + dt.timedelta(hours=1) <= closed}
    assert got


def test_late_ticks_are_dropped(spark, tmp_path):
    src = str(tmp_path / "src")
    for n, rows in enumerate([[tick(1, 0), tick(2, 300)], [tick(3, 1), tick(4, 400)], [tick(5, 900)]]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        live.start_bars(live.stream_bars(stream, tiebreak="event_id"), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    first = spark.read.parquet(str(tmp_path / "o")).filter(F.col("ts") == F.lit(START).cast("timestamp")).collect()
    assert [r.volume for r in first] == [1]


SPEC = TableSpec("d", "t", (FieldRule("name", "STRING", True), FieldRule("age", "INTEGER", True)))


def put(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records) + "\n")


def test_ingest_resumes_and_splits(spark, tmp_path):
    src, good, bad, state = tmp_path / "in", str(tmp_path / "g"), str(tmp_path / "b"), str(tmp_path / "c")

    def run():
        ingest.start_ingest(ingest.read_records(spark, str(src)), SPEC, good, bad, state).awaitTermination()

    put(src, "1.json", [{"name": "a", "age": 1}, {"name": "b", "age": "x"}])
    run()
    put(src, "2.json", [{"name": "c", "age": 3}, {"age": 4}])
    run()
    run()
    assert {(r.name, r.age) for r in spark.read.parquet(good).collect()} == {("a", 1), ("c", 3)}
    refused = spark.read.parquet(bad).collect()
    assert sorted(e.field for r in refused for e in r.errors) == ["age", "name"]
    assert {json.loads(r.record).get("age") for r in refused} == {"x", 4}


def test_ingest_atomic_batches(spark, tmp_path):
    src, good, bad = tmp_path / "in", str(tmp_path / "g"), str(tmp_path / "b")
    put(src, "1.json", [{"name": "a", "age": 1}, {"name": "b", "age": "x"}])
    ingest.start_ingest(ingest.read_records(spark, str(src)), SPEC, good, bad, str(tmp_path / "c"), atomic=True).awaitTermination()
    assert spark.read.parquet(good).isEmpty() and spark.read.parquet(bad).count() == 2


def test_retried_batch_leaves_no_duplicates(spark, tmp_path):
    import shutil

    src, good, bad, state = tmp_path / "in", str(tmp_path / "g"), str(tmp_path / "b"), tmp_path / "c"
    put(src, "1.json", [{"name": "a", "age": 1}])
    for _ in range(2):
        ingest.start_ingest(ingest.read_records(spark, str(src)), SPEC, good, bad, str(state)).awaitTermination()
        commits = state / "commits"
        state2 = tmp_path / "c2"
        if not state2.exists():
            shutil.copytree(state, state2, ignore=shutil.ignore_patterns("commits"))
            state = state2
    assert spark.read.parquet(good).count() == 1


def test_signals_go_on_after_a_restart(spark, tmp_path):
    """The stream, stopped in the middle, gives what the whole series gives at once."""
    import random

    from quillbar.operators import timeseries as ts
    from quillbar.streaming.bars import start_bars
    from quillbar.streaming.signals import stream_signals

    rng = random.Random(6)
    rows = [(s, i * 3600, None if i % 23 == 5 else float("nan") if i % 37 == 9 else 100 + 20 * rng.random() + (i // 40 % 2) * 15) for s in ("a", "b") for i in range(170)]
    bars = spark.createDataFrame(rows, "symbol string, at bigint, close double").selectExpr("symbol", "timestamp_seconds(at) AS ts", "close")
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for part in ("at < 200000", "at >= 200000 AND at < 201000", "at >= 201000", "at = 3600"):
        bars.withColumn("at", F.unix_timestamp("ts")).filter(part).drop("at").repartition(3).write.mode("append").parquet(source)
        stream = stream_signals(spark.readStream.schema(bars.schema).parquet(source))
        start_bars(stream, out, state).awaitTermination()
    batch = ts.add_multifactor(ts.add_edge(ts.add_regime(ts.add_indicators(bars))), "multifactor")
    names = ["sma20", "sma50", "rsi", "macd", "macd_signal", "signal", "edge", "multifactor"]
    want = {(r.symbol, r.ts): [r[n] for n in names] for r in batch.collect()}
    got = {(r.symbol, r.ts): [r[n] for n in names] for r in spark.read.parquet(out).collect()}
    assert got.keys() == want.keys() and spark.read.parquet(out).count() == len(rows)
    for at, values in want.items():
        for a, b in zip(got[at], values):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9), (at, got[at], values)
    last = {r.symbol: r.signal for r in ts.latest_crossover(bars).collect()}
    assert last == {r.symbol: r.action for r in spark.read.parquet(out).filter(F.col("ts") == F.timestamp_seconds(F.lit(169 * 3600))).collect()}
