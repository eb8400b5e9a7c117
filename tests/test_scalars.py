"""Column helpers on single values, and the synthetic catalog."""

import datetime as dt

from pyspark.sql import functions as F

from quillbar.functions import scalars, text
from quillbar.operators import timeseries as ts
from quillbar.session import scratch_path
from quillbar.sources import synthetic


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def ntz(value):
    return F.lit(value).cast("timestamp_ntz")


def test_local_time_knows_both_zone_names(spark):
    row = one(
        spark,
        summer=scalars.local_time_text(ntz("2024-07-01 12:00:00")),
        winter=scalars.local_time_text(ntz("2024-01-01 05:59:59")),
        before=scalars.local_time_text(ntz("2024-03-10 07:59:00")),
        after=scalars.local_time_text(ntz("2024-03-10 08:00:00")),
    )
    assert row.summer == "2024-07-01 07:00 AM CDT" and row.winter == "2023-12-31 11:59 PM CST"
    assert row.before == "2024-03-10 01:59 AM CST" and row.after == "2024-03-10 03:00 AM CDT"


def test_local_time_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert one(spark, x=scalars.local_time_text(ntz("2024-07-01 12:00:00"))).x == "2024-07-01 07:00 AM CDT"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bars_ignore_the_session_zone(spark):
    # Wall-clock ticks inside an hour that the session zone skips.
    rows = [("A", dt.datetime(2024, 3, 10, 2, m), float(m), m) for m in (50, 10, 30)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, price double, event_id bigint")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
        bar = ts.resample(df, "1 day", tiebreak="event_id").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (bar.open, bar.close, bar.volume) == (10.0, 50.0, 3)


def test_bars_of_instants_keep_their_order_when_clocks_go_back(spark):
    # 01:40 twice on the session's clock; the later instant has the earlier wall-clock time.
    df = spark.createDataFrame([("A", 1730615940, 1.0, 2), ("A", 1730619000, 2.0, 1)], "symbol string, s bigint, price double, event_id bigint")
    ticks = df.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
        bar = ts.resample(ticks, "1 day", tiebreak="event_id").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (bar.open, bar.close, bar.volume) == (1.0, 2.0, 2)


def test_timestamps_as_text(spark):
    row = one(
        spark, some=scalars.timestamp_text(ntz("2024-05-06 07:08:09")), none=scalars.timestamp_text(F.lit(None).cast("timestamp")),
        parsed=scalars.parse_timestamp(F.lit("2024-05-06 07:08:09")).cast("timestamp_ntz"), bad=scalars.parse_timestamp(F.lit("soon")),
        shaped=scalars.parse_timestamp(F.lit("06/05/2024"), "dd/MM/yyyy").cast("date"),
    )
    assert row.some == "2024-05-06 07:08:09" and row.none == "-"
    assert row.parsed == dt.datetime(2024, 5, 6, 7, 8, 9) and row.bad is None and row.shaped == dt.date(2024, 5, 6)


def test_arrays(spark):
    row = one(
        spark, even=scalars.even_only(F.array(*map(F.lit, [1, 2, 3, 4, 5, 8]))),
        pairs=scalars.zip_shortest(F.array(*map(F.lit, [2, 3, 4])), F.array(*map(F.lit, ["a", "b"]))),
        words=text.words(F.lit(" a\tb\r\n c\x0b\x0c ")), blank=text.words(F.lit("  ")),
    )
    assert row.even == [2, 4, 8] and [tuple(p) for p in row.pairs] == [(2, "a"), (3, "b")]
    assert row.words == ["a", "b", "c"] and row.blank == []


def test_rounding_and_sizes(spark):
    row = one(
        spark, tie=scalars.money(F.lit(0.125)), binary=scalars.money(F.lit(2.675)),
        coin=ts.position_size(F.lit(1000.0), 0.02, F.lit(3.0), F.lit("crypto")),
        share=ts.position_size(F.lit(1000.0), 0.02, F.lit(3.0), F.lit("stock")),
        whole=ts.order_quantity(F.lit(6.67), F.lit("stock")), part=ts.order_quantity(F.lit(6.67), F.lit("crypto")),
        up=scalars.gain_or_loss(F.lit(0.0)), down=scalars.gain_or_loss(F.lit(-0.01)),
    )
    assert (row.tie, row.binary) == (0.13, 2.68) and (row.coin, row.share) == (6.666667, 6.67)
    assert (row.whole, row.part) == (6.0, 6.67) and (row.up, row.down) == ("gain", "loss")


def test_json_types(spark):
    row = one(spark, x=scalars.parse_json(F.lit('{"a": 30, "b": "30"}'), "a bigint, b bigint"))
    assert row.x.a == 30 and row.x.b is None


def test_printable_strips_wide_blanks_first(spark):
    row = one(spark, a=text.clean_printable(F.lit("  \x1c a☃ b ☃　\n")), b=text.clean_printable(F.lit(" \n ")))
    assert row.a == "a b " and row.b == ""


def test_synthetic_catalog_is_repeatable(spark):
    ids = spark.range(400)
    books = {r["_id"]: r for r in synthetic.synthetic_catalog(ids, "id").collect()}
    again = {r["_id"]: r for r in synthetic.synthetic_catalog(ids.repartition(7), "id").collect()}
    assert books == again and set(books) == {f"bk{101 + i}" for i in range(400)}
    reviews = [len(b.reviewers.reviewer) for b in books.values()]
    assert set(reviews) == set(range(6)) and {len(b.onemorecolumn.col1) for b in books.values()} == set(range(5))
    comments = [r.comment for b in books.values() for r in b.reviewers.reviewer]
    special = sum(c.endswith(synthetic.SPECIAL) for c in comments) / len(comments)
    assert 0.05 < special < 0.15 and all("&" not in c for c in comments)
    assert all(7.99 <= b.price <= 99.99 and "'" not in b.author.name.last for b in books.values())


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))
