"""Views of the test tables that several queries start from, and the matching SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbar.operators import flatten, timeseries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, the SQL that gives the same rows."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- ticks and bars -----------------------------------------------------------------------------------------------

def ticks(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col(symbol).cast("string").alias("symbol"), "ts", F.col("value").alias("price"), "event_id"
    )


def bars(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    """Hourly bars. Five long series by event type, or many short ones by user."""
    return timeseries.resample(ticks(spark, sf_dir, symbol), "1 hour", tiebreak="event_id")


def bars_sql(symbol: str = "event_type") -> str:
    return f"""bars AS (
      SELECT CAST({symbol} AS VARCHAR) AS symbol, date_trunc('hour', ts) AS ts,
             first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
             last(value ORDER BY ts, event_id) AS close, count(*) AS volume
      FROM events GROUP BY 1, 2)"""


SMA_SQL = """sma AS (
      SELECT *,
        CASE WHEN count(close) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20
             THEN avg(close) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END AS sma20,
        CASE WHEN count(close) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 50
             THEN avg(close) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) END AS sma50,
        row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn
      FROM bars)"""

RSI_SQL = """step AS (
      SELECT symbol, ts, close - lag(close) OVER (PARTITION BY symbol ORDER BY ts) AS d,
             row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM bars),
    sides AS (SELECT symbol, ts, rn, CASE WHEN d > 0 THEN d ELSE 0 END AS up, CASE WHEN d < 0 THEN -d ELSE 0 END AS down FROM step),
    means AS (
      SELECT symbol, ts,
        CASE WHEN rn >= 14 THEN avg(up) OVER w END AS g, CASE WHEN rn >= 14 THEN avg(down) OVER w END AS l
      FROM sides WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
    rsi AS (
      SELECT symbol, ts, CASE WHEN l = 0 AND g > 0 THEN 100.0 WHEN l = 0 THEN NULL ELSE 100 - 100 / (1 + g / l) END AS rsi
      FROM means)"""

MACD_SQL = """numbered AS (SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM bars),
    ema AS (
      SELECT symbol, rn, ts, close AS e12, close AS e26, CAST(0 AS DOUBLE) AS sig FROM numbered WHERE rn = 1
      UNION ALL
      SELECT n.symbol, n.rn, n.ts,
             2.0/13 * n.close + 11.0/13 * e.e12,
             2.0/27 * n.close + 25.0/27 * e.e26,
             0.2 * ((2.0/13 * n.close + 11.0/13 * e.e12) - (2.0/27 * n.close + 25.0/27 * e.e26)) + 0.8 * e.sig
      FROM ema e JOIN numbered n ON n.symbol = e.symbol AND n.rn = e.rn + 1),
    macd AS (SELECT symbol, ts, rn, e12, e26, e12 - e26 AS macd, sig AS macd_signal FROM ema)"""


# ---- order documents ----------------------------------------------------------------------------------------------

ITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]
ITEM_ORDER_SQL = ", ".join(ITEM_ORDER)


MAX_ITEMS = 1000


def order_notes() -> Column:
    """Order remarks with blanks at the ends, special characters and, now and then, a line break."""
    k = F.col("o_orderkey")
    return (
        F.when(k % 10 == 0, F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ★ shipped ☂ ")))
        .when(k % 10 == 1, F.concat(F.col("o_orderpriority"), F.lit(" late\nvisé")))
        .otherwise(F.col("o_orderpriority"))
    )


ORDER_NOTES_SQL = """CASE WHEN o_orderkey % 10 = 0 THEN '  ' || o_orderpriority || ' ★ shipped ☂ '
          WHEN o_orderkey % 10 = 1 THEN o_orderpriority || ' late' || chr(10) || 'visé' ELSE o_orderpriority END"""


def order_documents(spark: SparkSession, sf_dir: str, notes: Column | None = None) -> DataFrame:
    """One nested document per order: id, customer, items and notes; orders without items have no ``items``.

    ``_part`` counts the documents of an order with very many items.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", (order_notes() if notes is None else notes).alias("notes")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # The narrow join first, so that the arrays are shuffled once only.
    parents = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name", "notes")
    documents = flatten.nest_under(
        parents, "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey", ITEM_ORDER,
        {"product": F.concat(F.lit("part-"), F.col("l_partkey")), "qty": F.col("l_quantity").cast("bigint")}, MAX_ITEMS,
    )
    return documents.select(
        F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("id"),
        F.struct(F.col("c_name").alias("name"), F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email")).alias("customer"),
        F.when(F.col("item").isNotNull(), F.struct("item")).alias("items"),
        "notes",
        F.col("part").alias("_part"),
    )


ORDER_SCHEMA = "id string, customer struct<name string, email string>, items struct<item array<struct<product string, qty bigint>>>, notes string, _part int"


# ---- text documents -----------------------------------------------------------------------------------------------

def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as nested rows: a struct in a struct, sibling arrays, some of them null or empty.

    Built per row from the row's own text, so nothing is gathered.
    """
    n = F.col("n_chars")
    lines = F.transform(
        F.split("text", "\n", -1), lambda t: F.struct(t.alias("body"), F.length(t).cast("bigint").alias("width"))
    )
    tags = F.when(n % 7 == 0, F.lit(None)).when(n % 5 == 0, F.array().cast("array<string>")).otherwise(F.array("lang", "source"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.struct("lang", F.struct("source", "n_chars").alias("size")).alias("meta"),
        tags.alias("tags"),
        F.when(n % 11 != 0, lines).alias("lines"),
    )


TEXT_DOCUMENTS_SQL = """docs AS (
      SELECT doc_id, lang, source, n_chars,
        CASE WHEN n_chars % 7 = 0 THEN NULL WHEN n_chars % 5 = 0 THEN CAST([] AS VARCHAR[]) ELSE [lang, source] END AS tags,
        CASE WHEN n_chars % 11 <> 0 THEN string_split(text, chr(10)) END AS lines
      FROM documents)"""
