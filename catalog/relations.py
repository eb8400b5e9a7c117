"""Sums, top lists, lookups, pair sums and account tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import query, table
from quillbar.functions import scalars
from quillbar.operators import relational


@query("sum_by_year_name", """
    SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, n_name AS name, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS sum_value
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def sum_by_year_name(spark, sf):
    """Orders are summed per customer and year first, so a customer with very many orders joins as a few rows."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.year("o_orderdate").cast("string").alias("year"), F.col("o_totalprice").cast("decimal(18,2)").alias("value")
    )
    per_customer = relational.sum_by(orders, ["o_custkey", "year"], "value", "value")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    rows = per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return relational.sum_by(rows, ["year", "name"], "value", "sum_value").withColumn("sum_value", F.col("sum_value").cast("double"))


@query("top20_names", """
    SELECT c_name AS name, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE c_mktsegment = 'BUILDING' GROUP BY c_name ORDER BY total DESC, name LIMIT 20""")
def top20_names(spark, sf):
    """Twenty customers of one market segment with the largest order totals, in cents; summed per customer before the join."""
    orders = table(spark, sf, "orders").select("o_custkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("number"))
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), "c_mktsegment")
    rows = relational.sum_by(orders, ["o_custkey"], "number", "number").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return relational.top_totals(rows, F.col("c_mktsegment") == "BUILDING", "name", "number", 20)


@query("array_even_filter", """
    SELECT p_partkey, CAST(to_json(list_filter([p_size, p_size + 1, p_size * 3, p_partkey], lambda x: x % 2 = 0)) AS VARCHAR) AS evens FROM part""")
def array_even_filter(spark, sf):
    size, key = F.col("p_size").cast("bigint"), F.col("p_partkey").cast("bigint")
    evens = scalars.even_only(F.array(size, size + 1, size * 3, key))
    return table(spark, sf, "part").select("p_partkey", F.to_json(evens).alias("evens"))


WANTED = """w AS (SELECT event_id, user_id AS symbol, value AS qty FROM events WHERE event_type = 'purchase'),
    h AS (SELECT user_id AS symbol, value AS qty FROM events WHERE event_type = 'view')"""


def _wanted(spark, sf):
    """Purchases are the sales somebody wants to make, views the holdings."""
    events = table(spark, sf, "events")
    wanted = events.filter("event_type = 'purchase'").select("event_id", F.col("user_id").alias("symbol"), F.col("value").alias("qty"))
    held = events.filter("event_type = 'view'").select(F.col("user_id").alias("symbol"), F.col("value").alias("qty"))
    return wanted, held


@query("sellable_semi_join", f"WITH {WANTED} SELECT * FROM w WHERE EXISTS (SELECT 1 FROM h WHERE h.symbol = w.symbol AND h.qty >= w.qty)")
def sellable_semi_join(spark, sf):
    return relational.sellable(*_wanted(spark, sf))


@query("blocked_anti_join", f"WITH {WANTED} SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.symbol = w.symbol AND h.qty >= w.qty)")
def blocked_anti_join(spark, sf):
    return relational.blocked(*_wanted(spark, sf))


@query("pair_sum_self_join", """
    WITH r AS (SELECT user_id AS g, event_id AS p, CAST(json_extract(props, '$.k') AS BIGINT) AS v FROM events),
    pairs AS (SELECT a.g, a.p AS i, b.p AS j FROM r a JOIN r b ON a.g = b.g AND b.v = 100 - a.v AND a.p < b.p)
    SELECT g AS user_id, count(*) AS n_pairs, min(i) AS first_i, arg_min(j, (i, j)) AS next_j, arg_min(j, (i, -j)) AS last_j
    FROM pairs GROUP BY g""")
def pair_sum_self_join(spark, sf):
    """Per user, the event pairs whose ``k`` values add up to 100."""
    rows = table(spark, sf, "events").select("user_id", "event_id", scalars.parse_json(F.col("props"), "k bigint")["k"].alias("k"))
    return relational.pair_sums(rows, "user_id", "event_id", "k", 100)


@query("recent_orders", """
    SELECT o_orderkey, o_orderstatus AS status, coalesce(strftime(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S'), '-') AS submitted_at
    FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""")
def recent_orders(spark, sf):
    """The ten newest orders of any status; a missing time shows as a dash."""
    newest = relational.newest(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"), "o_orderdate", "o_orderkey")
    shown = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate"))
    return newest.select("o_orderkey", F.col("o_orderstatus").alias("status"), scalars.timestamp_text(shown).alias("submitted_at"))


@query("pnl_sign", "SELECT c_custkey, CASE WHEN c_acctbal - 5000 >= 0 THEN 'gain' ELSE 'loss' END AS outcome FROM customer")
def pnl_sign(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", scalars.gain_or_loss(F.col("c_acctbal") - 5000).alias("outcome"))


@query("json_props_parse", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_parse(spark, sf):
    return table(spark, sf, "events").select("event_id", scalars.parse_json(F.col("props"), "k bigint")["k"].alias("k"))
