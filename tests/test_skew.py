"""One key with a large share of the rows: whole results, and no task or group that holds them all."""

import itertools
import random

from pyspark.sql import functions as F

from quillbar.operators import blocks, flatten, relational, skew
from quillbar.operators import validate as v
from quillbar.sources import tables


def hot(spark, n=6000):
    """A third of all rows belongs to key 0."""
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))


def test_hot_document_continues_in_parts(spark):
    docs = flatten.nest_rows(hot(spark), "k", ["n"], {"n": "n"}, max_items=100)
    rows = sorted(docs.filter("k = 0").collect(), key=lambda r: r.part)
    assert [r.part for r in rows] == list(range(20)) and all(len(r.item) == 100 for r in rows)
    assert [e.n for r in rows for e in r.item] == list(range(0, 6000, 3))
    assert docs.filter("k <> 0").count() == 4000 and docs.select(F.sum(F.size("item"))).first()[0] == 6000


def test_index_by_range_splits_equal_rows(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") < 4000, 7).otherwise(F.col("id")).alias("v"))
    got = blocks.index_by_range(df, "k", ["v"])
    for k in (0, 1):
        rows = got.filter(F.col("k") == k).orderBy("row_index").collect()
        assert [r.row_index for r in rows] == list(range(1, 2501))
        assert [r.v for r in rows] == sorted(r.v for r in rows)


def test_hot_parent_meets_its_parts(spark):
    parents = spark.range(-3, 5).withColumnRenamed("id", "pk")
    for limit, parts in ((100, 20), (100_000, 1)):
        got = flatten.nest_under(parents, "pk", hot(spark), "k", ["n"], {"n": "n"}, max_items=limit).collect()
        of_hot = [r for r in got if r.pk == 0]
        assert len(of_hot) == parts and sorted(e.n for r in of_hot for e in r.item) == list(range(0, 6000, 3))
        rest = {r.pk: r.item and [e.n for e in r.item] for r in got if r.pk}
        assert rest == {-3: None, -2: None, -1: None, 1: [1], 2: [2], 3: None, 4: [4]}


def test_long_list_of_heavy_keys_is_not_broadcast(spark):
    df = spark.range(4000).select((F.col("id") % 40).alias("k"), F.col("id").alias("n"))
    parts = skew.heavy_parts(df, "k", 10, limit=5)
    assert parts.count() == 40 and {r._parts for r in parts.collect()} == {10}
    docs = flatten._gather(df, "k", ["n"], {"n": "n"}, parts, 10, "item", "part").collect()
    assert len(docs) == 400 and all(len(r.item) == 10 for r in docs)
    assert skew.heavy_parts(df, "k", 100) is None


def test_join_list_gives_the_same_rows_both_ways(spark):
    df, keys = hot(spark, 900), spark.range(0, 900, 2).withColumnRenamed("id", "k")
    small, large = skew.join_list(df, keys, "k", "left_semi"), skew.join_list(df, keys, "k", "left_semi", limit=10)
    assert sorted(small.collect()) == sorted(large.collect())
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_index_rows_in_slices(spark):
    got = blocks.index_rows(hot(spark, 3000), "k", ["n"], F.floor(F.col("n") / 100)).collect()
    of_hot = sorted((r.n, r.row_index) for r in got if r.k == 0)
    assert [i for _, i in of_hot] == list(range(1, 1001)) and len(got) == 3000
    assert all(r.row_index == 1 for r in got if r.k != 0)


def test_null_keys_stay(spark):
    df = hot(spark, 900).withColumn("k", F.when(F.col("k") != 0, F.col("k")))
    for got in (blocks.index_by_range(df, "k", ["n"]), blocks.index_rows(df, "k", ["n"], F.floor(F.col("n") / 100))):
        assert sorted(r.row_index for r in got.filter("k IS NULL").collect()) == list(range(1, 301)) and got.count() == 900
    peaks = blocks.running_max(df, "k", ["n"], "n", "peak")
    assert peaks.count() == 900 and peaks.filter("peak <> n").count() == 0
    docs = flatten.nest_rows(df, "k", ["n"], {"n": "n"}, max_items=20)
    assert docs.agg(F.max(F.size("item"))).first()[0] == 20 and docs.filter("k IS NULL").count() == 15


def test_one_instant_and_one_burst_stay_even(spark):
    """Three quarters of the rows at one instant, a burst beside it: every range holds its share."""
    instant = F.when(F.col("id") % 4 != 0, 7).when(F.col("id") < 40_000, 8 + F.col("id") % 10).otherwise(F.col("id"))
    df = spark.range(200_000).select(F.lit(1).alias("k"), instant.alias("ts"), F.col("id").alias("n"))
    got = blocks.index_by_range(df, "k", ["ts"])
    assert got.agg(F.countDistinct("row_index"), F.max("row_index")).first()[:] == (200_000, 200_000)
    sizes = [r["count"] for r in blocks._ranged(df, "k", ["ts"]).groupBy("_range").count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
    assert blocks.running_max(df, "k", ["ts", "n"], "n", "peak").filter("ts = 7").agg(F.max("peak")).first()[0] == 199_999


def test_latest_n_of_a_hot_key(spark):
    got = tables.latest_n(hot(spark), 5, "k", ["n"]).collect()
    assert sorted(r.n for r in got if r.k == 0) == [5985, 5988, 5991, 5994, 5997]
    assert len(got) == 4005


def brute(values, target):
    pairs = [(i, j) for i, j in itertools.combinations(range(len(values)), 2) if values[i] + values[j] == target]
    if not pairs:
        return None
    first = min(pairs)[0]
    partners = [j for i, j in pairs if i == first]
    return len(pairs), first, min(partners), max(partners)


def test_pair_sums_match_brute_force(spark):
    rnd = random.Random(9)
    groups = {g: [rnd.randint(0, 12) for _ in range(rnd.randint(1, 25))] for g in range(40)}
    groups[100] = [5] * 300
    groups[101] = [1, 2, 3]
    df = spark.createDataFrame([(g, i, x) for g, xs in groups.items() for i, x in enumerate(xs)], "g int, i int, x int")
    got = {r.g: (r.n_pairs, r.first_i, r.next_j, r.last_j) for r in relational.pair_sums(df, "g", "i", "x", 10).collect()}
    assert got == {g: b for g, xs in groups.items() if (b := brute(xs, 10))}
    assert got[100] == (300 * 299 // 2, 0, 1, 299)


def test_hot_batch_is_rejected_without_a_window(spark):
    df = hot(spark, 3000).select(F.col("k").alias("batch_id"), "n", F.when(F.col("n") == 1500, F.array(F.struct(F.lit("f").alias("field"), F.lit("m").alias("message"))))
                                 .otherwise(F.array().cast(v.NO_ERRORS)).alias("errors"))
    marked = v.mark_batches(df)
    assert marked.filter("NOT accepted").count() == 1000
    assert "Window" not in marked._jdf.queryExecution().executedPlan().toString()


def test_semi_and_anti_are_complements(spark):
    rnd = random.Random(3)
    trades = [(i, rnd.choice("ABCD"), rnd.uniform(0, 10)) for i in range(200)]
    held = [(rnd.choice("ABC"), rnd.uniform(0, 9)) for _ in range(30)]
    t = spark.createDataFrame(trades, "id int, symbol string, qty double")
    p = spark.createDataFrame(held, "symbol string, qty double")
    can = {r.id for r in relational.sellable(t, p).collect()}
    cannot = {r.id for r in relational.blocked(t, p).collect()}
    assert can == {i for i, s, q in trades if any(hs == s and hq >= q for hs, hq in held)}
    assert can | cannot == {i for i, _, _ in trades} and not can & cannot


def test_word_count_and_top(spark):
    df = spark.createDataFrame([("a b  a\nc",), ("",), ("b a ",)], "text string")
    assert {r.word: r.n for r in relational.word_count(df).collect()} == {"a": 3, "b": 2, "c": 1}
    names = spark.createDataFrame([("TX", n, x) for n, x in (("A", 2), ("B", 3), ("C", 3), ("A", 1))] + [("CA", "Z", 99)], "state string, name string, number long")
    top = relational.top_totals(names, F.col("state") == "TX", "name", "number", 2)
    assert [(r.name, r.total) for r in top.collect()] == [("A", 3), ("B", 3)]
    assert relational.preview(names, 2).count() == 2
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_long_ticker_lists_are_joined(spark):
    many = relational.ticker_list(spark, [{"data": str(i), "order": f"o{i}", "type": "stock"} for i in range(20_000)])
    got = relational.map_symbols(spark.range(0, 30_000, 3).select(F.col("id").cast("string").alias("symbol")), many)
    assert got.count() == 6667 and got.filter("order_symbol <> concat('o', symbol)").count() == 0
