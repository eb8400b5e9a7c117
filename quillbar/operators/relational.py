"""Group sums, top-k, lookups, semi and anti joins, word counts, pair sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbar.functions.text import words


# ---- aggregates ---------------------------------------------------------------------------------------------------

def sum_by(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def top_totals(df: DataFrame, where: Column, key: str, value: str, n: int = 20, out: str = "total") -> DataFrame:
    """Filter, sum by key, the ``n`` largest sums. Equal sums are ordered by key, so the result is fixed."""
    sums = df.filter(where).groupBy(key).agg(F.sum(value).alias(out))
    return sums.orderBy(F.col(out).desc(), key).limit(n)


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences of each blank-separated word. Counts are combined before the shuffle, so frequent words are cheap."""
    return df.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def distinct_pairs(df: DataFrame, key: str, pairs: Column) -> DataFrame:
    """The distinct ``{a, b}`` pairs of each row's pair array."""
    return df.select(key, F.explode(F.array_distinct(pairs)).alias("_p")).select(key, "_p.a", "_p.b")


# ---- lookups ------------------------------------------------------------------------------------------------------

def ticker_list(spark, tickers: Sequence[dict]) -> DataFrame:
    """The declared ticker map (data symbol, order symbol, asset type) as a DataFrame. Read long maps from a table instead."""
    return spark.createDataFrame(
        [(t["data"], t["order"], t["type"]) for t in tickers], "symbol string, order_symbol string, asset_type string"
    )


def map_symbols(df: DataFrame, tickers: DataFrame) -> DataFrame:
    """Order symbol and asset type by data symbol, for a ticker map of any length: Spark broadcasts a small one by its bytes."""
    return df.join(tickers, "symbol")


def every_ticker(tickers: DataFrame, summary: DataFrame, missing: str = "NO DATA") -> DataFrame:
    """One row per requested symbol; those without a summary are marked. Spark picks the join by size."""
    return tickers.join(summary, "symbol", "left").withColumn("signal", F.coalesce("signal", F.lit(missing)))


def _covered(positions: DataFrame) -> DataFrame:
    """One row per symbol: a holding with enough quantity exists exactly when the largest one is enough."""
    return positions.groupBy(F.col("symbol").alias("_held")).agg(F.max("qty").alias("_most"))


def sellable(trades: DataFrame, positions: DataFrame) -> DataFrame:
    """Trades whose symbol is held with at least the wanted quantity."""
    held = _covered(positions)
    return trades.join(held, (F.col("symbol") == F.col("_held")) & (F.col("_most") >= F.col("qty")), "left_semi")


def blocked(trades: DataFrame, positions: DataFrame) -> DataFrame:
    """The complement of ``sellable``."""
    held = _covered(positions)
    return trades.join(held, (F.col("symbol") == F.col("_held")) & (F.col("_most") >= F.col("qty")), "left_anti")


# ---- pairs that add up --------------------------------------------------------------------------------------------

def pair_sums(df: DataFrame, group: str, pos: str, value: str, target) -> DataFrame:
    """Per group, about positions i < j with value[i] + value[j] = target:

    ``n_pairs``; ``first_i``, the lowest position in any pair; ``next_j`` and ``last_j``, its first and last partner.
    Groups without a pair are left out.

    A value and its counterpart share the smaller of the two as key, so both sides of a pair meet in one aggregate that
    is combined on the map side; nothing is joined. Pairs are counted, not listed, so many equal values stay cheap. Only
    rows whose value is half the target are read a second time, since their partner is the next row of the same value.
    Values are whole numbers or decimals.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).alias("v"), F.col(pos).alias("p"))
    want, v, p = F.lit(target) - F.col("v"), F.col("v"), F.col("p")
    small, large = v <= want, v > want
    sides = rows.groupBy("g", F.least(v, want).alias("c")).agg(
        *[f(F.when(cond, p)).alias(f"{name}_{side}") for side, cond in (("a", small), ("b", large))
          for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    )
    twin = F.col("c") * 2 == F.lit(target)
    pairs = F.when(twin, F.col("n_a") * (F.col("n_a") - 1) / 2).otherwise(F.col("n_a") * F.col("n_b")).cast("bigint")

    def first(i: str, other: str) -> Column:
        return F.struct(F.col(f"lo_{i}").alias("i"), F.col(f"lo_{other}").alias("next"), F.col(f"hi_{other}").alias("last"))

    earliest = F.when(twin, first("a", "a")).when(F.col("lo_a") < F.col("lo_b"), first("a", "b")).otherwise(first("b", "a"))
    found = sides.select("g", pairs.alias("n"), earliest.alias("f")).filter("n > 0").groupBy("g").agg(
        F.sum("n").alias("n_pairs"), F.min("f").alias("f")
    )

    # Where the partner has the same value, its first position is i itself; take the next one.
    twins = found.filter("f.i = f.next").select(F.col("g").alias("tg"), "f.i")
    second = (
        rows.filter(F.col("v") * 2 == F.lit(target))
        .join(twins, (F.col("g") == F.col("tg")) & (F.col("p") > F.col("i")))
        .groupBy("tg")
        .agg(F.min("p").alias("second"))
    )
    return found.join(second, F.col("g") == F.col("tg"), "left").select(
        F.col("g").alias(group),
        "n_pairs",
        F.col("f.i").alias("first_i"),
        F.when(F.col("f.i") == F.col("f.next"), F.col("second")).otherwise(F.col("f.next")).alias("next_j"),
        F.col("f.last").alias("last_j"),
    )


# ---- ordering -----------------------------------------------------------------------------------------------------

def newest(df: DataFrame, ts: str, tiebreak: str, n: int = 10) -> DataFrame:
    """The ``n`` newest rows, whatever their status."""
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(tiebreak).desc()).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
