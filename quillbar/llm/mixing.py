"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbar.llm.common import WORD, Scratch, whole
from quillbar.operators.skew import join_list

# Buckets of the rank score in [0, 1). Only the bucket in which a source's sample ends is ordered row by row.
RANK_BUCKETS = 4096


def word_size(text: str = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: list[float], share: float, stop: float) -> DataFrame:
    """Targets per source: (``source``, ``source_size``, ``target``).

    ``sizes`` has ``source`` and ``size`` per document. Sources in code point order, null last, get the weights in turn and
    share ``share`` times all sizes. No target exceeds ``stop`` times the source's size; what is over goes to the others by
    weight. Sorting the sources by cap / weight, the capped ones are a prefix, so that running sums give the level at
    which the rest is filled. One row per source passes the windows, never one per document.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.select("*", weight.alias("w")).select("*", (F.col("source_size") * float(stop)).alias("cap"))
    filled = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = filled.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = F.try_divide(
        F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
    )
    per = per.select("*", level.alias("level")).select("*", (F.col("w") * F.col("level") >= F.col("cap")).alias("full"))
    last = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), F.col("source").isNull(), "source", "level"))).over(everything)
    return per.select(
        "source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * last["level"]).alias("target"))


def _uniform(identity: list[Column], seed: str) -> Column:
    """A number in (0, 1) from the first 13 hex digits of an MD5; the same on every run."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in identity]
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *parts).cast("binary")), 1, 13), 16, 10).cast("double")
    return (digits + 0.5) / float(2**52)


def by_length(size: Column) -> Column:
    """An appetite for longer documents: 1 below 50 words, 2 below 500, else 3."""
    return F.when(size >= 500, 3.0).when(size >= 50, 2.0).otherwise(1.0)


def _rates(narrow: DataFrame, sources: DataFrame, stop: int) -> DataFrame:
    """``_s, _per``: the factor on the appetite at which a source's expected copies, ``stop`` at most for each document, make up its target.

    By falling appetite, documents at ``stop`` are a prefix, so running sums over the levels of the appetite give the factor. One
    row per source and level passes the windows.
    """
    levels = narrow.groupBy("source", "_x").agg(F.sum("size").alias("s"))
    same = F.col("source").eqNullSafe(F.col("_t"))
    levels = levels.join(sources.select(F.col("source").alias("_t"), "target", "source_size"), same).drop("_t")
    whole = Window.partitionBy("source")
    above = whole.orderBy(F.col("_x").desc()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum(F.col("s") * F.col("_x")).over(whole) - F.coalesce(F.sum(F.col("s") * F.col("_x")).over(above), F.lit(0.0))
    rate = F.try_divide(F.col("target") - float(stop) * F.coalesce(F.sum("s").over(above), F.lit(0)), left)
    rated = levels.select("source", "source_size", "_x", rate.alias("rate"))
    found = F.max_by("rate", F.when(F.col("rate") * F.col("_x") < stop, F.col("_x")))
    # Every document at ``stop``: any large factor.
    per = F.when(F.max("source_size") == 0, 0.0).otherwise(F.coalesce(F.when(F.min(F.col("rate") * F.col("_x")) < stop, found), F.lit(1e300)))
    return rated.groupBy("source").agg(per.alias("_per")).withColumnRenamed("source", "_s")


def mix(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5, stop: int = 2, text: str = "text",
        appetite: Column | None = None, seed: str = "mix") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (size times copies).

    A document expects copies in proportion to its ``appetite`` (positive, of few different values, such as ``by_length``; it may use the
    column ``size``), at most ``stop``, and so many that a source's expected words are its target; without an appetite all documents
    of a source expect the same. The whole part is certain. The fraction p is an inclusion probability: documents are ranked by
    (u / (1 - u)) / (p / (1 - p)) with u from an MD5 of ``doc_id``, and the sample is the head of that order whose words
    come nearest to what the certain copies leave of the target. The end of the sample is found from sums per rank bucket
    and then inside one bucket, so no source is ever sorted whole, and each row is decided on its own against its
    source's cut.

    Null text: size 0. Null source: a source of its own. Rows with equal ``doc_id`` and text rank equal and are taken alike;
    with distinct texts the text breaks the tie. Empty input: empty result. Columns of ``docs`` that share a name with a new
    column are replaced.
    """
    made = ["size", "source_size", "target", "copies", "taken"]
    own = [c for c in docs.columns if c not in made]
    base = docs.select(*own, word_size(text).alias("size")).select("*", (F.lit(1.0) if appetite is None else appetite.cast("double")).alias("_x"))
    key = [_uniform([F.col("doc_id")], seed).alias("_u"), F.xxhash64(whole(text)).alias("_tie")]
    narrow = Scratch(docs.sparkSession, "mixing").save(base.select("source", "size", "_x", *key), "sizes")
    sources = source_targets(narrow, list(weights), share, stop)
    rates = _rates(narrow, sources, stop)
    sources = sources.join(rates, F.col("source").eqNullSafe(F.col("_s")), "left").select(F.col("source").alias("_source"), "source_size", "target", "_per")

    def ranked(rows: DataFrame) -> DataFrame:
        expected = F.least(F.lit(float(stop)), F.coalesce(F.col("_per") * F.col("_x"), F.lit(0.0)))
        odds = F.col("_u") / (1 - F.col("_u"))
        rows = rows.select("*", F.floor(expected).alias("_sure"), (expected - F.floor(expected)).alias("_p"))
        q = F.when(F.col("_sure") >= stop, None).when(F.col("_p") > 0, odds * (1 - F.col("_p")) / F.col("_p")).otherwise(F.lit(1e300) * F.col("_u"))
        return rows.select("*", q.alias("_q")).select(
            "*", F.least(F.lit(RANK_BUCKETS - 1), F.floor(F.col("_q") / (1 + F.col("_q")) * RANK_BUCKETS)).alias("_bucket"))

    same = lambda column: F.col(column).eqNullSafe(F.col("_source"))
    rows = ranked(join_list(narrow, sources, same("source"), "left"))
    sums = rows.groupBy("_source", "_bucket").agg(
        F.sum(F.col("size") * F.col("_sure")).alias("_certain"), F.sum("size").alias("_words"), F.first("target").alias("target"))
    running = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "*", (F.col("target") - F.sum("_certain").over(Window.partitionBy("_source"))).alias("_rest"),
        F.sum(F.when(F.col("_bucket").isNotNull(), F.col("_words")).otherwise(0)).over(running).alias("_before"))
    ends = (
        sums.filter(F.col("_bucket").isNotNull()).select("*", F.coalesce("_before", F.lit(0)).alias("_start"))
        .filter((F.col("_start") < F.col("_rest")) & (F.col("_start") + F.col("_words") >= F.col("_rest")))
        .select(F.col("_source").alias("_es"), F.col("_bucket").alias("_eb"), (F.col("_rest") - F.col("_start")).alias("_left"))
    )
    order = Window.partitionBy("source").orderBy("_q", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    edge = join_list(rows, ends, F.col("source").eqNullSafe(F.col("_es")) & (F.col("_bucket") == F.col("_eb")), "inner")
    edge = edge.select("source", "_q", "_tie", "size", "_left", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("_done"))
    inside = edge.filter(F.col("_done") + F.col("size") / 2 < F.col("_left"))
    cuts = inside.groupBy("source").agg(F.max(F.struct("_q", "_tie")).alias("_cut"))
    full = (
        sums.groupBy("_source").agg(F.max("_rest").alias("_rest"), F.sum(F.when(F.col("_bucket").isNotNull(), F.col("_words"))).alias("_all"))
    )
    bounds = (
        sources.join(full.withColumnRenamed("_source", "_f"), same("_f"), "left")
        .join(cuts.withColumnRenamed("source", "_c"), same("_c"), "left")
        .join(ends.select("_es", "_eb"), same("_es"), "left")
        .select("_source", "source_size", "target", "_per", "_cut", "_eb", (F.col("_all") < F.col("_rest")).alias("_everything"))
    )
    decided = ranked(join_list(base.select("*", *key), bounds, same("source"), "left"))
    extra = (
        F.when(F.col("_q").isNull() | (F.col("size") == 0), 0).when(F.col("_everything"), 1).when(F.col("_eb").isNull(), 0)
        .when(F.col("_bucket") < F.col("_eb"), 1).when(F.struct("_q", "_tie") <= F.col("_cut"), 1).otherwise(0)
    )
    copies = (F.col("_sure") + extra).cast("int")
    return decided.select(*own, "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
