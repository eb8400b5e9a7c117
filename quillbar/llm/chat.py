"""Collapse logged snapshots of the same conversation to the longest ones and render those. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOW = 0xFFFFFFFF
PARTS = ["a", "b", "c", "d"]


def _sums(columns: list[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def _order(block: int) -> tuple:
    return F.floor(F.coalesce("turn", F.lit(-1)) / block)


def numbered(turns: DataFrame, block: int = 256) -> DataFrame:
    """``conv_id, at, turn, role, text`` with ``at`` = 1, 2, ... by turn (null first), then role, then text.

    Equal rows are logged twice and count once. Turns are ranked inside blocks of ``block`` turn numbers and the counts of earlier
    blocks are added, so no task sorts a whole long conversation.
    """
    rows = turns.select("conv_id", "turn", "role", "text").distinct().select("*", _order(block).alias("_block"))
    counts = rows.groupBy("conv_id", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("conv_id").alias("_c"), F.col("_block").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("conv_id", "_block").orderBy("turn", "role", "text")
    ranked = rows.select("*", F.row_number().over(inside).alias("_at"))
    joined = ranked.join(counts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_block") == F.col("_b")))
    return joined.select("conv_id", (F.col("_before") + F.col("_at")).alias("at"), "turn", "role", "text", "_block")


def _turn_hashes() -> list[Column]:
    """Four 32-bit numbers per turn, from its place, role and text. Their sums over turns 1..t identify the prefix of length t:
    the place is part of the hash, so order matters, and sums can be combined in any order before and after a shuffle."""
    told = [F.col("at"), F.coalesce(F.col("role"), F.lit("\x00")), F.coalesce(F.col("text"), F.lit("\x00"))]
    out = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), *told)
        out += [h.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(h, 32)]
    return [c.alias(p) for c, p in zip(out, PARTS, strict=True)]


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id, at`` and the rolling sums over turns 1..at, for the rows of ``numbered``."""
    hashed = rows.select("conv_id", "_block", "at", *_turn_hashes())
    per = hashed.groupBy("conv_id", "_block").agg(*_sums(PARTS))
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("conv_id").alias("_pc"), F.col("_block").alias("_pb"), *[F.coalesce(F.sum(p).over(before), F.lit(0)).alias(f"_{p}") for p in PARTS])
    inside = Window.partitionBy("conv_id", "_block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.select("conv_id", "_block", "at", *[F.sum(p).over(inside).alias(p) for p in PARTS])
    joined = rolled.join(per, F.col("conv_id").eqNullSafe(F.col("_pc")) & (F.col("_block") == F.col("_pb")))
    return joined.select("conv_id", "at", *[(F.col(p) + F.col(f"_{p}")).alias(p) for p in PARTS])


def maximal(turns: DataFrame, block: int = 256) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of the conversations to keep: none is a prefix of a longer one, and of equal ones the smallest
    id stays (null last); ``n_copies`` counts the equal ones.

    Anti-join of the whole conversations with the distinct proper prefixes, on length and four sums. Both sides have one row
    per distinct sequence, so a first turn or a conversation that many share is one row.
    """
    rolled = prefixes(numbered(turns, block))
    ends = rolled.groupBy("conv_id").agg(F.max("at").alias("_last")).withColumnRenamed("conv_id", "_e")
    marked = rolled.join(ends, F.col("conv_id").eqNullSafe(F.col("_e"))).select(
        "conv_id", "at", *PARTS, (F.col("at") == F.col("_last")).alias("_end"))
    ranked = F.struct(F.col("conv_id").isNull().alias("n"), F.col("conv_id").alias("conv_id"))
    grouped = marked.groupBy("at", *PARTS).agg(
        F.min(F.when(F.col("_end"), ranked)).alias("_first"),
        F.sum(F.col("_end").cast("bigint")).alias("n_copies"), F.max((~F.col("_end")).cast("int")).alias("_inner"))
    wholes = grouped.filter("n_copies > 0")
    longer = grouped.filter("_inner = 1").select("at", *PARTS)
    kept = wholes.join(longer, ["at", *PARTS], "left_anti")
    return kept.select(F.col("_first.conv_id").alias("conv_id"), F.col("at").cast("bigint").alias("n_turns"), "n_copies")


def render(rows: DataFrame, per_part: int = 1024, opening: str = "<|", closing: str = "|>") -> DataFrame:
    """``conv_id, part, text``: turns as ``<|role|>`` line, text line, joined in order; ``per_part`` turns to a part at most, so that no row
    gathers a conversation without bound. Null role: ``unknown``; null text: empty."""
    said = F.concat(F.lit(opening), F.coalesce("role", F.lit("unknown")), F.lit(closing + "\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    turns = rows.select("conv_id", F.floor((F.col("at") - 1) / per_part).alias("part"), "at", said.alias("said"))
    gathered = turns.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("at", "said"))).alias("turns"))
    return gathered.select("conv_id", "part", F.concat_ws("", F.transform("turns", lambda t: t["said"])).alias("text"))


def collapse(turns: DataFrame, block: int = 256, per_part: int = 1024) -> DataFrame:
    """Maximal conversations, rendered: ``conv_id, part, n_turns, n_copies, text``.

    Rows without an id form one conversation with a null id. Empty input: empty result. Further columns are ignored.
    """
    kept = maximal(turns, block).withColumnRenamed("conv_id", "_kept")
    rows = numbered(turns, block).join(kept, F.col("conv_id").eqNullSafe(F.col("_kept"))).select("conv_id", "at", "role", "text", "n_turns", "n_copies")
    facts = kept.select("_kept", "n_turns", "n_copies")
    return render(rows.drop("n_turns", "n_copies"), per_part).join(facts, F.col("conv_id").eqNullSafe(F.col("_kept"))).select(
        "conv_id", "part", "n_turns", "n_copies", "text")
