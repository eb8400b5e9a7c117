"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbar.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, label`` for every end of a link (``a``, ``b``): the smallest node of its component.

    Each round takes the smallest label among a node and its neighbours, then follows labels to their own labels, which halves
    long chains. Each round is written to the shared folder; the rounds end when no label changes.
    """
    both = scratch.save(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "edges")
    labels = scratch.save(both.groupBy("a").agg(F.min("b").alias("n")).select(F.col("a").alias("node"), F.least("a", "n").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("n"))
        step = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "n").alias("label"))
        jump = labels.select(F.col("node").alias("j"), F.col("label").alias("further"))
        step = step.join(jump, F.col("label") == F.col("j"), "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        step = scratch.save(step, "labels")
        moved = step.filter("old <> label").limit(1).count()
        scratch.drop(labels)
        labels = step.select("node", "label")
        if not moved:
            scratch.drop(both)
            return labels


def merged(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``labels`` after further ``links``: only the components that these connect are worked on, and what they become is passed on to the nodes."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    known = scratch.save(labels.unionByName(ends.select("node", F.col("node").alias("label"))), "known")
    of = lambda name: known.select(F.col("node").alias(name), F.col("label").alias(f"{name}_label"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))
    moved = components(between, scratch).select(F.col("node").alias("label"), F.col("label").alias("now"))
    return scratch.save(known.join(moved, "label", "left").select("node", F.coalesce("now", "label").alias("label")), "merged")
