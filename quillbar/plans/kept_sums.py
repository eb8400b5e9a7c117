"""Sums that are kept by day: a new day is added without reading the rows of the old ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbar.sources import sinks


def add_days(rows: DataFrame, table: str, day: str, keys: Sequence[str], values: dict[str, str]) -> None:
    """Put the partial sums of the days in ``rows`` into ``table``, partitioned by ``day``: one row per day and key with ``sum_<out>``,
    ``n_<out>``, ``min_<out>`` and ``max_<out>`` for each ``{out: column}``, and ``rows``.

    A day that is added again replaces its sums. ``rows`` holds whole days.
    """
    measures = [f(F.col(c)).alias(f"{name}_{out}") for out, c in values.items() for name, f in (("sum", F.sum), ("n", F.count), ("min", F.min), ("max", F.max))]
    sinks.load_day(rows.groupBy(day, *keys).agg(*measures, F.count(F.lit(1)).alias("rows")), table, day)


def totals(spark: SparkSession, table: str, keys: Sequence[str], outs: Sequence[str]) -> DataFrame:
    """The sums over all days, merged from the kept ones; the mean of ``out`` is ``sum_out / n_out``."""
    merge = {"sum": F.sum, "n": F.sum, "min": F.min, "max": F.max}
    kept = [f(f"{name}_{out}").alias(f"{name}_{out}") for out in outs for name, f in merge.items()]
    return spark.table(table).groupBy(*keys).agg(*kept, F.sum("rows").alias("rows"))
