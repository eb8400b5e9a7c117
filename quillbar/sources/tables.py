"""Table scans and bar selections."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def list_datasets(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def lookback(df: DataFrame, period: str, ts: str = "ts", grid: str | None = None) -> DataFrame:
    """Rows of the last ``period`` (``"7 days"``), measured from the newest row, or from the start of the ``grid`` bar
    (``"1 hour"``) that holds it.

    The bound is a scalar subquery compared with the bare column: Spark computes it first and hands it to the scan as a
    constant.
    """
    newest = df.agg(F.max(ts).alias("_newest"))
    start = F.window("_newest", grid)["start"] if grid else F.col("_newest")
    bound = newest.select((start - F.expr(f"INTERVAL {period}")).alias("_from"))
    return df.filter(F.col(ts) >= bound.scalar())


def latest_n(df: DataFrame, n: int, key: str = "symbol", order: Sequence[str] = ("ts",), rank: str | None = None) -> DataFrame:
    """The newest ``n`` rows of every key.

    Spark turns the rank filter into a group limit that runs before and after the shuffle, so a hot key ships at most
    ``n`` rows per input task.
    """
    newest_first = W.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    out = df.withColumn("_back", F.row_number().over(newest_first)).filter(F.col("_back") <= n)
    return out.withColumnRenamed("_back", rank) if rank else out.drop("_back")


def previous_day(df: DataFrame, run: datetime, ts: str = "ts") -> DataFrame:
    """Rows of the day before ``run``: a half-open range of constants on the raw column, so that it reaches the scan."""
    today = datetime.combine(run, time.min)
    start, end = (F.lit(d.isoformat(" ")).cast(df.schema[ts].dataType) for d in (today - timedelta(days=1), today))
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))
