"""Joins and groupings that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Longest list that is sent to every task, in rows. Lists are a few narrow columns, so this is some megabytes.
SMALL_LIST = 100_000


def small_list(df: DataFrame, limit: int = SMALL_LIST) -> DataFrame | None:
    """``df`` as a local list if it has at most ``limit`` rows, else None.

    At most ``limit + 1`` rows reach the driver, whatever the size of ``df``.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def join_list(df: DataFrame, keys: DataFrame, on: Column | str | Sequence[str], how: str, limit: int = SMALL_LIST) -> DataFrame:
    """Join with a list that is usually short. Its size is checked: a short one is broadcast and ``df`` is not
    shuffled at all; a long one goes through a shuffled join, where AQE splits hot keys."""
    local = small_list(keys, limit)
    return df.join(keys if local is None else F.broadcast(local), on, how)


def heavy_keys(df: DataFrame, key: str, above: int) -> DataFrame:
    """Keys with more than ``above`` rows and their counts. Reads the key column only; combines before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > above)


def heavy_parts(df: DataFrame, key: str, max_rows: int, limit: int = SMALL_LIST) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows and the number of parts they need; None when there are none.

    A short list comes back as a broadcast one, a long list as it is.
    """
    parts = heavy_keys(df, key, max_rows).select(
        F.col(key).alias("_heavy"), F.ceil(F.col("rows") / max_rows).cast("int").alias("_parts")
    )
    local = small_list(parts, limit)
    if local is None:
        return parts
    return None if local.isEmpty() else F.broadcast(local)
