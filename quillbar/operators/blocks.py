"""Split long series into blocks, so that no window ever needs a whole key in one task.

``index_by_range`` numbers the rows of each key exactly, for any distribution; ``index_rows`` does so in slices that the caller gives. ``with_halo`` cuts the numbered series into blocks
of fixed length and repeats the last rows of each block at the head of the next. Look-back indicators then run per
``(key, block)`` with unchanged formulas, and ``drop_halo`` removes the repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillbar.operators import timeseries
from quillbar.operators.skew import join_list
from quillbar.session import scratch_path

BLOCK = "_block"
HALO = "_halo"


def index_rows(df: DataFrame, key: str, order: Sequence[str], slice_by: Column, out: str = "row_index") -> DataFrame:
    """The 1-based position of each row within its key, exact, without sorting a whole key in one task.

    ``slice_by`` must grow with ``order`` (for a series, the time cut to a width that holds a moderate number of rows).
    Rows are ranked inside ``(key, slice)``; slice sizes, pre-aggregated on the map side, give each slice its offset.
    The rank and the join share one shuffle on ``(key, slice)``. Null is a key like any other.
    """
    sliced = df.withColumn("_slice", slice_by)
    before = W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(key, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(F.col(key).alias("_key"), F.col("_slice").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    rank = F.row_number().over(W.partitionBy(key, "_slice").orderBy(*order))
    return (
        sliced.withColumn("_rank", rank)
        .join(offsets, F.col(key).eqNullSafe(F.col("_key")) & F.col("_slice").eqNullSafe(F.col("_of")))
        .withColumn(out, F.col("_before") + F.col("_rank"))
        .drop("_slice", "_rank", "_before", "_key", "_of")
    )


def _ranged(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The rows sorted by range, once, with ``_range`` and ``_place`` in it, from the shared scratch folder.

    Writing pins the ranges; a lost executor cannot shift them. Rows that agree in ``order`` are told apart by a hash of the
    whole row, and copies by a row id, so that they spread over ranges as well. Only copies depend on the id, and it does not
    matter which copy a task that runs again puts where.
    """
    path = scratch_path(df.sparkSession, "ranges")
    sort = [key, *order, "_hash", "_tie"]
    (
        df.withColumns({"_hash": F.xxhash64(*df.columns), "_tie": F.monotonically_increasing_id()})
        .repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
        .drop("_hash", "_tie")
        .write.parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def _with_earlier(stored: DataFrame, key: str, earlier: DataFrame) -> DataFrame:
    """Joins one row per (``_key``, ``_of``) to the rows of that key and range; null is a key like any other."""
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of"))
    return join_list(stored, earlier, same, "inner").drop("_key", "_of")


def index_by_range(df: DataFrame, key: str, order: Sequence[str], out: str = "row_index") -> DataFrame:
    """The 1-based position of each row within its key, exact and even for any distribution: bursts, equal rows, hot and null keys.

    One aggregated row per (key, range) gives the offsets.
    """
    stored = _ranged(df, key, order)
    before = W.partitionBy(key).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        stored.groupBy(key, "_range")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        .select(F.col(key).alias("_key"), F.col("_range").alias("_of"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    numbered = _with_earlier(stored, key, offsets)
    return numbered.withColumn(out, F.col("_before") + F.col("_place") - F.col("_first") + 1).drop("_range", "_place", "_first", "_before")


def with_halo(df: DataFrame, block_rows: int, halo_rows: int, index: str = "row_index") -> DataFrame:
    """Blocks of ``block_rows`` rows, each preceded by the last ``halo_rows`` rows of the block before."""
    if not 0 <= halo_rows <= block_rows:
        raise ValueError("the halo must not be longer than a block")
    own = F.floor((F.col(index) - 1) / F.lit(block_rows))
    into_block = F.pmod(F.col(index) - 1, F.lit(block_rows))
    homes = F.when(into_block >= block_rows - halo_rows, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn(BLOCK, F.explode(homes)).withColumn(HALO, F.col(BLOCK) != own)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(BLOCK, HALO)


def in_blocks(df: DataFrame, key: str, order: Sequence[str], compute: Callable[[DataFrame, list[str], list[str]], DataFrame],
              block_rows: int, halo_rows: int) -> DataFrame:
    """Run a look-back computation over series of any length. ``compute(df, by, order)`` gets the columns that delimit
    a block and the order inside it; ``halo_rows`` is how far back it looks. ``row_index`` stays in the result."""
    cut = with_halo(index_by_range(df, key, order), block_rows, halo_rows)
    return drop_halo(compute(cut, [key, BLOCK], ["row_index"]))


def running_max(df: DataFrame, key: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """The largest ``value`` of the key up to each row, without a window over the whole key: the maximum inside the
    range, combined with the maximum of all earlier ranges, which come from one aggregated row per range."""
    stored = _ranged(df, key, order)
    earlier = W.partitionBy(key).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    tops = stored.groupBy(key, "_range").agg(F.max(timeseries.present(value)).alias("_top")).select(
        F.col(key).alias("_key"), F.col("_range").alias("_of"), F.max("_top").over(earlier).alias("_before"))
    inside = W.partitionBy(key, "_range").orderBy("_place").rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = _with_earlier(stored.withColumn("_inside", F.max(timeseries.present(value)).over(inside)), key, tops)
    return joined.withColumn(out, F.greatest("_inside", "_before")).drop("_range", "_place", "_inside", "_before")


def ema_in_blocks(df: DataFrame, key: str, order: Sequence[str], spans: dict[str, int], value: str = "price", block_rows: int = 16_384) -> DataFrame:
    """Exponential means ``{out: span}`` over series of any length and spans of any length, without a halo.

    Over a block of rows the mean is an affine map of the mean before it: y -> keep^n y + end, with n values in the block. Inside blocks
    the means are scaled running sums; blocks are short enough (``block_rows`` at most) for the scale to stay in a double's range.
    One row per block holds its map; these are applied in order, a few numbers per key, and each block gets the mean that it
    starts from. No history is cut off. Rows without a value (null or NaN) carry the last mean; there is none before the first value.
    Null is a key like any other. ``row_index`` stays in the result.
    """
    if any(s < 1 for s in spans.values()):
        raise ValueError("a span is at least 1")
    names, rates = list(spans), [float(timeseries._rate(s)) if s > 1 else None for s in spans.values()]
    width = min([block_rows, *[int(600 / r) for r in rates if r]])
    numbered = index_by_range(df, key, order)
    x = timeseries.present(F.col(value).cast("double"))
    inside = W.partitionBy(key, BLOCK).orderBy("row_index").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = numbered.withColumn(BLOCK, F.floor((F.col("row_index") - 1) / F.lit(width))).withColumn("_n", F.count(x).over(inside))
    scaled = {}
    for i, (span, rate) in enumerate(zip(spans.values(), rates, strict=True)):
        if rate is None:
            scaled[f"in_{i}"] = F.coalesce(F.last(x, ignorenulls=True).over(inside), F.lit(0.0))
        else:
            total = F.sum(x * F.lit(2 / (span + 1)) * F.exp((F.col("_n") - 1) * rate)).over(inside)
            scaled[f"in_{i}"] = F.coalesce(total * F.exp((1 - F.col("_n")) * rate), F.lit(0.0))
    local = cut.withColumns(scaled)
    # A key may be null or of any type; its text and nullness only have to keep keys apart while the maps are folded.
    mark = F.struct(F.col(key).isNull(), F.col(key)).cast("string")
    maps = local.groupBy(key, BLOCK).agg(F.max("_n").alias("_n"), F.min_by(x, F.when(x.isNotNull(), F.col("row_index"))).alias("_first"),
                                         *[F.max_by(f"in_{i}", "row_index").alias(f"end_{i}") for i in range(len(names))])
    maps = maps.withColumn("_mark", mark).drop(key)
    keeps = [1 - 2 / (s + 1) for s in spans.values()]
    # Plain values only, so that the workers need no copy of this package.
    ends, befores = [f"end_{i}" for i in range(len(names))], [f"before_{i}" for i in range(len(names))]

    def fold(batches):
        """Per block, in order: the means at the end of the block before. Block 0 starts a key; its own first value stands for the history."""
        import pandas as pd

        before = [None] * len(keeps)
        for pdf in batches:
            out = []
            for place, n, first, *own in zip(pdf["_block"], pdf["_n"], pdf["_first"], *[pdf[e] for e in ends]):
                if place == 0:
                    before = [None] * len(keeps)
                known = before[0] is not None
                if n and not known:
                    before = [first] * len(keeps)
                out.append([known, *before])
                if n:
                    before = [end + keep**n * b for end, keep, b in zip(own, keeps, before)]
            told = pd.DataFrame(out, columns=["_known", *befores]).astype(dict.fromkeys(befores, "float64"))
            yield pd.concat([pdf["_mark"].rename("_key").reset_index(drop=True), pdf["_block"].rename("_of").reset_index(drop=True), told], axis=1)

    fields = "_key string, _of bigint, _known boolean, " + ", ".join(f"before_{i} double" for i in range(len(names)))
    starts = maps.repartition("_mark").sortWithinPartitions("_mark", BLOCK).mapInPandas(fold, fields)
    joined = local.withColumn("_mark", mark).join(starts, (F.col("_mark") == F.col("_key")) & (F.col(BLOCK) == F.col("_of"))).drop("_mark", "_key", "_of")
    means = {}
    for i, (name, keep) in enumerate(zip(names, keeps, strict=True)):
        mean = F.col(f"in_{i}") + F.pow(F.lit(keep), F.col("_n")) * F.col(f"before_{i}")
        if keep == 0:
            mean = F.when(F.col("_n") > 0, F.col(f"in_{i}")).otherwise(F.col(f"before_{i}"))
        means[name] = F.when(F.col("_known") | (F.col("_n") > 0), mean)
    return joined.withColumns(means).drop(BLOCK, "_n", "_known", *scaled, *[f"before_{i}" for i in range(len(names))])
