"""Flatten, explode and pivot nested rows.

All schema walking happens on the driver and only touches the schema; each level adds one projection, and each
array one Generate. Nothing here shuffles, except ``pivot_rows``, which starts from rows that are flat already.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillbar.operators.blocks import index_by_range
from quillbar.operators.skew import heavy_parts


def tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fail_on_clash(names: Sequence[str]) -> None:
    twice = sorted(n for n, k in Counter(names).items() if k > 1)
    if twice:
        raise ValueError(f"the same column name is given twice: {twice}")


def _is_nested(t: T.DataType) -> bool:
    return isinstance(t, (T.StructType, T.ArrayType))


def flatten_outer(df: DataFrame, sibling_arrays: str = "cross") -> DataFrame:
    """Expand structs to ``parent_child`` and explode arrays, keeping rows whose array is null or empty.

    Arrays that are siblings multiply (``cross``) or run side by side (``zip``). Scalars come first, arrays last.
    Maps pass through.
    """
    if sibling_arrays not in ("cross", "zip"):
        raise ValueError("sibling_arrays is 'cross' or 'zip'")
    while any(_is_nested(f.dataType) for f in df.schema.fields):
        plain: list[tuple[str, Column]] = []
        arrays: list[str] = []
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StructType):
                plain += [(f"{f.name}_{s.name}", F.col(f"{tick(f.name)}.{tick(s.name)}")) for s in f.dataType.fields]
            elif isinstance(f.dataType, T.ArrayType):
                arrays.append(f.name)
            else:
                plain.append((f.name, F.col(tick(f.name))))
        fail_on_clash([n for n, _ in plain] + arrays)
        kept = [n for n, _ in plain]
        df = df.select(*[c.alias(n) for n, c in plain], *[F.col(tick(a)) for a in arrays])
        if sibling_arrays == "zip" and len(arrays) > 1:
            side_by_side = F.arrays_zip(*[F.coalesce(F.col(tick(a)), F.array()).alias(a) for a in arrays])
            df = df.select(*map(tick, kept), F.explode_outer(side_by_side).alias("_zipped"))
            df = df.select(*map(tick, kept), *[F.col(f"_zipped.{tick(a)}").alias(a) for a in arrays])
            continue
        for a in arrays:
            others = [c for c in df.columns if c != a]
            df = df.select(*map(tick, others), F.explode_outer(tick(a)).alias(a))
        df = df.select(*map(tick, kept + arrays))
    return df


def flatten_inner(df: DataFrame) -> DataFrame:
    """Flatten the first nested column until none is left; rows with a null or empty array are dropped.

    The columns of an expanded struct go to the end; an exploded array keeps its place.
    """
    while True:
        nested = next((f for f in df.schema.fields if _is_nested(f.dataType)), None)
        if nested is None:
            return df
        name = nested.name
        if isinstance(nested.dataType, T.StructType):
            rest = [c for c in df.columns if c != name]
            opened = [f"{name}_{s.name}" for s in nested.dataType.fields]
            fail_on_clash(rest + opened)
            df = df.select(
                *map(tick, rest),
                *[F.col(f"{tick(name)}.{tick(s.name)}").alias(f"{name}_{s.name}") for s in nested.dataType.fields],
            )
        else:
            df = df.select(*[F.explode(tick(c)).alias(c) if c == name else F.col(tick(c)) for c in df.columns])


def project_paths(df: DataFrame, paths: Sequence[tuple[str, str]]) -> DataFrame:
    """Nested paths to top-level columns: ``[("author.name.first", "author_name_first")]``. A path may come twice, a name may not."""
    fail_on_clash([a for _, a in paths])
    return df.select(*[F.col(p).alias(a) for p, a in paths])


def explode_items(df: DataFrame, container: str, array: str, fields: Sequence[str], keep: Sequence[Column | str],
                  number: str = "item_number", before: Column | None = None) -> DataFrame:
    """One row per array element, numbered from 1 in document order.

    A row without the container at all stays as one row with nulls; a container without elements gives no row.
    ``before`` is the number of items in earlier parts of the same document, if it has several.
    """
    items = F.col(f"{tick(container)}.{tick(array)}")
    skipped = F.lit(0) if before is None else before
    exploded = df.select(
        *keep, skipped.alias("_before"), F.col(container).isNull().alias("_absent"), F.posexplode_outer(items).alias("_pos", "_item")
    )
    inner = ("_before", "_absent", "_pos", "_item")
    return exploded.filter("_absent OR _pos IS NOT NULL").select(
        *[c for c in exploded.columns if c not in inner],
        (F.col("_pos") + F.col("_before") + 1).alias(number),
        *[F.col("_item")[f].alias(f) for f in fields],
    )


def pivot_columns(array: Column | str, prefix: str, max_items: int, fields: Sequence[tuple[str, str]] | None = None,
                  as_text: bool = True) -> list[Column]:
    """Array positions as numbered columns ``prefix-1 .. prefix-n`` or, for structs, ``prefix_suffix-i``.

    ``F.get`` gives null past the end; elements after ``max_items`` are not shown. ``fields`` lists struct fields with their
    column suffixes. Use all the columns in one ``select``.
    """
    arr = F.col(array) if isinstance(array, str) else array

    def shaped(c: Column) -> Column:
        return c.cast("string") if as_text else c

    out = []
    for i in range(max_items):
        element = F.get(arr, F.lit(i))
        if fields is None:
            out.append(shaped(element).alias(f"{prefix}-{i + 1}"))
        else:
            out += [shaped(element[f]).alias(f"{prefix}_{suffix}-{i + 1}") for f, suffix in fields]
    return out


def pivot_rows(df: DataFrame, key: str, order: Sequence[str], fields: dict[str, str], max_items: int) -> DataFrame:
    """Flat rows to one row per key with ``Name1, Qty1, Name2, ...`` for the first ``max_items`` rows of each key.

    ``row_number <= n`` becomes a group limit on both sides of the shuffle, so a hot key ships ``max_items`` rows per
    input task. The aggregate reuses the window's partitioning. Join other attributes after this, not before.
    """
    numbered = df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter(F.col("_n") <= max_items)
    cells = [
        F.max(F.when(F.col("_n") == i, F.col(f))).alias(f"{name}{i}")
        for i in range(1, max_items + 1)
        for f, name in fields.items()
    ]
    return numbered.groupBy(key).agg(*cells)


def _gather(df: DataFrame, key: str, order: Sequence[str], payload: dict[str, Column | str], heavy: DataFrame | None,
            max_items: int, array: str, part: str) -> DataFrame:
    if heavy is None:
        placed, group = df.repartition(key), [key]
    else:
        is_heavy = F.col(key).eqNullSafe(F.col("_heavy"))
        numbered = index_by_range(df.join(heavy, is_heavy, "left_semi"), key, order)
        cut = numbered.withColumn(part, F.floor((F.col("row_index") - 1) / F.lit(max_items)).cast("int")).drop("row_index")
        light = df.join(heavy, is_heavy, "left_anti").withColumn(part, F.lit(0))
        placed, group = light.unionByName(cut).repartition(key, part), [key, part]
    element = F.struct(
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(a) for a, c in payload.items()]).alias("_v"),
    )
    nested = placed.groupBy(*group).agg(F.sort_array(F.collect_list(element)).alias("_sorted"))
    number = F.lit(0) if heavy is None else F.col(part)
    return nested.select(key, number.alias(part), F.transform("_sorted", lambda e: e["_v"]).alias(array))


def nest_rows(df: DataFrame, key: str, order: Sequence[str], payload: dict[str, Column | str], max_items: int,
              array: str = "item", part: str = "part") -> DataFrame:
    """Flat rows to documents ``(key, part, array)`` of at most ``max_items`` elements, sorted by ``order``.

    Almost every key fits one document (part 0). A key with more rows gives several documents with the same ``key``: whoever counts
    documents counts those with ``part = 0``. Null is a key like any other. Only the rows of keys with more are numbered and continue in parts 1,
    2, ..., so no task ever gathers an unbounded group. Element ``i`` of a part is item ``part * max_items + i`` of its
    key. Rows are shuffled as they are and gathered afterwards: arrays built before the shuffle hold few rows each and
    only cost time.
    """
    return _gather(df, key, order, payload, heavy_parts(df, key, max_items), max_items, array, part)


def nest_under(parents: DataFrame, parent_key: str, df: DataFrame, key: str, order: Sequence[str],
               payload: dict[str, Column | str], max_items: int, array: str = "item", part: str = "part") -> DataFrame:
    """Each parent with its rows as an array; null for a parent without rows. ``parent_key`` is unique in ``parents``.

    A parent with more than ``max_items`` rows comes back once per part, with the same ``parent_key``: count parents by ``part = 0``.

    A parent of a heavy key is repeated once per part, and the join is on key and part: the parts of one hot key then
    meet their parent in many tasks. Without heavy keys the join reuses the partitioning of the gathered rows.
    """
    heavy = heavy_parts(df, key, max_items)
    docs = _gather(df, key, order, payload, heavy, max_items, array, part)
    if heavy is None:
        return parents.join(docs, F.col(parent_key) == F.col(key), "left").withColumn(part, F.lit(0)).drop(key)
    docs = docs.withColumnRenamed(part, "_part")
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    copies = parents.join(heavy, F.col(parent_key) == F.col("_heavy"), "left").withColumn(part, F.explode(F.sequence(F.lit(0), last)))
    joined = copies.join(docs, (F.col(parent_key) == F.col(key)) & (F.col(part) == F.col("_part")), "left")
    return joined.drop(key, "_part", "_heavy", "_parts")


@dataclass(frozen=True)
class ArrayPivot:
    """How one array becomes columns: where it is, the column prefix, how many positions, which struct fields."""

    path: str
    prefix: str
    max_items: int
    fields: Sequence[tuple[str, str]] | None = field(default=None)
