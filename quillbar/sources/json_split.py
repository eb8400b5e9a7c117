"""One big JSON file by many tasks: an array of objects, or objects one after the other, over many lines or in one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillbar.session import scratch_path

STRETCH = ["file", "stretch"]


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text between closing braces, in order, with what each piece does to the state of a reader.

    ``quotes``: string marks in it. ``outside`` and ``inside``: brackets opened less those closed, if the piece begins outside or inside
    a string. Spark cuts the file into stretches at any place; a piece belongs to the stretch that it begins in.
    """
    text = spark.read.option("lineSep", "}").text(path)
    meta = F.col("_metadata")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    # What stands between string marks: every second part is a string.
    parts = F.split(plain, '"', -1)
    side = lambda rest: F.array_join(F.filter(parts, lambda _, i: i % 2 == rest), "")
    opened = lambda t: _count(t, "{[") - _count(t, "]")
    return text.select(
        meta["file_path"].alias("file"), meta["file_size"].alias("file_size"), meta["file_block_start"].alias("stretch"),
        F.monotonically_increasing_id().alias("place"), "value", _count(plain, '"').alias("quotes"),
        opened(side(0)).alias("outside"), opened(side(1)).alias("inside"),
    )


def _first(column: str) -> Column:
    return F.min_by(column, "place")


def json_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, record``: the text of every object of the files' arrays (or of their objects one after the other), cut by many tasks.

    What a stretch of the file does to the state (inside a string or not, depth) is known without what stands before it, for both cases;
    one row per stretch is then composed in order, and each stretch starts from the state that its predecessors leave. UTF-8
    only. Files without objects give no row. Text that is no array of objects, and an object without its end, fail the read.
    """
    path_out = scratch_path(spark, "json-pieces")
    _pieces(spark, path).write.parquet(path_out)
    pieces = spark.read.parquet(path_out)

    in_stretch = W.partitionBy(*STRETCH).orderBy("place")
    before, so_far = in_stretch.rowsBetween(W.unboundedPreceding, -1), in_stretch.rowsBetween(W.unboundedPreceding, W.currentRow)
    odd = F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2))
    local = pieces.withColumn("odd", odd)

    def moved(inside: Column) -> Column:
        """Change of depth over a piece and the brace behind it, which counts if the piece ends outside a string."""
        closes = F.when(F.pmod(F.when(inside, 1).otherwise(0) + F.col("quotes"), F.lit(2)) == 0, 1).otherwise(0)
        return F.when(inside, F.col("inside")).otherwise(F.col("outside")) - closes

    starts_inside = F.col("odd") == 1
    stretches = local.groupBy(*STRETCH).agg(
        F.pmod(F.sum("quotes"), F.lit(2)).alias("flip"), F.sum(moved(starts_inside)).alias("from_outside"), F.sum(moved(~starts_inside)).alias("from_inside"),
        _first("value").alias("head"), F.sum(F.octet_length("value")).alias("bytes"), F.count(F.lit(1)).alias("pieces"), F.first("file_size").alias("file_size"))
    # One row per stretch: few to a file.
    in_file = W.partitionBy("file").orderBy("stretch")
    earlier, whole = in_file.rowsBetween(W.unboundedPreceding, -1), W.partitionBy("file")
    known = stretches.withColumn("inside_at", F.pmod(F.coalesce(F.sum("flip").over(earlier), F.lit(0)), F.lit(2)) == 1)
    known = known.withColumn("change", F.when(F.col("inside_at"), F.col("from_inside")).otherwise(F.col("from_outside")))
    known = known.withColumn("depth_at", F.coalesce(F.sum("change").over(earlier), F.lit(0)))
    array = F.ltrim(F.regexp_replace(F.first("head").over(in_file), "^﻿", ""))
    known = known.withColumn("base", F.when(F.rlike(array, F.lit(r"^\s*\[")), 1).otherwise(0))
    # As many braces as pieces means that the file ends with one; else the last piece has none behind it.
    known = known.withColumn("open_end", F.sum("bytes").over(whole) + F.sum("pieces").over(whole) > F.col("file_size"))
    known = known.withColumn("last_stretch", F.max("stretch").over(whole))
    known = known.select(F.col("file").alias("_f"), F.col("stretch").alias("_s"), "inside_at", "depth_at", "base", "open_end", "last_stretch")

    state = local.join(known, (F.col("file") == F.col("_f")) & (F.col("stretch") == F.col("_s")))
    inside = F.col("inside_at") != starts_inside
    last = (F.col("stretch") == F.col("last_stretch")) & F.lead("place").over(in_stretch).isNull()
    state = state.withColumn("inside_here", inside).withColumn("tail", F.col("open_end") & last)
    state = state.withColumn("depth", F.col("depth_at") + F.sum(moved(F.col("inside_here"))).over(so_far))
    closes = F.pmod(F.when(F.col("inside_here"), 1).otherwise(0) + F.col("quotes"), F.lit(2)) == 0
    state = state.withColumn("ends", closes & (F.col("depth") == F.col("base")) & ~F.col("tail"))
    state = state.withColumn("done", F.coalesce(F.sum(F.when(F.col("ends"), 1).otherwise(0)).over(before), F.lit(0)))
    state = state.select("file", "stretch", "place", "ends", "done", F.concat("value", F.when(F.col("tail"), "").otherwise("}")).alias("value"))

    # Records are numbered through the file: those ended in earlier stretches, then those ended before in this one.
    ended = state.groupBy(*STRETCH).agg(F.sum(F.when(F.col("ends"), 1).otherwise(0)).alias("n"))
    ended = ended.select(F.col("file").alias("_f"), F.col("stretch").alias("_s"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    numbered = state.join(ended, (F.col("file") == F.col("_f")) & (F.col("stretch") == F.col("_s")))
    parts = F.array_sort(F.collect_list(F.struct("stretch", "place", "value")))
    records = numbered.groupBy("file", (F.col("earlier") + F.col("done")).alias("number")).agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "").alias("text"), F.max("ends").alias("whole"))
    body = F.regexp_replace("text", r"^[\s,\[﻿]*", "")
    rest = F.regexp_replace("text", r"[\s,\[\]﻿]*", "")
    checked = F.when(F.col("whole") & body.startswith("{"), body).when(~F.col("whole") & (rest == ""), F.lit(None).cast("string")).otherwise(
        F.raise_error(F.concat(F.lit("cannot cut this JSON into objects: "), F.substring("text", 1, 200))).cast("string"))
    return records.select("file", checked.alias("record")).filter(F.col("record").isNotNull())


def read_json_split(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """What ``files.read_json`` reads from multi-line files, with any number of tasks to a file.

    A record is held whole by its task. An object that does not parse fails the read.
    """
    records = json_records(spark, path)
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    return records.select(F.from_json("record", ddl, {"mode": "FAILFAST"}).alias("_r")).select("_r.*")
