"""XML scans: one row per element, with an explicit schema wherever types matter."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_xml(spark: SparkSession, path: str | list[str], row_tag: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One row per ``row_tag`` element. ``path`` may be a glob. A file is one task; see ``read_xml_split`` for big files.

    Without a schema the types are inferred by an extra pass, and ``001`` becomes the number 1.
    """
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _let(value, body):
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _records(piece, row_tag: str):
    """The row elements in the text before one end tag: self-closing ones, then the one that the end tag closes.

    Comments, CDATA sections and tags are told apart first, so that a tag named in a comment or in CDATA does not count. A piece
    that cannot be decided fails: it was cut inside a comment or CDATA, or row elements are nested or unclosed.
    """
    tag = re.escape(row_tag)
    inside_tag = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
    pattern = rf"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<{tag}(?=[\s/>]){inside_tag}|[^<]++|<"
    row = lambda t: F.rlike(t, F.lit(rf"^<{tag}[\s/>]"))
    self_closing = lambda t: row(t) & t.endswith("/>")
    opening = lambda t: row(t) & ~t.endswith("/>")

    def decided(tokens):
        first = F.array_position(F.transform(tokens, opening), True).cast("int")
        loose = F.array_join(F.filter(tokens, lambda t: ~t.startswith("<![CDATA[")), "")
        torn = F.rlike(loose, F.lit(r"<!--|-->|<!\[CDATA\[|\]\]>"))
        many = F.size(F.filter(tokens, opening)) > 1
        failed = F.raise_error(F.concat(F.lit(f"cannot cut <{row_tag}> elements here: "), F.substring(loose, 1, 200))).cast("array<string>")
        ahead = F.when(first > 0, F.slice(tokens, 1, first - 1)).otherwise(tokens)
        closed = F.concat(F.array_join(F.slice(tokens, first, F.size(tokens)), ""), F.lit(f"</{row_tag}>"))
        found = F.concat(F.filter(ahead, self_closing), F.when(first > 0, F.array(closed)).otherwise(F.array().cast("array<string>")))
        return F.when(torn | many, failed).otherwise(found)

    tokens = F.filter(F.regexp_extract_all(piece, F.lit(pattern), F.lit(0)), lambda t: ~(t.startswith("<!--") & t.endswith("-->")))
    # Most pieces name the tag once, in a whole opening tag, and hold no mark of a comment or CDATA: what begins there is the record.
    before, after = F.substring_index(piece, f"<{row_tag}", 1), F.substring_index(piece, f"<{row_tag}", -1)
    once = F.octet_length(before) + F.octet_length(after) + len(f"<{row_tag}".encode()) == F.octet_length(piece)
    whole_tag = after.startswith(">") | F.rlike(after, F.lit(rf"^(?=[\s/>]){inside_tag}(?<!/>)"))
    marked = F.contains(piece, F.lit("<!")) | F.contains(piece, F.lit("-->")) | F.contains(piece, F.lit("]]>"))
    record = F.array(F.concat(F.lit(f"<{row_tag}"), after, F.lit(f"</{row_tag}>")))
    return F.when(once & ~marked & whole_tag, record).otherwise(_let(tokens, decided))


def read_xml_split(spark: SparkSession, path: str | list[str], row_tag: str, schema: T.StructType | str) -> DataFrame:
    """Read big XML files in parallel: cut the text at each end tag and parse every record on its own.

    Any number of tasks can share one file; a record is held whole by its task. Self-closing row elements are records; comments are
    passed over; blanks in an end tag are allowed. UTF-8 only. What cannot be cut for certain (an end tag inside a comment or
    CDATA, row elements inside row elements, a record without its end) and what cannot be parsed fails the read.
    """
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    if isinstance(schema, str) and not schema.lower().startswith("struct<"):
        ddl = T.StructType.fromDDL(schema).simpleString()
    text = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    blanks = F.contains("value", F.lit(f"</{row_tag}"))  # the only end tags that are left have blanks
    cut = F.when(blanks, F.split("value", rf"</{re.escape(row_tag)}\s+>", -1)).otherwise(F.array("value"))
    pieces = text.select(F.explode(cut).alias("_piece"))
    records = pieces.select(F.explode(_records(F.col("_piece"), row_tag)).alias("_record"))
    return records.select(F.from_xml("_record", ddl, {"rowTag": row_tag, "mode": "FAILFAST"}).alias("_rec")).select("_rec.*")


def infer_schema(spark: SparkSession, path: str, row_tag: str, out: str | None = None, sampling_ratio: float = 1.0) -> T.StructType:
    """Infer once and, if ``out`` is given, save the schema as JSON text for later reads."""
    schema = (
        spark.read.format("xml").option("rowTag", row_tag).option("samplingRatio", sampling_ratio).load(path).schema
    )
    if out:
        save_schema(spark, schema, out)
    return schema


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(read_small_text(spark, path)))


def read_small_text(spark: SparkSession, path: str) -> str:
    """The text of one small settings file, read through Spark so that any file system works."""
    return spark.read.text(path, wholetext=True).first()["value"]


# Kinds of text from the narrowest on; a number with a leading zero or plus is a code and stays text.
_KINDS = [
    ("bigint", r"^-?(0|[1-9][0-9]{0,17})$"),
    ("double", r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"),
    ("boolean", r"^(true|false)$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
]


def _leaves(kind: T.DataType, value) -> list:
    """(path, all texts) of each leaf below ``value``: a column of that type."""
    if isinstance(kind, T.StructType):
        return [((f.name, *path), texts) for f in kind.fields for path, texts in _leaves(f.dataType, value[f.name])]
    if isinstance(kind, T.ArrayType):
        def nth(i: int):
            return lambda v: _leaves(kind.elementType, v)[i][1]

        found = _leaves(kind.elementType, F.lit(None))
        return [((None, *path), F.flatten(F.transform(value, nth(i)))) for i, (path, _) in enumerate(found)]
    return [((), F.array(value))]


def _with_kinds(kind: T.DataType, path: tuple, found: dict) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _with_kinds(f.dataType, (*path, f.name), found)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_with_kinds(kind.elementType, (*path, None), found))
    return found[path]


def merged_schema(spark: SparkSession, path: str | list[str], row_tag: str) -> T.StructType:
    """The least schema that holds every record of all files, for reading them as one table.

    A tag that repeats anywhere is an array everywhere; a tag that has children or attributes anywhere is a struct. A leaf is bigint, double,
    boolean or date if all its texts are, bigint and double together double, any other mix text, and so is a number written with a leading zero. A
    leaf without any text is text. Files are read twice, by tasks; one row of flags reaches the driver.
    """
    shape = spark.read.format("xml").option("rowTag", row_tag).option("inferSchema", False).load(path).schema
    rows = read_xml(spark, path, row_tag, shape)
    leaves = [(p, texts) for f in shape.fields for p, texts in (((f.name, *rest), t) for rest, t in _leaves(f.dataType, F.col(f"`{f.name}`")))]
    if not leaves:
        return shape

    def flags(texts):
        there = F.filter(texts, lambda t: t.isNotNull() & (t != ""))
        like = lambda pattern: lambda t: F.rlike(F.trim(t), F.lit(pattern))
        fits = [F.bool_and(F.forall(there, like(r))) for _, r in _KINDS[:3]]
        day = F.bool_and(F.forall(there, lambda t: F.rlike(t, F.lit(_KINDS[3][1])) & t.try_cast("date").isNotNull()))
        return F.struct(F.bool_or(F.size(there) > 0), *fits, day)

    told = rows.agg(*[flags(t).alias(f"f{i}") for i, (_, t) in enumerate(leaves)]).first()
    found = {}
    for i, (p, _) in enumerate(leaves):
        met, *fits = told[f"f{i}"]
        name = next((k for (k, _), ok in zip(_KINDS, fits, strict=True) if ok), "string") if met else "string"
        found[p] = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "string": T.StringType()}[name]
    return _with_kinds(shape, (), found)
