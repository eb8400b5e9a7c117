"""Writers: delimited files, XML parts, managed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, sep: str = ",", single_file: bool = False) -> None:
    """Overwrite a folder of delimited files with a header. One file only on request: it makes the last stage one task.

    Blanks at the ends of a value are kept; Spark's writer would drop them.
    """
    out = df.coalesce(1) if single_file else df
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    out.write.options(header=True, sep=sep, **blanks).mode("overwrite").csv(path)


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    write_csv(df, path, sep="\t", single_file=single_file)


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str, records_per_file: int = 1000) -> None:
    """XML files of at most ``records_per_file`` row elements, each below its own root element."""
    (
        df.write.format("xml")
        .option("rootTag", root_tag)
        .option("rowTag", row_tag)
        .option("maxRecordsPerFile", records_per_file)
        .mode("overwrite")
        .save(path)
    )


def _aside(df: DataFrame, table: str, fmt: str) -> str:
    """Write the rows to a new table beside ``table`` and name it."""
    name = f"{table}__{uuid.uuid4().hex}"
    df.write.format(fmt).saveAsTable(name)
    return name


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Create or replace a managed table from a query.

    The rows are written aside and the tables are swapped by name, so a write that fails leaves the old table as it was. ``df``
    may read the table itself. Readers that come between the drop and the rename find no table.
    """
    spark, name = df.sparkSession, _aside(df, table, fmt)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {name} RENAME TO {table}")


def truncate_and_load(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Replace the rows of ``table`` and keep its definition; create it if it is missing. The rows are computed before any old
    one goes."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return overwrite_table(df, table, fmt)
    name = _aside(df.select(*spark.table(table).columns), table, fmt)
    spark.table(name).write.mode("overwrite").insertInto(table)
    spark.sql(f"DROP TABLE {name}")


def append_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").saveAsTable(table)


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, fmt: str = "parquet") -> bool:
    """Create an empty table from ``schema`` if there is none. True when it was created."""
    if spark.catalog.tableExists(table):
        return False
    spark.catalog.createTable(table, source=fmt, schema=schema)
    return True


class SchemaDrift(ValueError):
    """A declaration that an existing table cannot take without losing values."""


# What a declared type can replace without loss; any type can become text.
_WIDER = {
    "bigint": ("tinyint", "smallint", "int"),
    "int": ("tinyint", "smallint"),
    "double": ("tinyint", "smallint", "int", "float"),
    "float": ("tinyint", "smallint"),
    "timestamp": ("date",),
}


def drift(spark: SparkSession, table: str, schema: T.StructType) -> tuple[list[T.StructField], dict[str, T.DataType]]:
    """What ``table`` lacks against ``schema``: (columns to add, columns to widen with their new types); none for a missing table.

    Names are compared without case. A column that the table alone has stays. A type that would narrow a column raises ``SchemaDrift``,
    and so does a new column that must not be null, as long as the table has rows without it.
    """
    if not spark.catalog.tableExists(table):
        return [], {}
    there = {f.name.lower(): f for f in spark.table(table).schema.fields}
    added, widened = [], {}
    for field in schema.fields:
        old = there.get(field.name.lower())
        if old is None:
            added.append(field)
        elif old.dataType != field.dataType:
            was, now = old.dataType.simpleString(), field.dataType.simpleString()
            if was in _WIDER.get(now, ()) or (now == "string" and isinstance(old.dataType, T.AtomicType)):
                widened[old.name] = field.dataType
            elif not (now in _WIDER.get(was, ()) or was == "string"):
                raise SchemaDrift(f"{table}.{old.name} is {was} and cannot become {now}")
            else:
                raise SchemaDrift(f"{table}.{old.name} is {was}; {now} would narrow it")
    needed = [f.name for f in added if not f.nullable]
    if needed and not spark.table(table).isEmpty():
        raise SchemaDrift(f"{table} has rows without {', '.join(needed)}")
    return added, widened


def reconcile_table(spark: SparkSession, table: str, schema: T.StructType, fmt: str = "parquet") -> bool:
    """Create ``table``, or bring it up to ``schema``: new columns are added, null in the old rows; wider types rewrite the table once,
    aside, with a swap by name. True when anything changed."""
    added, widened = drift(spark, table, schema)
    if ensure_table(spark, table, schema, fmt):
        return True
    if widened:
        old = spark.table(table)
        wider = [F.col(f"`{c}`").cast(widened[c]).alias(c) if c in widened else F.col(f"`{c}`") for c in old.columns]
        overwrite_table(old.select(*wider, *[F.lit(None).cast(f.dataType).alias(f.name) for f in added]), table, fmt)
    elif added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return bool(added or widened)


def append_rows(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append by name: columns that ``df`` lacks are null, and values take the table's types."""
    have = {c.lower(): c for c in df.columns}
    fields = df.sparkSession.table(table).schema.fields
    values = [F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None) for f in fields]
    append_table(df.select(*[x.cast(f.dataType).alias(f.name) for x, f in zip(values, fields, strict=True)]), table, fmt)


def load_day(df: DataFrame, table: str, day: str, fmt: str = "parquet") -> None:
    """Replace the days of ``df`` in a table that is partitioned by the column ``day``; other days are not touched.

    A day that is loaded again leaves one copy. The table is created on the first load. A load without rows changes nothing.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.limit(0).write.format(fmt).partitionBy(day).saveAsTable(table)
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(setting, before)


def has_rows(df: DataFrame) -> bool:
    """Stops at the first row instead of counting them all."""
    return not df.isEmpty()
