"""JSON and CSV scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, multi_line: bool = True, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON documents. A multi-line file is one task; prefer JSON lines (``multi_line=False``) for large data."""
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header line and inferred types, which costs one more pass over the text."""
    return spark.read.csv(path, header=True, inferSchema=True, sep=sep)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str, skip_header: bool = True, sep: str = ",") -> DataFrame:
    """CSV with declared columns; the header line is skipped, not trusted."""
    return spark.read.schema(schema).options(header=skip_header, enforceSchema=True, sep=sep).csv(path)


def load_tsv(spark: SparkSession, path: str, schema: T.StructType | str, skip_header: bool = True) -> DataFrame:
    return load_csv(spark, path, schema, skip_header, sep="\t")
