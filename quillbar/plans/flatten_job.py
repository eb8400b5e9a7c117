"""A flatten job described by a mapping file: project, pivot, clean, write."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbar.functions.text import clean_all_strings
from quillbar.operators.flatten import ArrayPivot, fail_on_clash, pivot_columns
from quillbar.sources import sinks, xml


@dataclass(frozen=True)
class FlattenJob:
    columns: list[tuple[str, str]]
    pivots: list[ArrayPivot] = field(default_factory=list)
    source: str | None = None
    row_tag: str | None = None
    schema_path: str | None = None
    target: str | None = None

    @classmethod
    def from_dict(cls, d: dict) -> FlattenJob:
        """Reads the mapping layout: flatten_cols (path, alias), pivot_arrays (path, pivot_prefix, max_items, ...)."""
        pivots = [
            ArrayPivot(
                path=p["path"],
                prefix=p["pivot_prefix"],
                max_items=p["max_items"],
                fields=[(f["original"], f["new_suffix"]) for f in p["struct_fields"]] if p.get("is_struct") else None,
            )
            for p in d.get("pivot_arrays", [])
        ]
        return cls(
            columns=[(c["path"], c["alias"]) for c in d["flatten_cols"]],
            pivots=pivots,
            source=d.get("source_xml_path"),
            row_tag=d.get("row_tag"),
            schema_path=d.get("schema_path"),
            target=d.get("target_path"),
        )

    @classmethod
    def from_file(cls, spark: SparkSession, path: str) -> FlattenJob:
        return cls.from_dict(json.loads(xml.read_small_text(spark, path)))


def shape(df: DataFrame, job: FlattenJob) -> DataFrame:
    """The whole mapping as one projection, then one cleaning projection; Catalyst merges the two.

    One path may feed several columns; a column name that is given twice fails.
    """
    wide = [F.col(p).alias(a) for p, a in job.columns]
    for p in job.pivots:
        wide += pivot_columns(p.path, p.prefix, p.max_items, p.fields)
    shaped = df.select(*wide)
    fail_on_clash(shaped.columns)
    return clean_all_strings(shaped)


def run(spark: SparkSession, job: FlattenJob, single_file: bool = False, split: bool = False) -> DataFrame:
    """Read with the saved schema, shape, write tab-separated files. The input is read once; ``split`` shares big files among tasks."""
    schema = xml.load_schema(spark, job.schema_path)
    read = xml.read_xml_split if split else xml.read_xml
    out = shape(read(spark, job.source, job.row_tag, schema), job)
    sinks.write_tsv(out, job.target, single_file=single_file)
    return out
