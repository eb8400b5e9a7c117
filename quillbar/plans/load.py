"""Checked loads: validate, create or widen the table, append, hand back what was refused."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbar.operators import validate as v
from quillbar.plans.registry import Registry, TableSpec
from quillbar.session import scratch_path
from quillbar.sources import sinks


def _prepare(spark, specs: Sequence[TableSpec]) -> None:
    """Databases and tables as declared. Every table is compared before the first one is touched, so a declaration that would narrow
    a table stops the load with nothing written."""
    for spec in specs:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{spec.dataset}`")
    for spec in specs:
        sinks.drift(spark, spec.full_name, spec.spark_schema())
    for spec in specs:
        sinks.reconcile_table(spark, spec.full_name, spec.spark_schema())


def load_records(batch: DataFrame, registry: Registry, table: str | None = None, atomic: bool = True,
                 record: str = "record", batch_id: str | None = None, email_fields: Sequence[str] = ()) -> DataFrame:
    """Append the accepted records and return the refused ones with their errors.

    Without ``batch_id`` the whole input is one batch. The registry is asked first, so a wrong table starts no job; a table that
    exists with fewer or narrower columns is widened, and a declaration that would narrow it fails before any write. Each record
    is parsed once: the checked rows are written to the shared scratch folder, and bad batches, accepted and refused rows are
    taken from there.
    """
    spec = registry.resolve(table)
    spark = batch.sparkSession
    _prepare(spark, [spec])
    rows = batch if batch_id else batch.withColumn("_batch", F.lit(0))
    staged = scratch_path(spark, "checked")
    v.validate(rows, spec, record, email_fields).write.parquet(staged)
    marked = v.mark_batches(spark.read.parquet(staged), batch_id or "_batch", atomic)
    sinks.append_rows(v.accepted_rows(marked), spec.full_name)
    return v.rejected_rows(marked).drop("_batch")


BODY = "struct<table_name:string, records:array<string>, _malformed:string>"


def parse_request(body: DataFrame, text: str = "body") -> DataFrame:
    """Request bodies to one row per record. A body is parsed once.

    A body that is not a JSON object, or whose ``records`` is there but not a list, gives one row with ``bad_request``. An empty, null or
    missing list is a request without records and gives no row.
    """
    keep = [c for c in body.columns if c != text]
    parsed = body.withColumn("_r", F.from_json(text, BODY, {"columnNameOfCorruptRecord": "_malformed"}))
    bad = F.col("_r").isNull() | F.col("_r._malformed").isNotNull()
    records = F.when(bad, F.array(F.lit(None).cast("string"))).otherwise(F.coalesce("_r.records", F.array().cast("array<string>")))
    # Behind a one-row generator, so that later uses do not repeat the parse.
    once = F.struct(F.col("_r.table_name").alias("table_name"), bad.alias("bad_request"), records.alias("_records"))
    rows = parsed.select(*keep, F.inline(F.array(once)))
    return rows.select(*keep, "table_name", "bad_request", F.explode("_records").alias("record"))


UNKNOWN_TABLE = "unknown table"
BAD_REQUEST = "records must be a list"
_NOWHERE = -1


def _route(table: Column, names: Sequence[str | None]) -> Column:
    """The place of the destination in ``names`` (null is the default table), -1 for an unknown one."""
    named = [x for i, n in enumerate(names) if n is not None for x in (F.lit(n), F.lit(i))]
    default = names.index(None) if None in names else _NOWHERE
    known = F.try_element_at(F.create_map(*named), table) if named else F.lit(None).cast("int")
    return F.when(table.isNull(), F.lit(default)).otherwise(F.coalesce(known, F.lit(_NOWHERE)))


def stage_requests(bodies: DataFrame, specs: Sequence[TableSpec], names: Sequence[str | None], request: str, text: str) -> DataFrame:
    """One row per record with its destination ``_to``, its ``errors`` and the texts of the declared fields; nothing is written."""
    parsed = parse_request(bodies.select(request, text), text)
    to = F.when(F.col("bad_request"), _NOWHERE).otherwise(_route(F.col("table_name"), names))
    why = F.when(F.col("bad_request"), F.lit(BAD_REQUEST)).otherwise(F.lit(UNKNOWN_TABLE))
    field = F.when(F.col("bad_request"), F.lit("records")).otherwise(F.lit("table_name"))
    refused = F.struct(F.array(F.struct(field.alias("field"), why.alias("message"))).cast(v.NO_ERRORS).alias("errors"), F.array().cast("array<string>").alias("texts"))
    routed = parsed.withColumn("_to", to)
    rules = F.get(F.array(*[v.rule_list(s) for s in specs]), F.col("_to")) if specs else F.array().cast(v.RULES)
    checked = F.when(F.col("_to") == _NOWHERE, refused).otherwise(v.check_record(F.col("record"), rules))
    return routed.select(request, "table_name", "record", "_to", F.inline(F.array(checked)))


def load_requests(bodies: DataFrame, registry: Registry, request: str = "request_id", text: str = "body") -> DataFrame:
    """Load request bodies into the tables that they name; a body without ``table_name`` goes to the default table.

    A body is all or nothing. Returned are the refused rows: ``request``, ``table_name``, ``record``, ``errors``, the last with the field and
    message of each broken rule, or one message for an unknown table or a bad body.

    However many tables are registered, bodies and records are read and parsed in one pass: the checked rows are written to the shared
    scratch folder by destination, and each table that got any reads its own part. Tables are created or widened first; a declaration that
    would narrow one stops the load before any write.
    """
    spark = bodies.sparkSession
    names: list[str | None] = [*registry.names(), *([None] if registry.default else [])]
    specs = [registry.resolve(n) for n in names]
    _prepare(spark, specs)
    rows, path = stage_requests(bodies, specs, names, request, text), scratch_path(spark, "requests")
    rows.write.partitionBy("_to").parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    bad = staged.filter((F.col("_to") != _NOWHERE) & ~v.is_good()).select(F.col(request).alias("_bad"), F.col("_to").alias("_of")).distinct()
    same = F.col(request).eqNullSafe(F.col("_bad"))
    for place in sorted(r["_to"] for r in staged.select("_to").distinct().collect() if r["_to"] != _NOWHERE):
        spec, mine = specs[place], F.col("_to") == place
        values = [v.typed(F.get("texts", F.lit(i)), r).alias(r.name) for i, r in enumerate(spec.fields)]
        good = staged.filter(mine).join(bad.filter(F.col("_of") == place), same, "left_anti")
        sinks.append_rows(good.select(*values), spec.full_name)
    whole = staged.join(bad, same & (F.col("_to") == F.col("_of")), "left_semi").unionByName(staged.filter(F.col("_to") == _NOWHERE))
    return whole.select(request, "table_name", "record", "errors")
