"""Record checks against a declared table: required, type, length, e-mail, all-or-nothing batches.

A record is JSON text. It is parsed once into texts, which keeps "missing" apart from "wrong type"; every rule is a column
expression on those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillbar.plans.registry import FieldRule, TableSpec

# Error texts and limits.
REQUIRED = "This field is required."
MAX_TEXT = 255
TOO_LONG = f"Ensure this field has no more than {MAX_TEXT} characters."
WRONG_TYPE = {
    "INTEGER": "A valid integer is required.",
    "FLOAT": "A valid number is required.",
    "BOOLEAN": "Must be a valid boolean.",
    "TIMESTAMP": "Datetime has wrong format.",
}
BAD_EMAIL = "Enter a valid email address."
NOT_AN_OBJECT = "This record must be a JSON object."
EMAIL = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$"
NO_ERRORS = "array<struct<field:string,message:string>>"
MALFORMED = "_malformed"


def typed(text: Column, rule: FieldRule) -> Column:
    """The declared type, or null when the text does not fit it."""
    if rule.type == "BOOLEAN":
        low = F.lower(text)
        return F.when(low.isin("true", "false"), low == "true")
    sql_type = {"INTEGER": "bigint", "FLOAT": "double", "TIMESTAMP": "timestamp"}.get(rule.type)
    return text.try_cast(sql_type) if sql_type else text


def field_error(text: Column, rule: FieldRule, email: bool = False) -> Column:
    """The first rule that ``text`` breaks, as ``{field, message}``; null when it is fine."""
    def err(message: str) -> Column:
        return F.struct(F.lit(rule.name).alias("field"), F.lit(message).alias("message"))

    checks = []
    if rule.required:
        checks.append((text.isNull(), REQUIRED))
    if rule.type in WRONG_TYPE:
        checks.append((text.isNotNull() & typed(text, rule).isNull(), WRONG_TYPE[rule.type]))
    if rule.type == "STRING":
        checks.append((F.length(text) > MAX_TEXT, TOO_LONG))
    if email:
        checks.append((text.isNotNull() & ~text.rlike(EMAIL), BAD_EMAIL))
    out = F.lit(None).cast("struct<field:string,message:string>")
    for broken, message in reversed(checks):
        out = F.when(broken, err(message)).otherwise(out)
    return out


def validate(df: DataFrame, spec: TableSpec, record: str = "record", email_fields: Sequence[str] = ()) -> DataFrame:
    """Adds ``errors`` (an array, empty for a good record) and ``value`` (the typed record).

    Every declared field is parsed as text, so that a wrong type is told apart from a missing value. Both columns come
    out of a one-row generator: filters on them cannot move below it, where each use of a field would parse the record
    again.
    """
    fields = T.StructType([T.StructField(r.name, T.StringType()) for r in spec.fields] + [T.StructField(MALFORMED, T.StringType())])
    parsed = df.withColumn("_m", F.from_json(record, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}))
    texts = {r.name: F.col("_m").getField(r.name) for r in spec.fields}
    broken = [field_error(texts[r.name], r, r.name in email_fields) for r in spec.fields]
    listed = F.concat(*[F.when(e.isNull(), F.array().cast(NO_ERRORS)).otherwise(F.array(e)) for e in broken])
    whole = F.array(F.struct(F.lit("records").alias("field"), F.lit(NOT_AN_OBJECT).alias("message")))
    no_object = F.col("_m").isNull() | F.col("_m").getField(MALFORMED).isNotNull()
    errors = F.when(no_object, whole).otherwise(listed)
    value = F.struct(*[typed(texts[r.name], r).alias(r.name) for r in spec.fields])
    return parsed.select(
        *df.columns, F.inline(F.array(F.struct(errors.cast(NO_ERRORS).alias("errors"), value.alias("value"))))
    )


RULES = "array<struct<name:string,type:string,required:boolean>>"


def rule_list(spec: TableSpec) -> Column:
    """The fields of a table as data."""
    rules = [F.struct(F.lit(r.name).alias("name"), F.lit(r.type).alias("type"), F.lit(r.required).alias("required")) for r in spec.fields]
    return F.array(*rules).cast(RULES)


def broken_rule(text: Column, kind: Column, required: Column) -> Column:
    """The message of the first rule that ``text`` breaks, with the rule as data; null when it is fine."""
    wrong = [F.when((kind == k) & typed(text, FieldRule("", k, False)).isNull(), F.lit(m)) for k, m in WRONG_TYPE.items()]
    long = F.when((kind == "STRING") & (F.length(text) > MAX_TEXT), F.lit(TOO_LONG))
    return F.when(text.isNull(), F.when(required, F.lit(REQUIRED))).otherwise(F.coalesce(*wrong, long))


def check_record(record: Column, rules: Column) -> Column:
    """``{errors, texts}`` of JSON text under a list of rules, whichever table they come from: ``texts`` are the declared fields in order.

    The record is parsed into a map of texts, so one expression serves any number of tables. Of a name that a record has twice the
    last value counts.
    """
    def last(entries: Column, name: Column) -> Column:
        return F.element_at(F.filter(entries, lambda e: e["key"] == name), -1)["value"]

    def checked(entries: Column) -> Column:
        texts = F.transform(rules, lambda r: F.when(F.exists(entries, lambda e: e["key"] == r["name"]), last(entries, r["name"])))
        told = F.transform(rules, lambda r: F.struct(r["name"].alias("field"), broken_rule(
            F.when(F.exists(entries, lambda e: e["key"] == r["name"]), last(entries, r["name"])), r["type"], r["required"]).alias("message")))
        whole = F.array(F.struct(F.lit("records").alias("field"), F.lit(NOT_AN_OBJECT).alias("message"))).cast(NO_ERRORS)
        errors = F.when(entries.isNull(), whole).otherwise(F.filter(told, lambda e: e["message"].isNotNull()).cast(NO_ERRORS))
        return F.struct(errors.alias("errors"), texts.alias("texts"))

    entries = F.map_entries(F.from_json(record, "map<string,string>"))
    return F.get(F.transform(F.array(entries), checked), F.lit(0))


def is_good() -> Column:
    return F.size("errors") == 0


def mark_batches(validated: DataFrame, batch: str = "batch_id", atomic: bool = True) -> DataFrame:
    """Adds ``accepted``. With ``atomic`` one bad record rejects its whole batch.

    Bad batches are found by an aggregate, then joined back. A window over the batch would pull a huge batch into one
    task; here only the ids of bad batches meet the rows, and AQE splits or broadcasts by size. Nothing runs before the result
    is asked for. ``validated`` is read twice: write it down first if it is expensive, as ``load_records`` does.
    """
    if not atomic:
        return validated.withColumn("accepted", is_good())
    bad = validated.filter(~is_good()).groupBy(F.col(batch).alias("_bad")).agg(F.lit(True).alias("_hit"))
    joined = validated.join(bad, F.col(batch).eqNullSafe(F.col("_bad")), "left")
    return joined.withColumn("accepted", F.col("_hit").isNull()).drop("_bad", "_hit")


def accepted_rows(marked: DataFrame) -> DataFrame:
    return marked.filter("accepted").select("value.*")


def rejected_rows(marked: DataFrame) -> DataFrame:
    return marked.filter("NOT accepted").drop("value")


def error_rows(validated: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per broken rule."""
    return validated.select(*keep, F.explode("errors").alias("_e")).select(*keep, "_e.field", "_e.message")
