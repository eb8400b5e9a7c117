"""Record checks on customers rendered as JSON, with faults planted by the customer number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.common import query, table
from quillbar.operators import validate as v
from quillbar.plans.registry import FieldRule, TableSpec
from quillbar.session import scratch_path
from quillbar.streaming import ingest

SPEC = TableSpec("demo", "members", (
    FieldRule("name", "STRING", True),
    FieldRule("age", "INTEGER", True),
    FieldRule("email", "STRING", True),
    FieldRule("balance", "FLOAT", False),
    FieldRule("active", "BOOLEAN", False),
    FieldRule("joined", "TIMESTAMP", False),
))

# The planted faults, in SQL that Spark and the oracle both understand; k is the customer number.
FIELDS = {
    "name": "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN rpad(c_name, 256, 'x') ELSE c_name END",
    "age": "CASE WHEN k % 7 = 0 THEN '29.99' WHEN k % 29 = 0 THEN NULL ELSE CAST(k % 90 AS {text}) END",
    "email": "CASE WHEN k % 23 = 0 THEN 'broken.at.example' ELSE concat(lower(c_name), '@example.com') END",
    "balance": "CASE WHEN k % 17 = 0 THEN 'n/a' WHEN k % 6 = 0 THEN NULL ELSE CAST(k % 1000 AS {text}) END",
    "active": "CASE WHEN k % 5 = 0 THEN 'yes' WHEN k % 3 = 0 THEN 'true' ELSE 'false' END",
    "joined": "CASE WHEN k % 19 = 0 THEN 'not a date' ELSE concat('2024-01-', lpad(CAST(k % 28 + 1 AS {text}), 2, '0'), ' 06:30:00') END",
}


def records(spark, sf) -> DataFrame:
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    named = rows.select("k", *[F.expr(e.format(text="STRING")).alias(n) for n, e in FIELDS.items()])
    return named.select("k", F.floor(F.col("k") / 3).alias("batch_id"), F.to_json(F.struct(*FIELDS)).alias("record"))


RECORDS_SQL = f"""c AS (SELECT c_custkey AS k, c_name FROM customer),
    r AS (SELECT k, k // 3 AS batch_id, {", ".join(f"{e.format(text='VARCHAR')} AS {n}" for n, e in FIELDS.items())} FROM c)"""
REQUIRED_SQL = " UNION ALL ".join(f"SELECT k, '{n}' AS field, '{v.REQUIRED}' AS message FROM r WHERE {n} IS NULL" for n in ("name", "age", "email"))
TYPES_SQL = " UNION ALL ".join(
    f"SELECT k, '{n}' AS field, '{v.WRONG_TYPE[t]}' AS message FROM r WHERE {n} IS NOT NULL AND NOT {ok}"
    for n, t, ok in (
        ("age", "INTEGER", "regexp_full_match(age, '[+-]?[0-9]+')"),
        ("balance", "FLOAT", "regexp_full_match(balance, '[+-]?[0-9]+(\\.[0-9]+)?')"),
        ("active", "BOOLEAN", "lower(active) IN ('true', 'false')"),
        ("joined", "TIMESTAMP", "try_cast(joined AS TIMESTAMP) IS NOT NULL"),
    )
)
LENGTH_SQL = f"SELECT k, 'name' AS field, '{v.TOO_LONG}' AS message FROM r WHERE length(name) > 255"
EMAIL_SQL = f"SELECT k, 'email' AS field, '{v.BAD_EMAIL}' AS message FROM r WHERE email NOT LIKE '%_@_%.%'"
ALL_SQL = f"{REQUIRED_SQL} UNION ALL {TYPES_SQL} UNION ALL {LENGTH_SQL}"


def _errors(spark, sf, message=None, email=()):
    found = v.error_rows(v.validate(records(spark, sf), SPEC, email_fields=email), ["k"])
    return found.filter(F.col("message").isin(*message)) if message else found


@query("validate_required", f"WITH {RECORDS_SQL} {REQUIRED_SQL}")
def validate_required(spark, sf):
    return _errors(spark, sf, [v.REQUIRED])


@query("validate_types", f"WITH {RECORDS_SQL} {TYPES_SQL}")
def validate_types(spark, sf):
    return _errors(spark, sf, list(v.WRONG_TYPE.values()))


@query("validate_length", f"WITH {RECORDS_SQL} {LENGTH_SQL}")
def validate_length(spark, sf):
    return _errors(spark, sf, [v.TOO_LONG])


@query("validate_email", f"WITH {RECORDS_SQL} {EMAIL_SQL}")
def validate_email(spark, sf):
    return _errors(spark, sf, [v.BAD_EMAIL], ["email"])


@query("validate_batch_atomic", f"""
    WITH {RECORDS_SQL}, e AS ({ALL_SQL}), bad AS (SELECT DISTINCT batch_id FROM r JOIN e USING (k))
    SELECT k, batch_id, batch_id NOT IN (SELECT batch_id FROM bad) AS accepted FROM r""")
def validate_batch_atomic(spark, sf):
    """One bad record rejects its batch of three."""
    return v.mark_batches(v.validate(records(spark, sf), SPEC)).select("k", "batch_id", "accepted")


@query("validate_record_split", f"""
    WITH {RECORDS_SQL}, e AS ({ALL_SQL})
    SELECT name, CAST(age AS BIGINT) AS age, email, CAST(balance AS DOUBLE) AS balance, CAST(active AS BOOLEAN) AS active, CAST(joined AS TIMESTAMP) AS joined
    FROM r WHERE k NOT IN (SELECT k FROM e)""")
def validate_record_split(spark, sf):
    """Record by record: the typed values of the good ones."""
    marked = v.mark_batches(v.validate(records(spark, sf), SPEC), atomic=False)
    return v.accepted_rows(marked).withColumn("joined", F.col("joined").cast("timestamp_ntz"))


@query("stream_checked_ingest", f"""
    WITH {RECORDS_SQL}, e AS ({ALL_SQL})
    SELECT name, CAST(age AS BIGINT) AS age, email, CAST(balance AS DOUBLE) AS balance, CAST(active AS BOOLEAN) AS active, CAST(joined AS TIMESTAMP) AS joined
    FROM r WHERE k NOT IN (SELECT k FROM e)""")
def stream_checked_ingest(spark, sf):
    """The same records as arriving JSON-line files: stream, check, append, read the accepted table."""
    root = scratch_path(spark, "ingest")
    records(spark, sf).select("record").write.text(f"{root}/in")
    ingest.start_ingest(ingest.read_records(spark, f"{root}/in"), SPEC, f"{root}/good", f"{root}/bad", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/good").drop("batch_id").withColumn("joined", F.col("joined").cast("timestamp_ntz"))
