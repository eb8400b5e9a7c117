"""File and table round trips: what is written comes back the same, and the loads built on that."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.common import ORACLES, query, table, text_documents
from catalog.records import ALL_SQL, RECORDS_SQL, SPEC, records
from quillbar.functions import scalars, text
from quillbar.operators import flatten, relational
from quillbar.operators import validate as v
from quillbar.plans import kept_sums
from quillbar.plans.load import load_records, load_requests, parse_request
from quillbar.plans.registry import Registry
from quillbar.session import scratch_path
from quillbar.sources import files, json_split, sinks, synthetic, xml


def _database(spark) -> str:
    """A database of its own whose tables live in the shared scratch folder."""
    name = f"check_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


@query("csv_fixed_load", "SELECT * REPLACE (CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS INTEGER) AS c_nationkey) FROM customer")
def csv_fixed_load(spark, sf):
    """CSV out with a header, in with declared columns; the key stays text."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "customer"), path)
    return files.load_csv(spark, path, "c_custkey string, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


@query("csv_inferred_load", "SELECT * REPLACE (CAST(c_custkey AS INTEGER) AS c_custkey, CAST(c_nationkey AS INTEGER) AS c_nationkey) FROM customer")
def csv_inferred_load(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "customer"), path)
    return files.read_csv(spark, path)


@query("tsv_roundtrip", ORACLES["clean_all_strings"].replace("SELECT doc_id,", "SELECT CAST(doc_id AS VARCHAR) AS doc_id,").replace(" n_chars", " CAST(n_chars AS VARCHAR) AS n_chars"))
def tsv_roundtrip(spark, sf):
    """Cleaned documents as tab-separated text and back; an empty value comes back as null and is filled again."""
    path = scratch_path(spark, "tsv")
    sinks.write_tsv(text.clean_all_strings(table(spark, sf, "documents")), path)
    return text.fill_empty(files.load_tsv(spark, path, "doc_id string, text string, lang string, source string, n_chars string"))


@query("json_scan_flatten", ORACLES["flatten_outer"])
def json_scan_flatten(spark, sf):
    """Nested documents as JSON lines, read with the declared schema and flattened."""
    path = scratch_path(spark, "json")
    docs = text_documents(spark, sf)
    docs.write.option("ignoreNullFields", False).json(path)
    return flatten.flatten_outer(files.read_json(spark, path, multi_line=False, schema=docs.schema))


@query("xml_inferred_catalog", ORACLES["synthetic_catalog"])
def xml_inferred_catalog(spark, sf):
    """A catalog as XML, its schema inferred from a scan, saved, loaded and used for the real read."""
    root = scratch_path(spark, "catalog")
    books = synthetic.synthetic_catalog(table(spark, sf, "part").select("p_partkey"), "p_partkey")
    sinks.write_xml(books, f"{root}/xml", "catalog", "book")
    xml.infer_schema(spark, f"{root}/xml", "book", f"{root}/schema")
    back = xml.read_xml(spark, f"{root}/xml", "book", xml.load_schema(spark, f"{root}/schema"))
    flat = back.select("_id", "author", "title", "genre", "price", "publish_date", "onemorecolumn", "secondcoloum",
                       F.explode_outer("reviewers.reviewer").alias("r"))
    return flat.select(
        F.col("_id").alias("book_id"), F.col("author.name.first").alias("first"), F.col("author.name.last").alias("last"), "title", "genre", "price",
        F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"),
        *[F.coalesce(F.array_join(f"{c}.col1", ","), F.lit("")).alias(n) for c, n in (("onemorecolumn", "first_values"), ("secondcoloum", "second_values"))],
        F.col("r._stars").alias("stars"), F.col("r.name").alias("reviewer"), F.col("r.comment").alias("comment"),
    )


@query("load_and_aggregate_tables", """
    SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderpriority AS name, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS sum_value FROM orders GROUP BY 1, 2""")
def load_and_aggregate_tables(spark, sf):
    """CSV into a table that is truncated first, then a second table created from its grouped sums."""
    db, path = _database(spark), scratch_path(spark, "csv")
    orders = table(spark, sf, "orders")
    sinks.write_csv(orders.select(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("data_value")), path)
    loaded = files.load_csv(spark, path, "year string, name string, data_value decimal(18,2)")
    for _ in range(2):
        sinks.truncate_and_load(loaded, f"{db}.values")
    sinks.overwrite_table(relational.sum_by(spark.table(f"{db}.values"), ["year", "name"], "data_value", "sum_value"), f"{db}.sums")
    return spark.table(f"{db}.sums").withColumn("sum_value", F.col("sum_value").cast("double"))


@query("append_tables", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer")
def append_tables(spark, sf):
    """Create an empty table from a schema, append twice."""
    name, rows = f"{_database(spark)}.t", table(spark, sf, "customer").select("c_custkey", "c_name")
    sinks.ensure_table(spark, name, rows.schema)
    for _ in range(2):
        sinks.append_table(rows, name)
    return spark.table(name)


@query("checked_load", f"""
    WITH {RECORDS_SQL}, e AS ({ALL_SQL})
    SELECT name, CAST(age AS BIGINT) AS age, email, CAST(balance AS DOUBLE) AS balance, CAST(active AS BOOLEAN) AS active, CAST(joined AS TIMESTAMP) AS joined
    FROM r WHERE batch_id NOT IN (SELECT batch_id FROM r JOIN e USING (k))""")
def checked_load(spark, sf):
    """Records of many batches into a declared table; a batch with one bad record stays out."""
    db = _database(spark)
    schema = [{"name": f.name, "field_type": f.type, "mode": "REQUIRED" if f.required else "NULLABLE"} for f in SPEC.fields]
    registry = Registry({"tables": {"members": {"dataset_id": db, "table_id": "members", "schema": schema}}})
    load_records(records(spark, sf), registry, "members", batch_id="batch_id")
    return spark.table(f"{db}.members").withColumn("joined", F.col("joined").cast("timestamp_ntz"))


WRONG_AGE = v.WRONG_TYPE["INTEGER"]
REQUEST_TABLES = """q AS (SELECT c_custkey AS k, c_name, c_custkey % 4 AS t FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0),
    r AS (SELECT k, t, c_name AS name, CASE WHEN k % 11 = 0 THEN NULL ELSE k % 90 END AS age FROM q UNION ALL SELECT k, t, c_name || '-2', 1 FROM q),
    good AS (SELECT * FROM r WHERE k NOT IN (SELECT k FROM r WHERE age IS NULL))"""


@query("requests_to_tables", f"""
    WITH {REQUEST_TABLES}
    SELECT CASE t WHEN 0 THEN 'members' WHEN 1 THEN 'goods' ELSE 'fallback' END AS loaded_into, name, CAST(age AS BIGINT) AS age, CAST(NULL AS BIGINT) AS request_id, CAST(NULL AS VARCHAR) AS message
    FROM good WHERE t < 3
    UNION ALL SELECT 'refused', NULL, NULL, c_custkey, 'records must be a list' FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 5 <> 0
    UNION ALL SELECT 'refused', NULL, NULL, k, 'unknown table' FROM r WHERE t = 3
    UNION ALL SELECT 'refused', NULL, NULL, k, CASE WHEN age IS NULL THEN '{WRONG_AGE}' END FROM r WHERE t < 3 AND k IN (SELECT k FROM r WHERE age IS NULL)""")
def requests_to_tables(spark, sf):
    """Bodies for two tables, the default table and an unknown one; some empty, some without a list, some with one bad record."""
    db, k = _database(spark), F.col("c_custkey")
    columns = [{"name": "name", "field_type": "STRING", "mode": "REQUIRED"}, {"name": "age", "field_type": "INTEGER", "mode": "REQUIRED"}]
    spec = lambda name: {"dataset_id": db, "table_id": name, "schema": columns}
    registry = Registry({"default": spec("fallback"), "tables": {"members": spec("members"), "goods": spec("goods")}})
    age = F.when(k % 11 == 0, F.lit("old")).otherwise((k % 90).cast("string"))
    records = F.to_json(F.array(F.struct(F.col("c_name").alias("name"), age.alias("age")), F.struct(F.concat("c_name", F.lit("-2")).alias("name"), F.lit("1").alias("age"))))
    listed = F.when(k % 5 == 0, F.lit("[]")).when(k % 7 == 0, F.lit('"none"')).otherwise(records)
    named = F.when(k % 4 == 0, '"table_name": "members", ').when(k % 4 == 1, '"table_name": "goods", ').when(k % 4 == 3, '"table_name": "nowhere", ').otherwise("")
    bodies = table(spark, sf, "customer").select(k.alias("request_id"), F.concat(F.lit("{"), named, F.lit('"records": '), listed, F.lit("}")).alias("body"))
    refused = load_requests(bodies, registry).select(
        F.lit("refused").alias("loaded_into"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("bigint").alias("age"), "request_id",
        F.get(F.transform("errors", lambda e: e["message"]), F.lit(0)).alias("message"))
    for name in ("members", "goods", "fallback"):
        rows = spark.table(f"{db}.{name}").select(F.lit(name).alias("loaded_into"), "name", "age")
        refused = refused.unionByName(rows, allowMissingColumns=True)
    return refused


@query("json_multiline_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_multiline_scan(spark, sf):
    """Customers in JSON arrays that run over many lines, a hundred to a file."""
    path = scratch_path(spark, "json")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    arrays = rows.groupBy(F.floor(F.col("c_custkey") / 100)).agg(F.collect_list(F.struct(*rows.columns)).alias("all"))
    arrays.select(F.to_json("all", {"pretty": "true"}).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return files.read_json(spark, path, schema=rows.schema)


@query("shouted_names", "SELECT c_custkey, upper(trim('  ' || c_name || ' ', ' ')) AS shouted FROM customer")
def shouted_names(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.shout(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("shouted"))


@query("request_bodies", """
    SELECT user_id, coalesce(event_id, NULL) AS event_id, bad_request FROM (
      SELECT user_id, event_id, user_id % 7 = 0 AS bad_request FROM events WHERE user_id % 7 <> 0
      UNION ALL SELECT DISTINCT user_id, CAST(NULL AS BIGINT), true FROM events WHERE user_id % 7 = 0)""")
def request_bodies(spark, sf):
    """Request bodies with a list of records each; in every seventh the list is missing."""
    events = table(spark, sf, "events").select("user_id", "event_id")
    lists = flatten.nest_rows(events, "user_id", ["event_id"], {"event_id": "event_id"}, array="records", max_items=1_000)
    body = F.when(F.col("user_id") % 7 == 0, F.lit('{"records": {"a": 1}}')).otherwise(F.to_json(F.struct(F.lit("t").alias("table_name"), "records")))
    lists = lists.filter("user_id % 7 <> 0 OR part = 0")
    parsed = parse_request(lists.select("user_id", body.alias("body")))
    return parsed.select("user_id", F.get_json_object("record", "$.event_id").cast("bigint").alias("event_id"), "bad_request")


@query("parsed_timestamps", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS parsed FROM orders""")
def parsed_timestamps(spark, sf):
    """Timestamps from text; what does not parse is null."""
    shown = F.when(F.col("o_orderkey") % 5 == 0, F.lit("soon")).otherwise(scalars.timestamp_text(F.col("o_orderdate")))
    return table(spark, sf, "orders").select("o_orderkey", scalars.parse_timestamp(shown).cast("timestamp_ntz").alias("parsed"))


@query("json_split_scan", """
    SELECT c_custkey, c_name || CASE c_custkey % 4 WHEN 0 THEN ' } "{[' WHEN 1 THEN ' \\' WHEN 2 THEN ' ]]}' || chr(10) ELSE '' END AS note, c_acctbal FROM customer""")
def json_split_scan(spark, sf):
    """All customers in one JSON array over many lines, with braces, marks and escapes in strings, cut by many tasks."""
    path, k = scratch_path(spark, "json"), F.col("c_custkey")
    more = F.when(k % 4 == 0, F.lit(' } "{[')).when(k % 4 == 1, F.lit(" \\")).when(k % 4 == 2, F.lit(" ]]}\n")).otherwise("")
    rows = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", more).alias("note"), "c_acctbal")
    # One file as the thing to read, so one task writes it: an element a row, with the array's brackets and commas.
    texts = rows.orderBy("c_custkey").select(F.to_json(F.struct(*rows.columns), {"pretty": "true"}).alias("value")).coalesce(1)
    i, n = F.monotonically_increasing_id(), rows.count()
    texts.select(F.concat(F.when(i == 0, "[\n").otherwise(",\n"), "value", F.when(i == n - 1, "\n]").otherwise(""))).write.text(path)
    return json_split.read_json_split(spark, path, rows.schema)


@query("xml_merged_schema", """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS code, CAST(l_linenumber AS BIGINT) AS line, CASE WHEN l_linenumber > 3 THEN l_shipmode END AS mode,
           CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 7 AS DOUBLE) ELSE o_orderkey % 7 + 0.5 END AS weight
    FROM orders JOIN (SELECT *, l_returnflag AS l_shipmode FROM lineitem) ON o_orderkey = l_orderkey WHERE l_linenumber <= 5""")
def xml_merged_schema(spark, sf):
    """Orders in two sets of files: with single items and whole weights in one, with repeated items and broken weights in the other. One
    merged schema reads them back whole; codes with leading zeros stay text."""
    path, k = scratch_path(spark, "xml"), F.col("l_orderkey")
    items = table(spark, sf, "lineitem").filter("l_linenumber <= 5").select(k, F.struct(F.col("l_linenumber").alias("line"), F.when(F.col("l_linenumber") > 3, F.col("l_returnflag")).alias("mode")).alias("i"))
    # At most five items to an order.
    orders = items.join(table(spark, sf, "orders").select("o_orderkey"), k == F.col("o_orderkey")).groupBy(k).agg(F.array_sort(F.collect_list("i")).alias("item"))
    weight = F.when(k % 3 == 0, (k % 7).cast("string")).otherwise((k % 7 + 0.5).cast("string"))
    shown = orders.select(k.alias("k"), F.lpad(k.cast("string"), 8, "0").alias("code"), weight.alias("weight"), "item")
    single = (F.size("item") == 1) & (F.col("k") % 3 == 0)
    sinks.write_xml(shown.filter(single).select("code", "weight", F.get("item", F.lit(0)).alias("item")), f"{path}/single", "orders", "order", records_per_file=50_000)
    sinks.write_xml(shown.filter(~single).drop("k"), f"{path}/many", "orders", "order", records_per_file=50_000)
    schema = xml.merged_schema(spark, f"{path}/*", "order")
    return xml.read_xml(spark, f"{path}/*", "order", schema).select("code", F.explode("item").alias("i"), "weight").select("code", "i.line", "i.mode", "weight")


@query("grown_table_load", """
    SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS c_acctbal, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer""")
def grown_table_load(spark, sf):
    """A table that was made for half of the rows, then gets one more column and two wider types from its declaration."""
    name, rows = f"{_database(spark)}.t", table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    old = rows.filter("c_custkey % 2 = 0").select(F.col("c_custkey").cast("int").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"))
    new = rows.filter("c_custkey % 2 = 1").withColumns({"c_custkey": F.col("c_custkey").cast("bigint"), "c_nationkey": F.col("c_nationkey").cast("string")})
    for part in (old, new):
        sinks.reconcile_table(spark, name, part.schema)
        sinks.append_rows(part, name)
    return spark.table(name).select("c_custkey", "c_name", "c_acctbal", "c_nationkey")


@query("load_by_day", "SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def load_by_day(spark, sf):
    """Events by day, each day replaced as a whole: every third day is loaded a second time."""
    name, rows = f"{_database(spark)}.t", table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"))
    sinks.load_day(rows, name, "day")
    sinks.load_day(rows.filter(F.dayofyear("day") % 3 == 0), name, "day")
    return spark.table(name).withColumn("day", F.col("day").cast("string"))


@query("kept_sums", """
    SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) AS sum_value, count(value) AS n_value, max(CAST(value AS DECIMAL(18, 4)))::DOUBLE AS max_value, count(*) AS rows
    FROM events GROUP BY 1""")
def kept_sums_by_type(spark, sf):
    """Sums per type from the kept sums of each day, added in three steps, one day set of them twice."""
    name = f"{_database(spark)}.sums"
    rows = table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"), "event_type", F.col("value").cast("decimal(18,4)").alias("value"))
    for step in (0, 1, 2, 1):
        kept_sums.add_days(rows.filter(F.dayofyear("day") % 3 == step), name, "day", ["event_type"], {"value": "value"})
    sums = kept_sums.totals(spark, name, ["event_type"], ["value"])
    return sums.select("event_type", F.col("sum_value").cast("double").alias("sum_value"), "n_value", F.col("max_value").cast("double").alias("max_value"), "rows")


@query("row_probes", """
    SELECT 'orders' AS name, true AS has_rows, least(5, count(*)) AS shown FROM orders
    UNION ALL SELECT 'orders before 1900', count(*) > 0, least(5, count(*)) FROM orders WHERE year(o_orderdate) < 1900
    UNION ALL SELECT 'nation', count(*) > 0, least(5, count(*)) FROM nation""")
def row_probes(spark, sf):
    """Whether tables hold rows, and how many a preview shows."""
    orders = table(spark, sf, "orders")
    probed = {"orders": orders, "orders before 1900": orders.filter(F.year("o_orderdate") < 1900), "nation": table(spark, sf, "nation")}
    parts = [relational.preview(df, 5).agg(F.count(F.lit(1)).alias("shown")).select(F.lit(n).alias("name"), F.lit(sinks.has_rows(df)).alias("has_rows"), "shown")
             for n, df in probed.items()]
    return parts[0].union(parts[1]).union(parts[2])
