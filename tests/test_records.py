"""Registry, record checks, checked loads, sinks."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillbar.operators import validate as v
from quillbar.plans.load import load_records, load_requests, parse_request
from quillbar.plans.registry import Registry, RegistryError
from quillbar.sources import files, sinks, tables


def columns(*rows):
    return [{"name": n, "field_type": t, "mode": m} for n, t, m in rows]


PEOPLE = columns(("name", "STRING", "REQUIRED"), ("age", "INTEGER", "REQUIRED"), ("email", "STRING", "REQUIRED"))
CONFIG = {
    "default": {"dataset_id": "shop", "table_id": "fallback", "schema": PEOPLE},
    "tables": {
        "users": {"dataset_id": "shop", "table_id": "people", "schema": PEOPLE},
        "products": {"dataset_id": "shop", "table_id": "goods", "schema": columns(
            ("product_id", "STRING", "REQUIRED"), ("name", "STRING", "REQUIRED"), ("price", "FLOAT", "REQUIRED"), ("in_stock", "BOOLEAN", "NULLABLE"))},
        "half": {"dataset_id": "shop", "schema": []},
    },
}
ANN = {"name": "Ann", "age": 28, "email": "ann@example.com"}
BEN = {"name": "Ben", "age": 35, "email": "ben@example.com"}
MOUSE = {"product_id": "P1", "name": "Mouse", "price": 29.99, "in_stock": True}


@pytest.fixture()
def registry():
    return Registry(CONFIG)


@pytest.fixture()
def load(spark, registry):
    spark.sql("DROP DATABASE IF EXISTS shop CASCADE")

    def run(records, table=None, **kw):
        df = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "record string")
        return load_records(df, registry, table, **kw)

    yield run
    spark.sql("DROP DATABASE IF EXISTS shop CASCADE")


def test_default_table(spark, load):
    assert load([ANN, BEN]).count() == 0
    assert {tuple(r) for r in spark.table("shop.fallback").collect()} == {("Ann", 28, "ann@example.com"), ("Ben", 35, "ben@example.com")}
    load([ANN])
    assert spark.table("shop.fallback").count() == 3


def test_named_tables_and_nullable_field(spark, load):
    load([ANN], "users")
    load([MOUSE, {"product_id": "P2", "name": "Hat", "price": 5}], "products")
    assert spark.table("shop.people").count() == 1
    assert {r.product_id: r.in_stock for r in spark.table("shop.goods").collect()} == {"P1": True, "P2": None}


def test_missing_required_field(spark, load):
    refused = load([{"product_id": "P9", "price": 49.99, "in_stock": True}], "products").first()
    assert [tuple(e) for e in refused.errors] == [("name", "This field is required.")]
    assert spark.table("shop.goods").isEmpty()


def test_unknown_and_incomplete_tables(load):
    with pytest.raises(RegistryError, match="'table_id' is missing in the configuration for table 'orders'"):
        load([{"order_id": 1}], "orders")
    with pytest.raises(RegistryError, match="'table_id' is missing in the configuration for table 'half'"):
        load([ANN], "half")


def test_atomic_batch_and_record_split(spark, load):
    bad = dict(BEN, age="x")
    assert load([ANN, bad], "users").count() == 2
    assert spark.table("shop.people").isEmpty()
    refused = load([ANN, bad], "users", atomic=False).collect()
    assert len(refused) == 1 and refused[0].errors[0].message == v.WRONG_TYPE["INTEGER"]
    assert spark.table("shop.people").count() == 1


def test_limits(load):
    messages = [e.message for r in load([dict(ANN, name="n" * 256), dict(ANN, age="x"), dict(ANN, name="n" * 255)], "users", atomic=False).collect() for e in r.errors]
    assert sorted(messages) == sorted([v.TOO_LONG, v.WRONG_TYPE["INTEGER"]])


def test_types(spark, registry):
    spec = registry.resolve("products")
    cases = {"yes": False, "TRUE": True, "false": True, "1": False}
    df = spark.createDataFrame([(k, json.dumps(dict(MOUSE, in_stock=k))) for k in cases], "k string, record string")
    got = {r.k: not r.errors for r in v.validate(df, spec).collect()}
    assert got == cases
    df = spark.createDataFrame([("29.99",), ("30",), ("-4",), ("1e3",), ("",)], "a string")
    ints = {r.a: r.v for r in df.select("a", v.typed(F.col("a"), registry.resolve("users").fields[1]).alias("v")).collect()}
    assert ints == {"29.99": None, "30": 30, "-4": -4, "1e3": None, "": None}


def test_unknown_type_is_text():
    spec = Registry({"default": {"dataset_id": "d", "table_id": "t", "schema": [{"name": "x", "field_type": "GEOGRAPHY"}]}}).resolve()
    assert spec.spark_schema() == T.StructType([T.StructField("x", T.StringType(), True)])


def test_not_an_object(load):
    refused = load(["[1, 2]", "nonsense", json.dumps(ANN)], "users", atomic=False).collect()
    assert {e.field for r in refused for e in r.errors} <= {"records", "name", "age", "email"} and len(refused) == 2


def test_email_rule(spark, registry):
    df = spark.createDataFrame([(json.dumps(dict(ANN, email=e)),) for e in ("a@b.co", "a.b", "a@b")], "record string")
    got = [bool(r.errors) for r in v.validate(df, registry.resolve("users"), email_fields=["email"]).collect()]
    assert got == [False, True, True]


def test_request_bodies(spark):
    bodies = [json.dumps({"table_name": "users", "records": [ANN, BEN]}), json.dumps({"records": {"a": 1}}), json.dumps({"table_name": "users"}),
              json.dumps({"table_name": "users", "records": []}), json.dumps({"records": "[1]"}), "no json", "[1]", '{"records": null}', None, '"text"']
    df = spark.createDataFrame(list(enumerate(bodies)), "batch_id int, body string")
    rows = parse_request(df).collect()
    good = [r for r in rows if r.batch_id == 0]
    assert len(good) == 2 and json.loads(good[0].record) == ANN and good[0].table_name == "users"
    assert {r.batch_id for r in rows if r.bad_request} == {1, 4, 5, 6, 8, 9} and all(r.record is None for r in rows if r.batch_id > 0)
    assert {r.batch_id for r in rows} == {0, 1, 4, 5, 6, 8, 9}


def test_requests_reach_their_tables(spark, load, registry):
    """A good body, one with a bad record, an unknown table, an empty list, a bad body, the default table, another table."""
    mouse = {"product_id": "p1", "name": "Mouse", "price": 9.5, "in_stock": True}
    bodies = [{"table_name": "users", "records": [ANN, BEN]}, {"table_name": "users", "records": [ANN, {"name": "No age", "email": "x"}]},
              {"table_name": "nowhere", "records": [ANN]}, {"table_name": "users", "records": []}, {"table_name": "users", "records": 5},
              {"records": [BEN]}, {"table_name": "products", "records": [mouse]}, {"table_name": "half", "records": [ANN]}]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "request_id int, body string")
    refused = load_requests(df, registry).collect()
    assert sorted(r.request_id for r in refused) == [1, 1, 2, 4, 7]
    assert {r.errors[0].message for r in refused if r.request_id in (2, 7)} == {"unknown table"}
    assert [r.name for r in spark.table("shop.people").orderBy("name").collect()] == ["Ann", "Ben"]
    assert spark.table("shop.fallback").count() == 1 and spark.table("shop.goods").first().price == 9.5


def test_fifty_tables_in_one_pass(spark):
    """Bodies are read once and parsed once, whatever the number of registered tables."""
    schema = columns(("name", "STRING", "REQUIRED"), ("age", "INTEGER", "NULLABLE"))
    many = Registry({"tables": {f"t{i}": {"dataset_id": "many", "table_id": f"t{i}", "schema": schema if i % 2 else PEOPLE} for i in range(50)}})
    spark.sql("DROP DATABASE IF EXISTS many CASCADE")
    try:
        bodies = [(i, json.dumps({"table_name": f"t{i % 7}", "records": [dict(ANN, age=i), BEN]})) for i in range(100)]
        bodies += [(200, json.dumps({"table_name": "t3", "records": [ANN, {"age": 1}]})), (201, "[")]
        seen = spark.sparkContext.accumulator(0)
        df = spark.createDataFrame(bodies, "request_id int, body string")
        counted = df.rdd.map(lambda r: (seen.add(1), tuple(r))[1]).toDF(df.schema)
        refused = load_requests(counted, many)
        assert sorted((r.request_id, len(r.errors)) for r in refused.collect()) == [(200, 0), (200, 1), (201, 1)]
        assert seen.value == len(bodies)
        assert sum(spark.table(f"many.t{i}").count() for i in range(7)) == 200 and spark.table("many.t49").isEmpty()
        from quillbar.plans.load import stage_requests
        plan = stage_requests(df, [many.resolve(n) for n in many.names()], many.names(), "request_id", "body")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(StructField(table_name") == 1 and plan.count("from_json(MapType") + plan.count("entries") >= 1
    finally:
        spark.sql("DROP DATABASE many CASCADE")


def test_rules_as_data_agree_with_rules_as_columns(spark, registry):
    texts = ["null", '"x"', '"29.99"', "30", '"true"', "true", '"2020-01-02 03:04:05"', '""', '"' + "n" * 256 + '"', '{"a":1}', "[1]"]
    fields = columns(*[(f"{k}{m[0]}".lower(), k, m) for k in ("STRING", "INTEGER", "FLOAT", "BOOLEAN", "TIMESTAMP", "GEOGRAPHY") for m in ("REQUIRED", "NULLABLE")])
    spec = Registry({"default": {"dataset_id": "d", "table_id": "t", "schema": fields}}).resolve()
    rows = ["{" + ", ".join(f'"{f.name}": {t}' for f in spec.fields) + "}" for t in texts] + ["{}", "[]", "5", "no", '{"a"', None, '{"stringr": "a", "stringr": "b"}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, record string")
    one = v.validate(df, spec).orderBy("i").collect()
    other = df.withColumn("c", v.check_record(F.col("record"), v.rule_list(spec))).orderBy("i").collect()
    assert [[tuple(e) for e in r.errors] for r in one] == [[tuple(e) for e in r.c.errors] for r in other]
    typed = df.withColumn("c", v.check_record(F.col("record"), v.rule_list(spec))).select(
        "i", "c.errors", F.struct(*[v.typed(F.get("c.texts", F.lit(k)), r).alias(r.name) for k, r in enumerate(spec.fields)]).alias("value")).orderBy("i").collect()
    assert [r.value for r in one if not r.errors] == [r.value for r in typed if not r.errors]


def test_a_registry_that_grows(spark, load):
    """A new column, a wider type, a narrower type."""
    load([ANN], "users")
    wider = {"tables": {"users": {"dataset_id": "shop", "table_id": "people", "schema": [*PEOPLE[:1], {"name": "age", "field_type": "STRING", "mode": "REQUIRED"}, PEOPLE[2],
                                                                                         {"name": "city", "field_type": "STRING", "mode": "NULLABLE"}]}}}
    df = spark.createDataFrame([(json.dumps(dict(BEN, city="Ulm")),)], "record string")
    more = {"tables": {"users": dict(wider["tables"]["users"], schema=[*PEOPLE, wider["tables"]["users"]["schema"][-1]])}}
    load_records(df, Registry(more), "users")
    assert {(r.name, r.age, r.city) for r in spark.table("shop.people").collect()} == {("Ann", 28, None), ("Ben", 35, "Ulm")}
    load_records(df, Registry(wider), "users")
    assert {(r.name, r.age, r.city) for r in spark.table("shop.people").collect()} == {("Ann", "28", None), ("Ben", "35", "Ulm")}
    body = spark.createDataFrame([(1, json.dumps({"table_name": "users", "records": [ANN]}))], "request_id int, body string")
    for narrow in (lambda: load_records(df, Registry(more), "users"), lambda: load_requests(body, Registry(more))):
        with pytest.raises(sinks.SchemaDrift, match="narrow"):
            narrow()
    assert spark.table("shop.people").count() == 3
    load_requests(body, Registry({"tables": {"users": {"dataset_id": "shop", "table_id": "people", "schema": PEOPLE[:1]}}}))
    assert spark.table("shop.people").filter("age IS NULL").count() == 1
    must = {"tables": {"users": dict(wider["tables"]["users"], schema=[*wider["tables"]["users"]["schema"], {"name": "zip", "field_type": "STRING", "mode": "REQUIRED"}])}}
    with pytest.raises(sinks.SchemaDrift, match="rows without zip"):
        load_records(df, Registry(must), "users")


def test_load_by_day(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS days_db")
    try:
        t, rows = "days_db.t", lambda day, n: spark.range(n).select(F.lit(day).cast("date").alias("day"), "id")
        for n in (2, 3):
            sinks.load_day(rows("2024-01-01", n), t, "day")
        sinks.load_day(rows("2024-01-02", 4), t, "day")
        sinks.load_day(rows("2024-01-01", 5), t, "day")
        sinks.load_day(rows("2024-01-01", 0), t, "day")
        assert {(str(r.day), r["count"]) for r in spark.table(t).groupBy("day").count().collect()} == {("2024-01-01", 5), ("2024-01-02", 4)}
        plan = spark.table(t).filter("day = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in plan
    finally:
        spark.sql("DROP DATABASE days_db CASCADE")


def test_marking_batches_starts_no_job(spark, registry):
    df = spark.createDataFrame([("b", json.dumps(ANN))], "batch_id string, record string")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    v.mark_batches(v.validate(df, registry.resolve("users")))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


def test_failed_overwrite_keeps_the_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS keep_db")
    try:
        sinks.overwrite_table(spark.range(3), "keep_db.t")
        broken = spark.range(5).select((F.col("id") + F.raise_error(F.lit("stop")).cast("bigint")).alias("id"))
        for write in (sinks.overwrite_table, sinks.truncate_and_load):
            with pytest.raises(Exception, match="stop"):
                write(broken, "keep_db.t")
            assert spark.table("keep_db.t").count() == 3
        sinks.overwrite_table(spark.table("keep_db.t").filter("id > 0"), "keep_db.t")
        assert spark.table("keep_db.t").count() == 2
    finally:
        spark.sql("DROP DATABASE keep_db CASCADE")


def test_records_are_parsed_once(spark, registry):
    df = spark.createDataFrame([(json.dumps(ANN),)], "record string")
    good = v.accepted_rows(v.mark_batches(v.validate(df, registry.resolve("users")), atomic=False))
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_registry_files(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "r.yaml"
    path.write_text("default:\n  dataset_id: d\n  table_id: t\n  schema:\n    - {name: n, field_type: FLOAT, mode: REQUIRED}\n")
    spec = Registry.from_file(spark, str(path)).resolve()
    assert spec.full_name == "d.t" and spec.spark_schema() == T.StructType([T.StructField("n", T.DoubleType(), False)])
    (tmp_path / "r.json").write_text(json.dumps(CONFIG))
    assert Registry.from_file(spark, str(tmp_path / "r.json")).resolve("users").table == "people"


# ---- files and tables ---------------------------------------------------------------------------------------------

def test_csv_scans(spark, tmp_path):
    path = tmp_path / "y.csv"
    path.write_text("year,name,data_value\n2001,Ann,1.5\n2001,Ann,2.5\n2002,Ben,3\n")
    assert dict(files.read_csv(spark, str(path)).dtypes) == {"year": "int", "name": "string", "data_value": "double"}
    fixed = files.load_csv(spark, str(path), "year string, name string, data_value double")
    assert fixed.count() == 3 and fixed.first().year == "2001"


def test_json_scan(spark, tmp_path):
    (tmp_path / "m.json").write_text('{\n "a": 1,\n "b": [1, 2]\n}')
    assert files.read_json(spark, str(tmp_path / "m.json")).first().b == [1, 2]


def test_delimited_sinks(spark, out):
    df = spark.createDataFrame([("a b", None), (" lead", "x\ty")], "p string, q string").repartition(2)
    sinks.write_tsv(df, out, single_file=True)
    import glob

    assert len(glob.glob(out + "/*.csv")) == 1
    rows = {tuple(r) for r in spark.read.csv(out, header=True, sep="\t").collect()}
    assert rows == {("a b", None), (" lead", "x\ty")}
    sinks.write_csv(df, out)
    assert spark.read.csv(out, header=True).count() == 2


def test_table_sinks(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks_db")
    try:
        t = "sinks_db.t"
        df = spark.range(3).withColumn("v", F.lit("a"))
        assert sinks.ensure_table(spark, t, df.schema) and not sinks.ensure_table(spark, t, df.schema)
        sinks.append_table(df, t)
        sinks.append_table(df, t)
        assert spark.table(t).count() == 6
        sinks.truncate_and_load(df.select("v", "id"), t)
        assert spark.table(t).columns == ["id", "v"] and spark.table(t).count() == 3
        sinks.truncate_and_load(df, "sinks_db.new")
        sinks.overwrite_table(spark.table(t).groupBy("v").agg(F.sum("id").alias("s")), "sinks_db.agg")
        assert spark.table("sinks_db.agg").first().s == 3
        assert "sinks_db" in tables.list_datasets(spark)
        assert sinks.has_rows(df) and not sinks.has_rows(df.filter("id > 9"))
    finally:
        spark.sql("DROP DATABASE sinks_db CASCADE")
