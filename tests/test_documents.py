"""Flatten, pivot and XML on small documents of our own."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillbar.functions import text
from quillbar.operators import flatten
from quillbar.plans import flatten_job
from quillbar.sources import files, sinks, xml

ORDER = "id string, customer struct<name string, email string>, items struct<item array<struct<product string, qty bigint>>>, notes string"
BOOK = """_id string, author struct<name struct<first string, last string>>, title string, genre string, price double,
publish_date string, reviewers struct<reviewer array<struct<_stars bigint, name string, comment string>>>,
onemorecolumn struct<col1 array<string>>, secondcoloum struct<col1 array<string>>"""


def item(i, letter):
    return f"<item><product>Tool {letter}{i}</product><qty>{i % 9 + 1}</qty></item>"


def order(number, name, items, notes):
    return (f"<order><id>{number}</id><customer><name>{name}</name><email>{name.split()[0].lower()}@example.com</email></customer>"
            f"{items}<notes>{notes}</notes></order>")


def ten(letter):
    return "<items>\n" + "\n".join("      " + item(i, letter) for i in range(10)) + "\n</items>"


ORDERS = "<orders>\n" + "\n  ".join([
    order("001", "Kim Vale", ten("A"), "Arrived early. 😊"),
    order("002", "Lou Marsh", ten("B"), r"Waiting. Odd text: \u2028"),
    order("003", "Max Reed", ten("C"), r"Sent. Odd text: \x92"),
]) + "\n</orders>\n"
EDGE_ORDERS = "<orders>" + order("010", "No Items", "", "none") + order("011", "Empty Items", "<items></items>", "empty") \
    + order("012", "One Item", "<items>" + item(1, "D") + "</items>", "one") \
    + order("013", "Twelve Items", "<items>" + "".join(item(i, "E") for i in range(12)) + "</items>", "many") + "</orders>"

def book(key, who, title, genre, price, day, reviews=None, first=(), second=()):
    """One ``book`` element; ``reviews`` None leaves the container out, an empty list leaves it empty."""
    given, family = who
    said = "" if reviews is None else "<reviewers>" + "".join(
        f'<reviewer stars="{stars}"><name>{name}</name><comment>{comment}</comment></reviewer>' for stars, name, comment in reviews) + "</reviewers>"
    lists = "".join(f"<{tag}>" + "".join(f"<col1>{x}</col1>" for x in xs) + f"</{tag}>" for tag, xs in (("onemorecolumn", first), ("secondcoloum", second)) if xs)
    return (f'<book id="{key}"><author><name><first>{given}</first><last>{family}</last></name></author><title>{title}</title><genre>{genre}</genre>'
            f"<price>{price}</price><publish_date>{day}</publish_date>{said}{lists}</book>")


# More reviews than columns; none at all; an empty list; text with line breaks, tabs and letters beyond ASCII; lists of other lengths.
BOOKS = "<catalog>" + "\n".join([
    book("tide", ("Mara", "Quist"), "Tides of Öland", "Sea", "12.25", "2018-03-07",
         [(2, "p", "dull"), (5, "q", "\n   Salt\tand \n wind.\n  Süß!\n"), (3, "r", "fair")], second=["n", "e", "s", "w"]),
    book("moss", ("Ivo", "Brandt"), "Moss", "Garden", "7.10", "2020-11-30", [(k % 5 + 1, f"n{k}", f"c{k}") for k in range(6)], first=["only"]),
    book("kiln", ("Noor", "Haddad"), "Kiln Notes", "Craft", "33", "1999-06-02", [], first=["a", "b"], second=["z"]),
    book("void", ("Sol", "Ek"), "Void", "Sea", "0.99", "2023-12-24"),
]) + "</catalog>"


@pytest.fixture()
def write(tmp_path):
    def put(name, body):
        path = tmp_path / name
        path.write_text(body, encoding="utf-8")
        return str(path)

    return put


def numbered(df):
    rows = flatten.explode_items(
        df, "items", "item", ["product", "qty"],
        [F.col("id").alias("order_id"), F.col("customer.name").alias("customer_name"),
         F.col("customer.email").alias("customer_email"), text.clean_printable(F.col("notes")).alias("notes")],
    )
    return text.fill_empty(rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]))


def test_golden_items_file(spark, write, out):
    """Three orders of ten items become thirty text rows, numbered from 1, with ids kept as text."""
    sinks.write_csv(numbered(xml.read_xml(spark, write("o.xml", ORDERS), "order", ORDER)), out, single_file=True)
    back = spark.read.csv(out, header=True)
    rows = sorted(tuple(r) for r in back.collect())
    assert back.columns == ["order_id", "customer_name", "customer_email", "notes", "item_number", "product", "qty"]
    want = []
    for number, name, letter, notes in (("001", "Kim Vale", "A", "Arrived early. "), ("002", "Lou Marsh", "B", r"Waiting. Odd text: \u2028"),
                                        ("003", "Max Reed", "C", r"Sent. Odd text: \x92")):
        want += [(number, name, name.split()[0].lower() + "@example.com", notes, str(i + 1), f"Tool {letter}{i}", str(i % 9 + 1)) for i in range(10)]
    assert rows == sorted(want)


def test_orders_without_items_stay_and_empty_items_go(spark, write):
    rows = numbered(xml.read_xml(spark, write("e.xml", EDGE_ORDERS), "order", ORDER)).collect()
    count = {}
    for r in rows:
        count.setdefault(r.order_id, []).append(r.item_number)
    assert count["010"] == [""]
    assert count["012"] == ["1"]
    assert len(count["013"]) == 12


def test_empty_items_give_no_row(spark):
    df = spark.createDataFrame(
        [("a", None), ("b", ([],)), ("c", ([("p", 1)],))], "id string, items struct<item array<struct<product string, qty bigint>>>"
    )
    rows = flatten.explode_items(df, "items", "item", ["product"], ["id"]).collect()
    assert {(r.id, r.item_number) for r in rows} == {("a", None), ("c", 1)}


@pytest.mark.parametrize("body,n", [(ORDERS, 3), (EDGE_ORDERS, 4)])
def test_split_scan_equals_plain_scan(spark, write, body, n):
    path = write("s.xml", body)
    plain = xml.read_xml(spark, path, "order", ORDER)
    split = xml.read_xml_split(spark, path, "order", ORDER)
    assert split.count() == n
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_split_scan_uses_many_tasks_for_one_file(spark, write):
    path = write("big.xml", "<orders>\n" + "\n".join(order(f"{i:05}", "Kim Vale", ten("A"), "n") for i in range(4000)) + "\n</orders>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)
        split = xml.read_xml_split(spark, path, "order", ORDER)
        assert split.rdd.getNumPartitions() > 4
        assert split.select("id").distinct().count() == 4000
        assert xml.read_xml(spark, path, "order", ORDER).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_split_scan_keeps_attributes_and_drops_the_tail(spark, write):
    path = write("a.xml", '<r><ord x="1"/><order k="7"><id>1</id></order>\n<order\n k="8"><id>2</id></order></r>')
    rows = xml.read_xml_split(spark, path, "order", "_k bigint, id string").collect()
    assert sorted((r._k, r.id) for r in rows) == [(7, "1"), (8, "2")]


def test_xml_sink_splits_and_glob_reads_all(spark, out):
    df = spark.range(2500).select(F.col("id").cast("string").alias("id"), F.lit("n").alias("notes")).coalesce(1)
    sinks.write_xml(df, out, "orders", "order")
    assert spark.read.text(out).select(F.input_file_name()).distinct().count() == 3
    assert xml.read_xml(spark, out + "/*.xml", "order", "id string, notes string").count() == 2500


def test_infer_save_and_load_schema(spark, write, out):
    schema = xml.infer_schema(spark, write("b.xml", BOOKS), "book", out)
    assert xml.load_schema(spark, out) == schema
    assert schema["_id"].dataType == T.StringType()
    assert "author" in schema.names


def test_inferred_types_lose_leading_zeros(spark, write):
    path = write("o.xml", ORDERS)
    assert dict(xml.read_xml(spark, path, "order").dtypes)["id"] == "bigint"
    assert {r.id for r in xml.read_xml(spark, path, "order", ORDER).select("id").collect()} == {"001", "002", "003"}


JOB = {
    "row_tag": "book",
    "flatten_cols": [{"path": "_id", "alias": "_id"}, {"path": "title", "alias": "title"}, {"path": "price", "alias": "price"},
                     {"path": "author.name.first", "alias": "author_name_first"}],
    "pivot_arrays": [
        {"path": "reviewers.reviewer", "alias": "r", "pivot_prefix": "reviewer", "max_items": 4, "is_struct": True,
         "struct_fields": [{"original": "_stars", "new_suffix": "stars"}, {"original": "comment", "new_suffix": "comment"}]},
        {"path": "onemorecolumn.col1", "alias": "o", "pivot_prefix": "more", "max_items": 2, "is_struct": False},
        {"path": "secondcoloum.col1", "alias": "s", "pivot_prefix": "second", "max_items": 3, "is_struct": False},
    ],
}


def test_mapping_job_end_to_end(spark, write, tmp_path):
    import json

    schema_path = str(tmp_path / "schema")
    xml.save_schema(spark, T.StructType.fromDDL(BOOK), schema_path)
    config = dict(JOB, source_xml_path=write("b.xml", BOOKS), schema_path=schema_path, target_path=str(tmp_path / "tsv"))
    job = flatten_job.FlattenJob.from_file(spark, write("job.json", json.dumps(config)))
    flatten_job.run(spark, job, single_file=True)
    back = spark.read.csv(str(tmp_path / "tsv"), header=True, sep="\t")
    rows = {r["_id"]: r for r in back.collect()}
    assert back.columns == ["_id", "title", "price", "author_name_first"] + \
        [f"reviewer_{s}-{i}" for i in range(1, 5) for s in ("stars", "comment")] + \
        ["more-1", "more-2", "second-1", "second-2", "second-3"]
    assert rows["kiln"]["more-2"] == "b" and rows["kiln"]["reviewer_stars-1"] is None
    assert rows["moss"]["reviewer_stars-4"] == "4" and [rows["moss"][f"reviewer_comment-{i}"] for i in (1, 4)] == ["c0", "c3"]
    assert rows["tide"]["title"] == "Tides of land" and rows["tide"]["reviewer_stars-4"] is None
    assert "Salt" in rows["tide"]["reviewer_comment-2"] and "S!" in rows["tide"]["reviewer_comment-2"] and "\n" not in rows["tide"]["reviewer_comment-2"]
    assert rows["void"]["reviewer_stars-1"] is None and rows["void"]["second-3"] is None
    assert rows["tide"]["second-3"] == "s"


def test_typed_pivot_leaves_numbers_null(spark, write):
    df = xml.read_xml(spark, write("b.xml", BOOKS), "book", BOOK)
    wide = text.fill_empty(df.select("_id", *flatten.pivot_columns(
        "reviewers.reviewer", "reviewers_reviewer", 4, [("_stars", "_stars"), ("name", "name")], as_text=False)))
    row = wide.filter("_id = 'void'").first()
    assert row["reviewers_reviewer__stars-1"] is None and row["reviewers_reviewer_name-1"] == ""
    assert dict(wide.dtypes)["reviewers_reviewer__stars-1"] == "bigint"


COMPANY = """{"company": {"name": "Acme", "departments": [
  {"name": "R&D", "budget": 10.5, "employees": [
    {"id": 1, "name": "Ann", "active": true, "skills": ["a", "b"], "contact": {"email": "x", "phone": null, "address": {"street": "s", "city": "c", "zip": null}},
     "projects": [{"name": "p1", "details": {"budget": 1.0, "tasks": [{"taskId": 1, "desc": "d", "status": null}, {"taskId": 2, "desc": "e", "status": "ok"}]}},
                  {"name": "p2", "details": {"budget": 2.0, "tasks": []}}]},
    {"id": 2, "name": "Bob", "active": false, "skills": [], "contact": null, "projects": null}]},
  {"name": "Ops", "budget": 1.0, "employees": []}]}, "metadata": {"generatedBy": "t", "note": "n"}}"""


def test_flatten_irregular_json(spark, write):
    df = files.read_json(spark, write("c.json", COMPANY))
    flat = flatten.flatten_outer(df)
    # Ann: 2 skills x (2 tasks + 1 project without tasks); Bob and the empty department one row each.
    assert flat.count() == 2 * 3 + 1 + 1
    assert "company_departments_employees_contact_address_city" in flat.columns
    assert not any(isinstance(f.dataType, (T.StructType, T.ArrayType)) for f in flat.schema.fields)
    inner = flatten.flatten_inner(df)
    assert inner.count() == 2 * 2
    assert set(inner.columns) == set(flat.columns)


def test_flatten_quotes_names_and_passes_maps(spark):
    schema = T.StructType([
        T.StructField("a.b", T.StructType([T.StructField("c.d", T.LongType())])),
        T.StructField("m", T.MapType(T.StringType(), T.LongType())),
        T.StructField("x", T.ArrayType(T.LongType())),
    ])
    df = spark.createDataFrame([((1,), {"k": 1}, [1, 2])], schema)
    for flat in (flatten.flatten_outer(df), flatten.flatten_inner(df)):
        assert set(flat.columns) == {"a.b_c.d", "m", "x"}
        assert flat.count() == 2


def test_flatten_refuses_clashing_names(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<b bigint>, a_b bigint")
    for f in (flatten.flatten_outer, flatten.flatten_inner):
        with pytest.raises(ValueError, match="a_b"):
            f(df)


def test_zip_keeps_the_longer_array(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], ["x"]), (2, None, [])], "k bigint, a array<bigint>, b array<string>")
    rows = {tuple(r) for r in flatten.flatten_outer(df, "zip").collect()}
    assert rows == {(1, 1, "x"), (1, 2, None), (1, 3, None), (2, None, None)}
    assert flatten.flatten_outer(df).count() == 4


ARRAYS = st.lists(st.tuples(st.none() | st.lists(st.integers(0, 9), max_size=3), st.none() | st.lists(st.sampled_from("xyz"), max_size=3)), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ARRAYS)
def test_flatten_row_counts(spark, rows):
    df = spark.createDataFrame(rows, "a array<bigint>, b array<string>")
    sizes = [(len(a or []), len(b or [])) for a, b in rows]
    assert flatten.flatten_outer(df).count() == sum(max(a, 1) * max(b, 1) for a, b in sizes)
    assert flatten.flatten_inner(df).count() == sum(a * b for a, b in sizes)
    assert flatten.flatten_outer(df, "zip").count() == sum(max(a, b, 1) for a, b in sizes)


def test_pivot_rows_drops_overflow(spark):
    df = spark.createDataFrame([("k", i, f"p{i}", i * 10) for i in range(1, 13)] + [("one", 1, "q", 5)], "k string, n int, p string, q int")
    rows = {r.k: r for r in flatten.pivot_rows(df, "k", ["n"], {"p": "Product", "q": "Qty"}, 10).collect()}
    assert rows["k"]["Product10"] == "p10" and rows["k"]["Qty10"] == 100 and "Product11" not in rows["k"].asDict()
    assert rows["one"]["Product2"] is None


def test_pivot_rows_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    plan = flatten.pivot_rows(df, "k", ["n"], {"n": "N"}, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_text_functions(spark):
    df = spark.createDataFrame([("  Ab\r\ncé ☂ ", "P$op", "jo van dyke", None)], "a string, b string, c string, d string")
    row = df.select(
        text.drop_non_ascii(F.col("a")).alias("drop"), text.space_non_ascii(F.col("a")).alias("space"),
        text.space_line_breaks(F.col("a")).alias("line"), text.clean_string(F.col("a")).alias("clean"),
        text.clean_printable(F.col("a")).alias("print"), text.clean_printable(F.col("d")).alias("none"),
        text.is_palindrome(F.col("b")).alias("pal"), text.capitalize_words(F.col("c")).alias("cap"), text.shout(F.lit(" buy ")).alias("up"),
    ).first()
    assert row.drop == "  Ab\r\nc  " and row.space == "  Ab\r\nc    " and row.line == "  Ab  cé ☂ "
    assert row.clean == "Ab  c" and row.print == "Abc " and row.none == ""
    assert row.pal is True and row.cap == "Jo Van Dyke" and row.up == "BUY"
    assert df.select(text.capitalize_words(F.lit("McD  oN")).alias("x")).first().x == "McD  ON"


def both_reads(spark, path, schema):
    plain = sorted(map(str, xml.read_xml(spark, path, "order", schema).collect()))
    return plain, sorted(map(str, xml.read_xml_split(spark, path, "order", schema).collect()))


PIECES = st.lists(st.sampled_from([
    '<order k="1"/>', "<order/>", '<order k="2"><id>a</id></order>', "<order><id>b</id></order >", '<!-- <order k="5"> -->', "<other/>",
    '<order\n k="3"><id><![CDATA[<order k="9"> & ]]></id></order>', "<order k='4' n='a > b'/>", '<order k="6"><!-- <order> --><id>c</id><x/></order>', " \n ",
]), max_size=8)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(PIECES)
def test_split_scan_loses_nothing(spark, tmp_path, pieces):
    path = tmp_path / f"p{abs(hash(tuple(pieces)))}.xml"
    path.write_text("<orders>" + "".join(pieces) + "</orders>")
    plain, split = both_reads(spark, str(path), "_k bigint, id string")
    assert split == plain


@pytest.mark.parametrize("body", [
    "<o><order><id>1</id><!-- </order> --></order></o>", "<o><order><id>1</id><order><id>2</id></order></o>", "<o><order><id><![CDATA[</order>]]></id></order></o>",
    "<o><order><id>1</order></o>", "<o><order><id>1</id></order><order><id>2</o>",
])
def test_split_scan_fails_where_it_cannot_cut(spark, write, body):
    with pytest.raises(Exception, match="cannot cut|MALFORMED|FAILFAST|malformed"):
        xml.read_xml_split(spark, write("bad.xml", body), "order", "id string").collect()


def test_repeated_paths_stay_and_repeated_names_fail(spark):
    df = spark.createDataFrame([((1,),)], "a struct<b bigint>")
    assert flatten.project_paths(df, [("a.b", "x"), ("a.b", "y")]).first().asDict() == {"x": 1, "y": 1}
    with pytest.raises(ValueError, match="x"):
        flatten.project_paths(df, [("a.b", "x"), ("a.b", "x")])
    job = flatten_job.FlattenJob.from_dict({"flatten_cols": [{"path": "a.b", "alias": "x"}, {"path": "a.b", "alias": "x"}]})
    with pytest.raises(ValueError, match="x"):
        flatten_job.shape(df, job)


# ---- one JSON file by many tasks ----------------------------------------------------------------------------------

HARD_JSON = [{"id": i, "t": t, "in": {"x": [{"y": i}, {"y": t}], "z": {}}, "list": [[1, 2], []]} for i, t in enumerate(
    ["plain", "a } b", "{[\"", "\\", "\\\\\" }", "é ☂ }}", "line\nbreak", "", "]]}}", '"}", {"id": 9', None, "tab\t}", "\\\"}{"] * 7)]
JSON_SCHEMA = "id bigint, t string, in struct<x: array<struct<y: string>>, z: struct<a: int>>, list array<array<int>>"


@pytest.mark.parametrize("shape", ["pretty", "one line", "objects", "single", "no end of line", "empty array"])
def test_json_split_reads_what_the_plain_reader_reads(spark, tmp_path, shape):
    import json

    from quillbar.sources import files, json_split

    text = {"pretty": json.dumps(HARD_JSON, indent=2, ensure_ascii=False) + "\n", "one line": json.dumps(HARD_JSON), "objects": "\n".join(json.dumps(r, indent=1) for r in HARD_JSON[:1]),
            "single": json.dumps(HARD_JSON[4], indent=3) + " ", "no end of line": "\n \t" + json.dumps(HARD_JSON, indent=1), "empty array": "[ ]\n"}[shape]
    (tmp_path / "one.json").write_text(text)
    (tmp_path / "two.json").write_text(json.dumps(HARD_JSON[:2]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    plain = files.read_json(spark, str(tmp_path), schema=JSON_SCHEMA).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        got = json_split.read_json_split(spark, str(tmp_path), JSON_SCHEMA)
        parts = json_split._pieces(spark, str(tmp_path)).rdd.getNumPartitions()
        assert sorted(map(str, got.collect())) == sorted(map(str, plain))
        assert parts > (10 if shape in ("pretty", "one line") else 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text", ['[{"a": 1}, {"a": 2', '[{"a": 1}, 5]', '{"a": {"b": 1}', 'words', '[{"a": "x}]'])
def test_json_split_fails_on_what_it_cannot_cut(spark, tmp_path, text):
    from quillbar.sources import json_split

    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="cannot cut|MALFORMED|JSON"):
        json_split.read_json_split(spark, str(tmp_path / "bad.json"), "a string").collect()


def test_merged_schema(spark, tmp_path):
    """A child that repeats in one file only, a child with attributes in one file only, leading zeros, mixed numbers, empty leaves."""
    from quillbar.sources import xml

    (tmp_path / "a.xml").write_text("<r><o id='1'><code>001</code><n>5</n><item><q>1</q></item><tag>x</tag><day>2024-01-02</day><none/><ok>true</ok></o></r>")
    (tmp_path / "b.xml").write_text("<r><o id='2'><code>12</code><n>2.5</n><item><q>2</q></item><item><q>3</q><w>a</w></item><tag k='1'>y</tag><day>2024-01-03</day><ok>false</ok></o></r>")
    (tmp_path / "c.xml").write_text("<r><o id='3'><n>7</n><day>soon</day></o></r>")
    schema = xml.merged_schema(spark, str(tmp_path), "o")
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds["_id"] == "bigint" and kinds["code"] == "string" and kinds["n"] == "double" and kinds["day"] == "string" and kinds["ok"] == "boolean" and kinds["none"] == "string"
    assert kinds["item"] == "array<struct<q:bigint,w:string>>"
    rows = {r._id: r for r in xml.read_xml(spark, str(tmp_path), "o", schema).collect()}
    assert [(i.q, i.w) for i in rows[1].item] == [(1, None)] and [(i.q, i.w) for i in rows[2].item] == [(2, None), (3, "a")] and rows[3].item is None
    assert rows[1].code == "001" and rows[2].n == 2.5 and rows[2].ok is False


def test_plain_records_are_cut_without_tokens(spark, out, monkeypatch):
    """A piece that names its tag once and holds no comment or CDATA is not taken apart; all others are, with the same records."""
    from quillbar.sources import xml

    plain = "<rows><row><a>1</a></row>\n<row b='x > y' c=\"'\"><a>é</a></row><row\n><a>3</a></row></rows>"
    odd = "<row><a>4</a></row ><row/><row><a>5<!-- <row> --></a></row><rows><row><a>6</a></row></rows><row a='7'/><row><a><![CDATA[8]]></a></row>"
    spark.createDataFrame([(plain,), (odd,)], "value string").coalesce(1).write.text(out)
    read = lambda: sorted(r.a or "" for r in xml.read_xml_split(spark, out, "row", "a string").collect())
    assert read() == ["", "", "1", "3", "4", "5", "6", "8", "é"]
    pieces = spark.createDataFrame([("<all><row><a>1</a>",), ("\n<row b='x > y' c=\"'\"><a>é</a>",), ("<row\n><a>3</a>",)], "p string")
    monkeypatch.setattr(xml, "_let", lambda value, body: F.raise_error(F.lit("taken apart")).cast("array<string>"))
    found = pieces.select(F.explode(xml._records(F.col("p"), "row")).alias("r")).collect()
    assert [r.r for r in found] == ["<row><a>1</a></row>", "<row b='x > y' c=\"'\"><a>é</a></row>", "<row\n><a>3</a></row>"]
