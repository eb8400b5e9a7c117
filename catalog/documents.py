"""Nested documents, XML and text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import (ITEM_ORDER, MAX_ITEMS, ITEM_ORDER_SQL, ORDER_NOTES_SQL, ORDER_SCHEMA, TEXT_DOCUMENTS_SQL, order_documents,
                            order_notes, query, table, text_documents)
from quillbar.functions import scalars, text
from quillbar.operators import flatten, relational
from quillbar.plans.flatten_job import FlattenJob, run, shape
from quillbar.session import scratch_path
from quillbar.sources import files, sinks, synthetic, xml

ITEMS_SQL = f"""
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS order_id, c_name AS customer_name,
           lower(c_name) || '@example.com' AS customer_email, {{notes}} AS notes,
           {{number}} AS item_number, {{product}} AS product, {{qty}} AS qty
    FROM orders
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {ITEM_ORDER_SQL}) AS n FROM lineitem) i
      ON l_orderkey = o_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey"""

TYPED_ITEMS_SQL = ITEMS_SQL.format(notes="o_orderpriority", number="CAST(n AS INTEGER)", product="'part-' || l_partkey",
                                   qty="CAST(l_quantity AS BIGINT)")


def _items(docs):
    return flatten.explode_items(
        docs, "items", "item", ["product", "qty"],
        [F.col("id").alias("order_id"), F.col("customer.name").alias("customer_name"),
         F.col("customer.email").alias("customer_email"), F.col("notes")],
        before=F.col("_part") * MAX_ITEMS,
    )


@query("order_items_numbered", f"""
    WITH x AS ({ITEMS_SQL.format(notes=ORDER_NOTES_SQL, number="CAST(n AS VARCHAR)", product="'part-' || l_partkey",
                                 qty="CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)")})
    SELECT order_id, customer_name, customer_email,
           regexp_replace(regexp_replace(notes, '^\\s+|\\s+$', '', 'g'), '[^\\x20-\\x7E]+', '', 'g') AS notes,
           coalesce(item_number, '') AS item_number, coalesce(product, '') AS product, coalesce(qty, '') AS qty
    FROM x""")
def order_items_numbered(spark, sf):
    """Items numbered within their order, all as text, blanks for an order without items."""
    rows = _items(order_documents(spark, sf, text.clean_printable(order_notes())))
    return text.fill_empty(rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]))


@query("xml_roundtrip_orders", TYPED_ITEMS_SQL)
def xml_roundtrip_orders(spark, sf):
    """Order documents written as XML parts and read back with the declared schema.

    Parts of 50,000 records are some 35 MB each: the source takes one task per file, so neither too small nor too large.
    """
    path = scratch_path(spark, "orders-xml")
    sinks.write_xml(order_documents(spark, sf, F.col("o_orderpriority")), path, "orders", "order", records_per_file=50_000)
    return _items(xml.read_xml(spark, path, "order", ORDER_SCHEMA))


@query("xml_split_scan_orders", TYPED_ITEMS_SQL)
def xml_split_scan_orders(spark, sf):
    """The same documents in few large files, scanned in parallel by cutting at the end tag."""
    path = scratch_path(spark, "orders-xml-large")
    sinks.write_xml(order_documents(spark, sf, F.col("o_orderpriority")), path, "orders", "order", records_per_file=10_000_000)
    return _items(xml.read_xml_split(spark, path, "order", ORDER_SCHEMA))


@query("xml_split_mixed_elements", """
    SELECT CAST(p_partkey AS BIGINT) AS _id, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS name,
           CASE WHEN p_partkey % 3 <> 0 THEN '<part _id="0">' END AS code FROM part""")
def xml_split_mixed_elements(spark, sf):
    """Elements of which every third is self-closing, with the tag named in comments and CDATA, scanned by cutting at the end tag."""
    path, i = scratch_path(spark, "parts-xml"), F.col("p_partkey")
    name = F.regexp_replace(F.regexp_replace("p_name", "&", "&amp;"), "<", "&lt;")
    whole = F.concat(F.lit('<part id="'), i, F.lit('"><!-- not a <part id="5"> --><name>'), name,
                     F.lit('</name><code><![CDATA[<part _id="0">]]></code></part'), F.when(i % 5 == 0, " >").otherwise(">"))
    empty = F.concat(F.lit("<!-- <part> --><part id='"), i, F.lit("' note=\"a > b\"/>"))
    table(spark, sf, "part").select(F.when(i % 3 == 0, empty).otherwise(whole).alias("value")).write.option("lineSep", " ").text(path)
    return xml.read_xml_split(spark, path, "part", "_id bigint, name string, code string")


JOB_COLUMNS = [("id", "order_id"), ("customer.name", "customer"), ("customer.name", "buyer"), ("notes", "notes")]


@query("mapping_job_xml_to_tsv", f"""
    WITH i AS (SELECT l_orderkey, 'part-' || l_partkey AS product, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS qty,
                      row_number() OVER (PARTITION BY l_orderkey ORDER BY {ITEM_ORDER_SQL}) AS n FROM lineitem),
    p AS (SELECT l_orderkey, {", ".join(f'max(CASE WHEN n = {k} THEN product END) AS "item_product-{k}", max(CASE WHEN n = {k} THEN qty END) AS "item_qty-{k}"' for k in range(1, 4))}
          FROM i GROUP BY l_orderkey)
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS order_id, c_name AS customer, c_name AS buyer, o_orderpriority AS notes,
           {", ".join(f'"item_product-{k}", "item_qty-{k}"' for k in range(1, 4))}
    FROM orders LEFT JOIN p ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey""")
def mapping_job_xml_to_tsv(spark, sf):
    """The whole mapping job: XML read in parallel with a saved schema, shaped by the mapping, written tab-separated, read back."""
    root = scratch_path(spark, "mapping-job")
    docs = order_documents(spark, sf, F.col("o_orderpriority")).filter("_part = 0").drop("_part")
    sinks.write_xml(docs, f"{root}/xml", "orders", "order", records_per_file=10_000_000)
    xml.save_schema(spark, docs.schema, f"{root}/schema")
    mapping = {"flatten_cols": [{"path": a, "alias": b} for a, b in JOB_COLUMNS],
               "pivot_arrays": [{"path": "items.item", "pivot_prefix": "item", "max_items": 3, "is_struct": True,
                                 "struct_fields": [{"original": f, "new_suffix": f} for f in ("product", "qty")]}],
               "source_xml_path": f"{root}/xml", "row_tag": "order", "schema_path": f"{root}/schema", "target_path": f"{root}/tsv"}
    shaped = run(spark, FlattenJob.from_dict(mapping), split=True)
    return files.load_tsv(spark, f"{root}/tsv", ", ".join(f"`{c}` string" for c in shaped.columns))


@query("order_items_pivot", f"""
    WITH i AS (SELECT l_orderkey, 'part-' || l_partkey AS product, CAST(l_quantity AS BIGINT) AS qty,
                      row_number() OVER (PARTITION BY l_orderkey ORDER BY {ITEM_ORDER_SQL}) AS n FROM lineitem),
    p AS (SELECT l_orderkey, {", ".join(f"max(CASE WHEN n = {i} THEN product END) AS Product{i}, max(CASE WHEN n = {i} THEN qty END) AS Qty{i}" for i in range(1, 11))}
          FROM i GROUP BY l_orderkey)
    SELECT o_orderkey AS order_id, c_name AS customer_name,
           {", ".join(f"Product{i}, Qty{i}" for i in range(1, 11))}, o_orderpriority AS notes
    FROM orders LEFT JOIN p ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey""")
def order_items_pivot(spark, sf):
    """The first ten items of each order side by side."""
    items = table(spark, sf, "lineitem").withColumns(
        {"product": F.concat(F.lit("part-"), F.col("l_partkey")), "qty": F.col("l_quantity").cast("bigint")}
    )
    wide = flatten.pivot_rows(items, "l_orderkey", ITEM_ORDER, {"product": "Product", "qty": "Qty"}, 10)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    cells = [f"{n}{i}" for i in range(1, 11) for n in ("Product", "Qty")]
    parents = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    return parents.join(wide, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("customer_name"), *cells, F.col("o_orderpriority").alias("notes")
    )


@query("order_items_array_pivot", f"""
    WITH i AS (SELECT l_orderkey, 'part-' || l_partkey AS product, CAST(l_quantity AS BIGINT) AS qty,
                      row_number() OVER (PARTITION BY l_orderkey ORDER BY {ITEM_ORDER_SQL}) AS n FROM lineitem),
    p AS (SELECT l_orderkey, {", ".join(f"max(CASE WHEN n = {i} THEN product END) AS Product{i}, max(CASE WHEN n = {i} THEN qty END) AS Qty{i}" for i in range(1, 11))}
          FROM i GROUP BY l_orderkey)
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS order_id, c_name AS customer_name, lower(c_name) || '@example.com' AS customer_email,
           {", ".join(f"Product{i}, Qty{i}" for i in range(1, 11))}, o_orderpriority AS notes
    FROM orders LEFT JOIN p ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey""")
def order_items_array_pivot(spark, sf):
    """The same pivot on documents that are nested already: one projection, no shuffle of its own."""
    items = F.col("items.item")
    cells = []
    for i in range(10):
        cells += [F.get(items, F.lit(i))["product"].alias(f"Product{i + 1}"), F.get(items, F.lit(i))["qty"].alias(f"Qty{i + 1}")]
    return order_documents(spark, sf, F.col("o_orderpriority")).filter("_part = 0").select(
        F.col("id").alias("order_id"), F.col("customer.name").alias("customer_name"),
        F.col("customer.email").alias("customer_email"), *cells, "notes"
    )


@query("project_nested_paths", "SELECT doc_id, lang AS language, source AS origin, n_chars AS chars FROM documents")
def project_nested_paths(spark, sf):
    return flatten.project_paths(
        text_documents(spark, sf),
        [("doc_id", "doc_id"), ("meta.lang", "language"), ("meta.size.source", "origin"), ("meta.size.n_chars", "chars")],
    )


@query("flatten_outer", f"""
    WITH {TEXT_DOCUMENTS_SQL},
    t AS (SELECT doc_id, unnest(CASE WHEN tags IS NULL OR len(tags) = 0 THEN [NULL] ELSE tags END) AS tags FROM docs),
    l AS (SELECT doc_id, unnest(CASE WHEN lines IS NULL THEN [NULL] ELSE lines END) AS body FROM docs)
    SELECT docs.doc_id, lang AS meta_lang, source AS meta_size_source, n_chars AS meta_size_n_chars, t.tags,
           body AS lines_body, length(body) AS lines_width
    FROM docs JOIN t USING (doc_id) JOIN l USING (doc_id)""")
def flatten_outer(spark, sf):
    """Everything flat, tags times lines, documents without either kept."""
    return flatten.flatten_outer(text_documents(spark, sf))


@query("flatten_outer_zip", f"""
    WITH {TEXT_DOCUMENTS_SQL},
    n AS (SELECT *, greatest(coalesce(len(tags), 0), coalesce(len(lines), 0), 1) AS k FROM docs),
    r AS (SELECT *, unnest(range(1, k + 1)) AS i FROM n)
    SELECT doc_id, lang AS meta_lang, source AS meta_size_source, n_chars AS meta_size_n_chars, tags[i] AS tags,
           lines[i] AS lines_body, length(lines[i]) AS lines_width FROM r""")
def flatten_outer_zip(spark, sf):
    """Sibling arrays side by side instead of multiplied."""
    return flatten.flatten_outer(text_documents(spark, sf), sibling_arrays="zip")


@query("flatten_inner", f"""
    WITH {TEXT_DOCUMENTS_SQL},
    t AS (SELECT doc_id, unnest(tags) AS tags FROM docs), l AS (SELECT doc_id, unnest(lines) AS body FROM docs)
    SELECT docs.doc_id, lang AS meta_lang, source AS meta_size_source, n_chars AS meta_size_n_chars, t.tags,
           body AS lines_body, length(body) AS lines_width
    FROM docs JOIN t USING (doc_id) JOIN l USING (doc_id)""")
def flatten_inner(spark, sf):
    """Everything flat; documents with a null or empty array fall out."""
    return flatten.flatten_inner(text_documents(spark, sf))


@query("pivot_scalar_array", """
    SELECT doc_id, string_split(text, ' ')[1] AS "word-1", string_split(text, ' ')[2] AS "word-2",
           string_split(text, ' ')[3] AS "word-3" FROM documents""")
def pivot_scalar_array(spark, sf):
    words = F.split("text", " ", -1)
    return table(spark, sf, "documents").select("doc_id", *flatten.pivot_columns(words, "word", 3))


PIVOT_STRUCT_SQL = ", ".join(
    f"lines[{i}] AS \"line_text-{i}\", {{c}}(length(lines[{i}]) AS {{t}}) AS \"line_width-{i}\"" for i in range(1, 5)
)


@query("pivot_struct_array", f"""
    WITH {TEXT_DOCUMENTS_SQL} SELECT doc_id, {PIVOT_STRUCT_SQL.format(c="CAST", t="VARCHAR")} FROM docs""")
def pivot_struct_array(spark, sf):
    return text_documents(spark, sf).select(
        "doc_id", *flatten.pivot_columns("lines", "line", 4, [("body", "text"), ("width", "width")])
    )


@query("pivot_struct_array_typed", f"""
    WITH {TEXT_DOCUMENTS_SQL}, p AS (SELECT doc_id, {PIVOT_STRUCT_SQL.format(c="CAST", t="BIGINT")} FROM docs)
    SELECT doc_id, {", ".join(f'coalesce("line_text-{i}", chr(0)[1:0]) AS "line_text-{i}", "line_width-{i}"' for i in range(1, 5))} FROM p""")
def pivot_struct_array_typed(spark, sf):
    """Element types kept: the fill turns missing texts into blanks and leaves missing numbers null."""
    wide = text_documents(spark, sf).select(
        "doc_id", *flatten.pivot_columns("lines", "line", 4, [("body", "text"), ("width", "width")], as_text=False)
    )
    return text.fill_empty(wide)


MAPPING = {
    "flatten_cols": [
        {"path": "doc_id", "alias": "doc_id"},
        {"path": "meta.lang", "alias": "lang"},
        {"path": "meta.lang", "alias": "language"},
        {"path": "meta.size.source", "alias": "source"},
    ],
    "pivot_arrays": [
        {"path": "lines", "alias": "lines_array", "pivot_prefix": "line", "max_items": 3, "is_struct": True,
         "struct_fields": [{"original": "body", "new_suffix": "text"}, {"original": "width", "new_suffix": "width"}]},
        {"path": "tags", "alias": "tags_array", "pivot_prefix": "tag", "max_items": 2, "is_struct": False},
    ],
}


def _clean_sql(c: str) -> str:
    ascii_only = f"trim(regexp_replace({c}, '[^\\x00-\\x7F]', '', 'g'), ' ')"
    return f"coalesce(trim(regexp_replace({ascii_only}, '[\\r\\n]', ' ', 'g'), ' '), '')"


@query("config_flatten_job", f"""
    WITH {TEXT_DOCUMENTS_SQL}
    SELECT doc_id, {_clean_sql("lang")} AS lang, {_clean_sql("lang")} AS language, {_clean_sql("source")} AS source,
      {", ".join(f'{_clean_sql(f"lines[{i}]")} AS "line_text-{i}", coalesce(CAST(length(lines[{i}]) AS VARCHAR), {chr(39)*2}) AS "line_width-{i}"' for i in range(1, 4))},
      {", ".join(f'{_clean_sql(f"tags[{i}]")} AS "tag-{i}"' for i in range(1, 3))} FROM docs""")
def config_flatten_job(spark, sf):
    """A mapping-driven job: project one path twice and others once, pivot two arrays, clean every text."""
    return shape(text_documents(spark, sf), FlattenJob.from_dict(MAPPING))


# ---- text ---------------------------------------------------------------------------------------------------------

@query("clean_ascii_remove", "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS text FROM documents")
def clean_ascii_remove(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.drop_non_ascii(F.col("text")).alias("text"))


@query("clean_ascii_space", "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', ' ', 'g') AS text FROM documents")
def clean_ascii_space(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.space_non_ascii(F.col("text")).alias("text"))


@query("clean_newlines", "SELECT doc_id, regexp_replace(text, '[\\r\\n]', ' ', 'g') AS text FROM documents")
def clean_newlines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.space_line_breaks(F.col("text")).alias("text"))


@query("clean_all_strings", f"""
    SELECT doc_id, {_clean_sql("text")} AS text, {_clean_sql("lang")} AS lang, {_clean_sql("source")} AS source, n_chars
    FROM documents""")
def clean_all_strings(spark, sf):
    return text.clean_all_strings(table(spark, sf, "documents"))


@query("clean_printable", """
    SELECT doc_id, regexp_replace(regexp_replace(text, '^[\\s\\pZ\\x0B\\x1C-\\x1F\\x{85}]+|[\\s\\pZ\\x0B\\x1C-\\x1F\\x{85}]+$', '', 'g'),
                                  '[^\\x20-\\x7E]+', '', 'g') AS text FROM documents""")
def clean_printable(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean_printable(F.col("text")).alias("text"))


@query("palindrome_flag", """
    SELECT o_orderkey, lower(regexp_replace('No. ' || o_orderkey || ' .oN', '[^A-Za-z0-9]', '', 'g'))
             = reverse(lower(regexp_replace('No. ' || o_orderkey || ' .oN', '[^A-Za-z0-9]', '', 'g'))) AS is_palindrome
    FROM orders""")
def palindrome_flag(spark, sf):
    label = F.concat(F.lit("No. "), F.col("o_orderkey"), F.lit(" .oN"))
    return table(spark, sf, "orders").select("o_orderkey", text.is_palindrome(label).alias("is_palindrome"))


@query("capitalize_words", """
    SELECT doc_id, array_to_string(list_transform(string_split(text, ' '),
      lambda w: CASE WHEN substr(w, 1, 1) = 'ß' THEN 'SS' ELSE upper(substr(w, 1, 1)) END || substr(w, 2)), ' ') AS text FROM documents""")
def capitalize_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.capitalize_words(F.col("text")).alias("text"))


@query("word_count", """
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def word_count(spark, sf):
    return relational.word_count(table(spark, sf, "documents"))


@query("distinct_zipped_pairs", """
    SELECT DISTINCT doc_id, p[1] AS a, p[2] AS b FROM (
      SELECT doc_id, unnest(list_transform(list_zip(string_split(text, ' '), string_split(text, chr(10)), true), lambda z: [z[1], z[2]])) AS p
      FROM documents)""")
def distinct_zipped_pairs(spark, sf):
    """Words zipped with lines, cut to the shorter, each pair once per document."""
    pairs = scalars.zip_shortest(F.split("text", " ", -1), F.split("text", "\n", -1))
    return relational.distinct_pairs(table(spark, sf, "documents"), "doc_id", pairs)


def _draw_sql(seed: str, salt: int, bound: int) -> str:
    x = f"((({seed}) * 48271 + {salt} * 69621 + 12345) % 2147483647)"
    return f"((({x} * 16807) % 2147483647) // 1000 % {bound})"


def _pick_sql(words: list[str], n: str) -> str:
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return f"[{listed}][{n} + 1]"


def _values_sql(count: str, salt: int) -> str:
    picked = _pick_sql(synthetic.WORDS, _draw_sql("(i * 8 + x)", salt, 10))
    return f"coalesce(array_to_string(list_transform(range(1, CAST({count} AS BIGINT) + 1), lambda x: {picked}), ','), '')"


def _review_sql() -> str:
    s = "i * 8 + n"
    body = " || ' ' || ".join(_pick_sql(synthetic.WORDS, _draw_sql(s, k, 10)) for k in (21, 22, 23)) + " || ' and more'"
    name = f"{_pick_sql(synthetic.FIRST, _draw_sql(s, 26, 8))} || ' ' || {_pick_sql([w.replace(chr(39), '') for w in synthetic.LAST], _draw_sql(s, 27, 6))}"
    return (f"{_draw_sql(s, 25, 5)} + 1 AS stars, {name} AS reviewer, "
            f"{body} || CASE WHEN {_draw_sql(s, 24, 10)} = 0 THEN '{synthetic.SPECIAL}' ELSE '' END AS comment")


@query("synthetic_catalog", f"""
    WITH p AS (SELECT CAST(p_partkey AS BIGINT) AS i FROM part),
    b AS (SELECT i, {_pick_sql(synthetic.FIRST, _draw_sql("i", 1, 8))} AS first, {_pick_sql([w.replace(chr(39), '') for w in synthetic.LAST], _draw_sql("i", 2, 6))} AS last,
                 {_pick_sql([w.title() for w in synthetic.WORDS], _draw_sql("i", 3, 10))} || ' ' || {_pick_sql(synthetic.WORDS, _draw_sql("i", 4, 10))} AS title, {_pick_sql(synthetic.GENRES, _draw_sql("i", 5, 7))} AS genre,
                 ({_draw_sql("i", 6, 9201)} + 799) / 100.0 AS price,
                 strftime(DATE '2000-01-01' + CAST({_draw_sql("i", 7, 9000)} AS INTEGER), '%Y-%m-%d') AS publish_date,
                 {_draw_sql("i", 8, 6)} AS k, {_draw_sql("i", 9, 5)} AS v1, {_draw_sql("i", 11, 5)} AS v2 FROM p),
    r AS (SELECT *, unnest(CASE WHEN k = 0 THEN [NULL] ELSE range(1, k + 1) END) AS n FROM b)
    SELECT 'bk' || (i + 101) AS book_id, first, last, title, genre, CAST(price AS DOUBLE) AS price, publish_date,
           {_values_sql("v1", 10)} AS first_values, {_values_sql("v2", 12)} AS second_values, {_review_sql()}
    FROM r""")
def synthetic_catalog(spark, sf):
    """One book per part, flattened to one row per review."""
    books = synthetic.synthetic_catalog(table(spark, sf, "part").select("p_partkey"), "p_partkey")
    flat = books.select("_id", "author", "title", "genre", "price", "publish_date", "onemorecolumn", "secondcoloum",
                        F.explode_outer("reviewers.reviewer").alias("r"))
    return flat.select(
        F.col("_id").alias("book_id"), F.col("author.name.first").alias("first"), F.col("author.name.last").alias("last"), "title", "genre", "price", "publish_date",
        F.array_join("onemorecolumn.col1", ",").alias("first_values"), F.array_join("secondcoloum.col1", ",").alias("second_values"),
        F.col("r._stars").alias("stars"), F.col("r.name").alias("reviewer"), F.col("r.comment").alias("comment"),
    )
