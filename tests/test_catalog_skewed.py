"""Queries against their SQL on tables where one key holds a third of the rows, half of those being equal copies."""

import importlib.util
import os

import duckdb
import pytest
from compare import TABLES, compare, connect

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

HOT = {
    "lineitem": """SELECT * EXCLUDE (n) REPLACE (
        CASE WHEN n % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, CASE WHEN n % 6 = 0 THEN 11 ELSE l_partkey END AS l_partkey,
        CASE WHEN n % 6 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey, CASE WHEN n % 6 = 0 THEN 2 ELSE l_linenumber END AS l_linenumber,
        CASE WHEN n % 6 = 0 THEN 5.0 ELSE l_quantity END AS l_quantity) FROM (SELECT *, row_number() OVER () AS n FROM lineitem)""",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey) FROM orders",
    "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id,
        CASE WHEN event_id % 3 = 0 THEN 'click' ELSE event_type END AS event_type,
        CASE WHEN event_id % 6 = 0 THEN '{"k": 50}' ELSE props END AS props) FROM events""",
    "documents": "SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM documents WHERE doc_id = 1) ELSE text END AS text) FROM documents",
}
NAMES = """order_items_numbered order_items_pivot order_items_array_pivot xml_roundtrip_orders xml_split_scan_orders request_bodies word_count
distinct_zipped_pairs latest_n_bars ohlc_hourly tick_indicators_in_blocks tick_drawdown_in_slices pair_sum_self_join sellable_semi_join
blocked_anti_join sum_by_year_name top20_names trade_log equity_curve signal_summary_with_missing flatten_outer stream_hourly_bars""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for t in TABLES:
        con.execute(f"COPY ({HOT.get(t, f'SELECT * FROM {t}')}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql_on_hot_keys(spark, hot_dir, name):
    found = compare(entry.queries()[name](spark, hot_dir), connect(hot_dir), entry.oracle_sql()[name])
    assert found["columns"] and found["rows"][0] == found["rows"][1]
    assert not found["missing"] and not found["extra"], found
