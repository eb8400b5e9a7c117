"""Every registered query against its SQL on the smallest tables."""

import importlib.util
import os

import pytest
from compare import compare, connect

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from catalog.common import ORACLES, QUERIES  # noqa: E402

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    found = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert found["columns"]
    assert not found["missing"] and not found["extra"], found
    assert found["rows"][0] == found["rows"][1]
    assert {c: d for c, (s, d) in found["types"].items() if SPARK_TO_DUCK.get(s) != d} == {}


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
