import subprocess
import sys

import pytest

import __spark_entry__ as entry
from kotonoha.plans import flow_queries, reference_queries, review_queries, text_queries

PARTS = (reference_queries, text_queries, flow_queries, review_queries)
QUERIES = {k: v for part in PARTS for k, v in part.queries().items()}
SQL = {k: v for part in PARTS for k, v in part.oracle_sql().items()}


def test_contract():
    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names) and set(QUERIES) <= set(names) and "p2_found" in QUERIES
    assert set(QUERIES) == set(SQL)


def test_a_broken_subpackage_is_not_taken_for_a_missing_one():
    code = "import sys; sys.modules['numpy'] = None; import __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode and "numpy" in done.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(agrees, name):
    assert agrees(QUERIES[name], SQL[name])
