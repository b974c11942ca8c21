"""Every registered query against its SQL on the smallest test set."""

import importlib.util
from pathlib import Path

import pytest

import compare
from conftest import ROOT

SF = "/root/testdata/sf0.001"
spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
QUERIES, SQL = entry.all_queries(), entry.all_oracles()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) > 130


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    _, rows, verdict = compare.compare(spark, duck, SF, name, QUERIES[name], SQL[name])
    assert verdict.startswith("ok"), verdict


def test_entry_has_every_query():
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
