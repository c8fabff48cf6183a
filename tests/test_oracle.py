"""Every registered query against its DuckDB oracle (sf0.001 keeps the suite fast;
the driver runs the same comparison at sf0.01)."""

from __future__ import annotations

import os

import pytest

from tests.oracle_check import compare, duck
from tierline.plans import registry

SF_DIR = os.environ.get("TIERLINE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = registry.all_queries()
ORACLE = registry.all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert missing == [], f"queries without oracle: {missing}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    if name not in ORACLE:
        pytest.skip("rows-only query")
    problems, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR)
    assert problems == []


def test_entry_smoke(spark):
    import __spark_entry__ as entry_mod

    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "customer_key" in df.columns
