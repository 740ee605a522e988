"""Every registered query against its DuckDB SQL (row count, column names, value hash).

Runs at sf0.001 by default (fast); set COMPARO_TEST_SF=/root/testdata/sf0.01 for the driver's scale.
Queries without SQL must run and return rows.
"""

import os

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck

SF = os.environ.get("COMPARO_TEST_SF", SF_SMALL)


def _registry():
    from comparo.registry import ORACLE, QUERIES
    return QUERIES, ORACLE


QUERIES, ORACLE = _registry()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    import importlib.util
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.columns[:3] == ["input_id", "rank", "domain"] and df.count() > 0
    assert set(mod.oracle_sql()) <= set(mod.queries())
