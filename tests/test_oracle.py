"""Every registered query against its DuckDB statement (sf0.001, whole tables)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck
from tunemill.plans.catalog import QUERIES
from tunemill.plans.sql import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res["ok"], res


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == set()
    assert len(QUERIES) >= 55
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["example_id", "input_ids", "attention_mask", "labels",
                          "prompt_len", "n_tokens"]
