import pytest
from oracle_compare import compare, duck

import __spark_entry__ as entry
from tunemill.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    r = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert r["ok"], r
