"""Every registered query against its DuckDB oracle (smoke scale)."""

import pytest

import __spark_entry__ as E
from tools.compare import compare

NAMES = sorted(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, name):
    res = compare(spark, sf_dir, [name])[name]
    if name in E.oracle_sql():
        assert res["ok"] is True, res
        assert "type_mismatch" not in res, res
    else:
        assert "error" not in res, res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "doi"
