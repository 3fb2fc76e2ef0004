"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import pytest

from liftlens.plans.catalog import ORACLE, QUERIES
from oracle_harness import compare, duck

from conftest import SF_SMALL

_con = {}


def _duck():
    if "c" not in _con:
        _con["c"] = duck(SF_SMALL)
    return _con["c"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE.get(name), _duck())
    assert res["status"] in ("exact", "approx9", "rows-only"), res
    assert res["rows_spark"] >= 0


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
