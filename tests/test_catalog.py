"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, duck, rows_of

from .conftest import SF

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    verdict = compare(rows_of(df.columns, rows), rows_of(names, result.fetchall()))
    assert verdict == "exact" or verdict.startswith("rounding"), verdict


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
