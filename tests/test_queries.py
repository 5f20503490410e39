"""Every registered query against its SQL twin (or: it returns rows)."""

from __future__ import annotations

import check
import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.duck(sf_dir)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert check.compare(df, con, ORACLES[name]) is None
    else:
        assert df.limit(1).count() == 1


def test_entry(spark):
    assert contract.entry(spark).count() > 0
