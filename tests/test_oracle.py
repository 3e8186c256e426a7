"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from loam.plans.oracle import oracle_sql
from loam.plans.oracle_check import compare, duck_connection
from loam.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(E.queries()[name](spark, SF), E.oracle_sql()[name], con)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["areasymbol", "musym", "muname", "mukey", "int_mukey", "claytotal_r"]
