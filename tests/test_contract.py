"""Every query of the entry module runs on the smallest tables, and equals its SQL where there is one."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
CORE = [n for n in contract.queries() if not (n[0] == "p" and n[1].isdigit())]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(DATA):
        c.sql(f"create view {t.split('.')[0]} as select * from '{DATA}/{t}'")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    tidy = lambda v: round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(tidy(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    got = rows(df.columns, df.collect())
    if name in contract.oracle_sql():
        want = duck.sql(contract.oracle_sql()[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert got == rows(list(want.columns), want.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
