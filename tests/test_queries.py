"""Every query with SQL gives the SQL's rows on the smallest tables; the others run."""

import math
import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
OWN = sorted(k for k in __spark_entry__.queries() if not k.startswith("op") and k != "pipeline")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    return round(float(v), 9) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    key = lambda r: [(x is None, str(x)) for x in r]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=key)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    df = __spark_entry__.queries()[name](spark, SF)
    rows = df.collect()
    sql = __spark_entry__.oracle_sql().get(name)
    assert sql, "no SQL"
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert table(df.columns, rows) == table(names, cur.fetchall())
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
