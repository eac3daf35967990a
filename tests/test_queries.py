"""Every query of the library on the smallest tables, against its SQL where it has one.

The training-data operators are tested in their own folder.
"""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from noticelake.queries import modules

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _rows(df):
    def cell(v):
        if pd.isna(v) is True:
            return "NULL"
        if isinstance(v, bool) or type(v).__name__.startswith("bool"):
            return str(bool(v))
        try:
            return "NULL" if math.isnan(float(v)) else f"{float(v):.7g}" if not isinstance(v, str) else v
        except (TypeError, ValueError):
            return str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(name for m in modules() for name in m.QUERIES))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
