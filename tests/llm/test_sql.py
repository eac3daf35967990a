"""The operators' queries against the SQL that is registered for them, on the smallest tables."""

import duckdb
import pytest

from noticelake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def cell(v):
    if v is None or v != v:
        return "NULL"
    return str(v.item() if hasattr(v, "item") else v)


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(cell(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, map(tuple, got.collect())) == rows(names, want.fetchall())
