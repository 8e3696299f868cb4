"""Queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from epistand.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    columns = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(c) for c in columns]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
