import os

import duckdb
import pytest

from tagloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    df, out = queries.QUERIES[name](spark, SF), con.execute(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(d[0] for d in out.description)
    names = [d[0] for d in out.description]
    expected = sorted(tuple(r[names.index(c)] for c in columns) for r in out.fetchall())
    assert sorted(map(tuple, df.select(columns).collect())) == expected
