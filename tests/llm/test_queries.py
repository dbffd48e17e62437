import duckdb
import pytest

from fieldloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
