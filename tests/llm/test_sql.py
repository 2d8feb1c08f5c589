"""The registered SQL of the operators gives their queries' rows."""

import duckdb
import pytest

from hourgrid.llm.registry import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = duck.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r) for r in got.select(*want.columns).collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr) and rows
