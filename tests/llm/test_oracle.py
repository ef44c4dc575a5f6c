"""The training-data queries that SQL can express, against DuckDB at sf0.001."""

import duckdb
import pytest

from terrane.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=key) == sorted(cur.fetchall(), key=key)


def test_every_numbered_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
