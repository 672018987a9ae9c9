import duckdb
import pytest

from placewright.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(map(str, ({c: v for c, v in zip(columns, r)} for r in cursor.fetchall())))
    got = QUERIES[name](spark, sf)
    assert got.columns == columns
    assert sorted(str(r.asDict()) for r in got.collect()) == want
