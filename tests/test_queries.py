import math

import duckdb
import pytest

from placewright.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9) + 0.0
    return x


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    got = QUERIES[name](spark, sf)
    rows = got.collect()
    if name not in ORACLES:
        assert got.columns
        return
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    want = sorted(str({c: plain(v) for c, v in sorted(zip(columns, r))}) for r in cursor.fetchall())
    assert sorted(str({c: plain(v) for c, v in sorted(r.asDict().items())}) for r in rows) == want
    assert rows


def test_envelope_gathers_no_group(spark, sf):
    plan = QUERIES["envelope_and_core"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_all_rows(spark, sf):
    tables = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("part", "customer", "supplier", "orders")}
    assert QUERIES["tiles_of_all"](spark, sf).count() == tables["part"] + tables["customer"] + tables["supplier"]
    assert QUERIES["place_lookup_of_all"](spark, sf).count() == tables["orders"]


def test_every_part_is_voted(spark, sf):
    got = [r.query for r in QUERIES["voted_countries"](spark, sf).select("query").collect()]
    assert sorted(got) == sorted(f"pa:{r.p_partkey}" for r in spark.read.parquet(f"{sf}/part.parquet").select("p_partkey").collect())


def test_reconciled_turns_with_accents(spark, tmp_path):
    texts = {0: "Été à Köln", 1: "Straße und Tür", 2: "mañané", 3: "où", 5: "  ÀÉ "}
    spark.createDataFrame([(1, k, "user", t) for k, t in texts.items()], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.turn: (r.rule, r.reading) for r in QUERIES["reconciled_turns"](spark, str(tmp_path)).collect()}
    assert got == {0: ("match", "Été à Köln"), 1: ("vlm-truncated", "Straße und Tür"), 2: ("correction", "mañanx"), 3: ("vlm-empty", "où"), 5: ("match", "ÀÉ")}
