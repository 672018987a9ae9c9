"""Steps whose work, memory or disk once grew faster than they need to."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from placewright.functions import space
from placewright.llm import spread
from placewright.operators import graph, name_index, pairs, vector_index


def test_copies_of_points_are_never_broadcast(spark):
    at = spark.range(40).select(F.format_string("p%02d", "id").alias("place_id"), (F.col("id") * 0.1).alias("lon"), F.lit(1.0).alias("lat"))
    found = graph._spots_within(at, 12, space.haversine_km, None)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "REPARTITION_BY_NUM" in plan
    assert {(r.place_id, r.other) for r in found.collect()} == {(f"p{i:02d}", f"p{i + 1:02d}") for i in range(39)}


def test_names_are_cut_by_many_tasks(spark, tmp_path, monkeypatch):
    plans = []
    n = spark.createDataFrame([("a", "Anna Anna"), ("b", "nana")], "toponym_id string, name string")
    monkeypatch.setattr(type(n), "hint", lambda self, *a, of=type(n).hint: (plans.append(self._jdf.queryExecution().optimizedPlan().toString()), of(self, *a))[1])
    name_index.append(n, str(tmp_path))
    assert "RepartitionByExpression" in plans[0]
    rows = spark.read.parquet(f"{tmp_path}/postings")
    assert rows.count() == rows.distinct().count() and rows.where("kind = 'word'").count() == 2


def test_equal_vectors_are_one(spark, tmp_path, monkeypatch):
    built = []
    monkeypatch.setattr(vector_index, "build", lambda v, path, of=vector_index.build: (built.append(v.count()), of(v, path))[1])
    x = np.random.default_rng(2).normal(size=(4, 6))
    vec = spark.createDataFrame([(f"t{i:02d}", [float(c) for c in x[i % 4]]) for i in range(40)] + [("zero", [0.0] * 6)], "toponym_id string, vector array<double>")
    names = spark.createDataFrame([(f"p{i}", f"t{i:02d}", "LATIN") for i in range(40)], "place_id string, toponym_id string, script string")
    hashed = {r.toponym_id: r.h for r in vec.select("toponym_id", F.xxhash64("toponym_id").alias("h")).collect()}
    got = {r.toponym_id: r.negative for r in pairs.vector_negatives(vec, names, str(tmp_path / "v"), 3, 4).collect()}
    assert built == [4] and len(got) == 40
    for i in range(40):  # the nearest three by the hash of their names are of the same vector
        same = sorted((f"t{j:02d}" for j in range(i % 4, 40, 4) if j != i), key=hashed.get)
        assert got[f"t{i:02d}"] in same[:3]


def test_filter_of_ids(spark):
    words, bits = spread.filter_of(spark.range(0, 3000, 3).withColumnRenamed("id", "x"), "x")
    at = spark.range(3000).select("id", spread.place_in_filter("id", bits).alias("at")).toPandas().sort_values("id")
    passed = spread.passing(words, at["at"].to_numpy())
    assert passed[::3].all() and passed[1::3].mean() < 0.3


def test_a_text_travels_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(corpus_pipeline, "duplicated_words", lambda given, of=corpus_pipeline.duplicated_words, **more: (seen.append(given.schema["doc"].dataType.names), of(given, **more))[1])
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3), (2, None, "en", "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [tuple(r) for r in corpus_pipeline.substring_removal(spark, docs, "").collect()] == [(1, "a b", "en", "s", 3)]
    assert seen == [["doc_id", "lang", "source", "n_chars"]]
