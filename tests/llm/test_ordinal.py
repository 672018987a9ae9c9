import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from placewright.llm.ordinal import DIMS, FORM, OrdinalModel, features, fit_ordinal, grade_quality
from placewright.llm.queries import grades


def test_held_out(spark, sf):
    sf = sf.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    graded = grades(labels)
    train = graded.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 0)
    got = grade_quality(docs, train).join(graded.join(train, "doc_id", "left_anti"), "doc_id").toPandas()
    toxic = got["grade"] == 0
    assert toxic.sum() > 50 and (~got["kept"])[toxic].mean() > 0.8 and got["kept"][~toxic].mean() > 0.97
    order = got[~toxic].sort_values("expected_grade")["grade"].to_numpy()
    n = len(order) // 10
    assert np.mean(order[-5 * n :]) > np.mean(order[:n])


def test_edges(spark):
    docs = spark.createDataFrame([(1, "good text"), (2, None), (3, ""), (None, "bad"), (1, "good text")], "doc_id long, text string")
    ratings = spark.createDataFrame([(1, 2), (None, 0), (3, 0), (9, 1), (1, 2)], "doc_id long, grade int")
    got = grade_quality(docs, ratings).collect()
    assert len(got) == 5 and all(0 <= r.expected_grade <= 2 for r in got)
    assert len(grade_quality(docs, ratings.limit(0)).collect()) == 5
    assert grade_quality(docs.limit(0), ratings).count() == 0


def test_tails_by_hand():
    texts = ["Good text, good text!", "", None, "12 | 34\nbadly badly badly", "é" * 40]
    column = pa.chunked_array([pa.array(texts)])
    r = np.random.default_rng(3)
    model = OrdinalModel(r.normal(size=DIMS), r.normal(size=FORM), np.array([-0.5, 0.7]))
    key, at, form = features(column)
    for i, tails in enumerate(model.tails(column)):
        z = sum(model.words[k] for k in key[at[i] : at[i + 1]]) + sum(a * b for a, b in zip(form[i], model.form))
        assert np.allclose(tails, [1 / (1 + math.exp(-(z - t))) for t in model.thresholds])
        assert tails[0] > tails[1]
    assert len(set(key[at[0] : at[1]])) == at[1] - at[0] == 2 and at[2] == at[3] - 0 == at[1]


def test_fit_finds_a_word():
    marks = [np.array([5] if g == 2 else [9] if g == 0 else [1]) for g in (0, 1, 2) * 60]
    model = fit_ordinal([(k, np.zeros(FORM)) for k in marks], np.array([0, 1, 2] * 60))
    assert model.words[5] > 0 > model.words[9] and (np.diff(model.thresholds) >= 0).all()
    tail = lambda w, k: 1 / (1 + math.exp(-(model.words[w] - model.thresholds[k])))
    assert tail(5, 1) > 0.5 > tail(9, 0)


def test_negative_grades_are_left_out(spark):
    docs = spark.createDataFrame([(i, "good text" if i % 2 else "bad text") for i in range(40)], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, -1 if i == 3 else i % 2) for i in range(40)], "doc_id long, grade int")
    assert grade_quality(docs, ratings).count() == 40
