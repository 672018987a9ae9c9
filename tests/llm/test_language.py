import math

import pyarrow as pa
from pyspark.sql import functions as F

from placewright.llm.language import DIMS, FAMILY_OF, fit, identify


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'")
    n, right = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 150 and right / n > 0.97
    assert got.where("not score between 0 and 1").count() == 0


def test_edges(spark):
    rows = [(i, w * 9, l) for i, (w, l) in enumerate([("the and ", "en"), ("der und ", "de"), ("qq zz ", "xx"), ("le la ", "fr")] * 12)]
    rows += [(900, None, "en"), (901, "", "de"), (902, "12 .!", None), (None, "the and the and", None), (3, "le la le la", None), (3, "le la le la", None)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {900, 901, 902}
    assert all(r.lang_pred == rows[r.doc_id][2] for r in got if r.doc_id is not None and r.doc_id < 48)
    assert identify(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    assert identify(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).first().lang_pred == "und"


def by_hand(model, text):
    """Family by the largest sigmoid, then votes of the pairs within it, over plain loops."""
    b = [32, *(c + 32 if 65 <= c <= 90 else c for c in text.encode()), 32, 32]
    n = len(text.encode()) + 1
    column = [((b[i] | b[i + 1] << 8 | b[i + 2] << 16) * 2654435761 % (1 << 32)) >> 18 for i in range(n)]
    assert max(column) < DIMS
    raw = [sum(float(w[c]) for c in column) / n + float(bias) for w, bias in zip(model.weights, model.bias)]
    p = [1 / (1 + math.exp(-4 * m)) for m in raw]
    f = [x / sum(p[: len(model.families)]) for x in p[: len(model.families)]]
    best = f.index(max(f))
    names = model.members[model.families[best]]
    votes, sure = dict.fromkeys(names, 0), dict.fromkeys(names, 1.0)
    for (a, c), x in zip(model.pairs, p[len(model.families) :]):
        if a in votes:
            votes[a if x > 0.5 else c] += 1
            sure[a], sure[c] = min(sure[a], x), min(sure[c], 1 - x)
    own = max(names, key=lambda k: votes[k] + sure[k] / 2)
    return own, max(f) * sure[own]


def test_predictions_by_hand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = fit(docs, ~held)
    assert sorted(x for m in model.members.values() for x in m) == sorted(r[0] for r in docs.select("lang").distinct().collect() if r[0])
    assert all(FAMILY_OF.get(x, x) == f for f, m in model.members.items() for x in m)
    got = {r.doc_id: r for r in identify(docs).collect()}
    for r in docs.collect():
        if got[r.doc_id].lang_pred != "und" and len(r.text) < 5000:
            lang, score = by_hand(model, r.text)
            assert got[r.doc_id].lang_pred == lang and abs(got[r.doc_id].score - score) < 1e-3
    column = pa.chunked_array([pa.array(["The thing and the other", "x"])])
    assert [by_hand(model, t)[0] for t in column.to_pylist()] == model.predict(column)[0].tolist()


def test_columns_with_the_names_of_results(spark):
    rows = [(i, "the and of " * 9 if i % 2 else "der und die " * 9, "en" if i % 2 else "de", 5, "x", 1.5) for i in range(40)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, SCORE int, Held_Out string, own double"), columns=True)
    assert got.columns == ["doc_id", "text", "lang", "own", "held_out", "lang_pred", "score", "typical"] and got.where("lang = lang_pred and own = 1.5").count() == 40


def test_repeated_rows_are_fitted_once(spark):
    many = [(7, "the and of " * 9, "en")] * 5000 + [(i, "der und die " * 9, "de") for i in range(50)]
    model = fit(spark.createDataFrame(many, "doc_id long, text string, lang string"), F.lit(True), per_language=10)
    assert model is not None and sorted(x for m in model.members.values() for x in m) == ["de", "en"]


def test_every_language_is_learned(spark):
    """Seventy languages, each of its own words."""
    word = lambda k: "".join(chr(97 + (k * m + m) % 26) for m in (3, 5, 7, 11))
    names = [f"l{k:02d}" for k in range(66)] + ["de", "en", "fr", "es"]
    rows = [(k * 100 + j, f"{word(k)}{k} {word(k + 100)} " * (3 + j), n) for k, n in enumerate(names) for j in range(9)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(False))
    assert {(r.doc_id, r.lang_pred) for r in got.collect()} == {(d, n) for d, _, n in rows}
