import numpy as np
from pyspark.sql import functions as F

from placewright.operators import name_index, search, vector_index
from placewright.plans import QUERIES


def names(spark):
    words = ["Köln", "Cologne", "Colne", "Kolín", "São Paulo", "St. John's", "Saint-Jean", "a", "", "New  York", "Newyork", "x" * 30 + "y", "Ελλάς", "O'Neil"]
    return spark.createDataFrame([(f"{w}@{i}", w) for i, w in enumerate(words * 2)] + [(None, "lost"), ("lost", None)], "toponym_id string, name string")


def test_names_as_by_scans(spark, tmp_path):
    n = names(spark)
    whole = n.where("toponym_id is not null and name is not null").distinct()
    for part in (n.where("toponym_id like '%1%'"), n, n.where("toponym_id like '%2%'")):
        name_index.append(part, str(tmp_path), 8)
    for f, by_scan, asked in ((name_index.starts, search.starts, ["co", "kol", "SAINT", "john", "x" * 25, "a", "new  y"]), (name_index.infix, search.infix, ["OLN", "o", "w  y", "aint-j", "λλ", "xyz"]), (name_index.fuzzy, search.fuzzy, ["kolm", "colgne", "o'neil", "new york", "nothing", "St. Johm's"])):
        for q in asked:
            key = lambda df: sorted((r.toponym_id, r.name, r.score) for r in df.select("toponym_id", "name", "score").collect())
            assert key(f(spark, str(tmp_path), q, 8)) == key(by_scan(whole, q)), (f.__name__, q)


def test_few_files_are_read(spark, tmp_path):
    name_index.append(names(spark), str(tmp_path))
    read = name_index.postings(spark, str(tmp_path), "edge", ["co"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan and "bucket" in plan
    assert 0 < read._jdf.queryExecution().toRdd().getNumPartitions() <= 2


def test_vectors_by_brute_force(spark, tmp_path):
    r = np.random.default_rng(8)
    x = np.concatenate([c + 0.35 * r.normal(size=(150, 16)) for c in r.normal(size=(12, 16))])
    rows = [(i, i % 3, [float(v) for v in row]) for i, row in enumerate(x)] + [(9000, 0, None), (9001, 0, [0.0] * 16), (9002, 1, [float("nan")] + [1.0] * 15)]
    e = spark.createDataFrame(rows, "id long, label int, e array<double>")
    vector_index.build(e.where("id <= 1500 or id >= 9000"), str(tmp_path), sample=700)
    vector_index.append(e.where("id > 1500 and id < 9000"), str(tmp_path))
    asked = e.where("id % 50 = 0 and id < 9000")
    unit = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32).astype(float)
    for keep, fits in ((None, lambda i: True), (F.col("label") == 1, lambda i: i % 3 == 1)):
        got = {}
        for q in vector_index.search(spark, str(tmp_path), asked, 10, 6, keep=keep).collect():
            got.setdefault(q.query, {})[q.id] = q.score
        wanted = found = 0
        for q in range(0, len(x), 50):
            s = unit @ unit[q]
            top = [j for j in np.argsort(-s, kind="stable") if j != q and s[j] >= 0.7 and fits(j)][:10]
            wanted, found = wanted + len(top), found + len(set(top) & set(got.get(q, {})))
            assert all(abs(s[j] - v) < 1e-5 and v >= 0.7 and fits(j) and j != q for j, v in got.get(q, {}).items())
        assert wanted > 100 and found / wanted >= 0.9
    seen = vector_index.scanned(spark, str(tmp_path), asked, 6).first()
    assert seen.rows == len(x) and seen.compared < 0.5 * len(x) * asked.count()


def test_recall_of_the_given_table(spark, sf):
    r = QUERIES["indexed_recall"](spark, sf).first()
    assert r.wanted > 0 and r.recall >= 0.9 and r.scanned < 0.6


def test_negatives_are_near(spark, tmp_path):
    from placewright.operators import pairs

    r = np.random.default_rng(3)
    x = r.normal(size=(60, 8))
    vec = spark.createDataFrame([(f"t{i}", [float(v) for v in row]) for i, row in enumerate(x)], "toponym_id string, vector array<double>")
    names = spark.createDataFrame([(f"p{i // 3}", f"t{i}", "LATIN" if i % 4 else "GREEK") for i in range(60)], "place_id string, toponym_id string, script string")
    got = {q.toponym_id: q.negative for q in pairs.vector_negatives(vec, names, str(tmp_path / "v"), 10, 60).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    fits = lambda i, j: i != j and i // 3 != j // 3 and (i % 4 > 0) == (j % 4 > 0)
    for i in range(60):
        near = [j for j in np.argsort(-(unit @ unit[i])) if j != i][:10]
        good = {f"t{j}" for j in near if fits(i, j)}
        assert got.get(f"t{i}") in good if good else f"t{i}" not in got
