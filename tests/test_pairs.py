import numpy as np
from pyspark.sql import functions as F

from placewright.functions import labels, script, shapes, temporal
from placewright.operators import documents, knn, pairs, tree


def test_balanced_shards_by_hand(spark):
    costs = [9, 7, 6, 5, 5, 4, 1]
    items = spark.createDataFrame([("g", i, c) for i, c in enumerate(costs)], "g string, item int, cost int")
    got = {r.item: r.shard for r in documents.balanced_shards(items, "g", "item", "cost", 2, 1).collect()}
    load, want = [0, 0], {0: 0}
    for i in sorted(range(1, 7), key=lambda i: (-costs[i], i)):
        s = load.index(min(load))
        load[s] += costs[i]
        want[i] = s + 1
    assert got == want


def test_calibration_by_hand(spark):
    r = np.random.default_rng(2)
    x, y = r.random((300, 2)), r.random(300)
    label = (x[:, 0] > y).astype(int)
    frame = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, label)], "a double, b double, label int")
    got = pairs.calibrated(frame, ["a", "b"], steps=200)
    w, m = np.zeros(3), np.c_[np.ones(300), x]
    for _ in range(200):
        w -= 0.5 * (m.T @ (1 / (1 + np.exp(-(m @ w))) - label) + np.r_[0, w[1:]]) / 300
    size = np.abs(w[1:]) / np.abs(w[1:]).sum() * 0.85
    assert abs(got["a"] - size[0]) < 1e-6 and abs(got["b"] - size[1]) < 1e-6 and got["link"] == 0.15 and got["a"] > got["b"]


def test_clusters_are_split_where_wide(spark):
    at = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.1, 0.0), ("c", 9.0, 0.0), ("d", 9.1, 0.0), ("e", 50.0, 0.0), ("f", 50.1, 0.0)], "place_id string, lon double, lat double")
    scored = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.5), ("c", "d", 0.8), ("e", "f", 0.41), ("a", "e", 0.1)], "place_a string, place_b string, score double")
    got = {r.place_id: r.cluster for r in pairs.clusters(scored, at).collect()}
    assert got["a"] == got["b"] != got["c"] == got["d"] != got["e"] == got["f"] and all(c.startswith("c_") and len(c) == 18 for c in got.values())


def test_triplets_and_negatives(spark):
    names = spark.createDataFrame([(f"p{i}", f"na{i}@en", f"na{i}", "LATIN", "en") for i in range(30)] + [("p0", "nb@en", "nb", "LATIN", "en")], "place_id string, toponym_id string, name string, script string, lang string")
    p = pairs.candidate_pairs(names)
    got = pairs.triplets(p, names, hard=True).collect()
    assert len(got) == 1 and got[0].anchor == "na0@en" and got[0].negative.startswith("na") and got[0].negative != "na0@en"
    near = names.select("toponym_id").crossJoin(names.select(F.col("toponym_id").alias("other")))
    for r in pairs.hard_negatives(near, names).collect():
        assert r.toponym_id != r.negative and {r.toponym_id, r.negative} != {"na0@en", "nb@en"}


def test_spellings_join_by_chains(spark):
    v = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [("p", f"t{i}", v(i * 0.5)) for i in range(4)] + [("p", "far", v(3.0)), ("q", "t0", v(0))]
    got = {(r.place_id, r.toponym_id): r.spelling for r in pairs.grouped_names(spark.createDataFrame(rows, "place_id string, toponym_id string, vector array<double>"), 0.85).collect()}
    assert {got["p", f"t{i}"] for i in range(4)} == {"t0"} and got["p", "far"] == "far" and got["q", "t0"] == "t0"


def test_nearest_by_brute_force(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(90, 5))
    e = spark.createDataFrame([(i, i % 3, [float(c) for c in row]) for i, row in enumerate(x)], "id long, label int, e array<double>")
    got = {(q.query, q.rank): q.id for q in knn.nearest(e.where("id < 9"), e, 4).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    for q in range(9):
        s = unit @ unit[q]
        s[q] = -2
        assert [got[q, k + 1] for k in range(4)] == np.argsort(-s)[:4].tolist()


def test_noise_and_shapes(spark):
    row = spark.createDataFrame([("Kirkby", 7)], "t string, k int").select(labels.noisy(F.col("t"), F.col("k")).alias("n"), shapes.wkt(shapes.rectangle(F.lit(0), F.lit(0), F.lit(2), F.lit(1))).alias("w"), script.jaro_winkler(F.lit("martha"), F.lit("marhta")).alias("j")).first()
    assert row.n != "Kirkby" and abs(len(row.n) - 6) <= 1 and row.w == "POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))" and abs(row.j - 0.9611) < 1e-4


def test_walk_through_a_cycle(spark):
    links = spark.createDataFrame([(2, 1), (3, 2), (1, 3), (3, 1), (4, 3)], "child long, parent long")
    assert {r.node: r.path for r in tree.walk(links, [1]).collect()} == {1: "1", 2: "1.2", 3: "1.3", 4: "1.3.4"}


def test_overlap_of_ranges(spark):
    cases = [((1400, 1500), (1450, 1550), 50 / 150), ((1707, None), (1800, 1850), 50 / 143), ((None, 1974), (None, 1850), 0.0)]
    for (a, b), (c, d), want in cases:
        t = spark.createDataFrame([(a, b, c, d)], "a long, b long, c long, d long").select(temporal.overlap(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("o")).first().o
        assert abs(t - want) < 1e-9


def test_winkler_halves_are_whole_and_low_values_are_not_raised(spark):
    # Three matches out of order are one exchange; a shared beginning counts above 0.7 only.
    pairs_ = {("abcxyz", "bcaxyz"): (1 + 1 + 5 / 6) / 3, ("abqrst", "abuvwx"): (2 / 6 + 2 / 6 + 1) / 3}
    got = spark.createDataFrame(list(pairs_), "a string, b string").select("a", "b", script.jaro_winkler(F.col("a"), F.col("b")).alias("j")).collect()
    assert len(got) == 2 and all(abs(r.j - pairs_[r.a, r.b]) < 1e-12 for r in got)


def test_negatives_of_a_bucket_aren_t_crossed(spark, monkeypatch):
    # 400 names of one beginning, two of which share a place: each gets a stranger, and no more than eight a name are looked at.
    rows = [(f"p{i // 2}", f"name{i:03}@en", f"name{i:03}", "LATIN", "en") for i in range(400)] + [("q", "other@en", "other", "LATIN", "en")]
    names = spark.createDataFrame(rows, "place_id string, toponym_id string, name string, script string, lang string")
    place = {r[1]: r[0] for r in rows}
    seen = []
    monkeypatch.setattr(pairs, "durable", lambda df, *a: seen.append(df) or df)
    got = pairs.bucket_negatives(names, 4).collect()
    assert {r.toponym_id for r in got} == set(place) - {"other@en"} and all(place[r.toponym_id] != place[r.negative] for r in got)
    tried = [df.count() for df in seen if df.columns == ["anchor", "step", "negative"]]
    assert tried and max(tried) <= 8 * 400
    # An anchor's only stranger being the positive, it has no negative; with two, the other.
    few = spark.createDataFrame([("p", "a@en", "a", "LATIN", "en"), ("q", "b@en", "b", "LATIN", "en"), ("r", "c@en", "c", "LATIN", "en")], names.schema)
    p = spark.createDataFrame([("a@en", "b@en"), ("a@en", "c@en")], "toponym_id_a string, toponym_id_b string")
    assert {tuple(r) for r in pairs.triplets(p, few, hard=False).collect()} == {("a@en", "b@en", "c@en"), ("a@en", "c@en", "b@en")}
