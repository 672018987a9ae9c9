import math
import random

import numpy as np

from placewright.operators import density, pairs


def km(a, b):
    h = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def plain(points, reach, core):
    """Points of one group by id: their cluster's least core place, or None."""
    near = {i: [j for j in points if km(points[i], points[j]) <= reach] for i in points}
    cores = {i for i in points if len(near[i]) >= core}
    label = {}
    for i in sorted(cores):
        todo = [] if i in label else [i]
        while todo:
            j = todo.pop()
            if j not in label:
                label[j] = i
                todo += [x for x in near[j] if x in cores]
    out = {}
    for i in points:
        close = [j for j in near[i] if j in cores]
        out[i] = label[i] if i in cores else label[min(close, key=lambda j: (km(points[i], points[j]), j))] if close else None
    return out


def test_points_by_brute_force(spark):
    r = random.Random(4)
    rows = []
    for i in range(2000):
        x, y = r.choice([(0, 0), (179.8, 10), (30, 60), (-40, -20)])
        rows.append((f"g{i % 3}", f"p{i:04d}", (x + r.gauss(0, 2) + 180) % 360 - 180, y + r.gauss(0, 2)))
    frame = spark.createDataFrame([*rows, ("g0", "none", None, None)], "grp string, place_id string, lon double, lat double")
    for core in (2, 5):
        got = {x.place_id: x.cluster for x in density.dense(frame, 25.0, core).collect()}
        want = {"none": None}
        for g in range(3):
            want |= plain({p: (x, y) for h, p, x, y in rows if h == f"g{g}"}, 25.0, core)
        assert got == want and len(set(want.values())) > 10


def test_equal_positions_are_one_point(spark):
    rows = [("g", f"p{i}", 5.0, 5.0) for i in range(400)] + [("g", "q", 5.1, 5.0), ("g", "r", 9.0, 9.0)]
    got = {x.place_id: x.cluster for x in density.dense(spark.createDataFrame(rows, "grp string, place_id string, lon double, lat double"), 20.0, 50).collect()}
    assert got == {**{f"p{i}": "p0" for i in range(400)}, "q": "p0", "r": None}


def test_wide_clusters(spark):
    at = [("a", 0.0, 0.0), ("b", 0.1, 0.0), ("c", 9.0, 0.0), ("d", 9.1, 0.0), ("d2", 9.2, 0.0), ("lone", 20.0, 0.0), ("lost", None, None), ("e", 50.0, 0.0), ("f", 50.1, 0.0)]
    scored = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.5), ("c", "d", 0.8), ("d", "d2", 0.8), ("d", "lone", 0.7), ("a", "lost", 0.6), ("e", "f", 0.41), ("a", "e", 0.1)], "place_a string, place_b string, score double")
    got = {r.place_id: r.cluster for r in density.coherent_clusters(scored, spark.createDataFrame(at, "place_id string, lon double, lat double")).collect()}
    groups = {}
    for k, c in got.items():
        groups.setdefault(c, set()).add(k)
    assert sorted(map(sorted, groups.values())) == [["a", "b"], ["c", "d", "d2", "lost"], ["e", "f"], ["lone"]]


def condensed(unit, samples, epsilon):
    """Straight from the definition: what is joined at a distance, taken apart at the largest distance that joins it."""
    n = len(unit)
    d = np.maximum(0.0, 1 - unit @ unit.T)
    np.fill_diagonal(d, 0)
    core = np.sort(d, 1)[:, min(samples, n - 1)]
    m = np.maximum(d, np.maximum(core[:, None], core[None, :]))

    def parts(s, limit, strict):
        left, out = set(s), []
        while left:
            todo, own = [left.pop()], set()
            while todo:
                i = todo.pop()
                own.add(i)
                more = {j for j in left if (m[i, j] < limit if strict else m[i, j] <= limit)}
                left -= more
                todo += more
            out.append(sorted(own))
        return out

    clusters = []

    def grow(s, born, parent):
        me = len(clusters)
        clusters.append({"born": born, "parent": parent, "kids": [], "lost": [], "size": len(s)})
        while len(s) > 1:
            t = min(t for t in {m[i, j] for i in s for j in s if i < j} if len(parts(s, t, False)) == 1)
            split = parts(s, t, True)
            big = [p for p in split if len(p) > 1]
            clusters[me]["lost"] += [(p[0], 1 / t) for p in split if len(p) == 1]
            if len(big) > 1:
                for p in big:
                    clusters[me]["kids"].append(grow(p, 1 / t, me))
                return me
            s = big[0] if big else []
        return me

    grow(list(range(n)), 0.0, -1)
    mass = {}
    chosen = {}
    for c in reversed(range(len(clusters))):
        x = clusters[c]
        own = sum(l - x["born"] for _, l in x["lost"]) + sum((clusters[k]["born"] - x["born"]) * clusters[k]["size"] for k in x["kids"])
        below = sum(mass[k] for k in x["kids"])
        chosen[c] = below <= own
        mass[c] = max(own, below)
    top = lambda c: [c] if chosen[c] else [y for k in clusters[c]["kids"] for y in top(k)]
    picked = top(0)
    if picked != [0]:
        up = lambda c: up(clusters[c]["parent"]) if c and 1 / clusters[c]["born"] < epsilon else c
        picked = sorted({up(c) for c in picked})
    label = [-1] * n

    def tell(c, k):
        k = c if c in picked else k
        for i, l in clusters[c]["lost"]:
            if picked == [0] and l >= 1 / epsilon or picked != [0] and k:
                label[i] = k
        for kid in clusters[c]["kids"]:
            tell(kid, k)

    tell(0, 0)
    return label


def same(a, b):
    return all((x == -1) == (y == -1) for x, y in zip(a, b)) and len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_names_by_brute_force():
    r = np.random.default_rng(6)
    seen = set()
    for trial in range(150):
        centres = r.normal(size=(r.integers(1, 5), 6))
        x = np.concatenate([c + r.normal(size=(r.integers(1, 9), 6)) * r.choice([0.05, 0.2, 0.5]) for c in centres] + [r.normal(size=(2, 6))])
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        eps = (0.2, 0.02, 0.6)[trial % 3]
        got, want = density.density_groups(unit, 2, eps).tolist(), condensed(unit, 2, eps)
        assert same(got, want), trial
        seen.add(len(set(want)))
    assert len(seen) > 3


def test_spellings(spark):
    v = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [("two", "a", v(0)), ("two", "b", v(1.0)), ("far", "a", v(0)), ("far", "b", v(1.2)), ("one", "a", v(0)), ("none", "a", None), ("two", "z", None)]
    rows += [("many", f"t{i}", v(i * 0.01)) for i in range(80)] + [("many", "x", v(2.5))]
    got = {(r.place_id, r.toponym_id): r.spelling for r in density.spellings(spark.createDataFrame(rows, "place_id string, toponym_id string, vector array<double>")).collect()}
    assert got["two", "b"] == "a" and got["far", "b"] == "b" and got["none", "a"] == "a" and got["two", "z"] == "z" and got["one", "a"] == "a"
    assert {got["many", f"t{i}"] for i in range(80)} == {"t0"} and got["many", "x"] == "x" and len(got) == len(rows)


def test_triplets_for_every_anchor(spark):
    """An anchor whose next names all share a place with it, and one alone with its beginning."""
    names = [(f"p{i // 60}", f"na{i:03d}@en", f"na{i:03d}", "LATIN", "en") for i in range(70)] + [("q", "xy@en", "xy", "LATIN", "en"), ("q", "xz@de", "xz", "LATIN", "de"), ("r", "ω@el", "ω", "GREEK", "el"), ("r", "ψ@el", "ψ", "GREEK", "el")]
    frame = spark.createDataFrame(names, "place_id string, toponym_id string, name string, script string, lang string")
    given = pairs.candidate_pairs(frame)
    anchors = {r.toponym_id_a for r in given.collect()}
    for hard in (True, False):
        got = pairs.triplets(given, frame, hard).collect()
        assert {r.anchor for r in got} == anchors - {"ψ@el", "ω@el"}
        of = {n[1]: n for n in names}
        assert all(of[r.anchor][0] != of[r.negative][0] and of[r.anchor][3] == of[r.negative][3] for r in got)
        assert len({(r.anchor, r.positive) for r in got}) == len(got)
