import math
import random

from placewright.functions import shapes
from placewright.operators import areas

RINGS = shapes.RINGS


def ring(r, x, y, size, n):
    at = sorted(r.random() for _ in range(n))
    pts = [(x + size * r.uniform(0.4, 1) * math.cos(6.283 * t), y + size * r.uniform(0.4, 1) * math.sin(6.283 * t)) for t in at]
    return [*pts, pts[0]]


def sides(rings):
    return [(a, b) for g in rings for a, b in zip(g, g[1:])] or [(g[0], g[0]) for g in rings]


def odd(rings, p):
    return sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0] for a, b in sides(rings)) % 2 == 1


def meet(s, t):
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return turn(*s, t[0]) * turn(*s, t[1]) < 0 and turn(*t, s[0]) * turn(*t, s[1]) < 0


def brute(kind, own, region, relation):
    crossed = any(meet(s, t) for s in sides(own) for t in sides(region))
    into, around = [odd(region, p) for g in own for p in g], kind == "area" and any(odd(own, p) for g in region for p in g)
    if relation == "intersects":
        return crossed or any(into) or around
    return not crossed and all(into) and not around


def rows(rings):
    return [[{"x": float(x), "y": float(y)} for x, y in g] for g in rings]


def test_random_shapes(spark):
    r = random.Random(5)
    regions, own = [], []
    for i in range(14):
        x, y = r.uniform(-20, 20), r.uniform(-20, 20)
        outer = ring(r, x, y, r.uniform(3, 12), 24)
        regions.append((f"r{i}", [outer, [(x + dx, y + dy) for dx, dy in ((0.5, 0), (0, 0.5), (-0.5, 0), (0.5, 0))], ring(r, x + 30, y, 3, 9)]))
    for i in range(160):
        x, y = r.uniform(-30, 45), r.uniform(-30, 30)
        kind = ("area", "area", "line", "point")[i % 4]
        g = ring(r, x, y, r.choice([0.2, 1, 6, 15]), 9)
        own.append((f"p{i}", kind, [g] if kind == "area" else [g[:-1]] if kind == "line" else [[(x, y)]]))
    given = spark.createDataFrame([(p, k, rows(g), None, None) for p, k, g in own], f"place_id string, kind string, rings {RINGS}, x double, y double")
    there = spark.createDataFrame([(n, rows(g)) for n, g in regions], f"region string, rings {RINGS}")
    for relation in ("intersects", "within"):
        got = {tuple(x) for x in areas.matches(given, there, relation).collect()}
        want = {(p, n) for p, k, g in own for n, z in regions if brute(k, g, z, relation)}
        assert got == want and len(want) > 10


def test_touching_missing_and_cells(spark):
    square = lambda x, y, d: [[(x, y), (x + d, y), (x + d, y + d), (x, y + d), (x, y)]]
    own = [("same", "area", square(0, 0, 4), 2.0, 2.0), ("corner", "area", square(4, 4, 1), 4.5, 4.5), ("side", "area", square(0, 1, 2), 1.0, 2.0), ("hole", "area", square(1, 1, 1), 1.5, 1.5), ("edge", "line", [[(0, 0), (4, 0)]], 2.0, 0.0), ("into", "line", [[(0, 0), (4, 0), (3, 3)]], 2.0, 0.0), ("none", None, None, None, None), ("spot", None, None, 3.0, 3.0), ("on", "point", [[(0, 2)]], 0.0, 2.0)]
    given = spark.createDataFrame([(p, k, None if g is None else rows(g), x, y) for p, k, g, x, y in own], f"place_id string, kind string, rings {RINGS}, x double, y double")
    there = spark.createDataFrame([("full", rows(square(0, 0, 4))), ("holed", rows(square(0, 0, 4) + square(1, 1, 1)))], f"region string, rings {RINGS}")
    got = {tuple(x) for x in areas.matches(given, there, "within").collect()}
    assert got == {("same", "full"), ("side", "full"), ("hole", "full"), ("into", "full"), ("into", "holed"), ("spot", "full"), ("spot", "holed")}
    met = {p for p, n in map(tuple, areas.matches(given, there).collect()) if n == "holed"}
    assert met == {"same", "corner", "side", "hole", "edge", "into", "spot", "on"}
    cells = given.selectExpr("*", "CASE WHEN x IS NOT NULL THEN 5L END AS cell", "CASE WHEN place_id = 'same' THEN array(5L, 6L) WHEN place_id = 'side' THEN array(5L) END AS cover")
    loose = there.selectExpr("*", "CAST(NULL AS array<bigint>) AS cells").unionByName(spark.createDataFrame([("cells", None, [5])], f"region string, rings {RINGS}, cells array<bigint>"))
    assert {p for p, n, e in map(tuple, areas.contained(cells, loose, "within", 0).collect()) if n == "cells" and not e} == {p for p, *_, x, _ in own if x is not None} - {"same"}
    assert {p for p, n, e in map(tuple, areas.contained(cells, loose, "intersects", 0).collect()) if not e} == {p for p, *_, x, _ in own if x is not None}


def test_union_of_slanted_shapes(spark):
    tri = lambda x, y, s: [[(x, y), (x + s, y), (x, y + s), (x, y)]]
    shapes_ = [("a", tri(0, 0, 4)), ("a", tri(1, 1, 4)), ("a", tri(0, 0, 4)), ("b", tri(0, 0, 1)), ("b", tri(1, 0, 1)), ("c", tri(0, 0, 8)), ("c", tri(1, 1, 1))]
    got = {x.key: x for x in areas.dissolved(spark.createDataFrame([(k, rows(g)) for k, g in shapes_], f"key string, rings {RINGS}")).collect()}
    assert got["a"].area == 8 + 8 - 2 and len(got["a"].rings) == 1  # they share a triangle of side 2
    assert got["b"].area == 1 and len(got["b"].rings) == 2  # they touch in a point
    assert got["c"].area == 32 and len(got["c"].rings) == 1 and len(got["c"].rings[0]) == 4
    assert areas.dissolved(spark.createDataFrame([], f"key string, rings {RINGS}")).count() == 0


def test_union_against_samples(spark):
    r = random.Random(3)
    given = [("k", [ring(r, r.uniform(0, 12), r.uniform(0, 12), r.uniform(1, 4), 11)]) for _ in range(25)]
    got = areas.dissolved(spark.createDataFrame([(k, rows(g)) for k, g in given], f"key string, rings {RINGS}")).first()
    out = [[(p.x, p.y) for p in g] for g in got.rings]
    for _ in range(3000):
        p = (r.uniform(-5, 17), r.uniform(-5, 17))
        assert odd(out, p) == any(odd(g, p) for _, g in given)


def test_covers(spark):
    square = lambda x, y, d: [(x, y), (x + d, y), (x + d, y + d), (x, y + d), (x, y)]
    given = [("far", "area", [square(0.1, 0.1, 1.0), square(90.1, 0.1, 1.0)], 0.5, 0.5, None), ("hulled", "area", [square(0.1, 0.1, 30.0)], 1.0, 1.0, [square(0.1, 0.1, 0.9)]), ("tiny", "area", [square(5, 5, 0.01)], 5.0, 5.0, None), ("dot", "point", [[(5, 5)]], 5.0, 5.0, None), ("line", "line", [[(10.1, 0.1), (13.3, 2.9)]], None, None, None), ("none", None, None, None, None, None)]
    frame = spark.createDataFrame([(i, k, g and rows(g), x, y, h and rows(h)) for i, k, g, x, y, h in given], f"id string, kind string, rings {RINGS}, x double, y double, hull {RINGS}")
    got = {}
    for r in areas.covers(frame, "id", (11, 9, 7), 200).collect():
        got.setdefault(r.id, set()).add((r.cell >> 58, r.cell >> 29 & (1 << 29) - 1, r.cell & (1 << 29) - 1))
    assert "none" not in got and got["tiny"] == got["dot"] and len(got["dot"]) == 1
    assert {z for z, _, _ in got["far"]} == {7} and {x for _, x, _ in got["far"]} == {64, 96}
    assert {z for z, _, _ in got["hulled"]} == {11} and len(got["hulled"]) == 36
    size = 360 / (1 << 9)
    on = {(9, int((x + 180) // size), int((y + 90) // size)) for t in range(2001) for dx, dy in ((0, 0), (0.005, 0), (-0.005, 0), (0, 0.005), (0, -0.005)) for x, y in [(10.1 + 3.2 * t / 2000 + dx, 0.1 + 2.8 * t / 2000 + dy)]}
    assert got["line"] == on


def test_shared_areas_of_random_shapes(spark):
    r = random.Random(9)
    turned = lambda g: g if sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(g, g[1:])) > 0 else g[::-1]
    star = lambda x, y, s: turned((p := [(x + s * q * math.cos(t), y + s * q * math.sin(t)) for t, q in sorted((r.uniform(0, 6.283), r.uniform(0.4, 1)) for _ in range(12))]) + p[:1])
    own, there = [star(r.uniform(0, 9), r.uniform(0, 9), 3) for _ in range(8)], [star(r.uniform(0, 9), r.uniform(0, 9), 4) for _ in range(4)]
    a = spark.createDataFrame([(f"p{i}", rows([g])) for i, g in enumerate(own)], f"place_id string, rings {RINGS}")
    b = spark.createDataFrame([(f"r{i}", rows([g])) for i, g in enumerate(there)], f"region string, rings {RINGS}")
    got = {(x.place_id, x.region): x.area for x in areas.overlaps(a, b).collect()}
    step = 0.04
    grid = [(-5 + step * i, -5 + step * j) for i in range(500) for j in range(500)]
    inside = {n: {p for p in grid if odd([g], p)} for n, g in [*((f"p{i}", g) for i, g in enumerate(own)), *((f"r{i}", g) for i, g in enumerate(there))]}
    for p in range(len(own)):
        for q in range(len(there)):
            near = len(inside[f"p{p}"] & inside[f"r{q}"]) * step * step
            assert abs(got.get((f"p{p}", f"r{q}"), 0.0) - near) < 0.25, (p, q)
