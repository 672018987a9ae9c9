import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from placewright.functions import project, shapes
from placewright.operators import sketches
from placewright.sources import loads


def write(spark, rows, path):
    spark.createDataFrame(rows, "k long, v string").coalesce(1).write.mode("append").parquet(path)


def test_a_stopped_load_is_taken_up(spark, tmp_path):
    given = f"{tmp_path}/given"
    for i in range(5):
        write(spark, [(i * 10 + j, f"v{i}") for j in range(10)], given)
    seen = []

    def broken(batch):
        seen.append(1)
        if len(seen) == 3:
            raise ValueError("stopped")
        return batch

    with pytest.raises(Exception, match="stopped"):
        loads.load(spark, {"a": given}, f"{tmp_path}/kept", broken, 1)
    assert loads.log(spark, f"{tmp_path}/kept").count() == 0  # half a run is not seen
    assert loads.load(spark, {"a": given}, f"{tmp_path}/kept", broken, 1) == {"a": "loaded"}
    assert len(seen) == 6  # the batch that broke, and those after it
    assert sorted(r.k for r in loads.current(spark, f"{tmp_path}/kept").collect()) == list(range(50))
    assert loads.load(spark, {"a": given}, f"{tmp_path}/kept", lambda b: 1 / 0, 1) == {"a": "unchanged"}  # nothing is read
    write(spark, [(3, "new"), (99, "new")], given)
    assert loads.load(spark, {"a": given}, f"{tmp_path}/kept", lambda b: b, 1) == {"a": "loaded"}
    rows = {r.k: r.v for r in loads.current(spark, f"{tmp_path}/kept", "k").collect()}
    assert rows[3] == "new" and rows[99] == "new" and len(rows) == 51


def test_known_points_of_the_grid(spark):
    p = spark.range(1).select(project.grid_to_datum(F.lit(651409.903), F.lit(313177.270)).alias("d"), project.datum_to_grid(F.lit(1 + 43 / 60 + 4.5177 / 3600), F.lit(52 + 39 / 60 + 27.2531 / 3600)).alias("g"), project.world_to_grid(F.lit(-0.0014), F.lit(51.4778)).alias("w")).first()
    assert abs(p.d.lon - (1 + 43 / 60 + 4.5177 / 3600)) < 1e-8 and abs(p.d.lat - (52 + 39 / 60 + 27.2531 / 3600)) < 1e-8
    assert abs(p.g.east - 651409.903) < 0.01 and abs(p.g.north - 313177.270) < 0.01
    assert math.hypot(p.w.east - 538890, p.w.north - 177320) < 30  # Greenwich


def test_deepest_points_by_grid(spark):
    r = random.Random(2)
    rows = []
    for i in range(12):
        at = sorted(r.random() for _ in range(14))
        ring = [(math.cos(6.283 * t) * (s := r.uniform(0.4, 3)), math.sin(6.283 * t) * s) for t in at]
        hole = [(x * 0.1, y * 0.1) for x, y in ring]
        rows.append((i, [[{"x": x, "y": y} for x, y in [*g, g[0]]] for g in (ring, hole)]))
    frame = spark.createDataFrame([*rows, (99, None)], f"id int, rings {shapes.RINGS}").withColumn("a", shapes.anchor(F.col("rings"), 0.005))
    got = {x.id: x.a for x in frame.collect()}
    assert got[99].x is None
    for i, rings in rows:
        g = [np.array([(p["x"], p["y"]) for p in q]) for q in rings]
        a, b = np.concatenate([q[:-1] for q in g]), np.concatenate([q[1:] for q in g])
        xs, ys = (m.ravel() for m in np.meshgrid(np.linspace(-3, 3, 180), np.linspace(-3, 3, 180)))
        assert got[i].distance >= shapes._distances(xs, ys, a, b).max() - 0.005
        assert abs(shapes._distances(np.array([got[i].x]), np.array([got[i].y]), a, b)[0] - got[i].distance) < 1e-9


def test_merged_parts_bound_the_counts(spark):
    r = random.Random(1)
    rows = [(d, min(int(r.expovariate(0.08)), 90)) for d in range(6) for _ in range(500)]
    kept = sketches.frequent(spark.createDataFrame(rows, "day int, v int"), ["day"], "v", 8)
    got = sketches.most_frequent(kept, [], ["day"], 8).collect()
    exact = {}
    for _, v in rows:
        exact[v] = exact.get(v, 0) + 1
    assert len(got) == 8 and all(x.low <= exact[x.value] <= x.high for x in got) and any(x.high > x.low for x in got) and got[0].low == max(exact.values())


def test_simplified_lines_keep_what_is_far(spark):
    line = [(0, 0), (1, 0.1), (2, -0.1), (3, 5), (4, 6), (5, 7), (6, 8.1), (7, 9)]
    ring = [(0, 0), (4, 0), (4, 4), (2, 4.1), (0, 4), (0, 0)]
    rows = [("a", [{"x": float(x), "y": float(y)} for x, y in line]), ("b", [{"x": float(x), "y": float(y)} for x, y in ring]), ("c", None), ("d", [{"x": 1.0, "y": 1.0}])]
    got = {r.id: r.k and [(p.x, p.y) for p in r.k] for r in spark.createDataFrame(rows, "id string, line array<struct<x:double,y:double>>").select("id", shapes.peucker(F.col("line"), 0.5).alias("k")).collect()}
    assert got == {"a": [(0, 0), (2, -0.1), (3, 5), (7, 9)], "b": [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], "c": None, "d": [(1, 1)]}
