"""Work on repeated values: done once, given to every row."""

from pyspark.sql import functions as F

from placewright.functions import shapes, space
from placewright.operators import areas, distinct, graph, pairs, within
from placewright.plans import QUERIES


def squares(spark, n, id, size):
    k = F.lit(0.0)
    frame = spark.range(n).select(F.concat(F.lit(id), F.col("id").cast("string")).alias(id), F.lit("area").alias("kind"), shapes.rectangle(k, k, k + size, k + size).alias("rings"))
    return frame.withColumns({"x": F.lit(size / 2), "y": F.lit(size / 2)})


def test_equal_shapes_are_compared_once(spark, monkeypatch):
    seen = []
    for name in ("_matches", "_overlaps"):
        def counted(a, b, *more, of=getattr(areas, name)):
            seen.append((a.count(), b.count()))
            return of(a, b, *more)

        monkeypatch.setattr(areas, name, counted)
    own = squares(spark, 20, "place_id", 1.0)
    there = squares(spark, 3, "region", 2.0).select("region", "rings").unionByName(squares(spark, 1, "region", 0.5).select(F.lit("small").alias("region"), "rings"))
    every = {(f"place_id{i}", f"region{j}") for i in range(20) for j in range(3)}
    assert {tuple(r) for r in areas.matches(own, there, "within").collect()} == every
    assert {(r.place_id, r.region) for r in areas.overlaps(own, there).where("abs(area - 1) < 1e-9").collect()} == every
    assert seen == [(1, 2), (1, 2)]


def test_equal_shapes_are_covered_and_repaired_once(spark, monkeypatch):
    seen = []
    for name in ("_covers", "dissolved"):
        def counted(a, *more, of=getattr(areas, name)):
            seen.append(a.count())
            return of(a, *more)

        monkeypatch.setattr(areas, name, counted)
    own = squares(spark, 20, "place_id", 3.0)
    cells = areas.covers(own, "place_id", (9,)).groupBy("place_id").count().collect()
    assert len(cells) == 20 and len({r["count"] for r in cells}) == 1
    got = areas.repaired(own.select("place_id", "rings"), "place_id").collect()
    assert len(got) == 20 and {r.area for r in got} == {9.0}
    assert seen == [1, 1]


def test_values_are_computed_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def twice(x):
        calls.add(1)
        return None if x is None else 2 * x

    rows = spark.range(100).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("k"))
    got = distinct.computed_once(rows, F.col("k"), twice, "two").collect()
    assert len(got) == 100 and all(r.two == (2 * r.k if r.k is not None else None) for r in got) and calls.value == 4


def test_pairs_of_a_key_are_shared_by_tasks(spark):
    # One record of 60 places in three sources: no task makes more than half of the pairs.
    rows = spark.createDataFrame([(1, f"{'abc'[i % 3]}:{i}", i != 7) for i in range(60)], "record int, place_id string, exact boolean")
    made = pairs.record_links(rows).withColumn("task", F.spark_partition_id()).collect()
    own = [(r.place_id, r.exact) for r in rows.collect()]
    want = {(a, b, "sameAs" if x and y else "closeMatch") for a, x in own for b, y in own if a < b and a[0] != b[0]}
    assert {(r.place_a, r.place_b, r.relation_type) for r in made} == want and len(made) == len(want)
    tasks = [r.task for r in made]
    assert max(tasks.count(t) for t in set(tasks)) <= len(made) / 2


def test_points_of_one_position_are_measured_once(spark, monkeypatch):
    seen = []

    def counted(points, *more, of=graph._spots_within):
        seen.append(points.count())
        return of(points, *more)

    monkeypatch.setattr(graph, "_spots_within", counted)
    at = spark.range(12).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("place_id"), (F.col("id") % 3 * 0.2).alias("lon"), F.lit(1.0).alias("lat"))
    got = {(r.place_id, r.other): r.km for r in graph.pairs_within(at, 30, space.haversine_km).collect()}
    lon = {f"p{i}": i % 3 for i in range(12)}
    assert set(got) == {(a, b) for a in lon for b in lon if a < b and abs(lon[a] - lon[b]) < 2} and seen == [3]
    assert all((km == 0) == (lon[a] == lon[b]) for (a, b), km in got.items())


def test_nearest_looks_at_each_point_once(spark, monkeypatch):
    seen = []

    def counted(queries, sites, *more, of=within._nearest):
        seen.append((queries.count(), sites.count()))
        return of(queries, sites, *more)

    monkeypatch.setattr(within, "_nearest", counted)
    queries = spark.range(6).select(F.concat(F.lit("q"), F.col("id").cast("string")).alias("query"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    sites = spark.range(50).select(F.format_string("s%02d", "id").alias("site"), F.when(F.col("id") < 48, 1.0).otherwise(0.5).alias("lon"), F.lit(0.0).alias("lat"))
    got = within.nearest(queries, sites, 3).orderBy("query", "rank").collect()
    assert [r.site for r in got] == ["s48", "s49", "s00"] * 6 and seen == [(1, 5)]


def test_codes_are_gathered_once_a_cell(spark):
    places = spark.createDataFrame([("a", [1, 2]), ("b", [1, 2]), ("c", [3]), ("d", None), ("e", [2])], "place_id string, cells array<long>")
    coverage = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "w"), (4, "v")], "cell long, code string")
    out = within.coded(places, "cells", coverage)
    assert {r.place_id: r.codes for r in out.collect()} == {"a": ["w", "x", "y"], "b": ["w", "x", "y"], "e": ["w", "x"]}
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()  # no place is grouped


def test_kinds_of_points_of_both_orders(spark):
    import struct

    def one(order, kind, more, x, y):
        return (struct.pack(order + "bI", order == "<", kind) + more + struct.pack(order + "dd", x, y)).hex() if order == ">" else (b"\x01" + struct.pack("<I", kind) + more + struct.pack("<dd", x, y)).hex()

    given = [one("<", 1, b"", 1.5, -2.25), one("<", 1 | 1 << 29, struct.pack("<I", 4326), -180.0, 0.0), "00" + struct.pack(">I", 1).hex() + struct.pack(">dd", 3.5, 89.125).hex(), one("<", 2, b"", 1.0, 1.0), "zz", None]
    got = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, g string").select("i", shapes.ewkb_point(F.col("g")).alias("p")).orderBy("i").collect()
    assert [r.p and tuple(r.p) for r in got] == [(1.5, -2.25), (-180.0, 0.0), (3.5, 89.125), None, None, None]


def counted_lists(monkeypatch):
    """Rows of each join of lists from now on."""
    seen = []

    def counted(*given, of=distinct.lists_that_meet):
        out = of(*given)
        seen.append(out.count())
        return out

    monkeypatch.setattr(distinct, "lists_that_meet", counted)
    return seen


def test_values_are_listed_in_order(spark):
    rows = spark.createDataFrame([(i % 3 or None, f"v{i:03d}") for i in range(100)] + [(1, None), (1, "v001")], "k int, v string")
    got = distinct.listed(rows, "v", 8).collect()
    assert sorted(v for r in got for v in r.v) == sorted(r.v for r in rows.collect() if r.v is not None)
    assert all(len(r.v) <= 8 and r.v == sorted(r.v) and all(int(v[1:]) % 3 == (r.k or 0) for v in r.v) for r in got) and {r._share for r in got} > {0, 1}
    for k in (None, 1, 2):  # runs of one key follow each other
        own = sorted(r.v for r in got if r.k == k)
        assert all(x[-1] <= y[0] for x, y in zip(own, own[1:]))


def test_lists_are_joined_not_records(spark, monkeypatch):
    seen = counted_lists(monkeypatch)
    rows = spark.range(1200).select((F.col("id") % 2).alias("record"), F.concat(F.when(F.col("id") % 3 == 0, "b-").when(F.col("id") % 3 == 1, "b:").otherwise("a:"), F.col("id").cast("string")).alias("place_id"), F.when(F.col("id") > 9, F.col("id") % 7 > 0).alias("exact"))
    rows = rows.withColumn("place_id", F.regexp_replace("place_id", "-", "-c:"))  # "b-c" comes before "b:", "b" before "b-c"
    own = [(r.record, r.place_id, r.exact) for r in rows.collect()]
    want = sorted((k, p, q, "sameAs" if x and y else "closeMatch") for k, p, x in own for j, q, y in own if k == j and p < q and p.split(":")[0] != q.split(":")[0])
    assert sorted(tuple(r) for r in pairs.record_links(rows).collect()) == want
    assert len(want) == 2 * 3 * 200 * 200 and sum(seen) < len(want) / 100


def test_lists_are_joined_not_names(spark, sf, monkeypatch):
    seen = counted_lists(monkeypatch)
    made = QUERIES["same_name_pairs"](spark, sf).count()
    rows = spark.read.parquet(f"{sf}/part.parquet").groupBy("p_name").count().collect()
    assert made == sum(r["count"] * (r["count"] - 1) // 2 for r in rows) and 0 < sum(seen) < made / 2


def test_distances_are_measured_and_rounded_once(spark, monkeypatch):
    seen = counted_lists(monkeypatch)
    # Four positions some 11 km apart, ids dealt over them: three steps are within 30 km, and the first and last aren't.
    at = spark.range(800).select(F.format_string("p%03d", "id").alias("place_id"), (F.col("id") % 4 * 0.1).alias("lon"), F.lit(1.0).alias("lat"))
    out = graph.pairs_within(at, 30, space.haversine_km, digits=3)
    got = {(r.place_id, r.other): r.km for r in out.collect()}
    assert set(got) == {(f"p{i:03d}", f"p{j:03d}") for i in range(800) for j in range(i + 1, 800) if {i % 4, j % 4} != {0, 3}}
    assert {(i % 4, j % 4): got[f"p{i:03d}", f"p{j:03d}"] for i, j in ((0, 4), (0, 1), (1, 2), (1, 3))} == {(0, 0): 0.0, (0, 1): 11.118, (1, 2): 11.118, (1, 3): 22.236}
    assert sum(seen) < len(got) / 100
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("round(")  # below the lists, not above the pairs


def test_the_limit_holds_before_rounding(spark):
    at = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.1, 0.0)], "place_id string, lon double, lat double")
    km = 11.1194  # they are 11.119492... km apart
    assert graph.pairs_within(at, km, space.haversine_km, digits=3).collect() == []
    assert [tuple(r) for r in graph.pairs_within(at, km + 0.0001, space.haversine_km, digits=3).collect()] == [("a", "b", 11.119)]
