"""Exact tests of areas, lines and points against regions: edges meet by cell, sides are told by parity along rows of cells.

A shape is (id, kind, rings): kind is area, line or point; rings are all its rings of all parts, holes included, or its lines, or its points as
lists of one. Inside is what an odd number of rings surrounds, so holes and several parts need no order. Every step is an equi-join on
cells, on rows of cells or on ids, of single edges: no task holds a whole shape, and no shape is compared with all others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import shapes, space
from .distinct import classed, computed_once, expanded
from .durable import durable

#: Zoom of the cells in which edges meet, and in whose rows rays run: some 0.7 degrees.
FINE = 9
#: Zoom of the cells in which boxes meet.
COARSE = 6
#: What is taken for rounding: shares of a side, and degrees around a side's path.
PAD = 1e-9


def edges(given: DataFrame, *ids: str) -> DataFrame:
    """(ids, edge, ax, ay, bx, by) of every segment; a point is one from itself to itself."""
    parts = given.select(*ids, F.posexplode("rings").alias("ring", "pts"))
    both = F.when(F.size("pts") == 1, F.array(F.struct(F.col("pts")[0].alias("a"), F.col("pts")[0].alias("b")))).otherwise(shapes.segments(F.col("pts")))
    each = parts.select(*ids, "ring", F.posexplode(both).alias("k", "s"))
    return each.select(*ids, F.struct("ring", "k").alias("edge"), F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"))


def path_cells(zoom: int) -> Column:
    """Numbers of the cells that the edge (ax, ay, bx, by) runs through, column by column."""
    size = 360.0 / (1 << zoom)
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    at = lambda v, base: F.floor((v + base) / size)
    west, east = F.least(ax, bx), F.greatest(ax, bx)
    low, high = F.least(ay, by), F.greatest(ay, by)
    y_at = lambda x: ay + (by - ay) * (F.least(F.greatest(x, west), east) - ax) / F.nullif(bx - ax, F.lit(0.0))

    def rows(c: Column) -> Column:
        one, two = y_at(c * size - 180), y_at((c + 1) * size - 180)
        a = F.greatest(F.coalesce(F.least(one, two), low) - PAD, low)
        b = F.least(F.coalesce(F.greatest(one, two), high) + PAD, high)
        return F.transform(F.sequence(at(a, 90), at(b, 90)), lambda r: c * F.lit(1 << 29) + r)

    return F.flatten(F.transform(F.sequence(at(west, 180), at(east, 180)), rows))


def box_cells(rings: Column, zoom: int) -> Column:
    size = 360.0 / (1 << zoom)
    w, s, e, n = shapes.box(rings)
    at = lambda v, base: F.floor((v + base) / size)
    return F.flatten(F.transform(F.sequence(at(w, 180), at(e, 180)), lambda c: F.transform(F.sequence(at(s, 90), at(n, 90)), lambda r: c * F.lit(1 << 29) + r)))


def row_of(y: Column) -> Column:
    return F.floor((y + 90) * ((1 << FINE) / 360.0))


def inside(points: DataFrame, sides: DataFrame, id: str) -> DataFrame:
    """Those points (id, x, y and more) that an odd number of the rings of their shape surrounds: edges of the shape in the point's row, right of it, are counted."""
    ids = [c for c in points.columns]
    rows = sides.where("ay <> by").select(id, F.explode(F.sequence(row_of(F.least("ay", "by")), row_of(F.greatest("ay", "by")))).alias("row"), "ax", "ay", "bx", "by")
    met = points.withColumn("row", row_of(F.col("y"))).join(rows, [id, "row"])
    right = ((F.col("ay") > F.col("y")) != (F.col("by") > F.col("y"))) & (F.col("x") < (F.col("bx") - F.col("ax")) * (F.col("y") - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax"))
    return met.where(right).groupBy(*ids).agg(F.count("*").alias("_n")).where("_n % 2 = 1").select(*ids)


def meeting(pairs: DataFrame) -> DataFrame:
    """Those pairs of edges (ax, ay, bx, by) and (oax, oay, obx, oby) that meet, with `at`: shares of the first's length (from, to), the same but where they run along each other, and the points there.

    Both edges of a pair get the same point, as it is computed from the one that comes first. Columns are computed step by step, so that none is twice.
    """
    c = F.col
    cross = lambda ux, uy, vx, vy: c(ux) * c(vy) - c(uy) * c(vx)
    given = pairs.withColumns({"rx": c("bx") - c("ax"), "ry": c("by") - c("ay"), "sx": c("obx") - c("oax"), "sy": c("oby") - c("oay"), "gx": c("oax") - c("ax"), "gy": c("oay") - c("ay")})
    given = given.withColumns({"d": cross("rx", "ry", "sx", "sy"), "tn": cross("gx", "gy", "sx", "sy"), "un": cross("gx", "gy", "rx", "ry"), "length": c("rx") * c("rx") + c("ry") * c("ry")})
    between = lambda n: F.when(c("d") > 0, (n >= 0) & (n <= c("d"))).otherwise((n <= 0) & (n >= c("d")))
    # On one line: the other edge's ends as shares of this one; a point lies on the other edge or not.
    on = (c("tn") == 0) & c("ax").between(F.least("oax", "obx"), F.greatest("oax", "obx")) & c("ay").between(F.least("oay", "oby"), F.greatest("oay", "oby"))
    t0 = (c("gx") * c("rx") + c("gy") * c("ry")) / F.nullif(c("length"), F.lit(0.0))
    given = given.withColumns({"t0": t0, "t1": t0 + (c("sx") * c("rx") + c("sy") * c("ry")) / F.nullif(c("length"), F.lit(0.0))})
    given = given.withColumns({"low": F.greatest(F.least("t0", "t1"), F.lit(0.0)), "high": F.least(F.greatest("t0", "t1"), F.lit(1.0))})
    how = F.when(c("d") != 0, F.when(between(c("tn")) & between(c("un")), "cross")).when(c("length") == 0, F.when(on, "point")).when((c("un") == 0) & (c("low") <= c("high")), "along")
    met = given.withColumn("how", how).where("how is not null").withColumn("first", F.struct("ax", "ay", "bx", "by") <= F.struct("oax", "oay", "obx", "oby"))
    crossing = lambda k: F.when(c("un") == 0, c(f"oa{k}")).when(c("un") == c("d"), c(f"ob{k}")).when(c("tn") == 0, c(f"a{k}")).when(c("tn") == c("d"), c(f"b{k}")).when(c("first"), c(f"a{k}") + c("tn") / c("d") * c(f"r{k}")).otherwise(c(f"oa{k}") + c("un") / c("d") * c(f"s{k}"))
    end = lambda t, k: F.when(t == 0, c(f"a{k}")).when(t == 1, c(f"b{k}")).when(t == c("t0"), c(f"oa{k}")).otherwise(c(f"ob{k}"))
    told = lambda a, b, p, q: F.struct(a.alias("from"), b.alias("to"), p.alias("p"), q.alias("q"))
    met = met.withColumns({"cx": crossing("x"), "cy": crossing("y"), "share": c("tn") / F.nullif(c("d"), F.lit(0.0))})
    there, here = shapes.point(c("cx"), c("cy")), shapes.point(c("ax"), c("ay"))
    ends = [shapes.point(end(c(n), "x"), end(c(n), "y")) for n in ("low", "high")]
    at = F.when(c("how") == "cross", told(c("share"), c("share"), there, there)).when(c("how") == "point", told(F.lit(0.0), F.lit(1.0), here, here)).otherwise(told(c("low"), c("high"), *ends))
    return met.select(*pairs.columns, at.alias("at"))


def cuts(own: DataFrame, other: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, edge, at) of each edge of a that meets an edge of b: where along it, as stretches of meeting()."""
    left = own.withColumn("cell", F.explode(path_cells(FINE))).join(pairs, a)
    right = other.select(F.col(b), F.explode(path_cells(FINE)).alias("cell"), *[F.col(n).alias(f"o{n}") for n in ("ax", "ay", "bx", "by")])
    hit = meeting(left.join(right, [b, "cell"]))
    return hit.groupBy(a, b, "edge").agg(F.collect_set("at").alias("at"))


def pieces(own: DataFrame, other: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, side) of the pieces into which b's edges cut those of a: side is in, on or out of b, one row for each side that occurs."""
    cut = cuts(own, other, pairs, a, b)
    all_ = own.join(pairs, a).join(cut, [a, b, "edge"], "left")
    ends = F.array_sort(F.array_union(F.array(F.lit(0.0), F.lit(1.0)), F.coalesce(F.flatten(F.transform("at", lambda s: F.array(s["from"], s["to"]))), F.array().cast("array<double>"))))
    middles = all_.withColumn("ends", ends).withColumn("t", F.explode(F.zip_with(F.slice("ends", F.lit(1), F.size("ends") - 1), F.slice("ends", F.lit(2), F.size("ends") - 1), lambda x, y: F.when(y - x > PAD, (x + y) / 2)))).where("t is not null")
    along = F.coalesce(F.exists("at", lambda s: (s["from"] < F.col("t")) & (F.col("t") < s["to"])), F.lit(False))
    points = middles.select(a, b, "edge", "t", along.alias("along"), (F.col("ax") + F.col("t") * (F.col("bx") - F.col("ax"))).alias("x"), (F.col("ay") + F.col("t") * (F.col("by") - F.col("ay"))).alias("y"))
    off = points.where("not along").drop("along")
    odd = inside(off, other, b).select(a, b, "edge", "t", F.lit(True).alias("odd"))
    sides = points.join(odd, [a, b, "edge", "t"], "left")
    return sides.select(a, b, F.when(F.col("along"), "on").when(F.col("odd"), "in").otherwise("out").alias("side")).distinct()


def matches(candidates: DataFrame, regions: DataFrame, relation: str = "intersects") -> DataFrame:
    """(place_id, region) of candidates (place_id, kind, rings, x, y) that intersect a region (region, rings), or lie within it.

    x and y are a point of the candidate. A candidate without rings is that point; without both it matches nothing. Touching is
    intersecting; what lies within has no part outside and some part in the region's interior. Equal shapes are tested once.
    """
    ones, own = classed(candidates, "place_id", "kind", "rings", "x", "y")
    zones, there = classed(regions, "region", "rings")
    return expanded(durable(_matches(ones, zones, relation)), own, there)


def _matches(candidates: DataFrame, regions: DataFrame, relation: str) -> DataFrame:
    alone = F.array(F.array(shapes.point(F.col("x"), F.col("y"))))
    bare = F.coalesce(F.size("rings"), F.lit(0)) <= 0
    given = candidates.where(~bare | F.col("x").isNotNull() & F.col("y").isNotNull()).select(
        "place_id", F.when(bare, "point").otherwise(F.col("kind")).alias("kind"), F.when(bare, alone).otherwise(F.col("rings")).alias("rings"), "x", "y")
    there = regions.where(F.size("rings") > 0).select("region", "rings")
    near = given.select("place_id", "kind", "x", "y", F.explode(box_cells(F.col("rings"), COARSE)).alias("cell")).join(there.select("region", F.explode(box_cells(F.col("rings"), COARSE)).alias("cell")), "cell")
    pairs = durable(near.drop("cell").distinct())
    own, other = edges(given, "place_id"), edges(there, "region")
    # Its own point decides most: within the region, it intersects; outside, it doesn't lie within.
    spots = pairs.where("x is not null and y is not null").select("place_id", "region", "x", "y")
    held = durable(inside(spots, other, "region").select("place_id", "region"))
    areas = pairs.where("kind = 'area'").select("place_id", "region")
    if relation == "intersects":
        rest = durable(pairs.select("place_id", "region").join(held, ["place_id", "region"], "left_anti"))
        met = durable(cuts(own, other, rest, "place_id", "region").select("place_id", "region").distinct())
        # No edges meet: each ring is all in or all out, and so one point of it tells.
        still = durable(rest.join(met, ["place_id", "region"], "left_anti"))
        first = lambda e, id: e.where("edge.k = 0").select(id, "edge", F.col("ax").alias("x"), F.col("ay").alias("y"))
        into = inside(first(own, "place_id").join(still, "place_id"), other, "region").select("place_id", "region")
        around = inside(first(other, "region").join(still.join(areas, ["place_id", "region"], "left_semi"), "region"), own, "place_id").select("place_id", "region")
        return held.unionByName(met).unionByName(into).unionByName(around).distinct()
    # An area's point lies in its interior; a line's may lie on the boundary, where it tells nothing.
    known = pairs.where("kind <> 'area' or x is null or y is null").select("place_id", "region")
    left = durable(held.unionByName(known).distinct())
    sides = pieces(own, other, left, "place_id", "region").groupBy("place_id", "region").agg(F.max((F.col("side") == "out").cast("int")).alias("out"), F.max((F.col("side") == "in").cast("int")).alias("in"))
    holes = pieces(other, own, left.join(areas, ["place_id", "region"], "left_semi"), "region", "place_id").where("side = 'in'").select("place_id", "region").distinct()
    solid = sides.join(areas.withColumn("area", F.lit(1)), ["place_id", "region"], "left")
    return solid.where("out = 0 and (in = 1 or area = 1)").select("place_id", "region").join(holes, ["place_id", "region"], "left_anti")


def contained(candidates: DataFrame, regions: DataFrame, relation: str = "intersects", zoom: int = 6) -> DataFrame:
    """(place_id, region, exact): matches() for regions with rings, and for those with cells alone the cells of candidates (cell, cover).

    regions are (region, rings, cells); a candidate's cell is its point's at `zoom`, its cover may be of any zoom.
    """
    exact = matches(candidates, regions.where("size(rings) > 0"), relation).withColumn("exact", F.lit(True))
    loose = regions.where("coalesce(size(rings), 0) <= 0").select("region", F.size("cells").alias("n"), F.explode("cells").alias("cell"))
    up = lambda c: F.when(space.zoom_of(c) > zoom, space.parent(c, zoom)).otherwise(c)
    points = candidates.select("place_id", up(F.col("cell")).alias("cell")).join(loose, "cell").select("place_id", "region")
    own = candidates.select("place_id", F.explode(F.array_distinct(F.transform("cover", up))).alias("cell"))
    shared = own.join(loose, "cell").groupBy("place_id", "region").agg(F.count("*").alias("shared"))
    if relation == "intersects":
        found = points.unionByName(shared.select("place_id", "region")).distinct()
    else:
        sizes = candidates.select("place_id", F.coalesce(F.size(F.array_distinct(F.transform("cover", up))), F.lit(0)).alias("of"))
        found = points.join(sizes, "place_id").join(shared, ["place_id", "region"], "left").where(F.coalesce("shared", F.lit(0)) >= F.greatest("of", F.lit(0))).select("place_id", "region")
    return exact.unionByName(found.withColumn("exact", F.lit(False)))


def dissolved(given: DataFrame, key: str = "key") -> DataFrame:
    """(key, area, rings) of the union of a key's areas (key, rings): its size in square degrees and its rings, outer ones counter-clockwise, holes clockwise.

    Edges of a key are cut where they meet each other, by cells, those of one shape too: a ring that crosses itself comes apart there. A piece bounds the union if it has it on one side only; shared
    edges so cancel. A ring is walked from piece to piece, leftmost turn first, so that parts that touch in a point stay apart. Equal shapes count
    once. Joins are of single edges; only the pieces of one union come together, for the row that holds it.
    """
    own = durable(given.select(F.col(key).alias("key"), "rings").distinct().withColumn("shape", F.monotonically_increasing_id()))
    sides = durable(edges(own, "key", "shape").where("ax <> bx or ay <> by"))
    names = ("ax", "ay", "bx", "by")
    left = sides.withColumn("cell", F.explode(path_cells(FINE)))
    right = sides.select("key", F.col("shape").alias("o_shape"), F.col("edge").alias("o_edge"), F.explode(path_cells(FINE)).alias("cell"), *[F.col(n).alias(f"o{n}") for n in names])
    hit = meeting(left.join(right, ["key", "cell"]).where("shape <> o_shape or edge <> o_edge"))
    cut = hit.groupBy("key", "shape", "edge").agg(F.collect_set("at").alias("at"))
    stop = lambda t, p: F.struct(t.alias("t"), p["x"].alias("x"), p["y"].alias("y"))
    ends = F.array(stop(F.lit(0.0), shapes.point(F.col("ax"), F.col("ay"))), stop(F.lit(1.0), shapes.point(F.col("bx"), F.col("by"))))
    more = F.flatten(F.transform("at", lambda s: F.array(stop(s["from"], s["p"]), stop(s["to"], s["q"]))))
    stops = sides.join(cut, ["key", "shape", "edge"], "left").withColumn("stops", F.array_sort(F.when(F.col("at").isNull(), ends).otherwise(F.array_union(ends, more))))
    each = stops.select("key", F.explode(F.zip_with(F.slice("stops", F.lit(1), F.size("stops") - 1), F.slice("stops", F.lit(2), F.size("stops") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("s"))
    fixed = lambda c: F.round(c, 9) + 0.0
    p, q = (F.struct(fixed(F.col(f"s.{e}.x")).alias("x"), fixed(F.col(f"s.{e}.y")).alias("y")) for e in "ab")
    found = durable(each.select("key", F.least(p, q).alias("p"), F.greatest(p, q).alias("q")).where("p <> q").distinct().withColumn("piece", F.monotonically_increasing_id()))
    dx, dy = F.col("q.x") - F.col("p.x"), F.col("q.y") - F.col("p.y")
    step = lambda side: F.least(F.lit(1e-3), F.lit(1e-7) / F.sqrt(dx * dx + dy * dy)) * side
    spot = lambda side: F.struct(F.lit(side).alias("side"), ((F.col("p.x") + F.col("q.x")) / 2 - dy * step(side)).alias("x"), ((F.col("p.y") + F.col("q.y")) / 2 + dx * step(side)).alias("y"))
    spots = found.select("key", "piece", F.explode(F.array(spot(1), spot(-1))).alias("s")).select("key", "piece", "s.*")
    size = 360.0 / (1 << FINE)
    cell = F.floor((F.col("x") + 180) / size) * F.lit(1 << 29) + F.floor((F.col("y") + 90) / size)
    w, s, e, n = shapes.box(F.col("rings"))
    boxes = own.select("key", "shape", w.alias("w"), s.alias("s"), e.alias("e"), n.alias("n"), F.explode(box_cells(F.col("rings"), FINE)).alias("cell"))
    asked = spots.withColumn("cell", cell).join(boxes, ["key", "cell"]).where("x between w and e and y between s and n").select("key", "piece", "side", "shape", "x", "y")
    covered = inside(asked, sides.drop("key"), "shape").groupBy("piece").agg(F.min("side").alias("low"), F.max("side").alias("high")).where("low = high")
    turned = F.col("high") < 0
    bounds = found.join(covered, "piece").select("key", F.when(turned, F.col("q")).otherwise(F.col("p")).alias("a"), F.when(turned, F.col("p")).otherwise(F.col("q")).alias("b"))
    kinds = f"key {own.schema['key'].dataType.simpleString()}, area double, rings {shapes.RINGS}"
    out = bounds.select("key", *[F.col(f"{e}.{c}").alias(f"{e}{c}") for e in "ab" for c in "xy"]).groupBy("key").applyInPandas(_walked, kinds)
    return out.withColumnRenamed("key", key)


def _walked(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
    """The rings of one union's directed pieces, without points in the middle of a straight side."""
    pieces = pieces.sort_values(["ax", "ay", "bx", "by"])
    a, b = pieces[["ax", "ay"]].to_numpy(), pieces[["bx", "by"]].to_numpy()
    out: dict[tuple, list[int]] = {}
    for k, at in enumerate(map(tuple, a)):
        out.setdefault(at, []).append(k)
    course = np.arctan2(b[:, 1] - a[:, 1], b[:, 0] - a[:, 0])
    free, rings = [True] * len(a), []
    for k in range(len(a)):
        ring = []
        while free[k]:
            free[k] = False
            ring.append(k)
            ways = [w for w in out.get(tuple(b[k]), []) if free[w]]
            if not ways:
                break
            k = max(ways, key=lambda w: (course[w] - course[k] + np.pi) % (2 * np.pi))  # noqa: B023
        if ring:
            straight = [a[ring[i]] for i in range(len(ring)) if abs(np.sin(course[ring[i]] - course[ring[i - 1]])) > 1e-12]
            rings.append([{"x": x, "y": y} for x, y in [*straight, *straight[:1]]])
    area = float((a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1]).sum() / 2)
    return pd.DataFrame({"key": [key[0]], "area": [area], "rings": [rings]})


def hulled(points: DataFrame, key: str, parts: int = 64) -> DataFrame:
    """(key, ring) of the convex hull of a key's points (key, x, y): hulls of its parts, dealt by hash, then the hull of their corners, so that no key's points come together."""
    at = F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    some = points.where("x is not null and y is not null").groupBy(key, F.pmod(F.xxhash64("x", "y"), F.lit(parts)).alias("_part")).agg(shapes.hull(F.collect_set(at)).alias("ring"))
    return some.groupBy(key).agg(shapes.hull(F.flatten(F.collect_list("ring"))).alias("ring"))


def repaired(given: DataFrame, id: str) -> DataFrame:
    """(id, area, rings) of shapes (id, rings) whose rings may cross themselves or each other: what an odd number of them surrounds, in rings that don't. A bow-tie becomes two. Equal shapes are repaired once."""
    shape = given.groupBy(id).agg(F.array_sort(F.collect_set("rings")).alias("all"))
    ones, own = classed(shape, id, "all")
    return expanded(durable(dissolved(ones.select(id, F.explode("all").alias("rings")), id)), own)


def anchored(given: DataFrame, id: str, tolerance: float = 0.01) -> DataFrame:
    """given (id, rings, more) with `at`, shapes.anchor() of its rings: equal shapes have it found once, and tasks share the distinct ones."""
    return computed_once(given, F.col("rings"), lambda r: shapes.anchor(r, tolerance), "at")


#: Zooms of covers, the finest first; cells that a cover may have; how far around a line its cover reaches, in degrees.
COVER_ZOOMS, COVER_MOST, LINE_REACH = (11, 9, 7), 10_000, 0.005


def covers(given: DataFrame, id: str, zooms: tuple[int, ...] = COVER_ZOOMS, most: int = COVER_MOST) -> DataFrame:
    """(id, cell) of every cell that a shape (id, kind, rings, x, y, and perhaps hull) meets, at the finest zoom at which its box has at most `most` cells, else at the coarsest.

    All parts and holes count. Where an area has a hull, that is covered in its stead. A line is covered with LINE_REACH around it. A shape smaller
    than a cell of the finest zoom, a point, and one without rings have the cell of (x, y), if these are known. Sides are dealt to the cells on
    their path; a row of cells is filled between every second and next crossing of its middle. Equal shapes are covered once.
    """
    ones, own = classed(given, id, "kind", "rings", "x", "y", *(["hull"] if "hull" in given.columns else []))
    return expanded(durable(_covers(ones, id, zooms, most)), own)


def _covers(given: DataFrame, id: str, zooms: tuple[int, ...], most: int) -> DataFrame:
    own = F.when((F.col("kind") == "area") & (F.coalesce(F.size("hull"), F.lit(0)) > 0), F.col("hull")).otherwise(F.col("rings")) if "hull" in given.columns else F.col("rings")
    base = given.select(id, "kind", own.alias("rings"), "x", "y")
    w, s, e, n = shapes.box(F.col("rings"))
    boxed = base.withColumns({"w": w, "s": s, "e": e, "n": n}).withColumn("small", F.coalesce(F.greatest(F.col("e") - F.col("w"), F.col("n") - F.col("s")) < 360.0 / (1 << zooms[0]), F.lit(True)) | (F.col("kind") == "point"))
    cells = lambda z: (F.floor((F.col("e") - F.col("w")) * ((1 << z) / 360.0)) + 1) * (F.floor((F.col("n") - F.col("s")) * ((1 << z) / 360.0)) + 1)
    zoom = F.coalesce(*(F.when(cells(z) <= most, F.lit(z)) for z in zooms), F.lit(zooms[-1]))
    big = durable(boxed.where("not small").withColumn("zoom", zoom).select(id, "kind", "rings", "zoom"))
    out = boxed.where("small and x is not null and y is not null").select(id, space.cell(F.col("x"), F.col("y"), zooms[0]).alias("cell"))
    for z in zooms:
        here = big.where(F.col("zoom") == z)
        sides = edges(here.where("kind = 'area'"), id)
        lines = edges(here.where("kind = 'line'"), id)
        wide = F.explode(F.array(*(F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in ((0.0, 0.0), (LINE_REACH, 0.0), (-LINE_REACH, 0.0), (0.0, LINE_REACH), (0.0, -LINE_REACH)))))
        beside = lines.withColumn("d", wide).select(id, "edge", *((F.col(f"{p}{c}") + F.col(f"d.d{c}")).alias(f"{p}{c}") for p in "ab" for c in "xy"))
        paths = sides.unionByName(beside).select(id, F.explode(path_cells(z)).alias("c"))
        # Where sides cross the middle of each row of cells.
        size = 360.0 / (1 << z)
        middle = lambda r: (r + 0.5) * size - 90  # noqa: B023, E731
        low, high = F.ceil((F.least("ay", "by") + 90) / size - 0.5), F.ceil((F.greatest("ay", "by") + 90) / size - 0.5) - 1
        crossed = sides.where(low <= high).withColumn("row", F.explode(F.sequence(low, high)))
        at = F.col("ax") + (F.col("bx") - F.col("ax")) * (middle(F.col("row")) - F.col("ay")) / (F.col("by") - F.col("ay"))
        runs = crossed.select(id, "row", at.alias("at")).groupBy(id, "row").agg(F.array_sort(F.collect_list("at")).alias("xs"))
        pairs = F.transform(F.sequence(F.lit(1), F.size("xs") - 1, F.lit(2)), lambda i: F.struct(F.ceil((F.get("xs", i - 1) + 180) / size - 0.5).alias("a"), (F.ceil((F.get("xs", i) + 180) / size - 0.5) - 1).alias("b")))  # noqa: B023
        fill = runs.where("size(xs) > 1").select(id, "row", F.explode(pairs).alias("p")).where("p.a <= p.b").select(id, F.explode(F.transform(F.sequence("p.a", "p.b"), lambda c: c * F.lit(1 << 29) + F.col("row"))).alias("c"))
        # Columns beyond the antimeridian go on at the other side.
        own = F.pmod(F.shiftright("c", 29), F.lit(1 << z)) * F.lit(1 << 29) + F.col("c").bitwiseAND(F.lit((1 << 29) - 1))
        out = out.unionByName(paths.unionByName(fill).select(id, (F.lit(z << 58) + own).alias("cell")).distinct())
    return out


def overlaps(candidates: DataFrame, regions: DataFrame) -> DataFrame:
    """(place_id, region, area) of areas (place_id, rings) and regions (region, rings) that share some: in square degrees, by the shapes themselves.

    What two shapes share is bounded by the sides of each that lie in the other, and by those that both have in one direction. Outer rings
    must run counter-clockwise and holes clockwise, as those of dissolved() and repaired() do. Equal shapes are measured once.
    """
    ones, members = classed(candidates, "place_id", "rings")
    zones, holders = classed(regions, "region", "rings")
    return expanded(durable(_overlaps(ones, zones)), members, holders)


def _overlaps(candidates: DataFrame, regions: DataFrame) -> DataFrame:
    own, there = candidates.select("place_id", "rings"), regions.select("region", "rings")
    near = own.select("place_id", F.explode(box_cells(F.col("rings"), COARSE)).alias("cell")).join(there.select("region", F.explode(box_cells(F.col("rings"), COARSE)).alias("cell")), "cell")
    pairs = durable(near.select("place_id", "region").distinct())
    a, b = edges(own, "place_id"), edges(there, "region")
    parts = [_bounding(a, b, pairs, "place_id", "region", True), _bounding(b, a, pairs, "region", "place_id", False)]
    found = parts[0].unionByName(parts[1]).groupBy("place_id", "region").agg(F.sum("part").alias("area"))
    return found.where(F.col("area") > 1e-12)


def _bounding(own: DataFrame, other: DataFrame, pairs: DataFrame, a: str, b: str, shared: bool) -> DataFrame:
    """(a, b, part) of a's pieces that lie in b, and, if asked, of those that run along b with b's inside on the same hand: each its part of a sum over the boundary."""
    cut = cuts(own, other, pairs, a, b)
    all_ = own.join(pairs, a).join(cut, [a, b, "edge"], "left")
    ends = F.array_sort(F.array_union(F.array(F.lit(0.0), F.lit(1.0)), F.coalesce(F.flatten(F.transform("at", lambda s: F.array(s["from"], s["to"]))), F.array().cast("array<double>"))))
    piece = F.zip_with(F.slice("ends", F.lit(1), F.size("ends") - 1), F.slice("ends", F.lit(2), F.size("ends") - 1), lambda x, y: F.when(y - x > PAD, F.struct(x.alias("f"), y.alias("t"))))
    each = all_.withColumn("ends", ends).withColumn("s", F.explode(piece)).where("s is not null")
    mid = (F.col("s.f") + F.col("s.t")) / 2
    along = F.coalesce(F.exists("at", lambda s: (s["from"] < mid) & (mid < s["to"])), F.lit(False))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    # A piece along b's side is looked at a little to its left, where its own inside is.
    step = F.when(along, F.lit(1e-7) / F.sqrt(dx * dx + dy * dy)).otherwise(0.0)
    x, y = (lambda t: F.col("ax") + t * dx), (lambda t: F.col("ay") + t * dy)
    part = (x(F.col("s.f")) * y(F.col("s.t")) - x(F.col("s.t")) * y(F.col("s.f"))) / 2
    points = each.select(a, b, "edge", F.col("s.f").alias("f"), along.alias("along"), part.alias("part"), (x(mid) - dy * step).alias("x"), (y(mid) + dx * step).alias("y"))
    kept = points if shared else points.where("not along")
    return inside(kept, other, b).select(a, b, "part")
