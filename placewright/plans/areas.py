"""Queries of exact area tests, unions and hulls, over shapes made from the tables' columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import shapes, space
from ..operators import areas
from .queries import query
from .views import Views

#: Squares on a corner around each place: all points within r of (x, y) by the sum of the differences, less those within h; some have a second part.
_SHAPES = """
own AS (SELECT place_id, lon AS x, lat AS y, 0.5 + (k % 8) * 0.25 AS r, CASE WHEN k % 3 = 0 THEN (0.5 + (k % 8) * 0.25) * (1 + k % 2) * 0.25 ELSE 0 END AS h, k % 4 = 0 AS two FROM p_pt WHERE namespace = 'cu'),
there AS (SELECT place_id AS region, lon + 0.5 AS x, lat - 0.25 AS y, 2.0 + (k % 9) * 0.5 AS r, CASE WHEN k % 2 = 0 THEN (2.0 + (k % 9) * 0.5) * (1 + k % 3) * 0.25 ELSE 0 END AS h, k % 5 = 0 AS two FROM p_pt WHERE namespace = 'su'),
part AS (SELECT place_id, x, y, r, h FROM own UNION ALL SELECT place_id, x + 2.5 * r, y, r / 2, 0 FROM own WHERE two),
zone AS (SELECT region, x, y, r, h FROM there UNION ALL SELECT region, x + 2.5 * r, y, r / 2, 0 FROM there WHERE two),
d AS (SELECT p.place_id, z.region, p.x AS px, p.r AS pr, p.h AS ph, z.r AS zr, z.h AS zh, abs(p.x - z.x) + abs(p.y - z.y) AS d FROM part p JOIN zone z ON abs(p.x - z.x) + abs(p.y - z.y) <= p.r + z.r)"""


def _diamond(x: Column, y: Column, r: Column) -> Column:
    return F.array(*(shapes.point(x + a * r, y + b * r) for a, b in ((1, 0), (0, 1), (-1, 0), (0, -1), (1, 0))))


def _diamonds(x: Column, y: Column, r: Column, h: Column, two: Column) -> Column:
    """Its rings: the outer one, the hole, the second part."""
    rings = F.array(_diamond(x, y, r), F.when(h > 0, _diamond(x, y, h)), F.when(two, _diamond(x + 2.5 * r, y, r / 2)))
    return F.filter(rings, lambda g: g.isNotNull())


def candidates(v: Views) -> DataFrame:
    k = F.col("k")
    own = v.p_pt.where("namespace = 'cu'").withColumn("r", 0.5 + (k % 8) * 0.25).withColumn("h", F.when(k % 3 == 0, F.col("r") * (1 + k % 2) * 0.25).otherwise(0.0))
    # A point between the hole and the outer ring.
    return own.select("place_id", F.lit("area").alias("kind"), _diamonds(F.col("lon"), F.col("lat"), F.col("r"), F.col("h"), k % 4 == 0).alias("rings"), (F.col("lon") + (F.col("r") + F.col("h")) / 2).alias("x"), F.col("lat").alias("y"))


def zones(v: Views) -> DataFrame:
    k = F.col("k")
    there = v.p_pt.where("namespace = 'su'").withColumn("x", F.col("lon") + 0.5).withColumn("y", F.col("lat") - 0.25)
    return there.select(F.col("place_id").alias("region"), _diamonds(F.col("x"), F.col("y"), 2.0 + (k % 9) * 0.5, F.when(k % 2 == 0, (2.0 + (k % 9) * 0.5) * (1 + k % 3) * 0.25).otherwise(0.0), k % 5 == 0).alias("rings"))


@query(f"WITH {_SHAPES} SELECT DISTINCT place_id, region FROM d WHERE d + pr >= zh AND d + zr >= ph")
def areas_that_meet(v: Views) -> DataFrame:
    return areas.matches(candidates(v), zones(v), "intersects")


# A part lies in one of the zone's parts, and the zone's hole meets it nowhere or lies in its own hole.
@query(f"""
WITH {_SHAPES}, held AS (SELECT place_id, region, px, pr FROM d WHERE d + pr <= zr AND (d >= pr + zh OR zh = 0 OR d + zh <= ph))
SELECT h.place_id, h.region FROM (SELECT place_id, region, count(*) AS n FROM held GROUP BY ALL) h JOIN (SELECT place_id, count(*) AS n FROM part GROUP BY ALL) p ON p.place_id = h.place_id AND p.n = h.n""")
def areas_within(v: Views) -> DataFrame:
    return areas.matches(candidates(v), zones(v), "within")


#: Boxes of whole degrees, some of each nation's over each other.
_GRID = """
box AS (SELECT DISTINCT c_nationkey AS nation, c_custkey * 7 % 13 AS x, c_custkey * 11 % 17 AS y, 1 + c_custkey % 2 AS w, 1 + c_custkey % 3 AS h FROM customer),
square AS (SELECT DISTINCT nation, x + i AS x, y + j AS y FROM box, unnest(range(w)) a(i), unnest(range(h)) b(j))"""


# Of squares that touch by sides: rings are parts and holes, and parts less holes are squares less shared sides and more full blocks of four.
@query(f"""
WITH RECURSIVE {_GRID},
links AS MATERIALIZED (SELECT a.nation, a.x * 100 + a.y AS a, b.x * 100 + b.y AS b FROM square a JOIN square b ON a.nation = b.nation AND abs(a.x - b.x) + abs(a.y - b.y) = 1),
reach(nation, id, component) USING KEY (nation, id) AS (
  SELECT nation, x * 100 + y, x * 100 + y FROM square
  UNION
  SELECT l.nation, l.a, min(r.component) FROM reach r JOIN links l ON l.nation = r.nation AND l.b = r.id JOIN recurring.reach own ON own.nation = l.nation AND own.id = l.a
  WHERE r.component < own.component GROUP BY l.nation, l.a),
parts AS (SELECT nation, count(DISTINCT component) AS n FROM reach GROUP BY nation),
euler AS (
  SELECT s.nation, count(*) AS area, count(*) - count(e.x) - count(n.x) + count(CASE WHEN e.x IS NOT NULL AND n.x IS NOT NULL AND ne.x IS NOT NULL THEN 1 END) AS n
  FROM square s LEFT JOIN square e ON e.nation = s.nation AND e.x = s.x + 1 AND e.y = s.y LEFT JOIN square n ON n.nation = s.nation AND n.x = s.x AND n.y = s.y + 1
  LEFT JOIN square ne ON ne.nation = s.nation AND ne.x = s.x + 1 AND ne.y = s.y + 1 GROUP BY s.nation)
SELECT e.nation, e.area::DOUBLE AS area, (2 * p.n - e.n)::BIGINT AS rings, (p.n)::BIGINT AS parts FROM euler e JOIN parts p USING (nation)""")
def dissolved_nations(v: Views) -> DataFrame:
    k = F.col("c_custkey")
    x, y = (k * 7 % 13).cast("double"), (k * 11 % 17).cast("double")
    out = areas.dissolved(v.customer.select(F.col("c_nationkey").alias("nation"), shapes.rectangle(x, y, x + 1 + k % 2, y + 1 + k % 3).alias("rings")), "nation")
    return out.select("nation", F.round("area", 6).alias("area"), F.size("rings").cast("long").alias("rings"), F.size(F.filter("rings", lambda r: shapes.signed_area(r) > 0)).cast("long").alias("parts"))


# A side of the hull has all other points on its left, and those on its line between its ends.
@query("""
WITH pt AS (SELECT DISTINCT ccode, lon AS x, lat AS y FROM p_pt WHERE ccode IS NOT NULL),
side AS (
  SELECT a.ccode, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM pt a JOIN pt b ON a.ccode = b.ccode AND (a.x <> b.x OR a.y <> b.y)
  WHERE NOT EXISTS (SELECT 1 FROM pt c WHERE c.ccode = a.ccode AND ((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) < 0
    OR (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) = 0 AND ((c.x - a.x) * (c.x - b.x) + (c.y - a.y) * (c.y - b.y)) > 0)))
SELECT ccode, count(*) AS corners, round(sum(x1 * y2 - x2 * y1) / 2, 6) AS area FROM side GROUP BY ccode HAVING count(*) > 2""")
def nation_hulls(v: Views) -> DataFrame:
    out = areas.hulled(v.p_pt.where("ccode is not null").select("ccode", F.col("lon").alias("x"), F.col("lat").alias("y")), "ccode")
    return out.where("size(ring) > 3").select("ccode", (F.size("ring") - 1).cast("long").alias("corners"), F.round(shapes.signed_area(F.col("ring")), 6).alias("area"))


# A ring that goes up both sides of a strip crosses itself in the middle, or nowhere.
@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS rings, (CASE WHEN c_custkey % 2 = 0 THEN 0.25 ELSE 0.5 END * (1 + c_custkey % 50))::DOUBLE AS area FROM customer")
def repaired_strips(v: Views) -> DataFrame:
    """Strips of different widths, each second one with two corners swapped: a bow-tie has half the area."""
    k = F.col("c_custkey")
    w, bow = (1 + k % 50) / 2, k % 2 == 0
    at = lambda x, y: shapes.point(x, F.lit(y))
    top = F.when(bow, F.array(at(F.lit(0.0), 1.0), at(w, 1.0))).otherwise(F.array(at(w, 1.0), at(F.lit(0.0), 1.0)))
    ring = F.concat(F.array(at(F.lit(0.0), 0.0), at(w, 0.0)), top, F.array(at(F.lit(0.0), 0.0)))
    return areas.repaired(v.customer.select(k.alias("id"), F.array(ring).alias("rings")), "id").select("id", F.size("rings").cast("long").alias("rings"), F.round("area", 6).alias("area"))


_SIDE = 360 / (1 << 9)


# Cells that a square on a corner meets, but for those that lie whole in its hole. No corner of a cell lies on a side.
@query(f"""
WITH {_SHAPES}, one AS (SELECT place_id, x + 0.0078125 AS x, y, r, h, 9 AS z FROM part),
cell AS (SELECT DISTINCT place_id, ((c % 512) + 512) % 512 AS c, w FROM one, unnest(range(floor((x - r + 180) / {_SIDE})::BIGINT, floor((x + r + 180) / {_SIDE})::BIGINT + 1)) t(c), unnest(range(floor((y - r + 90) / {_SIDE})::BIGINT, floor((y + r + 90) / {_SIDE})::BIGINT + 1)) u(w)
  WHERE greatest(c * {_SIDE} - 180 - x, x - (c + 1) * {_SIDE} + 180, 0) + greatest(w * {_SIDE} - 90 - y, y - (w + 1) * {_SIDE} + 90, 0) <= r
    AND greatest(abs(c * {_SIDE} - 180 - x), abs((c + 1) * {_SIDE} - 180 - x)) + greatest(abs(w * {_SIDE} - 90 - y), abs((w + 1) * {_SIDE} - 90 - y)) >= h)
SELECT place_id, count(*) AS cells, sum(c)::BIGINT AS columns, sum(w)::BIGINT AS rows FROM cell GROUP BY place_id""")
def covered_areas(v: Views) -> DataFrame:
    """Covers of areas with holes and second parts, all at one zoom."""
    moved = candidates(v).withColumn("rings", F.transform("rings", lambda g: F.transform(g, lambda p: shapes.point(p["x"] + 0.0078125, p["y"]))))
    out = areas.covers(moved, "place_id", (9,))
    return out.groupBy("place_id").agg(F.count("*").alias("cells"), F.sum(space.x_of(F.col("cell"))).alias("columns"), F.sum(space.y_of(F.col("cell"))).alias("rows"))


# Boxes of halves of degrees against boxes of four: what each pair shares, and its part of the place.
@query("""
WITH b AS (SELECT place_id, namespace, lon AS w, lat AS s, CASE WHEN namespace = 'cu' THEN 0.5 + k % 6 ELSE 4 END AS d, CASE WHEN namespace = 'cu' THEN 0.5 + k % 4 ELSE 4 END AS e FROM p_pt WHERE namespace IN ('cu', 'su')),
o AS (SELECT p.place_id, r.place_id AS region, greatest(0, least(p.w + p.d, r.w + r.d) - greatest(p.w, r.w)) * greatest(0, least(p.s + p.e, r.s + r.e) - greatest(p.s, r.s)) AS area, p.d * p.e AS whole FROM b p JOIN b r ON p.namespace = 'cu' AND r.namespace = 'su')
SELECT place_id, region, round(area, 6)::DOUBLE AS area, round(area / whole, 6)::DOUBLE AS share FROM o WHERE area > 1e-9""")
def shared_areas(v: Views) -> DataFrame:
    k, cu = F.col("k"), F.col("namespace") == "cu"
    box = shapes.rectangle(F.col("lon"), F.col("lat"), F.col("lon") + F.when(cu, 0.5 + k % 6).otherwise(4.0), F.col("lat") + F.when(cu, 0.5 + k % 4).otherwise(4.0))
    b = v.p_pt.where("namespace in ('cu', 'su')").select("place_id", "namespace", box.alias("rings"))
    own = b.where("namespace = 'cu'")
    found = areas.overlaps(own, b.where("namespace = 'su'").select(F.col("place_id").alias("region"), "rings"))
    size = own.select("place_id", F.abs(shapes.signed_area(F.col("rings")[0])).alias("whole"))
    return found.join(size, "place_id").select("place_id", "region", F.round("area", 6).alias("area"), F.round(F.col("area") / F.col("whole"), 6).alias("share"))
