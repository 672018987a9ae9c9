"""Queries of shapes: measures, covers, containment in regions, country codes, map numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import shapes, space
from ..operators import stages, within
from ..operators.distinct import computed_once
from .queries import query
from .views import Views

#: A box of each nation: four degrees by six, at a place of its own.
_BOXES = "boxes AS (SELECT n_name AS region, n_nationkey AS j, (n_nationkey * 14 % 340 - 170)::DOUBLE AS w, (n_nationkey * 22 % 150 - 80)::DOUBLE AS s, (n_nationkey * 14 % 340 - 164)::DOUBLE AS e, (n_nationkey * 22 % 150 - 72)::DOUBLE AS n FROM nation)"


def boxes(v: Views) -> DataFrame:
    b = v.nation.select(F.col("n_name").alias("region"), F.col("n_nationkey").alias("j"), (F.col("n_nationkey") * 14 % 340 - 170).cast("double").alias("w"), (F.col("n_nationkey") * 22 % 150 - 80).cast("double").alias("s"))
    b = b.withColumn("e", F.col("w") + 6).withColumn("n", F.col("s") + 8)
    # The corner that is cut off makes five sides.
    ring = F.array(*(shapes.point(x, y) for x, y in ((F.col("w"), F.col("s")), (F.col("e"), F.col("s")), (F.col("e"), F.col("n") - 2), (F.col("e") - 2, F.col("n")), (F.col("w"), F.col("n")), (F.col("w"), F.col("s")))))
    return b.withColumn("rings", F.array(ring))


_IN = "lon + 0.03125 > w AND lon + 0.03125 < e AND lat + 0.03125 > s AND lat + 0.03125 < n AND (e - lon - 0.03125) + (n - lat - 0.03125) > 2"


def inner(v: Views) -> DataFrame:
    """Points, a little off the edges of all boxes."""
    return v.p_pt.select("place_id", "k", (F.col("lon") + 0.03125).alias("lon"), (F.col("lat") + 0.03125).alias("lat"))


@query(f"WITH {_BOXES} SELECT place_id, region FROM p_pt JOIN boxes ON {_IN}")
def containing_regions(v: Views) -> DataFrame:
    return within.containing(inner(v), boxes(v).select("region", "rings")).select("place_id", "region")


@query(f"""
WITH {_BOXES}, pt AS (SELECT place_id, lon + 0.03125 AS x, lat + 0.03125 AS y FROM p_pt), d AS (
  SELECT place_id, region, sqrt(pow(greatest(w - x, 0, x - e), 2) + pow(greatest(s - y, 0, y - n), 2)) AS d FROM pt JOIN boxes ON x BETWEEN w - 3 AND e + 3 AND y BETWEEN s - 3 AND n + 3),
i AS (SELECT DISTINCT place_id FROM d WHERE d = 0)
SELECT place_id, min(region) AS region FROM d WHERE d BETWEEN 1e-12 AND 2 AND place_id NOT IN (SELECT place_id FROM i) GROUP BY place_id HAVING count(*) = 1""")
def snapped_regions(v: Views) -> DataFrame:
    b = boxes(v)
    whole = b.select("region", shapes.rectangle(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("rings"))
    return within.snapped(inner(v).select("place_id", "lon", "lat"), whole, 2.0)


@query("""
WITH q AS (SELECT place_id AS query, lon AS x, lat AS y FROM p_pt WHERE namespace = 'pa'), t AS (SELECT place_id AS site, ccode, lon, lat FROM p_pt WHERE ccode IS NOT NULL),
d AS (SELECT query, ccode, row_number() OVER (PARTITION BY query ORDER BY pow(x - lon, 2) + pow(y - lat, 2), site) AS r FROM q, t),
c AS (SELECT query, ccode, count(*) AS n FROM d WHERE r <= 3 GROUP BY ALL), b AS (SELECT query, max(n) AS n, arg_max(ccode, n * 1000 + 0) AS ccode, sum(n) AS total FROM c GROUP BY query)
SELECT query, CASE WHEN n * 2 > total THEN ccode END AS ccode, CASE WHEN n = total THEN 'all' WHEN n * 2 > total THEN 'majority' ELSE 'none' END AS how FROM b""")
def voted_countries(v: Views) -> DataFrame:
    q = v.p_pt.where("namespace = 'pa'").select(F.col("place_id").alias("query"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    sites = v.p_pt.where("ccode is not null").select(F.col("place_id").alias("site"), "ccode", "lon", "lat")
    return within.voted(within.nearest(q, sites, 3), "ccode", 3)


@query(f"WITH {_BOXES} SELECT region, round(6371 * 6371 * pow(pi() / 180, 2) * 46 * cos(radians((s + n) / 2)), 3) AS km2, round(w + (48 * 3 - 2 * (6 - 2 / 3.0)) / 46, 6) AS x, round(s + (48 * 4 - 2 * (8 - 2 / 3.0)) / 46, 6) AS y, w, n AS north, true AS turned FROM boxes")
def region_measures(v: Views) -> DataFrame:
    r = F.col("rings")
    c = shapes.centroid(r[0])
    w, _, _, n = shapes.box(r)
    return boxes(v).select("region", F.round(shapes.area_km2(r), 3).alias("km2"), F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y"), w.alias("w"), n.alias("north"), (shapes.signed_area(r[0]) > 0).alias("turned"))


@query("SELECT event_id, 4::BIGINT AS corners, CASE WHEN user_id % 2 = 0 THEN 8.0 ELSE 12.0 END::DOUBLE AS area, user_id % 2 = 1 AS inside FROM events")
def hulls(v: Views) -> DataFrame:
    e = F.when(F.col("user_id") % 2 == 0, 2.0).otherwise(3.0)
    pts = [(F.lit(0.0), F.lit(0.0)), (e, F.lit(4.0)), (F.lit(1.0), F.lit(1.0)), (F.lit(0.0), F.lit(4.0)), (e, F.lit(0.0)), (e / 2, F.lit(2.0)), (F.lit(0.0), F.lit(2.0))]
    of = lambda ring: F.struct((F.size(ring) - 1).cast("long").alias("corners"), shapes.signed_area(ring).alias("area"), shapes.contains(F.array(ring), F.lit(2.5), F.lit(1.0)).alias("inside"))
    given = v.events.select("event_id", F.array(*(shapes.point(x, y) for x, y in pts)).alias("points"))
    return computed_once(given, F.col("points"), lambda p: shapes.once(shapes.hull(p), of), "h").select("event_id", "h.*")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS parts, event_id % 3 = 0 AS crosses, 20.0::DOUBLE AS area FROM events")
def split_rings(v: Views) -> DataFrame:
    far = F.col("event_id") % 3 == 0
    ring = F.when(far, shapes.rectangle(F.lit(178), F.lit(0), F.lit(-178), F.lit(5))[0]).otherwise(shapes.rectangle(F.lit(10), F.lit(0), F.lit(14), F.lit(5))[0])
    parts = shapes.split_at_antimeridian(ring)
    area = F.aggregate(parts, F.lit(0.0), lambda a, r: a + F.abs(shapes.signed_area(r)))
    return v.events.select("event_id", F.size(parts).alias("parts"), shapes.crosses_antimeridian(ring).alias("crosses"), F.round(area, 6).alias("area"))


@query("SELECT event_id, round(3 * 111.19492664455873::DOUBLE, 6) AS km, 3 AS kept FROM events")
def measured_lines(v: Views) -> DataFrame:
    line = F.array(shapes.point(F.lit(0), F.lit(0)), shapes.point(F.lit(0), F.lit(1)), shapes.point(F.lit(0), F.lit(2)), shapes.point(F.lit(1.0) * 0, F.lit(3)))
    bent = F.array(*(shapes.point(F.lit(x), F.lit(y)) for x, y in ((0, 0), (1, 0.001), (2, 0), (2, 5))))
    return v.events.select("event_id", F.round(shapes.length_km(line), 6).alias("km"), F.size(shapes.simplify(bent, 0.01)).alias("kept"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'area' WHEN 1 THEN 'line' WHEN 2 THEN 'point' WHEN 3 THEN 'area' END AS kind, event_id % 5 IN (0, 3) OR event_id % 5 = 4 AND user_id % 2 = 0 AS areal FROM events")
def geometry_kinds(v: Views) -> DataFrame:
    k = F.col("event_id") % 5
    kind = F.when(k == 0, "MultiPolygon").when(k == 1, "LineString").when(k == 2, "Point").when(k == 3, "GeometryCollection")
    c = shapes.kind_of(kind, F.array(F.lit("Point"), F.lit("Polygon"), F.lit("LineString")))
    return v.events.select("event_id", c.alias("kind"), shapes.is_areal(c, F.col("user_id") % 2 == 0).alias("areal"))


@query(f"""
WITH {_BOXES}, c AS (SELECT region, (6::BIGINT << 58) + x * 536870912 + y AS cell FROM boxes, unnest(range(floor((w + 180) / 5.625)::BIGINT, ceil((e + 180) / 5.625)::BIGINT)) t(x), unnest(range(floor((s + 90) / 5.625)::BIGINT, ceil((n + 90) / 5.625)::BIGINT)) u(y)
  WHERE (e + 180 - x * 5.625) + (n + 90 - y * 5.625) > 2)
SELECT region, count(*) AS cells, min(cell) AS first_cell FROM c GROUP BY region""")
def region_covers(v: Views) -> DataFrame:
    # Boxes whose edges are no cell's: a cell that only touches an edge would count too.
    return boxes(v).select("region", F.explode(shapes.cover(F.col("rings"), 6)).alias("cell")).groupBy("region").agg(F.count("*").alias("cells"), F.min("cell").alias("first_cell"))


@query(f"""
WITH {_BOXES}, a AS (SELECT place_id, lon - 3 + 0.03125 AS aw, lat - 3 + 0.03125 AS a_s FROM p_pt WHERE abs(lon) < 170 AND abs(lat) < 80 AND namespace = 'su'),
o AS (SELECT place_id, region, greatest(least(aw + 6, e) - greatest(aw, w), 0) * greatest(least(a_s + 6, n) - greatest(a_s, s), 0) / 36 AS part FROM a JOIN boxes ON aw < e AND aw + 6 > w AND a_s < n AND a_s + 6 > s)
SELECT place_id, string_agg(region, ',' ORDER BY -round(part, 9), region) AS codes FROM o WHERE part > 1e-9 GROUP BY place_id""")
def country_codes_by_share(v: Views) -> DataFrame:
    x, y = F.col("lon") - 3 + 0.03125, F.col("lat") - 3 + 0.03125
    a = v.p_pt.where("abs(lon) < 170 and abs(lat) < 80 and namespace = 'su'").select("place_id", shapes.rectangle(x, y, x + 6, y + 6).alias("rings"))
    out = within.shares(a, boxes(v).select(F.col("region").alias("code"), "w", "s", "e", "n"))
    return out.select("place_id", F.array_join("codes", ",").alias("codes"))


@query(f"""
WITH {_BOXES}, hit AS (SELECT place_id, string_agg(region, ',' ORDER BY region) AS c FROM p_pt JOIN boxes ON {_IN} GROUP BY place_id), p AS (SELECT place_id, ccode, k, c FROM p_pt LEFT JOIN hit USING (place_id))
SELECT place_id, array_to_string(list_sort(list_distinct(list_concat(string_split(coalesce(c, ccode, ''), ','), CASE WHEN k % 10 = 0 THEN ['ZZ'] ELSE [] END))), ',') AS codes,
  CASE WHEN c IS NOT NULL THEN 'primary' WHEN ccode IS NOT NULL THEN 'fallback' ELSE 'none' END || CASE WHEN k % 10 = 0 THEN '+disputed' ELSE '' END AS outcome FROM p""")
def tiered_codes(v: Views) -> DataFrame:
    hit = within.containing(inner(v), boxes(v).select("region", "rings")).groupBy("place_id").agg(F.array_sort(F.collect_set("region")).alias("first"))
    second = F.when(F.col("ccode").isNotNull(), F.array("ccode"))
    t = within.tiered(F.col("first"), second, F.when(F.col("k") % 10 == 0, F.array(F.lit("ZZ"))))
    joined = v.p_pt.join(hit, "place_id", "left").select("place_id", "ccode", "k", "first", t.alias("t"))
    blank = F.when(F.col("first").isNull() & F.col("ccode").isNull(), F.concat(F.array(F.lit("")), F.col("t.codes"))).otherwise(F.col("t.codes"))
    return joined.select("place_id", F.array_join(blank, ",").alias("codes"), F.col("t.outcome").alias("outcome"))


_CELL = "({z}::BIGINT << 58) + least(floor(({x} + 180) / 360 * (1 << {z})), (1 << {z}) - 1)::BIGINT * 536870912 + least(floor(({y} + 90) / 180 * (1 << ({z} - 1))), (1 << ({z} - 1)) - 1)::BIGINT"


@query(f"""
WITH c AS (SELECT DISTINCT {_CELL.format(z=5, x='lon', y='lat')} AS cell, ccode AS code FROM p_pt WHERE namespace = 'su')
SELECT place_id, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM p_pt p JOIN c ON cell = {_CELL.format(z=5, x='p.lon', y='p.lat')} WHERE namespace = 'pa' GROUP BY place_id""")
def codes_of_cells(v: Views) -> DataFrame:
    at = v.p_pt.withColumn("c", space.cell(F.col("lon"), F.col("lat"), 5))
    coverage = at.where("namespace = 'su'").select(F.col("c").alias("cell"), F.col("ccode").alias("code")).distinct()
    out = within.coded(at.where("namespace = 'pa'").select("place_id", F.array("c").alias("cells")), "cells", coverage)
    return out.select("place_id", F.array_join("codes", ",").alias("codes"))


@query(f"""
WITH c AS (SELECT DISTINCT namespace, {_CELL.format(z=4, x='lon', y='lat')} AS cell, {_CELL.format(z=3, x='lon', y='lat')} AS up FROM p_pt),
f AS (SELECT namespace, up FROM c GROUP BY ALL HAVING count(*) = 4)
SELECT namespace, count(*) AS cells, (SELECT count(*) FROM f WHERE f.namespace = u.namespace) AS whole FROM (SELECT namespace, cell FROM c WHERE (namespace, up) NOT IN (SELECT namespace, up FROM f) UNION SELECT namespace, up FROM f) u GROUP BY namespace""")
def compact_coverage(v: Views) -> DataFrame:
    cells = v.p_pt.select(F.col("namespace").alias("owner"), space.cell(F.col("lon"), F.col("lat"), 4).alias("cell"))
    out = stages.compact(cells, "cell", space.parent, 1)
    return out.groupBy(F.col("owner").alias("namespace")).agg(F.count("*").alias("cells"), F.count_if(space.zoom_of(F.col("cell")) == 3).alias("whole"))


@query(f"SELECT namespace, count(DISTINCT {_CELL.format(z=3, x='lon', y='lat')}) AS cells FROM p_pt GROUP BY namespace")
def coarse_coverage(v: Views) -> DataFrame:
    fine = space.cell(F.col("lon"), F.col("lat"), 7)
    return v.p_pt.select("namespace", space.parent(fine, 3).alias("c")).distinct().groupBy("namespace").agg(F.count("*").alias("cells"))


@query(f"""
WITH r AS (SELECT DISTINCT {_CELL.format(z=4, x='lon', y='lat')} AS c FROM p_pt WHERE namespace = 'su' AND k % 2 = 0),
p AS (SELECT place_id, {_CELL.format(z=4, x='lon', y='lat')} IN (SELECT c FROM r) AS here, {_CELL.format(z=4, x='(lon + 360 + 180 + 23) % 360 - 180', y='lat')} IN (SELECT c FROM r) AS there FROM p_pt)
SELECT place_id, here OR there AS meets, here AND there AS within FROM p""")
def fuzzy_containment(v: Views) -> DataFrame:
    region = v.p_pt.where("namespace = 'su' and k % 2 = 0").agg(F.collect_set(space.cell(F.col("lon"), F.col("lat"), 4)).alias("region"))  # at most 2^7 cells
    x, y = F.col("lon"), F.col("lat")
    other = F.pmod(x + 360 + 180 + 23, F.lit(360.0)) - 180
    own = F.array(space.cell(x, y, 7), space.cell(other, y, 6))
    c4 = space.cell(x, y, 4)
    return v.p_pt.crossJoin(F.broadcast(region)).select("place_id", within.may_intersect(c4, own, F.col("region"), 4).alias("meets"), within.may_lie_within(c4, own, F.col("region"), 4).alias("within"))


@query("""
WITH c AS (SELECT place_id, lon, lat FROM p_pt WHERE namespace = 'su'), x AS (SELECT place_id, lon, lat, unnest(range(0, 128)) AS i FROM c), y AS (SELECT *, unnest(range(0, 64)) AS j FROM x),
d AS (SELECT place_id, i, j, (floor((lon + 180) / 2.8125) = i AND floor((lat + 90) / 2.8125) = j) AS own, pow(sin(radians((j + 0.5) * 2.8125 - 90 - lat) / 2), 2) + cos(radians(lat)) * cos(radians((j + 0.5) * 2.8125 - 90)) * pow(sin(radians((i + 0.5) * 2.8125 - 180 - lon) / 2), 2) AS h FROM y)
SELECT place_id, count(*) AS cells FROM d WHERE own OR 2 * 6371 * atan2(sqrt(h), sqrt(1 - h)) <= 500 GROUP BY place_id""")
def discs(v: Views) -> DataFrame:
    return v.p_pt.where("namespace = 'su'").select("place_id", F.size(within.disc(F.col("lon"), F.col("lat"), 500.0, 7)).cast("long").alias("cells"))


@query("SELECT place_id, lon, lat FROM p_pt")
def decoded_points(v: Views) -> DataFrame:
    def sixteen(x):
        """Hexadecimal digits, lowest byte first, of a dyadic number's double: sign, exponent and the top of its fraction."""
        a = F.abs(x)
        power = F.when(a > 0, F.floor(F.log2(F.greatest(a, F.lit(1e-9))) + 1e-12)).otherwise(-1023)
        part = F.when(a > 0, F.rint((a / F.pow(F.lit(2.0), power) - 1) * (1 << 20))).otherwise(0)
        top = F.lpad(F.hex((F.when(x < 0, 1 << 31).otherwise(0) + (power + 1023) * (1 << 20) + part).cast("long")), 8, "0")
        return F.concat(F.lit("00000000"), *(F.substring(top, i, 2) for i in (7, 5, 3, 1)))

    raw = F.concat(F.lit("0101000020E6100000"), sixteen(F.col("lon")), sixteen(F.col("lat")))
    return v.p_pt.select("place_id", shapes.ewkb_point(raw).alias("p")).select("place_id", "p.lon", "p.lat")


@query("SELECT place_id, (CASE namespace WHEN 'su' THEN 1 WHEN 'cu' THEN 2 ELSE 3 END)::BIGINT * 281474976710656 + CASE WHEN k % 2 = 0 THEN k ELSE ('0x' || substr(sha256(place_id), 3, 12))::BIGINT END AS number, CASE namespace WHEN 'su' THEN 1 WHEN 'cu' THEN 2 ELSE 3 END AS space FROM p_base")
def feature_numbers(v: Views) -> DataFrame:
    ns = F.when(F.col("namespace") == "su", 1).when(F.col("namespace") == "cu", 2).otherwise(3)
    n = shapes.feature_id(ns, F.when(F.col("k") % 2 == 0, F.col("k").cast("string")).otherwise(F.col("place_id")))
    return v.p_base.select("place_id", n.alias("number"), shapes.of_feature(n)["space"].alias("space"))


@query("SELECT place_id, round(lon + length(title) * 25 / 2.0 / (111320 * cos(radians(lat))), 9) AS x, round(lat + 15 / 111320.0, 9) AS y FROM p_pt")
def label_centres(v: Views) -> DataFrame:
    c = shapes.label_centre(F.col("lon"), F.col("lat"), F.col("title"), 25, 30)
    return v.p_pt.select("place_id", F.round(c["x"], 9).alias("x"), F.round(c["y"], 9).alias("y"))


@query(f"WITH {_BOXES} SELECT region, true AS inside FROM boxes")
def representative_points(v: Views) -> DataFrame:
    w, s, e, n = (F.col(c) for c in "wsen")
    # A bracket open to the east: its centroid lies outside.
    ring = F.array(*(shapes.point(x, y) for x, y in ((w, s), (e, s), (e, s + 1), (w + 1, s + 1), (w + 1, n - 1), (e, n - 1), (e, n), (w, n), (w, s))))
    p = shapes.inside_point(F.array(ring))
    return boxes(v).select("region", (shapes.contains(F.array(ring), p["x"], p["y"]) & ~shapes.contains(F.array(ring), shapes.centroid(ring)["x"], shapes.centroid(ring)["y"])).alias("inside"))
