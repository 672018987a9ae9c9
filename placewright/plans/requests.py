"""Queries of what clients ask: filters, properties as table cells, candidate pools, scopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import shapes, temporal
from ..operators import extend, filters, search
from .queries import query
from .views import Views


def nested(v: Views) -> DataFrame:
    """Places with their lists: codes, types with concept paths, and the dataset that they came in."""
    k = F.col("k")
    concepts = F.when(F.col("namespace") == "pa", F.array(k % 20))
    kind = F.struct(F.col("type_identifier").alias("identifier"), F.col("type_label").alias("label"), F.concat("type_label", F.lit("."), "type_identifier").alias("sourceLabel"), concepts.alias("aat_ids"), F.when(concepts.isNotNull(), F.array(F.concat_ws(".", F.lit("1"), (k % 4).cast("string"), (k % 20).cast("string")))).alias("aat_paths"))
    return v.p_pt.select(
        "place_id", "namespace", "title", "lon", "lat", "k", F.when(F.col("ccode").isNotNull(), F.array("ccode")).alias("ccodes"), F.array(kind).alias("types"),
        F.when(k % 5 == 0, "pending").otherwise("published").alias("dataset_status"), F.concat(F.lit("set"), (k % 10).cast("string")).alias("dataset_id"),
    )


@query("SELECT place_id FROM p_base WHERE ccode IN ('FRANCE', 'CHINA', 'NATION_3', 'nation_3')")
def places_in_countries(v: Views) -> DataFrame:
    return nested(v).where(filters.any_country(["FRANCE", "CHINA", "NATION_3", "nation_3"])).select("place_id")


@query("SELECT place_id FROM p_base WHERE type_label IN ('su') OR type_identifier IN ('BUILDING', 'MACHINERY')")
def places_of_types(v: Views) -> DataFrame:
    return nested(v).where(filters.any_type("label", ["su"]) | filters.any_type("identifier", ["BUILDING", "MACHINERY"])).select("place_id")


@query("SELECT place_id FROM p_base WHERE namespace = 'pa' AND (k % 20 IN (2, 7) OR k % 4 = 2)")
def places_of_concepts(v: Views) -> DataFrame:
    return nested(v).where(filters.any_concept([2, 7])).select("place_id")


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN user_id::VARCHAR ELSE '' END AS concepts, CASE WHEN event_id % 3 = 2 THEN event_type ELSE '' END || '' AS native FROM events")
def split_types(v: Views) -> DataFrame:
    k, u = F.col("event_id") % 3, F.col("user_id").cast("string")
    asked = F.array(F.when(k == 0, F.concat(F.lit("AAT:"), u)).when(k == 1, u).otherwise(F.col("event_type")))
    shown = lambda a: F.array_join(a.cast("array<string>"), ",")
    return v.events.select("event_id", shown(filters.concept_ids(asked)).alias("concepts"), shown(filters.native_types(asked)).alias("native"))


@query("SELECT place_id, title, ccode AS ccodes, '' AS types FROM p_base")
def requested_fields(v: Views) -> DataFrame:
    docs = nested(v).select("place_id", "title", "ccodes", "types")
    out = filters.requested(docs, ["ccodes"], ["place_id", "title"])
    return out.select("place_id", "title", F.array_join("ccodes", ",").alias("ccodes"), F.array_join(F.transform("types", lambda t: t["label"]), ",").alias("types"))


@query("SELECT place_id, lon, lat FROM p_pt")
def source_fields(v: Views) -> DataFrame:
    docs = nested(v).withColumn("repr_point", F.struct("lon", "lat"))
    wanted = [c for c in filters.source_fields("repr_point") if c in ("place_id", "repr_point")]
    return docs.select(*wanted).select("place_id", "repr_point.lon", "repr_point.lat")


@query("SELECT place_id FROM p_base WHERE k % 5 <> 0 OR k % 10 = 5")
def places_in_scope(v: Views) -> DataFrame:
    return nested(v).where(filters.in_scope(["set5", "set7"])).select("place_id")


@query("""
SELECT event_id, event_id % 6 IN (0, 5) AS valid FROM events""")
def valid_ids(v: Views) -> DataFrame:
    k, u = F.col("event_id") % 6, F.col("user_id").cast("string")
    i = F.when(k == 0, F.concat(F.lit("gn:"), u)).when(k == 1, F.concat(F.lit("wd:"), u)).when(k == 2, "wd:None").when(k == 3, u).when(k == 4, F.concat(F.lit(":"), u)).otherwise(F.concat(F.lit("wd:Q"), u))
    return v.events.select("event_id", filters.namespaced(i).alias("valid"))


@query("SELECT place_id FROM p_pt WHERE lon > -20 AND lon < 30 AND lat > -10 AND lat < 40 AND lon + lat < 50")
def in_polygon(v: Views) -> DataFrame:
    # Corners between the places' eighths of degrees, so that no place lies on a side.
    corners = [(-19.96875, -9.96875), (29.96875, -9.96875), (29.96875, 19.96875), (9.96875, 39.96875), (-19.96875, 39.96875), (-19.96875, -9.96875)]
    ring = F.array(F.array(*(shapes.point(F.lit(x), F.lit(y)) for x, y in corners)))
    box = F.col("lon").between(-20, 30) & F.col("lat").between(-10, 40)  # reaches the scan
    return v.p_pt.where(box & filters.has_geometries(F.lit("Polygon"), F.array()) & shapes.contains(ring, F.col("lon"), F.col("lat"))).select("place_id")


@query("""
SELECT namespace, count(*) AS n, count(*) FILTER (WHERE k % 3 > 0 AND k % 4 = 0) AS dangling, count(*) FILTER (WHERE k % 3 = 1 AND k % 7 = 0) AS uncovered, bool_or(ccode IS NOT NULL) AS coded FROM p_base GROUP BY namespace""")
def defects(v: Views) -> DataFrame:
    k = F.col("k")
    g = v.p_base.select("namespace", F.when(k % 3 == 1, "area").when(k % 3 == 2, "line").otherwise("point").alias("geom_class"), F.when(k % 4 > 0, True).alias("has_geom"), F.when(k % 7 > 0, F.array(k)).alias("cover"), F.when(F.col("ccode").isNotNull(), F.array("ccode")).alias("ccodes"))
    return filters.defects(g)


@query("""
SELECT place_id, CASE WHEN k % 4 = 0 THEN 'admin_' || (k % 12) WHEN namespace = 'pa' AND type_identifier LIKE '%ECONOMY' THEN 'pa_listed' WHEN namespace = 'cu' THEN 'misc' ELSE namespace END AS bucket,
  CASE WHEN k % 12 < 3 THEN 'low' WHEN k % 12 < 6 THEN 'middle' WHEN k % 2 = 0 THEN 'even' END AS band FROM p_base""")
def tile_buckets(v: Views) -> DataFrame:
    k = F.col("k")
    listed = [r[0] for r in v.part.select("p_type").distinct().where("p_type like '%ECONOMY'").collect()]  # a vocabulary, at most a few hundred terms
    level = F.when(k % 4 == 0, (k % 12).cast("string")).otherwise("local")
    bucket = filters.tile_bucket(F.col("namespace"), level, F.col("type_identifier"), {"pa": listed}, ["cu"])
    return v.p_base.select("place_id", bucket.alias("bucket"), filters.first_band([("low", k % 12 < 3), ("middle", k % 12 < 6), ("even", k % 2 == 0)]).alias("band"))


@query("""
WITH n AS (SELECT namespace, count(*) AS n FROM p_base GROUP BY namespace)
SELECT namespace, namespace <> 'su' AND n <= (SELECT count(*) FROM part) AS downloadable, CASE WHEN namespace = 'su' THEN 'licence-restricted' WHEN n > (SELECT count(*) FROM part) THEN 'volume-exceeds-cap' END AS reason FROM n""")
def downloads(v: Views) -> DataFrame:
    n = v.p_base.groupBy("namespace").agg(F.count("*").alias("n"))
    d = filters.download(F.when(F.col("namespace") == "su", False), F.col("n"), v.part.count())
    return n.select("namespace", d.alias("d")).select("namespace", "d.*")


@query()
def empty_requests(v: Views) -> DataFrame:
    asked = filters.nothing_asked("  ", scope=False, filters=False)
    return filters.empty_like(v.p_base) if asked else v.p_base


@query("""
SELECT event_id, CASE WHEN user_id % 4 = 1 THEN 'named' WHEN user_id % 3 = 0 THEN 'filtered' WHEN event_id % 2 = 0 THEN 'spatial' ELSE 'nothing' END AS kind FROM events""")
def request_kinds(v: Views) -> DataFrame:
    """Requests whose name is text, blank or missing."""
    u = F.col("user_id") % 4
    name = F.when(u == 1, F.col("event_type")).when(u == 2, " ")
    return v.events.select("event_id", filters.request_kind(name, F.when(F.col("event_id") % 2 == 0, True), F.col("user_id") % 3 == 0).alias("kind"))


# Pools, spellings, scopes


_SCORES = "s AS (SELECT place_id, max(1.0 / (1 + length(name)))::DOUBLE AS score FROM t_att GROUP BY place_id)"


@query(f"WITH {_SCORES} SELECT place_id, round(score, 9) AS score FROM s ORDER BY s.score DESC, place_id DESC LIMIT 80")
def candidate_pool(v: Views) -> DataFrame:
    s = v.t_att.groupBy("place_id").agg(F.max(1 / (1 + F.length("name"))).alias("score"))
    return search.pool(s, 10, 10).select("place_id", F.round("score", 9).alias("score"))


@query("SELECT name, max(length(lang)) AS score, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs, string_agg(DISTINCT namespace, ',' ORDER BY namespace) AS namespaces, count(DISTINCT place_id) AS n FROM t_att GROUP BY name ORDER BY score DESC, name LIMIT 40")
def spellings(v: Views) -> DataFrame:
    out = search.spellings(v.t_att.withColumn("score", F.length("lang")), 40)
    return out.select("name", "score", F.array_join("langs", ",").alias("langs"), F.array_join("namespaces", ",").alias("namespaces"), F.size("places").alias("n"))


@query("WITH own AS (SELECT place_id, name, row_number() OVER (PARTITION BY place_id ORDER BY name) AS r FROM (SELECT DISTINCT place_id, name FROM t_att WHERE place_id IN (SELECT place_a FROM e_edges))) SELECT place_id, string_agg(name, ',' ORDER BY name) AS names FROM own WHERE r <= 5 GROUP BY place_id")
def names_of_linked(v: Views) -> DataFrame:
    out = search.names_of(v.t_att, v.e_edges.select(F.col("place_a").alias("place_id")), 5)
    return out.select("place_id", F.array_join("names", ",").alias("names"))


@query("SELECT string_agg(n, ',' ORDER BY n) AS namespaces FROM (SELECT DISTINCT CASE WHEN k % 2 = 0 THEN namespace ELSE split_part(place_id, ':', 1) END AS n FROM p_base)")
def namespaces_seen(v: Views) -> DataFrame:
    out = search.namespaces_seen(v.p_base.select("place_id", F.when(F.col("k") % 2 == 0, F.col("namespace")).otherwise("").alias("namespace")))
    return out.select(F.array_join("namespaces", ",").alias("namespaces"))


@query("""
WITH asked AS (SELECT place_id, k FROM p_base WHERE namespace = 'cu'), areas AS (SELECT place_id FROM p_base WHERE (namespace = 'cu' AND k % 7 = 0) OR (namespace = 'pa' AND k % 2 = 0)),
l AS (SELECT place_a, place_b FROM e_edges WHERE relation_type IN ('sameAs', 'exactMatch')), h AS (SELECT a.place_id, CASE WHEN k % 7 = 0 THEN 'polygon' WHEN EXISTS (SELECT 1 FROM l WHERE place_a = a.place_id AND place_b IN (SELECT place_id FROM areas)) THEN 'linked' WHEN k % 3 = 0 THEN 'point' ELSE 'unresolved' END AS how FROM asked a)
SELECT count(*) FILTER (WHERE how = 'polygon') AS polygon, count(*) FILTER (WHERE how = 'linked') AS linked, count(*) FILTER (WHERE how = 'point') AS point, count(*) FILTER (WHERE how = 'unresolved') AS unresolved, 'polygon' AS mode FROM h""")
def scope_report(v: Views) -> DataFrame:
    k = F.col("k")
    containers = v.p_base.where("namespace in ('cu', 'pa')").select("place_id", F.when(F.col("namespace") == "cu", k % 7 == 0).otherwise(k % 2 == 0).alias("is_area"), (k % 3 == 0).alias("has_point"))
    out = search.scope_report(v.p_base.where("namespace = 'cu'").select("place_id"), containers, v.e_edges)
    return out.select(*(F.size(c).cast("long").alias(c) for c in ("polygon", "linked", "point", "unresolved")), "mode")


@query("SELECT place_id, title AS names, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS areas, CASE WHEN k % 4 = 0 AND k % 3 > 0 THEN 0 ELSE 1 END AS shown FROM p_base")
def formatted_candidates(v: Views) -> DataFrame:
    k = F.col("k")
    g = F.struct(F.when(k % 4 > 0, F.struct("lon", "lat")).alias("repr_point"), F.when(k % 3 == 0, "area").otherwise("line").alias("geom_class"), (k % 3 == 0).alias("has_geom"))
    docs = v.p_pt.select("place_id", "title", F.array("title", "title", F.lit("")).alias("names"), F.array(g).alias("geometries"), F.lit(None).cast("array<string>").alias("links"), F.lit(1.0).alias("score"))
    out = search.candidates(docs)
    return out.select("place_id", F.array_join("names", ",").alias("names"), F.size(F.filter("geometries", lambda x: x["is_area"])).alias("areas"), F.size("geometries").alias("shown"))


# Table cells


@query("""
WITH a AS (SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 5 = 0 THEN 'cu:none' ELSE 'place:cu:' || o_custkey END AS asked FROM orders), p AS (SELECT * FROM p_pt WHERE namespace = 'cu'),
j AS (SELECT a.pos, p.*, s_in, e_in FROM a LEFT JOIN p ON place_id = replace(asked, 'place:', '') LEFT JOIN ts_flat USING (place_id))
SELECT pos, property, cell FROM j, unnest(['id_short', 'id_object', 'names_summary', 'countries_codes', 'types_objects', 'temporal_years', 'geometry_centroid', 'geometry_wkt', 'geometry_bbox', 'no_such']) t(property), unnest([CASE WHEN place_id IS NULL THEN '' ELSE
  CASE property WHEN 'id_short' THEN place_id WHEN 'id_object' THEN '{"id":"' || place_id || '","label":"' || title || '"}' WHEN 'names_summary' THEN title || '|old ' || title WHEN 'countries_codes' THEN ccode WHEN 'types_objects' THEN '{"identifier":"' || type_identifier || '","label":"cu","sourceLabel":""}'
  WHEN 'temporal_years' THEN CASE WHEN s_in IS NOT NULL THEN s_in || '-' || coalesce(e_in::VARCHAR, '?') ELSE '' END WHEN 'geometry_centroid' THEN lat || ', ' || lon
  WHEN 'geometry_wkt' THEN 'POLYGON ((' || k || ' 0, ' || (k + 1) || ' 0, ' || (k + 1) || ' 2, ' || k || ' 2, ' || k || ' 0))' WHEN 'geometry_bbox' THEN k || '.0, 0.0, ' || (k + 1) || '.0, 2.0' ELSE '' END END]) u(cell)""")
def extended_places(v: Views) -> DataFrame:
    k = F.col("k")
    spans = v.ts_flat.select("place_id", F.array(temporal.span(s_in=F.col("s_in"), e_in=F.col("e_in"))).alias("spans"))
    places = v.p_pt.where("namespace = 'cu'").join(spans, "place_id", "left").select(
        "place_id", "title", F.array("title", F.concat(F.lit("old "), "title")).alias("names"), F.struct("lon", "lat").alias("point"), shapes.rectangle(k, F.lit(0), k + 1, F.lit(2)).alias("rings"),
        F.when(F.col("ccode").isNotNull(), F.array("ccode")).alias("ccodes"), F.array(F.struct(F.col("type_identifier").alias("identifier"), F.col("type_label").alias("label"), F.lit(None).cast("string").alias("sourceLabel"))).alias("types"),
        F.array(F.lit("P")).alias("fclasses"), "spans",
    )
    asked = v.orders.select(F.col("o_orderkey").alias("pos"), F.when(F.col("o_orderkey") % 5 == 0, "cu:none").otherwise(F.concat(F.lit("place:cu:"), F.col("o_custkey").cast("string"))).alias("asked"))
    wanted = ["id_short", "id_object", "names_summary", "countries_codes", "types_objects", "temporal_years", "geometry_centroid", "geometry_wkt", "geometry_bbox", "no_such"]
    none = F.create_map(F.lit("-"), F.lit("-"))
    return extend.extend(places, asked, wanted, none, none).select("pos", "property", F.array_join("cell", "|").alias("cell"))


@query()
def extended_objects(v: Views) -> DataFrame:
    k = F.col("k")
    places = v.p_pt.select(
        "place_id", "title", F.array("title").alias("names"), F.when(k % 2 == 0, F.struct("lon", "lat")).alias("point"), F.when(k % 3 == 0, shapes.rectangle(k, F.lit(0), k + 1, F.lit(2))).alias("rings"),
        F.when(F.col("ccode").isNotNull(), F.array("ccode")).alias("ccodes"), F.array(F.struct(F.col("type_identifier").alias("identifier"), F.col("type_label").alias("label"), F.lit("").alias("sourceLabel"))).alias("types"),
        F.array(F.lit("P"), F.lit("?")).alias("fclasses"), F.array(temporal.span(s_in=k)).alias("spans"),
    )
    asked = v.p_base.select(k.alias("pos"), F.col("place_id").alias("asked"))
    names = F.create_map(F.lit("P"), F.lit("Populated place"))
    return extend.extend(places, asked, extend.PROPERTIES, names, names)
