"""Queries of dump readers, over lines made from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import shapes
from ..sources import dumps
from .queries import query
from .views import Views


@query("SELECT 'wd:Q' || k AS place_id, title, lon, lat, k * 10 AS population, CASE WHEN k % 2 = 0 THEN 1200 END AS start_year FROM p_pt WHERE namespace = 'cu' AND k % 5 > 0")
def dumped_entities(v: Views) -> DataFrame:
    k = F.col("k")
    snak = lambda x: F.array(F.struct(F.struct(F.struct(x.alias("value")).alias("datavalue")).alias("mainsnak")))
    claims = F.struct(
        F.when(k % 5 > 0, snak(F.struct(F.col("lon").alias("longitude"), F.col("lat").alias("latitude")))).alias("P625"), snak(F.struct(F.concat(F.lit("+"), (k * 10).cast("string")).alias("amount"))).alias("P1082"),
        F.when(k % 2 == 0, snak(F.struct(F.lit("+1200-00-00T00:00:00Z").alias("time")))).alias("P571"),
    )
    entity = F.struct(F.concat(F.lit("Q"), k.cast("string")).alias("id"), F.struct(F.struct(F.col("title").alias("value")).alias("en")).alias("labels"), claims.alias("claims"))
    lines = v.p_pt.where("namespace = 'cu'").select(F.concat(F.to_json(entity), F.lit(",")).alias("value"))
    return dumps.entities(lines).select("place_id", "title", "lon", "lat", "population", F.col("start").alias("start_year"))


@query("SELECT 'osm:n' || event_id AS place_id, event_type AS title, CASE WHEN event_id % 2 = 0 THEN event_type || ' x@de,' ELSE '' END || event_type || '@und' AS toponyms, CASE WHEN event_id % 3 = 0 THEN 1850 END AS start_year FROM events WHERE event_id % 4 > 0 AND event_type <> 'error'")
def map_elements(v: Views) -> DataFrame:
    i, t = F.col("event_id"), F.col("event_type")
    tag = lambda key, c: F.when(c.isNotNull(), F.create_map(F.lit(key), c)).otherwise(F.create_map().cast("map<string,string>"))
    tags = F.map_concat(tag("name", F.when(t != "error", t)), tag("name:de", F.when(i % 2 == 0, F.concat(t, F.lit(" x")))), tag("place", F.when(i % 4 > 0, F.lit("town"))), tag("start_date", F.when(i % 3 == 0, F.lit("1850-05"))))
    out = dumps.map_places(v.events.select(F.lit("node").alias("kind"), i.alias("id"), tags.alias("tags")), "osm")
    return out.select("place_id", "title", F.array_join("toponyms", ",").alias("toponyms"), F.get("spans", F.lit(0))["start"]["in"].alias("start_year"))


@query("""
WITH f AS (SELECT event_id AS pos, 's' || (event_id % 400) AS src, event_type, row_number() OVER (PARTITION BY event_id % 400 ORDER BY event_id) AS r FROM events)
SELECT 'lp:' || src || CASE WHEN r > 1 THEN '_' || r ELSE '' END AS place_id, event_type || '@' || CASE WHEN pos % 2 = 0 THEN 'en' ELSE 'und' END AS toponyms, 1800 + pos % 100 AS start_year FROM f""")
def linked_place_documents(v: Views) -> DataFrame:
    i, t = F.col("event_id"), F.col("event_type")
    name = F.struct(F.concat(F.lit(" "), t).alias("toponym"), F.when(i % 2 == 0, "en").alias("lang"))
    features = v.events.select(
        F.concat(F.lit("s"), (i % 400).cast("string")).alias("src_id"), t.alias("title"), F.array(name, name, F.struct(F.lit(" ").alias("toponym"), F.lit(None).cast("string").alias("lang"))).alias("names"),
        F.array().cast("array<struct<identifier:string,label:string>>").alias("types"), F.array().cast("array<struct<type:string,identifier:string>>").alias("links"), F.array().cast("array<struct<type:string,to:string>>").alias("relations"),
        F.concat((1800 + i % 100).cast("string"), F.lit("-01-01")).alias("start"), F.lit(None).cast("string").alias("end"), i.alias("pos"),
    )
    out = dumps.linked_places(features, "lp")
    return out.select("place_id", F.array_join("toponyms", ",").alias("toponyms"), F.col("spans")[0]["start"]["in"].alias("start_year"))


@query("""SELECT 'n' || page_id AS record, 'gn:' || page_id AS place_id, page_id % 2 = 0 AS exact FROM pages UNION ALL SELECT 'n' || page_id, 'wd:Q' || page_id, true FROM pages WHERE page_id % 3 = 0""")
def authority_records(v: Views) -> DataFrame:
    i = F.col("page_id").cast("string")
    gn, wd = F.concat(F.lit("http://sws.geonames.org/"), i, F.lit("/")), F.concat(F.lit("http://www.wikidata.org/entity/Q"), i)
    exact = F.array_compact(F.array(F.when(F.col("page_id") % 2 == 0, gn), F.when(F.col("page_id") % 3 == 0, wd), F.lit("http://elsewhere/1")))
    record = F.struct(F.concat(F.lit("n"), i).alias("@id"), exact.alias("exact"), F.array(gn).alias("close"))
    return dumps.authority_links(v.pages.select(F.to_json(record).alias("value")))


@query("SELECT s_suppkey AS k, s_name || ' (it''s)' AS name, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS nation FROM supplier")
def sql_dump_rows(v: Views) -> DataFrame:
    name = F.concat(F.lit("'"), F.col("s_name"), F.when(F.col("s_suppkey") % 3 == 0, r" (it\'s)'").otherwise(" (it''s)'"))
    row = F.concat(F.lit("("), F.col("s_suppkey").cast("string"), F.lit(", "), name, F.lit(","), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey").cast("string")).otherwise("NULL"), F.lit(")"))
    lines = v.supplier.groupBy((F.col("s_suppkey") % 7).alias("g")).agg(F.concat_ws(",", F.collect_list(row)).alias("t")).select(F.concat(F.lit("INSERT INTO `places` VALUES "), "t", F.lit(";")).alias("value"))
    out = dumps.sql_rows(lines.unionByName(lines.limit(1).select(F.lit("-- no rows").alias("value"))), "places")
    return out.select(F.col("fields")[0].cast("long").alias("k"), F.col("fields")[1].alias("name"), F.col("fields")[2].cast("int").alias("nation"))


@query("SELECT c_nationkey AS unit, max(c_name) || ' a' AS title, count(DISTINCT c_mktsegment) + 1 AS names, 1900 + c_nationkey AS start_year FROM customer GROUP BY c_nationkey")
def looked_up_units(v: Views) -> DataFrame:
    units = v.customer.select(F.col("c_nationkey").alias("unit")).distinct().select("unit", (1900 + F.col("unit")).cast("long").alias("start"), F.lit(None).cast("long").alias("end"))
    names = v.customer.select(F.col("c_nationkey").alias("unit"), F.col("c_mktsegment").alias("name"), F.lit("other").alias("kind"))
    first = v.customer.groupBy(F.col("c_nationkey").alias("unit")).agg(F.concat(F.max("c_name"), F.lit(" a")).alias("name")).withColumn("kind", F.lit("preferred"))
    out = dumps.looked_up(units, names.unionByName(first), ["preferred"])
    return out.select("unit", "title", F.size("names").cast("long").alias("names"), F.col("spans")[0]["start"]["in"].alias("start_year"))


@query("""
WITH s AS (SELECT DISTINCT o_custkey % 50 AS unit, year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) % 2 = 1), a AS (SELECT y, lag(y) OVER (ORDER BY y) AS b, coalesce(lead(y) OVER (ORDER BY y), y + 10) AS n FROM (SELECT DISTINCT y FROM s))
SELECT unit, count(*) AS geometries, min(y) AS first_year, first(b ORDER BY y) AS bounded_by, max(n) AS last_year FROM s JOIN a USING (y) GROUP BY unit""")
def census_units(v: Views) -> DataFrame:
    y = F.year("o_orderdate").cast("long")
    s = v.orders.where(y % 2 == 1).select((F.col("o_custkey") % 50).alias("unit"), y.alias("year")).distinct()
    s = s.select("unit", "year", F.lit("name").alias("name"), shapes.rectangle(F.col("unit"), F.lit(0), F.col("unit") + 1, F.lit(1)).alias("rings"))
    name = F.col("names")[0]["spans"][0]
    return dumps.census_documents(s).select("unit", F.size("geometries").cast("long").alias("geometries"), name["start"]["latest"].alias("first_year"), F.when(name["start"]["earliest"].isNotNull(), name["start"]["earliest"]).alias("bounded_by"), name["end"]["latest"].alias("last_year"))
