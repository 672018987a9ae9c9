"""Queries of whole documents: merging, lists, inherited links, loads, audits, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import space
from ..operators import documents, search
from .queries import query
from .views import Views


@query("""
WITH r AS (SELECT place_id, 1 AS pos, CASE WHEN k % 2 = 0 THEN '' ELSE title END AS title, title || '@und' AS t, ccode, k FROM p_base UNION ALL SELECT place_id, 2, upper(title), CASE WHEN k % 3 = 0 THEN title || '@und' ELSE title || '@en' END, CASE WHEN k % 5 = 0 THEN 'XX' END, k FROM p_base)
SELECT place_id, max(CASE WHEN k % 2 = 0 THEN upper(title) END) IS NULL AS own_title, count(DISTINCT t) AS toponyms, count(DISTINCT ccode) AS codes, CASE WHEN max(k) % 4 = 0 THEN 1 ELSE 2 END AS geometries FROM r GROUP BY place_id""")
def merged_documents(v: Views) -> DataFrame:
    k = F.col("k")
    names = lambda n: F.array(F.struct(n.alias("toponym_id"), F.lit(1).alias("n")))
    cover = lambda c: F.array(c).cast("array<bigint>")
    shape = lambda kind, c, i: F.array(F.struct(F.lit(i).alias("geometry_index"), kind.alias("geom_class"), F.lit(None).cast("bigint").alias("cell"), c.alias("cover")))
    one = v.p_base.select("place_id", F.lit(1).alias("pos"), F.when(k % 2 == 0, "").otherwise(F.col("title")).alias("title"), names(F.concat("title", F.lit("@und"))).alias("toponyms"), F.when(F.col("ccode").isNotNull(), F.array("ccode")).alias("ccodes"), shape(F.lit("point"), F.lit(None).cast("array<bigint>"), 0).alias("geometries"))
    two = v.p_base.select("place_id", F.lit(2).alias("pos"), F.upper("title").alias("title"), names(F.concat("title", F.when(k % 3 == 0, "@und").otherwise("@en"))).alias("toponyms"), F.when(k % 5 == 0, F.array(F.lit("XX"))).alias("ccodes"), shape(F.when(k % 4 == 0, "point").otherwise("area"), cover(k), 0).alias("geometries"))
    out = documents.merge_documents(one.unionByName(two), "pos")
    upper = F.col("title") == F.upper("title")
    own = v.p_base.select("place_id", "k", F.col("title").alias("given"))
    return out.join(own, "place_id").select("place_id", (~(upper & (k % 2 == 0))).alias("own_title"), F.size("toponyms").cast("long").alias("toponyms"), F.coalesce(F.size("ccodes"), F.lit(0)).cast("long").alias("codes"), F.size("geometries").alias("geometries"))


@query("""
SELECT user_id, count(DISTINCT event_type) + (CASE WHEN bool_or(event_type = 'view') THEN 0 ELSE 1 END) AS names, (SELECT count(DISTINCT event_type) FROM events) AS known FROM events GROUP BY user_id""")
def appended_names(v: Views) -> DataFrame:
    item = F.struct(F.col("event_type").alias("toponym_id"), F.col("event_id").alias("at"))
    add = v.events.groupBy("user_id").agg(F.array_sort(F.collect_list(item)).alias("more"))
    had = F.array(F.struct(F.lit("view").alias("toponym_id"), F.lit(0).cast("long").alias("at")))
    broken = F.array(F.struct(F.lit(None).cast("string").alias("toponym_id"), F.lit(1).cast("long").alias("at")))
    out = add.select("user_id", documents.append_new(had, F.concat("more", broken), ["toponym_id"]).alias("names"))
    n = v.events.agg(F.count_distinct("event_type").alias("known"))
    return out.crossJoin(F.broadcast(n)).select("user_id", F.size("names").cast("long").alias("names"), "known")


@query("""
WITH e AS (SELECT DISTINCT place_a, place_b FROM e_edges WHERE relation_type <> 'distinct'), l AS (SELECT DISTINCT place_a AS place_id, 'https://wikipedia.org/' || place_b AS i FROM e WHERE split_part(place_b, ':', 2)::BIGINT % 2 = 0)
SELECT p.place_id, 1 + count(DISTINCT i) AS links, min(i) AS first_link FROM p_base p LEFT JOIN l USING (place_id) WHERE namespace = 'cu' GROUP BY p.place_id""")
def inherited_links(v: Views) -> DataFrame:
    related = v.e_edges.groupBy(F.col("place_a").alias("place_id")).agg(F.collect_set(F.struct("relation_type", F.col("place_b").alias("related_place_id"))).alias("relations"))
    own = F.array(F.struct(F.lit("homepage").alias("type"), F.concat(F.lit("https://own/"), "place_id").alias("identifier")))
    places = v.p_base.where("namespace = 'cu'").join(related, "place_id", "left").select("place_id", "relations", own.alias("links"))
    held = F.when(F.col("k") % 2 == 0, F.concat(F.lit("https://wikipedia.org/"), "place_id")).otherwise("https://elsewhere/")
    holders = v.p_base.where("namespace = 'pa'").select("place_id", F.array(F.struct(F.lit(None).cast("string").alias("type"), held.alias("identifier"))).alias("links"))
    out = documents.inherited_links(places, holders, "pa:", "wikipedia.org")
    got = F.filter("links", lambda x: F.contains(x["identifier"], F.lit("wikipedia.org")))
    return out.select("place_id", F.size("links").cast("long").alias("links"), F.array_min(F.transform(got, lambda x: x["identifier"])).alias("first_link"))


@query("""
WITH asked AS (SELECT place_id FROM p_base WHERE namespace = 'cu' AND k % 3 = 0), b AS (SELECT place_a AS x, place_b AS far FROM e_edges WHERE relation_type IN ('sameAs', 'exactMatch') UNION SELECT place_b, place_a FROM e_edges WHERE relation_type IN ('sameAs', 'exactMatch'))
SELECT DISTINCT far AS place_id FROM b WHERE x IN (SELECT place_id FROM asked) AND far NOT IN (SELECT place_id FROM asked) AND far IN (SELECT place_id FROM p_base WHERE k % 2 = 0) ORDER BY 1 LIMIT 50""")
def lent_areas(v: Views) -> DataFrame:
    asked = v.p_base.where("namespace = 'cu' and k % 3 = 0").select("place_id")
    return documents.lent_areas(asked, v.e_edges, v.p_base.where("k % 2 = 0").select("place_id"))


@query("SELECT place_id FROM p_base WHERE namespace IN ('cu', 'su')")
def selected_namespaces(v: Views) -> DataFrame:
    return documents.without_namespaces(v.p_base, ["cu", "su"]).select("place_id")


@query("""
WITH old AS (SELECT toponym_id, place_id FROM t_att WHERE NOT (namespace = 'pa' AND split_part(place_id, ':', 2)::BIGINT % 2 = 0)), new AS (SELECT toponym_id, place_id FROM t_att WHERE namespace = 'pa' AND split_part(place_id, ':', 2)::BIGINT % 3 = 0),
u AS (SELECT * FROM old WHERE NOT starts_with(place_id, 'pa:') UNION SELECT * FROM new), n AS (SELECT DISTINCT toponym_id FROM old UNION SELECT toponym_id FROM new)
SELECT n.toponym_id, count(u.place_id) AS attestations, coalesce(string_agg(DISTINCT split_part(u.place_id, ':', 1), ',' ORDER BY split_part(u.place_id, ':', 1)), '') AS namespaces FROM n LEFT JOIN u USING (toponym_id) GROUP BY n.toponym_id""")
def reloaded_names(v: Views) -> DataFrame:
    k = F.split_part("place_id", F.lit(":"), F.lit(2)).cast("long")
    live = v.t_att.where(~((F.col("namespace") == "pa") & (k % 2 == 0))).groupBy("toponym_id").agg(F.collect_set("place_id").alias("attestations"), F.collect_set("namespace").alias("namespaces"), F.min("namespace").alias("primary"))
    new = v.t_att.where((F.col("namespace") == "pa") & (k % 3 == 0)).groupBy("toponym_id").agg(F.collect_set("place_id").alias("attestations"))
    out = documents.merged_attestations(live, new, "pa")
    return out.select("toponym_id", F.size("attestations").cast("long").alias("attestations"), F.array_join("namespaces", ",").alias("namespaces"))


@query("SELECT place_id, 'XX' AS ccode FROM p_base WHERE ccode IS NULL OR k % 3 = 0")
def changed_codes(v: Views) -> DataFrame:
    after = v.p_base.select("place_id", F.when(F.col("ccode").isNull() | (F.col("k") % 3 == 0), "XX").otherwise(F.col("ccode")).alias("ccode"))
    return documents.changed(v.p_base, after, "place_id", "ccode")


@query("""SELECT place_id, CASE WHEN k % 2 = 0 THEN 0.0 ELSE lon END AS w, (14::BIGINT << 58) + least(floor((lon + 180) / 360 * 16384), 16383)::BIGINT * 536870912 + least(floor((lat + 90) / 180 * 8192), 8191)::BIGINT AS cell FROM p_pt""")
def filled_points(v: Views) -> DataFrame:
    docs = v.p_pt.select("place_id", "lon", "lat", F.when(F.col("k") % 2 == 0, F.array(*(F.lit(0.0),) * 4)).alias("bounds"), F.lit(None).cast("long").alias("cell"))
    return documents.filled_points(docs).select("place_id", F.col("bounds")[0].alias("w"), "cell")


@query("SELECT place_id FROM p_base WHERE k % 2 = 0 AND k % 3 > 0")
def dangling_geometries(v: Views) -> DataFrame:
    docs = v.p_base.select("place_id", (F.col("k") % 2 == 0).alias("has_geom"), F.col("place_id").alias("geom_key"))
    return documents.dangling(docs, v.p_base.where("k % 3 = 0").select(F.col("place_id").alias("geom_key"))).select("place_id")


@query("SELECT coalesce(a.ccode, b.ccode) AS ccode, coalesce(a.n, 0) AS staged, coalesce(b.n, 0) AS live, coalesce(a.n, 0) - coalesce(b.n, 0) AS difference FROM (SELECT ccode, count(*) AS n FROM p_base WHERE namespace = 'cu' GROUP BY ccode) a FULL JOIN (SELECT ccode, count(*) AS n FROM p_base WHERE namespace = 'su' GROUP BY ccode) b USING (ccode)")
def code_parity(v: Views) -> DataFrame:
    return documents.parity(v.p_base.where("namespace = 'cu'"), v.p_base.where("namespace = 'su'"), "ccode")


@query("""
WITH c AS (SELECT event_type, user_id % 7 AS owner, count(*) AS c FROM events GROUP BY ALL)
SELECT e.event_type AS dataset_id, count(*) AS n, min(ts) AS first, max(ts) AS last, (SELECT arg_min(owner, owner - c * 1000) FROM c WHERE c.event_type = e.event_type) AS owner FROM events e GROUP BY e.event_type""")
def pending_datasets(v: Views) -> DataFrame:
    return documents.pending_datasets(v.events.select(F.col("event_type").alias("dataset_id"), (F.col("user_id") % 7).alias("owner"), "ts"))


@query("""
WITH l AS (SELECT user_id % 40 AS namespace, event_type AS stage, arg_max(event_id % 3, event_id) AS status FROM events GROUP BY ALL), n AS (SELECT DISTINCT user_id % 40 AS namespace FROM events), r AS (SELECT namespace, stage FROM n, unnest(['click', 'signup', 'view']) t(stage))
SELECT r.namespace, bool_and(coalesce(status, 0) > 0) AS passed, coalesce(string_agg(r.stage, ',' ORDER BY r.stage) FILTER (WHERE coalesce(status, 0) = 0), '') AS missing FROM r LEFT JOIN l USING (namespace, stage) GROUP BY r.namespace""")
def passed_barriers(v: Views) -> DataFrame:
    status = F.element_at(F.array(F.lit("failed"), F.lit("completed"), F.lit("skipped")), (F.col("event_id") % 3 + 1).cast("int"))
    log = v.events.select((F.col("user_id") % 40).alias("namespace"), F.col("event_type").alias("stage"), status.alias("status"), F.col("event_id").alias("at"))
    return documents.barrier(log, ["view", "click", "signup"]).select("namespace", "passed", F.array_join("missing", ",").alias("missing"))


@query("""SELECT p.namespace, count(*) AS records, min(coalesce(s_earliest, s_in)) AS first_year, (SELECT count(DISTINCT floor((lon + 180) / 22.5) * 100 + floor((lat + 90) / 22.5)) FROM p_pt q WHERE q.namespace = p.namespace) AS cells FROM p_base p LEFT JOIN ts_flat USING (place_id) GROUP BY p.namespace""")
def inventory(v: Views) -> DataFrame:
    years = v.p_base.join(v.ts_flat, "place_id").groupBy("namespace").agg(F.min(F.coalesce("s_earliest", "s_in")).alias("first_year"))
    cells = v.p_pt.select("namespace", space.cell(F.col("lon"), F.col("lat"), 4).alias("c")).distinct().groupBy("namespace").agg(F.count("*").alias("cells"))
    return documents.inventory(years, cells, v.p_base.groupBy("namespace").agg(F.count("*").alias("records")))


@query("""
WITH RECURSIVE o AS (SELECT s_nationkey, s_suppkey, s_suppkey % 100 + 1 AS n, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS i FROM supplier),
r AS (SELECT s_nationkey, s_suppkey, i, 0::BIGINT AS batch, n AS held FROM o WHERE i = 1 UNION ALL SELECT o.s_nationkey, o.s_suppkey, o.i, r.batch + (r.held + o.n > 120)::INT, CASE WHEN r.held + o.n > 120 THEN o.n ELSE r.held + o.n END FROM r JOIN o ON o.s_nationkey = r.s_nationkey AND o.i = r.i + 1)
SELECT s_nationkey, s_suppkey, batch FROM r""")
def inventory_batches(v: Views) -> DataFrame:
    return documents.batches_by_size(v.supplier.withColumn("cells", F.col("s_suppkey") % 100 + 1), "s_nationkey", "s_suppkey", "cells", 120)


@query()
def balanced_shards(v: Views) -> DataFrame:
    items = v.supplier.select("s_nationkey", "s_suppkey", (F.col("s_suppkey") * 7919 % 1000).alias("cost"))
    return documents.balanced_shards(items, "s_nationkey", "s_suppkey", "cost", 3, 1)


@query("SELECT doc_id, ('0x' || md5(doc_id::VARCHAR)[1:8])::BIGINT % 16 AS shard FROM documents")
def hash_shards(v: Views) -> DataFrame:
    return v.documents.select("doc_id", documents.hash_shard(F.col("doc_id").cast("string"), 16).alias("shard"))


@query()
def sampled_places(v: Views) -> DataFrame:
    return documents.sampled(v.p_base, "place_id", 100, 13).select("place_id")


@query("""
WITH p AS (SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'LATIN' WHEN 1 THEN 'GREEK' ELSE 'ARABIC' END AS a, CASE event_id % 2 WHEN 0 THEN 'LATIN' ELSE 'GREEK' END AS b, event_id % 4 = 0 AS same FROM events),
k AS (SELECT *, least(a, b) AS k1, greatest(a, b) AS k2, row_number() OVER (PARTITION BY least(a, b), greatest(a, b), same ORDER BY event_id) AS r FROM p), q AS (SELECT *, row_number() OVER (PARTITION BY k1, k2 ORDER BY event_id) AS n FROM k WHERE NOT same OR r <= 10)
SELECT event_id FROM q WHERE n <= 50""")
def pairs_within_quotas(v: Views) -> DataFrame:
    k = F.col("user_id") % 3
    p = v.events.select("event_id", F.when(k == 0, "LATIN").when(k == 1, "GREEK").otherwise("ARABIC").alias("a"), F.when(F.col("event_id") % 2 == 0, "LATIN").otherwise("GREEK").alias("b"))
    return documents.quotas(p, ("a", "b"), F.col("event_id") % 4 == 0, F.col("event_id"), 50).select("event_id")


# Sets and joins


@query("SELECT ccode FROM p_base WHERE namespace = 'cu' AND ccode IS NOT NULL INTERSECT SELECT ccode FROM p_base WHERE namespace = 'su'")
def shared_codes(v: Views) -> DataFrame:
    return v.p_base.where("namespace = 'cu' and ccode is not null").select("ccode").intersect(v.p_base.where("namespace = 'su'").select("ccode"))


@query("SELECT place_a AS place_id FROM e_edges EXCEPT SELECT place_id FROM ts_flat WHERE e_in IS NOT NULL")
def linked_without_end(v: Views) -> DataFrame:
    return v.e_edges.select(F.col("place_a").alias("place_id")).exceptAll(v.ts_flat.where("1 = 0").select("place_id")).distinct().subtract(v.ts_flat.where("e_in is not null").select("place_id"))


@query("SELECT 'type' AS kind, type_identifier AS value FROM p_base UNION SELECT 'country', ccode FROM p_base WHERE ccode IS NOT NULL")
def summary_terms(v: Views) -> DataFrame:
    kinds = v.p_base.select(F.lit("type").alias("kind"), F.col("type_identifier").alias("value"))
    return kinds.union(v.p_base.where("ccode is not null").select(F.lit("country"), "ccode")).distinct()


@query("SELECT t.toponym_id, count(DISTINCT t.place_id) AS places, count(s.place_id) > 0 AS dated FROM t_att t LEFT JOIN ts_flat s ON s.place_id = t.place_id GROUP BY t.toponym_id")
def attested_vocabulary(v: Views) -> DataFrame:
    dated = v.ts_flat.select("place_id", F.lit(1).alias("d"))
    return v.t_att.join(dated, "place_id", "left").groupBy("toponym_id").agg(F.count_distinct("place_id").alias("places"), (F.count("d") > 0).alias("dated"))


@query("SELECT d.doc_id, v.vec_id IS NOT NULL AS embedded FROM documents d LEFT JOIN embeddings v ON v.vec_id = d.doc_id")
def looked_up_vectors(v: Views) -> DataFrame:
    return v.documents.join(v.embeddings.select(F.col("vec_id").alias("doc_id"), F.lit(True).alias("e")), "doc_id", "left").select("doc_id", F.coalesce("e", F.lit(False)).alias("embedded"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'hit' ELSE 'miss' END AS cached FROM documents")
def cached_vectors(v: Views) -> DataFrame:
    version = F.when(F.col("doc_id") % 3 == 0, "v7").otherwise("v6")
    cache = v.documents.select("doc_id", version.alias("version")).where("version = 'v7'").withColumn("cached", F.lit("hit"))
    return v.documents.select("doc_id", F.lit("v7").alias("version")).join(cache, ["doc_id", "version"], "left").select("doc_id", F.coalesce("cached", F.lit("miss")).alias("cached"))


@query("SELECT place_id, floor((lon + 180) / 45)::BIGINT * 100 + floor((lat + 90) / 45)::BIGINT AS cell FROM p_pt ORDER BY 2, 1 LIMIT 200")
def sorted_by_cell(v: Views) -> DataFrame:
    c = space.cell(F.col("lon"), F.col("lat"), 3)
    at = v.p_pt.select("place_id", (space.x_of(c) * 100 + space.y_of(c)).alias("cell"))
    return search.top_per_group(at.withColumn("all", F.lit(1)), ["all"], [F.col("cell"), F.col("place_id")], 200).select("place_id", "cell")


@query("SELECT place_a, place_b, relation_type, source_id, row_number() OVER (PARTITION BY place_a ORDER BY place_b, relation_type, source_id) AS pos FROM e_edges")
def ordered_edges(v: Views) -> DataFrame:
    out = search.top_per_group(v.e_edges, ["place_a"], [F.col("place_b"), F.col("relation_type"), F.col("source_id")], 1 << 30)
    return out.select("place_a", "place_b", "relation_type", "source_id", F.col("rank").cast("long").alias("pos"))
