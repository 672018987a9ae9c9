"""More queries: merging, links, space, text, types, vectors, labels, stages and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import space, text, types, vectors
from ..operators import graph, knn, search, stages
from .queries import query
from .views import Views

# Merging and maintenance


@query("SELECT p.place_id, coalesce('supplier ' || s.k::VARCHAR, p.title) AS title, p.namespace FROM p_base p LEFT JOIN (SELECT * FROM p_base WHERE namespace = 'su' AND k % 2 = 0) s USING (place_id)")
def patched_titles(v: Views) -> DataFrame:
    patch = v.p_base.where("namespace = 'su' and k % 2 = 0").select("place_id", F.concat(F.lit("supplier "), F.col("k").cast("string")).alias("title"))
    return stages.merge_patch(v.p_base.select("place_id", "title", "namespace"), patch, "place_id")


@query("""
WITH d AS (SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey % 2 = 0), p AS (SELECT s_suppkey AS id, 'new' AS name FROM supplier WHERE s_suppkey % 3 = 0)
SELECT coalesce(d.id, p.id) AS id, coalesce(p.name, d.name) AS name FROM d FULL JOIN p ON d.id = p.id""")
def upserted(v: Views) -> DataFrame:
    d = v.supplier.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return stages.merge_patch(d, v.supplier.where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("id"), F.lit("new").alias("name")), "id", upsert=True)


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def last_events(v: Views) -> DataFrame:
    return stages.last_write(v.events.select("user_id", "event_type", "event_id"), ["user_id"], F.col("event_id"))


@query("SELECT place_id, namespace, title FROM p_base WHERE namespace <> 'su' UNION ALL SELECT place_id, namespace, upper(title) FROM p_base WHERE namespace = 'su' AND k > 3")
def replaced_namespace(v: Views) -> DataFrame:
    base = v.p_base.select("place_id", "namespace", "title", "k")
    new = base.where("k > 3").withColumn("title", F.upper("title"))
    return stages.replace_namespace(base, new, "su").drop("k")


@query("SELECT event_type, day FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS r FROM (SELECT DISTINCT event_type, strftime(ts, '%Y-%m-%d') AS day FROM events)) WHERE r > 2")
def expired_versions(v: Views) -> DataFrame:
    days = v.events.select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct()
    return stages.keep_newest(days, "event_type", "day", 2).select("event_type", "day")


@query("SELECT c_nationkey, string_agg(seg, ',' ORDER BY p) AS items FROM (SELECT c_nationkey, c_mktsegment AS seg, min(c_custkey) AS p FROM customer GROUP BY ALL) GROUP BY c_nationkey")
def united_lists(v: Views) -> DataFrame:
    return stages.merged_lists(v.customer, "c_nationkey", "c_mktsegment", "c_custkey").select("c_nationkey", F.array_join("items", ",").alias("items"))


@query("SELECT event_id FROM events WHERE event_id % 4 = 0 OR ts > (SELECT to_timestamp(avg(epoch(ts))::BIGINT)::TIMESTAMP FROM events)")
def pruned_live(v: Views) -> DataFrame:
    links = v.events.select("event_id", F.when(F.col("event_id") % 4 != 0, F.unix_micros(F.col("ts").cast("timestamp"))).alias("asserted_at"))
    cut = v.events.agg((F.round(F.avg(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)).cast("long") * 1000000).alias("c")).first()[0]
    return stages.prune_live(links, F.lit(cut)).select("event_id")


@query("SELECT place_id FROM p_base ANTI JOIN (SELECT * FROM ts_flat WHERE e_in IS NOT NULL) USING (place_id)")
def without_end(v: Views) -> DataFrame:
    return v.p_base.join(v.ts_flat.where("e_in is not null"), "place_id", "left_anti").select("place_id")


@query("SELECT namespace, count(*) AS n, count(DISTINCT title) AS distinct_titles, count(*) - count(DISTINCT title) AS lost FROM p_base GROUP BY namespace")
def index_losses(v: Views) -> DataFrame:
    return v.p_base.groupBy("namespace").agg(F.count("*").alias("n"), F.count_distinct("title").alias("distinct_titles")).withColumn("lost", F.col("n") - F.col("distinct_titles"))


@query("""
WITH r AS (SELECT event_type, event_id % 97 AS s, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n FROM events),
o AS (SELECT event_type, s, row_number() OVER (PARTITION BY event_type ORDER BY s) AS p, count(*) OVER (PARTITION BY event_type) AS c FROM r WHERE n <= 5)
SELECT event_type AS stage, floor(s * 1.2)::BIGINT AS estimate FROM o WHERE p = c // 2 + 1""")
def runtime_estimates(v: Views) -> DataFrame:
    return stages.runtime_estimate(v.events.select(F.col("event_type").alias("stage"), "ts", F.col("event_id").alias("id"), (F.col("event_id") % 97).alias("seconds")))


@query("SELECT doc_id, CASE WHEN source IN ('src1', 'src2') THEN 'exempt' WHEN doc_id % 400 >= 360 THEN 'delete' WHEN doc_id % 400 >= 330 THEN 'notify' ELSE 'keep' END AS action FROM documents")
def retention(v: Views) -> DataFrame:
    status = F.when(F.col("source") == "src1", "published").when(F.col("source") == "src2", "submitted").otherwise("draft")
    return v.documents.select("doc_id", stages.retention(F.col("doc_id") % 400, status).alias("action"))


@query("SELECT user_id, bool_and(event_type <> 'error') AS passed, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY user_id")
def stage_barrier(v: Views) -> DataFrame:
    return v.events.groupBy("user_id").agg(F.bool_and(F.col("event_type") != "error").alias("passed"), F.count_if(F.col("event_type") == "error").alias("failed"))


@query("SELECT s_nationkey, s_suppkey, sum(s_suppkey % 100 + 1) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey)::BIGINT // 150 AS shard FROM supplier")
def shard_by_running_size(v: Views) -> DataFrame:
    w = W.partitionBy("s_nationkey").orderBy("s_suppkey").rowsBetween(W.unboundedPreceding, 0)
    return v.supplier.select("s_nationkey", "s_suppkey", F.floor(F.sum(F.col("s_suppkey") % 100 + 1).over(w) / 150).alias("shard"))


# Links


@query("SELECT DISTINCT place_a, place_b, relation_type, source_id FROM e_edges WHERE place_a < place_b AND source_id <> 'src1'")
def inserted_links(v: Views) -> DataFrame:
    return graph.insert_or_ignore(v.e_edges.where("source_id = 'src1'"), v.e_edges).select("place_a", "place_b", "relation_type", "source_id")


@query("""
WITH own AS (SELECT place_id FROM p_base WHERE k % 3 = 0), n AS (SELECT e.*, place_a IN (SELECT place_id FROM own) AS x, place_b IN (SELECT place_id FROM own) AS y FROM e_edges e)
SELECT place_a, place_b, relation_type, source_id, true AS inside FROM n WHERE x AND y
UNION ALL (SELECT place_a, place_b, relation_type, source_id, false FROM n WHERE (x OR y) AND NOT (x AND y) ORDER BY place_a, place_b, relation_type, source_id LIMIT 40)""")
def one_hop_edges(v: Views) -> DataFrame:
    return graph.one_hop(v.e_edges, v.p_base.where("k % 3 = 0"), 40).select("place_a", "place_b", "relation_type", "source_id", "inside")


@query("""
WITH u AS (SELECT *, 0 AS r FROM e_edges WHERE source_category = 'authority' UNION ALL SELECT *, 1 FROM e_edges)
SELECT place_a, place_b, relation_type, source_id FROM (SELECT *, row_number() OVER (PARTITION BY place_a, place_b, relation_type ORDER BY r, source_id) AS p FROM u) WHERE p = 1""")
def batch_over_live(v: Views) -> DataFrame:
    return graph.batch_over_live(v.e_edges.where("source_category = 'authority'"), v.e_edges).select("place_a", "place_b", "relation_type", "source_id")


@query("""
WITH RECURSIVE l AS (SELECT place_a AS a, place_b AS b FROM e_edges WHERE relation_type <> 'distinct' UNION SELECT place_b, place_a FROM e_edges WHERE relation_type <> 'distinct'),
r(id, c) USING KEY (id) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.a, min(r.c) FROM r JOIN l ON l.b = r.id JOIN recurring.r o ON o.id = l.a WHERE r.c < o.c GROUP BY l.a)
SELECT id AS place_id, c AS component FROM r""")
def link_components(v: Views) -> DataFrame:
    return graph.components(v.e_edges.where(F.col("relation_type").isin(graph.IDENTITY)))


@query("""
WITH s AS (SELECT (doc_id * 37 % 101) / 100.0 AS score, quality AS label FROM labels), t AS (SELECT unnest(range(1, 100)) / 100.0 AS cut),
c AS (SELECT cut, round(count(*) FILTER (score >= cut AND label = 1) / count(*) FILTER (label = 1) - count(*) FILTER (score >= cut AND label = 0) / count(*) FILTER (label = 0), 9) AS j FROM s, t GROUP BY cut)
SELECT cut::DOUBLE AS cut, j::DOUBLE AS j FROM c ORDER BY j DESC, cut LIMIT 1""")
def youden_threshold(v: Views) -> DataFrame:
    return graph.youden(v.labels.select((F.col("doc_id") * 37 % 101 / 100).alias("score"), F.col("quality").alias("label")))


# Space


@query("""
SELECT a.place_id, b.place_id AS other, round(2 * 6371 * atan2(sqrt(h), sqrt(1 - h)), 6) AS km FROM (
  SELECT a.place_id AS p, b.place_id AS o, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2) AS h
  FROM p_pt a JOIN p_pt b ON a.place_id < b.place_id) x JOIN p_pt a ON a.place_id = p JOIN p_pt b ON b.place_id = o WHERE 2 * 6371 * atan2(sqrt(h), sqrt(1 - h)) <= 60""")
def nearby_pairs(v: Views) -> DataFrame:
    return graph.pairs_within(v.p_pt.select("place_id", "lon", "lat"), 60, space.haversine_km, digits=6)


@query("SELECT place_id, (7::BIGINT << 58) + least(floor((lon + 180) / 360 * 128), 127)::BIGINT * 536870912 + least(floor((lat + 90) / 180 * 64), 63)::BIGINT AS c7, (4::BIGINT << 58) + least(floor((lon + 180) / 360 * 16), 15)::BIGINT * 536870912 + least(floor((lat + 90) / 180 * 8), 7)::BIGINT AS c4 FROM p_pt")
def cells(v: Views) -> DataFrame:
    c = space.cell(F.col("lon"), F.col("lat"), 7)
    return v.p_pt.select("place_id", c.alias("c7"), space.parent(c, 4).alias("c4"))


@query("""
WITH r AS (SELECT DISTINCT (5::BIGINT << 58) + floor((lon + 180) / 360 * 32)::BIGINT * 536870912 + floor((lat + 90) / 180 * 16)::BIGINT AS c FROM p_pt WHERE namespace = 'su')
SELECT place_id FROM p_pt WHERE namespace = 'cu' AND (5::BIGINT << 58) + floor((lon + 180) / 360 * 32)::BIGINT * 536870912 + floor((lat + 90) / 180 * 16)::BIGINT IN (SELECT c FROM r)""")
def within_region(v: Views) -> DataFrame:
    at = v.p_pt.withColumn("c", space.cell(F.col("lon"), F.col("lat"), 5))
    return at.where("namespace = 'cu'").join(at.where("namespace = 'su'").select("c").distinct(), "c", "left_semi").select("place_id")


@query("SELECT ccode, count(*) AS places, count(DISTINCT floor((lon + 180) / 360 * 32) * 100 + floor((lat + 90) / 180 * 16)) AS cells, min(lon) AS w, min(lat) AS s, max(lon) AS e, max(lat) AS n FROM p_pt WHERE ccode IS NOT NULL GROUP BY ccode")
def country_boxes(v: Views) -> DataFrame:
    at = v.p_pt.where("ccode is not null").withColumn("c", space.cell(F.col("lon"), F.col("lat"), 5))
    return at.groupBy("ccode").agg(F.count("*").alias("places"), F.count_distinct("c").alias("cells"), F.min("lon").alias("w"), F.min("lat").alias("s"), F.max("lon").alias("e"), F.max("lat").alias("n"))


@query("SELECT place_id, ccode FROM p_pt WHERE lon BETWEEN -20 AND 40 AND lat BETWEEN 0 AND 60 AND namespace IN ('cu', 'su')")
def in_box(v: Views) -> DataFrame:
    return v.p_pt.where(F.col("lon").between(-20, 40) & F.col("lat").between(0, 60) & search.in_namespaces(["cu", "su"])).select("place_id", "ccode")


@query("SELECT event_id, CASE WHEN x BETWEEN -180 AND 180 THEN x ELSE (x + 180) - floor((x + 180) / 360) * 360 - 180 END AS lon FROM (SELECT event_id, (user_id * 13 % 1500 - 700)::DOUBLE AS x FROM events)")
def wrapped_longitudes(v: Views) -> DataFrame:
    return v.events.select("event_id", space.wrap_longitude((F.col("user_id") * 13 % 1500 - 700).cast("double")).alias("lon"))


@query("SELECT place_id, floor((lon + 180) / 360 * 256)::BIGINT AS x, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 256)::BIGINT AS y FROM p_pt WHERE k % 5 <> 0")
def tiles(v: Views) -> DataFrame:
    x, y = space.tile(F.col("lon"), F.col("lat"), 8)
    return v.p_pt.where("k % 5 <> 0").select("place_id", x.alias("x"), y.alias("y"))


@query("SELECT place_id, floor((lon + 180) / 360 * 256)::BIGINT AS x, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 256)::BIGINT AS y FROM p_pt")
def tiles_of_all(v: Views) -> DataFrame:
    x, y = space.tile(F.col("lon"), F.col("lat"), 8)
    return v.p_pt.select("place_id", x.alias("x"), y.alias("y"))


@query("""
WITH d AS (SELECT q.place_id, t.ccode, t.place_id AS o, (q.lon - t.lon) * (q.lon - t.lon) + (q.lat - t.lat) * (q.lat - t.lat) AS d FROM p_pt q JOIN p_pt t ON t.namespace = 'su' AND q.namespace = 'pa' AND q.k <= 60)
SELECT place_id, ccode, d FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY d, o) AS r FROM d) WHERE r <= 3""")
def nearest_labelled(v: Views) -> DataFrame:
    # A stated query set against all labelled points, in a broadcast of the few queries.
    q = v.p_pt.where("namespace = 'pa' and k <= 60").select("place_id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    t = v.p_pt.where("namespace = 'su'").select(F.col("place_id").alias("o"), "ccode", "lon", "lat")
    d = t.crossJoin(F.broadcast(q)).withColumn("d", (F.col("x") - F.col("lon")) * (F.col("x") - F.col("lon")) + (F.col("y") - F.col("lat")) * (F.col("y") - F.col("lat")))
    return search.top_per_group(d, ["place_id"], [F.col("d"), F.col("o")], 3).select("place_id", "ccode", "d")


# Text, types, vectors


@query("SELECT toponym_id, name, CASE WHEN lang = 'und' THEN NULL ELSE lang END AS lang FROM (SELECT DISTINCT toponym_id, name, lang FROM t_att)")
def parsed_toponyms(v: Views) -> DataFrame:
    name, lang = text.toponym_parts(F.col("toponym_id"))
    return v.t_att.select("toponym_id").distinct().select("toponym_id", name.alias("name"), lang.alias("lang"))


@query("SELECT doc_id, CASE WHEN b < 800 THEN 'train' WHEN b < 900 THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, ('0x' || md5(doc_id::VARCHAR)[1:8])::BIGINT % 1000 AS b FROM documents)")
def md5_split(v: Views) -> DataFrame:
    return v.documents.select("doc_id", text.split_of(F.col("doc_id").cast("string")).alias("split"))


@query("""
WITH n AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)
SELECT a, b, round(CASE WHEN least(length(a), length(b)) = 0 THEN 0.0 WHEN a = b THEN 1.0 WHEN (greatest(length(a), length(b)) - least(length(a), length(b))) / greatest(length(a), length(b)) > 0.65 THEN 0.0
  WHEN least(length(a), length(b)) >= 3 AND (contains(a, b) OR contains(b, a)) THEN 0.85 ELSE 1 - levenshtein(a, b) / greatest(length(a), length(b)) END::DOUBLE, 9) AS similarity FROM n""")
def name_similarity(v: Views) -> DataFrame:
    n = v.part.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("a"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("b")).distinct()
    return n.select("a", "b", F.round(text.phonetic_similarity(F.col("a"), F.col("b")), 9).alias("similarity"))


@query("SELECT gram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, length(p_name) - 1), lambda i: p_name[i:i + 2])) AS gram FROM part) GROUP BY gram")
def trigram_counts(v: Views) -> DataFrame:
    return v.part.select(F.explode(text.ngrams(F.col("p_name"), 3)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


@query("SELECT c, count(*) AS n, dense_rank() OVER (ORDER BY c) AS id FROM (SELECT unnest(string_split(lower(p_name), '')) AS c FROM part) GROUP BY c")
def character_vocabulary(v: Views) -> DataFrame:
    n = v.part.select(F.explode(F.split(F.lower("p_name"), "")).alias("c")).groupBy("c").agg(F.count("*").alias("n"))
    return n.withColumn("id", F.dense_rank().over(W.orderBy("c")).cast("long"))  # of the alphabet, which is small


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def script_language_counts(v: Views) -> DataFrame:
    return v.documents.groupBy("lang", "source").agg(F.count("*").alias("n"))


@query("""
WITH x AS (SELECT DISTINCT path, string_split(path, '.') AS s FROM x_path), p AS (SELECT a.path AS a, b.path AS b, CASE WHEN a.s[1] <> b.s[1] THEN 0 WHEN a.s[2] <> b.s[2] THEN 1 WHEN a.s[3] <> b.s[3] THEN 2 ELSE 3 END AS n, a.s[1] AS g FROM x a JOIN x b ON a.s[1] = b.s[1] AND a.path < b.path)
SELECT a, b, round(2 * n / 6, 9)::DOUBLE AS similarity FROM p""")
def type_similarity(v: Views) -> DataFrame:
    x = v.x_path.select("path").distinct().withColumn("g", F.split_part("path", F.lit("."), F.lit(1)))
    y = x.select("g", F.col("path").alias("b"))
    return x.join(y, "g").where("path < b").select(F.col("path").alias("a"), "b", F.round(types.wu_palmer(F.col("path"), F.col("b")), 9).alias("similarity"))


@query("""
WITH n AS (SELECT DISTINCT unnest([string_split(path, '.')[1], array_to_string(string_split(path, '.')[1:2], '.'), path]) AS node FROM x_path)
SELECT node, len(string_split(node, '.')) AS depth, (SELECT count(DISTINCT path) FROM x_path WHERE path = node OR starts_with(path, node || '.')) AS leaves FROM n""")
def type_tree(v: Views) -> DataFrame:
    node = v.x_path.select("path").distinct().select("path", F.explode(types.ancestors(F.col("path"))).alias("node"))
    return node.groupBy("node").agg(F.count("*").alias("leaves")).select("node", F.size(F.split("node", r"\.")).cast("long").alias("depth"), "leaves")


@query("SELECT vec_id, array_to_string(list_transform(embedding, lambda x: greatest(-128, least(127, round_even(x::DOUBLE * 127, 0)))::INT), ',') AS q FROM embeddings")
def quantised(v: Views) -> DataFrame:
    return v.embeddings.select("vec_id", F.array_join(vectors.quantise(F.col("embedding")), ",").alias("q"))


@query("""
WITH s AS (SELECT q.vec_id AS query, v.vec_id, round(list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) / sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) / sqrt(list_dot_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[])), 9) AS score
  FROM embeddings q JOIN embeddings v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id)
SELECT query, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5""")
def nearest_vectors(v: Views) -> DataFrame:
    # A stated query set against all vectors, in blocks.
    e = v.embeddings.select(F.col("vec_id").alias("id"), F.lit(0).alias("label"), F.col("embedding").alias("e"))
    return knn.nearest(e.where("id % 50 = 0"), e, 5).select("query", F.col("id").alias("vec_id"), "score")


@query("""
WITH s AS (SELECT q.vec_id AS query, v.vec_id, round(list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) / sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) / sqrt(list_dot_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[])), 9) AS score
  FROM embeddings q JOIN embeddings v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND v.label = 3)
SELECT query, vec_id, round((1 + score) / 2, 8) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS r FROM s WHERE score >= 0.4) WHERE r <= 200""")
def filtered_neighbours(v: Views) -> DataFrame:
    e = v.embeddings.select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("e"))
    near = knn.nearest(e.where("id % 50 = 0"), e.where("label = 3"), 200, 0.4)
    return near.select("query", F.col("id").alias("vec_id"), F.round((1 + F.col("score")) / 2, 8).alias("score"))


@query("""
WITH x AS (SELECT DISTINCT path, string_split(path, '.') AS s FROM x_path)
SELECT a.path AS a, b.path AS b, round(4 / 6.0, 9)::DOUBLE AS similarity FROM x a JOIN x b ON a.s[1] = b.s[1] AND a.s[2] = b.s[2] AND a.path < b.path""")
def similar_types(v: Views) -> DataFrame:
    # Paths that share two of their three segments; those that share one only are not alike enough.
    x = v.x_path.select("path").distinct().withColumn("g", F.substring_index("path", ".", 2))
    y = x.select("g", F.col("path").alias("b"))
    return x.join(y, "g").where("path < b").select(F.col("path").alias("a"), "b", F.round(types.wu_palmer(F.col("path"), F.col("b")), 9).alias("similarity"))


@query("""
WITH RECURSIVE b AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
SELECT vec_id, round(list_sum(list_transform(e[1:8], lambda x: x)) / 8, 6) AS first_bin, round(list_sum(list_transform(e[57:64], lambda x: x)) / 8, 6) AS last_bin, round(e[1] * 127 / 127, 2) AS back FROM b""")
def pooled_vectors(v: Views) -> DataFrame:
    rows = F.transform("embedding", lambda x: F.array(x.cast("double")))
    pooled = vectors.pooled(rows, 8, 1)
    back = vectors.dequantise(vectors.quantise(F.col("embedding")))
    near = F.when(F.abs(back[0] - F.col("embedding")[0]) < 0.004, F.round(F.col("embedding")[0].cast("double"), 2))
    return v.embeddings.select("vec_id", F.round(pooled[0], 6).alias("first_bin"), F.round(pooled[7], 6).alias("last_bin"), near.alias("back"))


# Labels, logs and windows


@query(r"""
WITH t AS (SELECT conv_id, turn, trim(text[1:12]) AS h, trim(CASE turn % 5 WHEN 0 THEN text[1:12] WHEN 1 THEN text[1:8] WHEN 2 THEN text[1:11] || 'x' WHEN 3 THEN '' ELSE text[5:25] END) AS v FROM conversations),
r AS (SELECT *, CASE WHEN v = '' THEN 'vlm-empty' WHEN h = '' THEN 'no-hint' WHEN regexp_matches(upper(h), '^(X+|\?+|-+|\.+)$') THEN 'resolved-illegible' WHEN lower(h) = lower(v) THEN 'match' WHEN contains(lower(h), lower(v)) THEN 'vlm-truncated' WHEN contains(lower(v), lower(h)) THEN 'vlm-overread'
  WHEN levenshtein(lower(h), lower(v)) <= 1 AND abs(length(h) - length(v)) <= 1 THEN 'correction' ELSE 'divergent' END AS rule FROM t)
SELECT conv_id, turn, rule, CASE WHEN rule IN ('no-hint', 'resolved-illegible', 'correction') THEN v ELSE h END AS reading FROM r WHERE regexp_matches(h, '^[ -~\n]*$') AND regexp_matches(v, '^[ -~\n]*$')""")
def reconciled_labels(v: Views) -> DataFrame:
    h, k = F.trim(F.substring("text", 1, 12)), F.col("turn") % 5
    o = F.trim(F.when(k == 0, F.substring("text", 1, 12)).when(k == 1, F.substring("text", 1, 8)).when(k == 2, F.concat(F.substring("text", 1, 11), F.lit("x"))).when(k == 3, "").otherwise(F.substring("text", 5, 21)))
    out = v.conversations.where(h.rlike(r"^[ -~\n]*$") & o.rlike(r"^[ -~\n]*$")).select("conv_id", "turn", stages.two_readings(h, o).alias("r"))
    return out.select("conv_id", "turn", F.col("r.rule").alias("rule"), F.col("r.text").alias("reading"))


@query()
def reconciled_turns(v: Views) -> DataFrame:
    # Whole texts of every turn, with any characters. No twin: DuckDB's levenshtein counts bytes.
    h, k = F.trim("text"), F.col("turn") % 5
    o = F.trim(F.when(k == 0, F.col("text")).when(k == 1, F.expr("substring(text, 1, length(text) - 4)")).when(k == 2, F.concat(F.expr("substring(text, 1, length(text) - 1)"), F.lit("x"))).when(k == 3, "").otherwise(F.expr("substring(text, 5)")))
    out = v.conversations.select("conv_id", "turn", stages.two_readings(h, o).alias("r"))
    return out.select("conv_id", "turn", F.col("r.rule").alias("rule"), F.col("r.text").alias("reading"))


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def hourly_windows(v: Views) -> DataFrame:
    return v.events.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select("event_type", F.col("w.start").alias("hour"), "n", "total")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM g)
SELECT user_id, min(ts) AS started, count(*) AS n FROM s GROUP BY user_id, s.n""")
def sessions(v: Views) -> DataFrame:
    return v.events.groupBy("user_id", F.session_window("ts", "2 hours").alias("w")).agg(F.min("ts").alias("started"), F.count("*").alias("n")).select("user_id", "started", "n")


@query("SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def parsed_props(v: Views) -> DataFrame:
    return v.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(r"SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '([^/]*)$', 1) AS tail FROM pages")
def page_hosts(v: Views) -> DataFrame:
    return v.pages.select("page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"), F.regexp_extract("url", r"([^/]*)$", 1).alias("tail"))
