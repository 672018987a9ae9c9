"""Queries of readers, writers and streams, over lines and files made from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import graph, knn
from ..sources import readers, writers
from ..streaming import incremental
from .queries import query
from .views import Views


def tsv(rows: DataFrame, *fields) -> DataFrame:
    """Tab-separated lines; nulls are empty."""
    return rows.select(F.concat_ws("\t", *(F.coalesce((F.lit(f) if isinstance(f, (int, str)) else f).cast("string"), F.lit("")) for f in fields)).alias("value"))


# Readers


@query("""
SELECT 'gn:' || k AS place_id, title, title || '@und' AS toponym, CASE WHEN k % 2 = 0 THEN 'GB,FR,DE' ELSE 'GB' END AS ccodes, lon, lat, CASE WHEN k % 3 = 0 THEN 'P' ELSE 'PPL' END AS identifier,
  CASE WHEN k % 3 = 0 THEN 'P' ELSE 'P.PPL' END AS source_label, CASE WHEN k % 4 = 0 THEN 12 ELSE k END AS elevation, CASE WHEN k % 5 <> 0 THEN k * 10 END AS population FROM p_pt WHERE namespace = 'su'""")
def places_of_lines(v: Views) -> DataFrame:
    k = F.col("k")
    lines = tsv(
        v.p_pt.where("namespace = 'su'"), k, F.col("title"), "", "", F.col("lat"), F.col("lon"), "P", F.when(k % 3 != 0, "PPL"), "GB", F.when(k % 2 == 0, "FR, DE,"), "", "", "", "",
        F.when(k % 5 != 0, k * 10), F.when(k % 4 != 0, k), 12, "", "",
    )
    kind = F.col("types")[0]
    return readers.geonames_places(lines).select(
        "place_id", "title", F.array_join("toponyms", ",").alias("toponym"), F.array_join("ccodes", ",").alias("ccodes"), "lon", "lat", kind["identifier"].alias("identifier"), kind["sourceLabel"].alias("source_label"), "elevation", "population"
    )


@query("""
WITH e AS (SELECT *, event_type || (event_id % 3) AS name FROM events), n AS (SELECT user_id, name, min(event_id) AS first_id FROM e WHERE event_type IN ('click', 'view', 'signup') GROUP BY ALL),
r AS (SELECT user_id, 'wd:Q' || event_id AS r, event_id AS first_id FROM events WHERE event_type = 'purchase')
SELECT 'gn:' || u.user_id AS place_id, (SELECT arg_min(name, first_id) FROM n WHERE n.user_id = u.user_id AND name LIKE 'signup%') AS title,
  coalesce((SELECT string_agg(name || '@' || CASE WHEN name LIKE 'click%' THEN 'zh-min' ELSE 'und' END || ':' || coalesce((1900 + first_id % 50)::VARCHAR, ''), ',' ORDER BY first_id) FROM n WHERE n.user_id = u.user_id), '') AS names,
  coalesce((SELECT string_agg(r, ',' ORDER BY first_id) FROM r WHERE r.user_id = u.user_id), '') AS relations
FROM (SELECT DISTINCT user_id FROM events WHERE event_type <> 'error') u""")
def names_of_lines(v: Views) -> DataFrame:
    kind, n = F.col("event_type"), F.col("event_id")
    lang = F.when(kind == "error", "iata").when(kind == "purchase", "wkdt").when(kind == "click", "zh_min")
    value = F.when(kind == "purchase", F.concat(F.lit("Q"), n.cast("string"))).otherwise(F.concat(kind, (n % 3).cast("string")))
    lines = tsv(v.events, n, F.col("user_id"), lang, value, F.when(kind == "signup", "1"), "", "", "", 1900 + n % 50, "")
    names = F.transform("toponyms_to_add", lambda t: F.concat(t["toponym_id"], F.lit(":"), F.coalesce(t["timespans"][0]["start"]["in"].cast("string"), F.lit(""))))
    return readers.geonames_names(lines).select("place_id", "title", F.array_join(names, ",").alias("names"), F.array_join(F.col("relations_to_add.related_place_id"), ",").alias("relations"))


@query("SELECT 'http://p/' || p_partkey AS subject, p_name || ' \"é' AS label, 'en' AS lang FROM part")
def two_hop_labels(v: Views) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    terms = v.part.select(F.concat(F.lit("<http://p/"), key, F.lit("> <http://x/term> <http://t/"), key, F.lit("> .")).alias("value"))
    labels = v.part.select(F.concat(F.lit("<http://t/"), key, F.lit('> <http://x/literal> "'), F.col("p_name"), F.lit(' \\"\\u00e9"@en .')).alias("value"))
    return readers.two_hop_labels(readers.ntriples(terms.unionByName(labels)), "http://x/term", "http://x/literal")


# Writers


@query("SELECT place_id, CASE WHEN k % 2 = 0 THEN 'draft' ELSE 'published' END AS dataset_status, CASE WHEN k % 3 = 0 THEN 'own' ELSE namespace END AS dataset_id FROM p_base")
def staged_defaults(v: Views) -> DataFrame:
    docs = v.p_base.withColumn("dataset_status", F.expr("case when k % 2 = 0 then 'draft' end")).withColumn("dataset_id", F.expr("case when k % 3 = 0 then 'own' end"))
    return writers.with_dataset(docs).select("place_id", "dataset_status", "dataset_id")


@query("SELECT place_id, CASE WHEN namespace <> 'su' OR k % 3 = 0 THEN ccode WHEN k % 3 = 1 THEN 'XX' END AS ccodes FROM p_base")
def patched_lists(v: Views) -> DataFrame:
    docs = v.p_base.withColumn("ccodes", F.expr("case when ccode is not null then array(ccode) end"))
    patch = v.p_base.where("namespace = 'su' and k % 3 > 0").select("place_id", F.expr("case when k % 3 = 1 then array('XX') else array() end").cast("array<string>").alias("ccodes"))
    return writers.apply_list_patch(docs, patch, "place_id", "ccodes").select("place_id", F.array_join("ccodes", ",").alias("ccodes"))


@query("""
SELECT place_id, CASE WHEN abs(lat * 1.5) <= 90 THEN CASE WHEN lon * 2 >= 180 THEN lon * 2 - 360 WHEN lon * 2 < -180 THEN lon * 2 + 360 ELSE lon * 2 END END AS lon, CASE WHEN abs(lat * 1.5) <= 90 THEN lat * 1.5 END AS lat
FROM p_pt WHERE abs(lat * 1.5) > 90 OR lon * 2 >= 180 OR lon * 2 < -180""")
def repaired_points(v: Views) -> DataFrame:
    out, changed = writers.repair_points(v.p_pt.select("place_id", (F.col("lon") * 2).alias("lon"), (F.col("lat") * 1.5).alias("lat")))
    return out.where(changed).select("place_id", "lon", "lat")


@query("SELECT namespace, count(*) AS n_rows, sum(('0x' || substr(md5(concat_ws('|', place_id, coalesce(title, ''), coalesce(ccode, ''))), 1, 8))::BIGINT)::BIGINT AS digest FROM p_base GROUP BY namespace")
def snapshot_manifest(v: Views) -> DataFrame:
    return writers.manifest(v.p_base, "namespace", ["place_id", "title", "ccode"])


# Streams


@query("""
SELECT strftime(time_bucket(INTERVAL 1 hour, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events
WHERE time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour <= (SELECT max(ts) FROM events) - INTERVAL 2 hour GROUP BY ALL""")
def streamed_windows(v: Views) -> DataFrame:
    stream = incremental.events_stream(v.spark, v.path("event[s]")).select("ts", "event_type")
    log = incremental.run_available(incremental.windows(stream, "ts", "1 hour", "2 hours", "event_type"), incremental.shared_folder(v.spark, "windows"))
    return log.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


@query("""
SELECT place_a, place_b, event_id FROM (SELECT least(user_id, event_id % 50) AS place_a, greatest(user_id, event_id % 50) AS place_b, max(event_id) AS event_id, arg_max(event_type, event_id) AS op
FROM events WHERE user_id <> event_id % 50 GROUP BY ALL) WHERE op <> 'error'""")
def streamed_links(v: Views) -> DataFrame:
    stream = incremental.events_stream(v.spark, v.path("event[s]")).select("event_id", "user_id", (F.col("event_id") % 50).alias("other"), F.when(F.col("event_type") == "error", "revoke").otherwise("assert").alias("op"))
    log = incremental.run_available(incremental.assertions(stream, "user_id", "other").select("place_a", "place_b", "event_id", "op"), incremental.shared_folder(v.spark, "links"))
    return incremental.live(log, ["place_a", "place_b"], "event_id").select("place_a", "place_b", "event_id")


# Joins, sets and bins


@query("SELECT place_id FROM p_base WHERE namespace = 'cu' AND EXISTS (SELECT 1 FROM orders WHERE concat('cu:', o_custkey) = place_id AND o_orderpriority = '1-URGENT')")
def attested_by_urgent(v: Views) -> DataFrame:
    urgent = v.orders.where("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("cu:"), F.col("o_custkey").cast("string")).alias("place_id"))
    return v.p_base.where("namespace = 'cu'").join(urgent, "place_id", "left_semi").select("place_id")


@query("""
WITH c AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT doc_id, lang, copy FROM c, unnest(generate_series(1, least(3, greatest(1, ceil(60.0 / n)::INT)))) t(copy) WHERE n >= 5 AND r <= 60""")
def balanced_bins(v: Views) -> DataFrame:
    counts = v.documents.groupBy(F.col("lang").alias("bin")).agg(F.count("*").alias("n")).where("n >= 5")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id"))
    kept = v.documents.select("doc_id", "lang").withColumn("r", rank).where("r <= 60")
    sized = kept.join(counts, F.col("lang").eqNullSafe(F.col("bin")))
    return sized.select("doc_id", "lang", F.explode(F.sequence(F.lit(1), F.least(F.lit(3), F.greatest(F.lit(1), F.ceil(60 / F.col("n")).cast("int"))))).alias("copy"))


@query("""
WITH q AS (SELECT vec_id AS q, label AS ql, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT q, ql, label, row_number() OVER (PARTITION BY q ORDER BY list_dot_product(qe::DOUBLE[], embedding::DOUBLE[]) DESC, vec_id) AS r FROM q, embeddings WHERE vec_id <> q),
f AS (SELECT q.q, min(r) FILTER (WHERE label = s.ql) AS r FROM q LEFT JOIN s USING (q) GROUP BY q.q)
SELECT count(*) AS n, count(*) FILTER (WHERE r <= 1) AS at_1, count(*) FILTER (WHERE r <= 5) AS at_5, count(*) FILTER (WHERE r <= 10) AS at_10, round(avg(coalesce(1.0 / r, 0)), 9) AS mrr FROM f""")
def retrieval_metrics(v: Views) -> DataFrame:
    e = v.embeddings.select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("e"))
    return knn.retrieval(knn.first_right(e.where("id % 50 = 0"), e)).select("n", "at_1", "at_5", "at_10", "mrr")


@query("""
WITH q AS (SELECT vec_id AS q, label AS ql, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT q, ql, label, row_number() OVER (PARTITION BY q ORDER BY list_dot_product(qe::DOUBLE[], embedding::DOUBLE[]) DESC, vec_id) AS r FROM q, embeddings WHERE vec_id <> q),
f AS (SELECT q.q, min(r) FILTER (WHERE label = s.ql) AS r FROM q LEFT JOIN s USING (q) GROUP BY q.q)
SELECT q AS query, r AS rank FROM f""")
def first_right_ranks(v: Views) -> DataFrame:
    e = v.embeddings.select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("e"))
    return knn.first_right(e.where("id % 50 = 0"), e)


@query("""
WITH s AS (SELECT doc_id, (doc_id * 37 % 101) / 100.0 AS score, quality AS label FROM labels), t AS (SELECT unnest([0.25, 0.5, 0.75]) AS cut),
c AS (SELECT cut, count(*) FILTER (score >= cut AND label = 1) AS tp, count(*) FILTER (score >= cut) AS found, count(*) FILTER (label = 1) AS good FROM s, t GROUP BY cut)
SELECT cut::DOUBLE AS cut, round(tp / found, 9)::DOUBLE AS precision, round(tp / good, 9)::DOUBLE AS recall, round(2 * tp / (found + good), 9)::DOUBLE AS f1, round(26 * tp / (found + 25 * good), 9)::DOUBLE AS f5 FROM c""")
def threshold_metrics(v: Views) -> DataFrame:
    scores = v.labels.select((F.col("doc_id") * 37 % 101 / 100).alias("score"), F.col("quality").alias("label"))
    return graph.at_thresholds(scores, [0.25, 0.5, 0.75])
