"""Queries of type hierarchies: a polyhierarchy of regions, nations and suppliers, and the paths of parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels, types
from ..operators import search, tree
from .queries import query
from .views import Views

_LINKS = """
links AS (SELECT 100 + n_nationkey AS child, 10 + n_regionkey AS parent FROM nation UNION SELECT 1000 + s_suppkey, 100 + s_nationkey FROM supplier
  UNION SELECT 1000 + s_suppkey, 100 + (s_suppkey * 7) % 25 FROM supplier UNION SELECT 1000 + s_suppkey, 1000 + (s_suppkey // 2) FROM supplier WHERE s_suppkey % 4 = 1 AND s_suppkey > 1 UNION SELECT 10, 1001)"""


def links(v: Views) -> DataFrame:
    n = v.nation.selectExpr("100L + n_nationkey child", "10L + n_regionkey parent")
    s = v.supplier.selectExpr("1000L + s_suppkey child", "100L + s_nationkey parent").union(v.supplier.selectExpr("1000L + s_suppkey", "100L + (s_suppkey * 7) % 25"))
    s = s.union(v.supplier.where("s_suppkey % 4 = 1 and s_suppkey > 1").selectExpr("1000L + s_suppkey", "1000L + (s_suppkey div 2)"))
    return n.union(s).union(v.region.limit(1).selectExpr("10L", "1001L")).distinct()


_WALK = _LINKS + """,
w(node, key, depth) AS (SELECT n, [n - 10, n], 0 FROM (SELECT unnest([10, 11, 12]) AS n)
  UNION ALL SELECT child, list_append(key, child), depth + 1 FROM w JOIN links ON parent = node WHERE child NOT IN (103, 1004) AND NOT list_contains(key, child) AND depth < 8),
best AS (SELECT node, depth, arg_min(key, list_concat([depth], key)) AS key FROM w WHERE (node, depth) IN (SELECT node, min(depth) FROM w GROUP BY node) GROUP BY node, depth)"""


@query(f"WITH RECURSIVE {_WALK} SELECT node, array_to_string(key[2:], '.') AS path, depth FROM best")
def walked_types(v: Views) -> DataFrame:
    return tree.walk(links(v), [10, 11, 12], [103, 1004]).select("node", "path", "depth")


_UP = _LINKS + """,
up(node, ancestor, hops) AS (SELECT child, child, 0 FROM links UNION SELECT parent, parent, 0 FROM links UNION SELECT node, parent, hops + 1 FROM up JOIN links ON child = ancestor WHERE hops < 12),
near AS (SELECT node, ancestor, min(hops) AS hops FROM up GROUP BY ALL)"""


@query(f"""WITH RECURSIVE {_UP}, c AS (SELECT * FROM (VALUES (10, 'A'), (101, 'P'), (105, 'S'), (110, 'H'), (12, 'L')) t(ancestor, class))
SELECT node, string_agg(DISTINCT class, ',' ORDER BY class) AS classes FROM near JOIN c USING (ancestor) GROUP BY node""")
def inherited_classes(v: Views) -> DataFrame:
    given = v.spark.createDataFrame([(10, "A"), (101, "P"), (105, "S"), (110, "H"), (12, "L")], "node long, class string")
    return tree.inherited(links(v), given).select("node", F.array_join("classes", ",").alias("classes"))


@query(f"""WITH RECURSIVE {_UP}, m AS (SELECT 10 + r_regionkey AS ancestor, r_name AS target FROM region UNION ALL SELECT 100 + n_nationkey, n_name FROM nation WHERE n_nationkey % 3 = 0)
SELECT node, arg_min(target, hops * 100000 + ancestor) AS target, min(hops) AS hops FROM near JOIN m USING (ancestor) WHERE hops BETWEEN 1 AND 3 GROUP BY node""")
def nearest_mapped_types(v: Views) -> DataFrame:
    mapped = v.region.selectExpr("10L + r_regionkey node", "r_name target").union(v.nation.where("n_nationkey % 3 = 0").selectExpr("100L + n_nationkey", "n_name"))
    return tree.nearest_mapped(links(v), mapped, 3)


_NODES = "nodes AS (SELECT node, path, depth, 'type ' || node || CASE WHEN node % 5 = 0 THEN ' <old>' ELSE '' END AS term, node % 4 <> 3 AS is_place_type FROM (SELECT node, array_to_string(key[2:], '.') AS path, depth FROM best))"


def nodes(v: Views) -> DataFrame:
    w = tree.walk(links(v), [10, 11, 12], [103, 1004])
    return w.select("node", "path", "depth", F.concat(F.lit("type "), F.col("node").cast("string"), F.when(F.col("node") % 5 == 0, " <old>").otherwise("")).alias("term"), (F.col("node") % 4 != 3).alias("is_place_type"))


@query(f"""WITH RECURSIVE {_WALK}, {_NODES}
SELECT node, term FROM nodes WHERE starts_with(path, '11.') AND is_place_type AND node NOT IN (101, 108) AND (depth = 1 AND node <> 102 OR depth = 2 AND starts_with(path, '11.102.'))""")
def children_shown(v: Views) -> DataFrame:
    return tree.children_shown(nodes(v), "11", [102], [101, 108]).select("node", "term")


@query(r"""WITH t AS (SELECT DISTINCT p_type AS term FROM part UNION SELECT '<' || p_type || '>' FROM part UNION SELECT 'aat:300' FROM part)
SELECT term FROM t WHERE list_contains(regexp_extract_all(lower(term), '[a-z0-9]+'), 'economy') AND NOT starts_with(term, '<')""")
def found_labels(v: Views) -> DataFrame:
    t = v.part.select(F.col("p_type").alias("term")).distinct()
    both = t.union(t.select(F.concat(F.lit("<"), "term", F.lit(">")))).union(t.select(F.lit("aat:300")).distinct())
    return tree.find_labels(both, ["economy"]).select("term")


@query("""SELECT DISTINCT term FROM (SELECT CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE upper(p_type) END AS term FROM part) WHERE strip_accents(lower(term)) = 'economy brass' OR strip_accents(lower(term)) = (SELECT lower(min(p_type)) FROM part)""")
def terms_by_label(v: Views) -> DataFrame:
    names = v.part.select(F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.upper("p_type")).alias("name")).distinct()
    asked = v.part.agg(F.min("p_type").alias("asked"))
    return search.by_label(names, asked).select(F.col("name").alias("term")).distinct()


@query("""
SELECT place_id, CASE WHEN k % 3 = 0 THEN '300' || (k % 7) WHEN type_identifier IN ('BUILDING', 'MACHINERY') THEN '3005' WHEN namespace = 'su' THEN '3001' ELSE '' END AS concepts FROM p_base WHERE NOT (k % 3 = 0 AND k % 7 = 6)
UNION ALL SELECT place_id, '' FROM p_base WHERE k % 3 = 0 AND k % 7 = 6""")
def enriched_types(v: Views) -> DataFrame:
    as_map = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv))
    own = F.when(F.col("k") % 3 == 0, F.concat(F.lit("aat:300"), (F.col("k") % 7).cast("string"))).otherwise(F.col("type_identifier"))
    kinds = F.array(F.struct(own.alias("identifier"), F.when(F.col("k") % 3 == 0, "-").otherwise(F.upper("type_label")).alias("label")))
    hierarchy = as_map({3000 + i: f"1.{i}" for i in range(6)})
    ids = tree.enriched_types(kinds, as_map({"BUILDING": 3005, "MACHINERY": 3005, "AUTOMOBILE": 9999}), hierarchy, as_map({"su": 3001, "pa": 8888}))
    return v.p_base.select("place_id", F.array_join(ids.cast("array<string>"), ",").alias("concepts"))


@query("SELECT place_id, ';' || string_agg(s, ';' ORDER BY s) || ';' AS types FROM (SELECT DISTINCT place_id, unnest(string_split(path || '.' || 'top', '.')) AS s FROM x_path) GROUP BY place_id")
def tile_types(v: Views) -> DataFrame:
    return v.x_path.select("place_id", tree.tile_types(F.array("path", F.lit("top"))).alias("types"))


@query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'inhabited places' WHEN 1 THEN event_type ELSE 'other' END AS label, CASE event_id % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'broad' ELSE 'none' END AS confidence FROM events""")
def legacy_labels(v: Views) -> DataFrame:
    k = F.col("event_id") % 3
    given = F.when(k == 0, " Inhabited Places [N] ").when(k == 1, F.col("event_type")).otherwise("??")
    known = F.create_map(F.lit("inhabited places"), F.lit("exact"), *(F.lit(x) for t in ("click", "error", "purchase", "signup", "view") for x in (t, "broad")))
    return v.events.select("event_id", types.legacy_label(given, known).alias("x")).select("event_id", "x.label", "x.confidence")


@query("SELECT type_label AS vocabulary, count(*) AS terms, count(*) FILTER (WHERE k % 3 = 0) AS mapped, round(count(*) FILTER (WHERE k % 3 = 0) / count(*)::DOUBLE, 6) AS share FROM p_base GROUP BY type_label")
def mapping_report(v: Views) -> DataFrame:
    return types.mapping_report(v.p_base, "type_label", F.col("k") % 3 == 0).withColumnRenamed("type_label", "vocabulary")


@query("SELECT type_identifier AS term, count(*) AS n FROM p_base WHERE namespace = 'pa' GROUP BY type_identifier")
def vocabulary_counts(v: Views) -> DataFrame:
    docs = v.p_base.select("namespace", F.array(F.struct(F.col("type_identifier").alias("identifier"))).alias("types"))
    return types.vocabulary_counts(docs.where("namespace = 'pa'"), "types", "identifier")


@query("""
WITH a AS (SELECT 3000 + k % 40 AS concept, count(*) AS n FROM p_base WHERE namespace = 'pa' GROUP BY ALL), x AS (SELECT 3000 + s_suppkey % 30 AS concept, max(s_name) AS label FROM supplier GROUP BY ALL)
SELECT a.concept, n, coalesce(label, 'aat:' || a.concept) AS label FROM a LEFT JOIN x USING (concept) ORDER BY n DESC, a.concept LIMIT 60""")
def concept_facet(v: Views) -> DataFrame:
    docs = v.p_base.where("namespace = 'pa'").select(F.explode(F.array(3000 + F.col("k") % 40)).alias("concept"))
    named = v.supplier.groupBy((3000 + F.col("s_suppkey") % 30).alias("concept")).agg(F.max("s_name").alias("label"))
    top = search.facet(docs, "concept", 60)
    return top.join(named, "concept", "left").withColumn("label", F.coalesce("label", F.concat(F.lit("aat:"), F.col("concept").cast("string"))))


@query("SELECT type_identifier, count(*) AS n FROM p_base WHERE k % 3 > 0 GROUP BY type_identifier ORDER BY n DESC, type_identifier LIMIT 50")
def custom_facet(v: Views) -> DataFrame:
    kinds = F.array(F.struct("type_identifier", F.when(F.col("k") % 3 == 0, F.array(F.lit(3000))).otherwise(F.array().cast("array<int>")).alias("aat_ids")))
    own = v.p_base.select(F.explode(F.filter(kinds, lambda t: F.size(t["aat_ids"]) == 0)).alias("t")).select("t.type_identifier")
    return search.facet(own, "type_identifier", 50)
