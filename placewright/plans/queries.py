"""Queries over the test tables, each with its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import temporal, text
from ..operators import search
from ..operators.distinct import FEW, MANY, listed, ordered_pairs
from .views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of Views under its name, with its SQL."""

    def add(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return add


def spans(v: Views) -> DataFrame:
    return v.ts_flat.withColumn("span", temporal.span(*(F.col(f"{e}_{b}") for e in "se" for b in temporal.BOUNDS)))


# Time


@query("SELECT place_id FROM ts_flat WHERE coalesce(coalesce(s_earliest, s_in) <= 1999, true) AND coalesce(coalesce(e_latest, e_in) >= 1997, true)")
def window_possibly(v: Views) -> DataFrame:
    return spans(v).where(temporal.possibly(F.col("span"), 1997, 1999)).select("place_id")


@query("SELECT place_id FROM ts_flat WHERE coalesce(coalesce(s_latest, s_in) <= 1996, false) AND coalesce(coalesce(e_earliest, e_in) >= 1995, false)")
def window_definitely(v: Views) -> DataFrame:
    return spans(v).where(temporal.definitely(F.col("span"), 1995, 1996)).select("place_id")


@query("SELECT namespace, count(*) AS n, count(t.place_id) AS dated FROM p_base p LEFT JOIN ts_flat t ON p.place_id = t.place_id AND coalesce(s_in, s_earliest, s_latest, e_in, e_earliest, e_latest) IS NOT NULL GROUP BY namespace")
def undated_places(v: Views) -> DataFrame:
    dated = spans(v).where(~temporal.undated(F.col("span"))).select("place_id", F.lit(1).alias("d"))
    return v.p_base.join(dated, "place_id", "left").groupBy("namespace").agg(F.count("*").alias("n"), F.count("d").alias("dated"))


@query("SELECT event_id, greatest(a, b) AS s_latest, least(a, b) AS e_earliest FROM (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 1900 + user_id % 50 END AS a, CASE WHEN event_id % 5 > 0 THEN 1930 - user_id % 40 END AS b FROM events) WHERE coalesce(a, b) IS NOT NULL")
def attested_window(v: Views) -> DataFrame:
    a, b = F.when(F.col("event_id") % 3 > 0, 1900 + F.col("user_id") % 50), F.when(F.col("event_id") % 5 > 0, 1930 - F.col("user_id") % 40)
    return v.events.select("event_id", F.explode(temporal.attested_window(a, b)).alias("s")).select("event_id", F.col("s.start.latest").alias("s_latest"), F.col("s.end.earliest").alias("e_earliest"))


@query("SELECT event_id, a AS s_in, CASE WHEN a IS NULL THEN b END AS s_latest, b AS e_in FROM (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 1900 + user_id % 50 END AS a, CASE WHEN event_id % 5 > 0 THEN 1960 + user_id % 40 END AS b FROM events) WHERE coalesce(a, b) IS NOT NULL")
def lifespans(v: Views) -> DataFrame:
    a, b = F.when(F.col("event_id") % 3 > 0, 1900 + F.col("user_id") % 50), F.when(F.col("event_id") % 5 > 0, 1960 + F.col("user_id") % 40)
    return v.events.select("event_id", F.explode(temporal.lifespan(a, b)).alias("s")).select("event_id", F.col("s.start.in").alias("s_in"), F.col("s.start.latest").alias("s_latest"), F.col("s.end.in").alias("e_in"))


@query("""
WITH x AS (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 1900 + user_id % 4 END AS se, CASE WHEN event_id % 4 > 0 THEN 1902 END AS sl, CASE WHEN event_id % 5 > 0 THEN 1950 + user_id % 3 END AS ee, CASE WHEN event_id % 7 > 0 THEN 1951 END AS el FROM events)
SELECT event_id, CASE WHEN se = sl THEN se END AS s_in, CASE WHEN se = sl THEN NULL ELSE se END AS s_earliest, CASE WHEN se = sl THEN NULL WHEN se IS NULL AND sl IS NULL THEN coalesce(ee, el) ELSE sl END AS s_latest,
  CASE WHEN ee = el THEN ee END AS e_in, CASE WHEN ee = el THEN NULL ELSE ee END AS e_earliest, CASE WHEN ee = el THEN NULL ELSE el END AS e_latest FROM x WHERE coalesce(se, sl, ee, el) IS NOT NULL""")
def bounded_spans(v: Views) -> DataFrame:
    i, u = F.col("event_id"), F.col("user_id")
    s = temporal.bounded(F.when(i % 3 > 0, 1900 + u % 4), F.when(i % 4 > 0, F.lit(1902).cast("long")), F.when(i % 5 > 0, 1950 + u % 3), F.when(i % 7 > 0, F.lit(1951).cast("long")))
    out = v.events.select("event_id", F.explode(s).alias("s"))
    return out.select("event_id", *(F.col(f"s.{e}.{b}").cast("long" if (e, b) in {("start", "in"), ("start", "earliest"), ("start", "latest"), ("end", "in"), ("end", "earliest")} else "int").alias(f"{e[0]}_{b}") for e in ("start", "end") for b in temporal.BOUNDS))


@query(r"""
WITH x AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN concat('-0', (user_id % 900)::VARCHAR, '-03-15') WHEN 1 THEN concat('+', (user_id + 1000)::VARCHAR) WHEN 2 THEN ' 2022 ' WHEN 3 THEN 'c. 1900' WHEN 4 THEN '1850-06' ELSE NULL END AS t FROM events)
SELECT event_id, CASE WHEN regexp_matches(t, '^\s*[+-]?\d+(-.*)?\s*$') THEN (CASE WHEN ltrim(t)[1] = '-' THEN -1 ELSE 1 END) * regexp_extract(t, '^\s*[+-]?(\d+)', 1)::BIGINT END AS year FROM x""")
def coerced_years(v: Views) -> DataFrame:
    u, k = F.col("user_id"), F.col("event_id") % 6
    t = F.when(k == 0, F.concat(F.lit("-0"), (u % 900).cast("string"), F.lit("-03-15"))).when(k == 1, F.concat(F.lit("+"), (u + 1000).cast("string"))).when(k == 2, " 2022 ").when(k == 3, "c. 1900").when(k == 4, "1850-06")
    return v.events.select("event_id", temporal.coerce_year(t).alias("year"))


@query("SELECT event_id, CAST(floor(y / p) * p AS BIGINT) AS low, CAST(floor(y / p) * p + p - 1 AS BIGINT) AS high FROM (SELECT event_id, user_id * 7 - 900 AS y, CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100 WHEN 3 THEN 1000 END AS p FROM events)")
def precision_bounds(v: Views) -> DataFrame:
    low, high = temporal.precision_bounds(F.col("user_id") * 7 - 900, 9 - (F.col("event_id") % 5))
    return v.events.select("event_id", low.alias("low"), high.alias("high"))


@query("""
SELECT namespace, count(*) AS n, min(coalesce(s_earliest, s_in)) AS first_start, max(coalesce(e_latest, e_in)) AS last_end, bool_and(coalesce(s_earliest, s_in) IS NOT NULL) AS all_start
FROM p_base JOIN ts_flat USING (place_id) GROUP BY namespace""")
def namespace_extent(v: Views) -> DataFrame:
    s, e = F.coalesce("s_earliest", "s_in"), F.coalesce("e_latest", "e_in")
    return v.p_base.join(v.ts_flat, "place_id").groupBy("namespace").agg(F.count("*").alias("n"), F.min(s).alias("first_start"), F.max(e).alias("last_end"), F.bool_and(s.isNotNull()).alias("all_start"))


@query("""
WITH s AS (SELECT ccode, CASE WHEN bool_and(coalesce(s_earliest, s_in) IS NOT NULL) THEN min(coalesce(s_earliest, s_in)) END AS outer_start, CASE WHEN bool_and(coalesce(e_latest, e_in) IS NOT NULL) THEN max(coalesce(e_latest, e_in)) END AS outer_end,
  min(coalesce(s_latest, s_in)) FILTER (WHERE coalesce(s_latest, s_in) IS NOT NULL AND coalesce(e_earliest, e_in) IS NOT NULL) AS core_start, max(coalesce(e_earliest, e_in)) FILTER (WHERE coalesce(s_latest, s_in) IS NOT NULL AND coalesce(e_earliest, e_in) IS NOT NULL) AS core_end
  FROM p_base JOIN ts_flat USING (place_id) WHERE ccode IS NOT NULL GROUP BY ccode) SELECT * FROM s""")
def envelope_and_core(v: Views) -> DataFrame:
    a, b, c, d = F.coalesce("s_earliest", "s_in"), F.coalesce("e_latest", "e_in"), F.coalesce("s_latest", "s_in"), F.coalesce("e_earliest", "e_in")
    core = c.isNotNull() & d.isNotNull()
    return v.p_base.where("ccode is not null").join(v.ts_flat, "place_id").groupBy("ccode").agg(
        F.when(F.bool_and(a.isNotNull()), F.min(a)).alias("outer_start"), F.when(F.bool_and(b.isNotNull()), F.max(b)).alias("outer_end"),
        F.min(F.when(core, c)).alias("core_start"), F.max(F.when(core, d)).alias("core_end"),
    )


@query("SELECT place_id, coalesce(s_earliest, s_in, -9999) AS start_year, coalesce(e_latest, e_in, 9999) AS end_year FROM ts_flat")
def tile_years(v: Views) -> DataFrame:
    return v.ts_flat.select("place_id", F.coalesce("s_earliest", "s_in", F.lit(temporal.OPEN_START)).cast("long").alias("start_year"), F.coalesce("e_latest", "e_in", F.lit(temporal.OPEN_END)).cast("long").alias("end_year"))


@query("SELECT event_id, CASE WHEN y BETWEEN -10000 AND 2125 THEN y END AS year FROM (SELECT event_id, user_id * 100 - 12000 AS y FROM events)")
def clamped_years(v: Views) -> DataFrame:
    return v.events.select("event_id", temporal.clamp(F.lit("gn"), F.col("user_id") * 100 - 12000, 2025).alias("year"))


@query("""
WITH o AS (SELECT o_custkey, min(year(o_orderdate)) AS y0, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE max(year(o_orderdate)) END AS y1 FROM orders GROUP BY o_custkey),
p AS (SELECT a.o_custkey AS a, a.y0 AS a0, a.y1 AS a1, b.y0 AS b0, b.y1 AS b1 FROM o a JOIN o b ON b.o_custkey = a.o_custkey + 1),
q AS (SELECT a, a0, b0, coalesce(a1, b1, greatest(a0, b0)) AS e0, coalesce(b1, a1, greatest(a0, b0)) AS e1 FROM p)
SELECT a, round(CASE WHEN least(e0, e1) < greatest(a0, b0) THEN 0.0 WHEN greatest(e0, e1) - least(a0, b0) <= 0 THEN 1.0 ELSE (least(e0, e1) - greatest(a0, b0)) / (greatest(e0, e1) - least(a0, b0)) END::DOUBLE, 9) AS overlap FROM q""")
def temporal_overlap(v: Views) -> DataFrame:
    o = v.orders.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("y0"), F.max(F.year("o_orderdate")).alias("y1")).withColumn("y1", F.when(F.col("o_custkey") % 3 != 0, F.col("y1")))
    b = o.select((F.col("o_custkey") - 1).alias("o_custkey"), F.col("y0").alias("b0"), F.col("y1").alias("b1"))
    return o.join(b, "o_custkey").select(F.col("o_custkey").alias("a"), F.round(temporal.overlap(F.col("y0"), F.col("y1"), F.col("b0"), F.col("b1")), 9).alias("overlap"))


@query("""
WITH d AS (SELECT DISTINCT o_custkey AS unit, year(o_orderdate) AS y FROM orders)
SELECT unit, y, lag(y) OVER w AS previous, coalesce(lead(y) OVER w, y + 10) AS next FROM d WINDOW w AS (PARTITION BY unit ORDER BY y)""")
def census_neighbours(v: Views) -> DataFrame:
    w = W.partitionBy("unit").orderBy("y")
    d = v.orders.select(F.col("o_custkey").alias("unit"), F.year("o_orderdate").cast("long").alias("y")).distinct()
    return d.select("unit", "y", F.lag("y").over(w).alias("previous"), F.coalesce(F.lead("y").over(w), F.col("y") + 10).alias("next"))


# Discovery, filters and ranking


@query("""
WITH s AS (SELECT place_id, 1.0::DOUBLE AS score, max(name) AS matched FROM t_att WHERE name = (SELECT min(p_name) FROM part) GROUP BY place_id)
SELECT s.place_id, s.score / (SELECT max(score) FROM s) * 100 AS score, matched, namespace, ccode FROM s JOIN p_base USING (place_id)
WHERE place_id IN (SELECT place_id FROM ts_flat WHERE coalesce(coalesce(s_earliest, s_in) <= 2001, true) AND coalesce(coalesce(e_latest, e_in) >= 1995, true)) ORDER BY score DESC, place_id DESC LIMIT 50""")
def reconcile_exact(v: Views) -> DataFrame:
    name = v.part.agg(F.min("p_name")).first()[0]
    return search.reconcile(v.t_att, v.p_base.select("place_id", F.col("namespace").alias("ns"), "ccode"), spans(v), name, (1995, 2001)).select("place_id", "score", "matched", F.col("ns").alias("namespace"), "ccode")


@query("SELECT name, count(*) AS n FROM t_att WHERE name = (SELECT max(p_name) FROM part) GROUP BY name")
def exact_names(v: Views) -> DataFrame:
    return search.exact(v.t_att, v.part.agg(F.max("p_name")).first()[0]).groupBy("name").agg(F.count("*").alias("n"))


@query(r"SELECT DISTINCT toponym_id, 1.0::DOUBLE AS score FROM t_att WHERE starts_with(lower(name), 'co') OR len(list_filter(regexp_extract_all(lower(name), '[a-z0-9]+'), lambda t: starts_with(t, 'co'))) > 0")
def prefix_names(v: Views) -> DataFrame:
    return search.starts(v.t_att.select("toponym_id", "name").distinct(), "Co").select("toponym_id", "score")


@query("SELECT DISTINCT toponym_id FROM t_att WHERE contains(lower(name), 'dge')")
def infix_names(v: Views) -> DataFrame:
    return search.infix(v.t_att.select("toponym_id", "name").distinct(), "DGE").select("toponym_id")


@query(r"""
WITH n AS (SELECT DISTINCT toponym_id, name, regexp_extract_all(lower(name), '[a-z0-9]+') AS t FROM t_att),
s AS (SELECT toponym_id, (CASE WHEN len(list_filter(t, lambda x: x[1:2] = 'wi' AND levenshtein(x, 'widgat') <= 2)) > 0 THEN 3.0 ELSE 0.0 END + CASE WHEN len(list_filter(t, lambda x: x[1:2] = 'co' AND levenshtein(x, 'cold') <= 1)) > 0 THEN 3.0 ELSE 0.0 END + CASE WHEN lower(name) = 'cold widgat' THEN 5.0 ELSE 0.0 END)::DOUBLE AS score FROM n)
SELECT * FROM s WHERE score > 0""")
def fuzzy_names(v: Views) -> DataFrame:
    return search.fuzzy(v.t_att.select("toponym_id", "name").distinct(), "cold widgat").select("toponym_id", "score")


@query("""
WITH f AS (SELECT min(p_name) AS a, max(p_name) AS b FROM part)
SELECT place_id, max(CASE WHEN name = a THEN 1.0 ELSE 0.9 END)::DOUBLE AS score FROM t_att, f WHERE name IN (a, b) GROUP BY place_id""")
def variant_scores(v: Views) -> DataFrame:
    a, b = v.part.agg(F.min("p_name"), F.max("p_name")).first()
    return search.accumulate(search.with_variants(v.t_att, [a, b, f" {a.upper()} ", ""])).select("place_id", "score")


@query(r"""
WITH n AS (SELECT DISTINCT name FROM t_att WHERE starts_with(lower(name), 'c') OR len(list_filter(regexp_extract_all(lower(name), '[a-z0-9]+'), lambda t: starts_with(t, 'c'))) > 0)
SELECT min(name) AS name, 1.0::DOUBLE AS score FROM n GROUP BY lower(name) ORDER BY 2 DESC, 1 LIMIT 10""")
def suggestions(v: Views) -> DataFrame:
    return search.suggest(v.t_att.select("name").distinct(), "c")


@query("SELECT place_id, namespace FROM p_base WHERE namespace IN ('su', 'pa')")
def included_namespaces(v: Views) -> DataFrame:
    return v.p_base.where(search.in_namespaces(["su", "pa"], ["su"])).select("place_id", "namespace")


@query("SELECT namespace, count(*) AS n FROM p_base WHERE namespace NOT IN ('pa') GROUP BY namespace")
def excluded_namespaces(v: Views) -> DataFrame:
    return v.p_base.where(search.in_namespaces(None, ["pa"])).groupBy("namespace").agg(F.count("*").alias("n"))


@query("SELECT place_id, title FROM p_base ORDER BY title, place_id LIMIT 20 OFFSET 30")
def browse_page(v: Views) -> DataFrame:
    return v.p_base.select("place_id", "title").orderBy("title", "place_id").offset(30).limit(20)


@query("SELECT place_id, title FROM p_base WHERE place_id > 'cu:5' ORDER BY place_id LIMIT 25")
def keyset_page(v: Views) -> DataFrame:
    return v.p_base.where("place_id > 'cu:5'").select("place_id", "title").orderBy("place_id").limit(25)


@query("SELECT type_identifier, count(*) AS n, min(type_label) AS label FROM p_base GROUP BY type_identifier ORDER BY n DESC, type_identifier LIMIT 50")
def type_facet(v: Views) -> DataFrame:
    return search.facet(v.p_base, "type_identifier", 50, "type_label")


@query("SELECT ccode, count(*) AS n FROM p_base WHERE ccode IS NOT NULL GROUP BY ccode ORDER BY n DESC, ccode LIMIT 50")
def country_facet(v: Views) -> DataFrame:
    return search.facet(v.p_base, "ccode", 50)


@query("""
WITH a AS (SELECT o_orderkey AS pos, concat('place:cu:', (o_custkey + o_orderkey % 2 * 1000000)::VARCHAR) AS asked FROM orders WHERE o_orderkey % 7 = 0)
SELECT pos, asked, title, title IS NOT NULL AS found FROM a LEFT JOIN p_base ON place_id = replace(asked, 'place:', '')""")
def place_lookup(v: Views) -> DataFrame:
    asked = v.orders.where("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("place:cu:"), (F.col("o_custkey") + F.col("o_orderkey") % 2 * 1000000).cast("string")).alias("asked"))
    return search.lookup(v.p_base, asked).select("pos", "asked", "title", "found")


@query("""
WITH a AS (SELECT o_orderkey AS pos, concat('place:cu:', (o_custkey + o_orderkey % 2 * 1000000)::VARCHAR) AS asked FROM orders)
SELECT pos, asked, title, title IS NOT NULL AS found FROM a LEFT JOIN p_base ON place_id = replace(asked, 'place:', '')""")
def place_lookup_of_all(v: Views) -> DataFrame:
    asked = v.orders.select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("place:cu:"), (F.col("o_custkey") + F.col("o_orderkey") % 2 * 1000000).cast("string")).alias("asked"))
    return search.lookup(v.p_base, asked).select("pos", "asked", "title", "found")


@query(r"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents), s AS (SELECT count(*) AS docs, avg(len(w)) AS mean FROM t),
f AS (SELECT doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS term FROM t) WHERE term IN ('thing', 'license') GROUP BY doc_id, w, term),
d AS (SELECT term, count(*) AS df FROM f GROUP BY term)
SELECT doc_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * n / mean))), 6) AS score FROM f JOIN d USING (term), s GROUP BY doc_id""")
def bm25(v: Views) -> DataFrame:
    out = search.bm25(v.documents.select("doc_id", text.tokens(F.col("text")).alias("tokens")), ["thing", "license"])
    return out.select("doc_id", F.round("score", 6).alias("score"))


@query("SELECT name, sum(n) AS places FROM (SELECT name, lang, count(*) AS n FROM t_att GROUP BY name, lang) GROUP BY name HAVING sum(n) >= 3 ORDER BY places DESC, name LIMIT 500")
def stoplist(v: Views) -> DataFrame:
    return v.t_att.groupBy("name").agg(F.count("*").alias("places")).where("places >= 3").orderBy(F.col("places").desc(), "name").limit(500)


@query("SELECT toponym_id, string_agg(DISTINCT namespace, ',' ORDER BY namespace) AS namespaces, count(DISTINCT place_id) AS places FROM t_att GROUP BY toponym_id")
def vocabulary(v: Views) -> DataFrame:
    return v.t_att.groupBy("toponym_id").agg(F.array_join(F.sort_array(F.collect_set("namespace")), ",").alias("namespaces"), F.count_distinct("place_id").alias("places"))


@query("SELECT * FROM (SELECT place_id, toponym_id, row_number() OVER (PARTITION BY toponym_id ORDER BY place_id) AS rank FROM t_att) WHERE rank <= 3")
def first_attestations(v: Views) -> DataFrame:
    return search.top_per_group(v.t_att, ["toponym_id"], [F.col("place_id")], 3).select("place_id", "toponym_id", F.col("rank").cast("long").alias("rank"))


@query("SELECT a.place_id AS place_a, b.place_id AS place_b, a.name FROM t_att a JOIN t_att b ON a.name = b.name AND a.place_id < b.place_id WHERE a.namespace = 'pa'")
def same_name_pairs(v: Views) -> DataFrame:
    a = v.t_att.where("namespace = 'pa'").select("name", F.col("place_id").alias("place_a"))
    b = v.t_att.select("name", F.col("place_id").alias("place_b")).join(a.select("name").distinct(), "name", "left_semi")
    return ordered_pairs(listed(a, "place_a", FEW), listed(b, "place_b", MANY), "name", "place_a", "place_b").select("place_a", "place_b", "name")


@query("SELECT sum(c * (c - 1) // 2)::BIGINT AS pairs, count(*) AS names FROM (SELECT least(count(*), 50) AS c FROM t_att GROUP BY name)")
def pair_estimate(v: Views) -> DataFrame:
    c = v.t_att.groupBy("name").agg(F.least(F.count("*"), F.lit(50)).alias("c"))
    return c.agg(F.sum(F.floor(F.col("c") * (F.col("c") - 1) / 2)).alias("pairs"), F.count("*").alias("names"))
