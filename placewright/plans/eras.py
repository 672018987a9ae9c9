"""Queries of spans from sources, and of documents that have several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import temporal
from .queries import query, spans
from .views import Views

#: Years of two spans of an event, and of text bounds, for both engines.
_PAIR = """SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 1900 + user_id % 50 END AS a, CASE WHEN event_id % 5 > 0 THEN 1960 + user_id % 40 END AS b, CASE WHEN event_id % 7 > 0 THEN 1990 - user_id % 80 END AS c FROM events"""


def pair(v: Views) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return v.events.select(e, F.when(e % 3 > 0, 1900 + u % 50).alias("a"), F.when(e % 5 > 0, 1960 + u % 40).alias("b"), F.when(e % 7 > 0, 1990 - u % 80).alias("c"))


def two_spans() -> Column:
    """[exact a to b, attested in c]."""
    return F.array(temporal.span(s_in=F.col("a"), e_in=F.col("b")), temporal.span(s_latest=F.col("c"), e_earliest=F.col("c")))


@query(f"WITH x AS ({_PAIR}) SELECT event_id, CASE WHEN a IS NULL THEN coalesce(b, c) END AS s_latest FROM x WHERE b IS NOT NULL OR c IS NOT NULL")
def closed_spans(v: Views) -> DataFrame:
    one = F.array(temporal.span(s_in=F.col("a"), e_in=F.col("b"), e_latest=F.col("c")))
    return pair(v).where("b is not null or c is not null").select("event_id", temporal.closed(one)[0]["start"]["latest"].alias("s_latest"))


@query(f"WITH x AS ({_PAIR}) SELECT event_id, 2 - (a IS NULL AND b IS NULL)::INT - (c IS NULL)::INT AS n, coalesce(a, CASE WHEN b IS NULL THEN c END) AS first_year FROM x")
def coerced_spans(v: Views) -> DataFrame:
    t = lambda c: F.concat(F.col(c).cast("string"), F.lit("-05-01"))
    end = lambda *c: F.struct(*(x.cast("string").alias(b) for x, b in zip(c, temporal.BOUNDS, strict=True)))
    none, junk = F.lit(None), F.lit("unknown")
    given = F.array(F.struct(end(t("a"), none, junk).alias("start"), end(t("b"), junk, none).alias("end")), F.struct(end(none, none, none).alias("start"), end(none, t("c"), none).alias("end")))
    out = pair(v).select("event_id", temporal.coerced(given).alias("s"))
    first = F.coalesce(F.get("s", F.lit(0))["start"]["in"], F.when(F.get("s", F.lit(0))["end"]["in"].isNull(), F.get("s", F.lit(0))["end"]["earliest"]))
    return out.select("event_id", F.size("s").alias("n"), first.alias("first_year"))


@query("""
WITH d AS (SELECT DISTINCT o_custkey AS unit, year(o_orderdate) AS y FROM orders), n AS (SELECT unit, y, lag(y) OVER w AS p, coalesce(lead(y) OVER w, y + 10) AS s FROM d WINDOW w AS (PARTITION BY unit ORDER BY y))
SELECT unit, y, CASE WHEN p = y THEN NULL ELSE p END AS s_earliest, y AS s_latest, y AS e_earliest, s AS e_latest FROM n""")
def census_snapshots(v: Views) -> DataFrame:
    w = W.partitionBy("unit").orderBy("y")
    d = v.orders.select(F.col("o_custkey").alias("unit"), F.year("o_orderdate").cast("long").alias("y")).distinct()
    near = d.withColumn("p", F.lag("y").over(w)).withColumn("n", F.coalesce(F.lead("y").over(w), F.col("y") + 10))
    s = near.select("unit", "y", temporal.bounded(F.col("p"), F.col("y"), F.col("y"), F.col("n"))[0].alias("s"))
    return s.select("unit", "y", *(F.col(f"s.{e}.{b}").alias(f"{e[0]}_{b}") for e in ("start", "end") for b in ("earliest", "latest")))


@query("""
WITH c AS (SELECT event_id, user_id, event_type, 1000 + user_id * 3 AS y, 7 + event_id % 4 AS p FROM events),
g AS (SELECT user_id, coalesce(min(y) FILTER (WHERE event_type = 'signup'), min(y) FILTER (WHERE event_type = 'click')) AS s, coalesce(max(y) FILTER (WHERE event_type = 'purchase'), max(y) FILTER (WHERE event_type = 'view')) AS e, min(y) FILTER (WHERE event_type = 'error') AS t FROM c GROUP BY user_id)
SELECT user_id, CASE WHEN s IS NULL AND e IS NULL THEN NULL ELSE floor(s / 10)::BIGINT * 10 END AS s_earliest, CASE WHEN s IS NULL AND e IS NULL THEN t ELSE coalesce(floor(s / 10)::BIGINT * 10 + 9, e) END AS s_latest, e AS e_in, CASE WHEN s IS NULL AND e IS NULL THEN t END AS e_earliest FROM g WHERE coalesce(s, e, t) IS NOT NULL""")
def claimed_spans(v: Views) -> DataFrame:
    y = 1000 + F.col("user_id") * 3
    pick = lambda f, kind: f(F.when(F.col("event_type") == kind, y))
    g = v.events.groupBy("user_id").agg(F.coalesce(pick(F.min, "signup"), pick(F.min, "click")).alias("s"), F.coalesce(pick(F.max, "purchase"), pick(F.max, "view")).alias("e"), pick(F.min, "error").alias("t"))
    out = g.select("user_id", F.explode(temporal.claimed(F.col("s"), F.lit(8), F.col("e"), F.lit(9), F.col("t"), F.lit(11))).alias("x"))
    earliest = F.coalesce("x.start.earliest", F.when(F.col("x.start.in").isNotNull(), F.col("x.start.in")))
    return out.select("user_id", earliest.alias("s_earliest"), F.col("x.start.latest").alias("s_latest"), F.col("x.end.in").alias("e_in"), F.col("x.end.earliest").alias("e_earliest"))


@query("""
SELECT place_id, coalesce(s_earliest, s_in) AS start_year, coalesce(e_latest, e_in) AS end_year, CASE WHEN coalesce(s_latest, s_in) IS NOT NULL AND coalesce(e_earliest, e_in) IS NOT NULL THEN coalesce(s_latest, s_in) END AS core_start
FROM ts_flat WHERE coalesce(s_in, s_earliest, s_latest, e_in, e_earliest, e_latest) IS NOT NULL""")
def shown_spans(v: Views) -> DataFrame:
    out = spans(v).select("place_id", F.explode(temporal.shown_spans(F.array("span"))).alias("x"))
    return out.select("place_id", F.col("x.start").alias("start_year"), F.col("x.end").alias("end_year"), F.get("x.definite", F.lit(0)).alias("core_start"))


@query(f"WITH x AS ({_PAIR}) SELECT event_id, a AS start_year, b AS end_year FROM x")
def envelopes(v: Views) -> DataFrame:
    return pair(v).select("event_id", temporal.envelope(two_spans()).alias("x")).select("event_id", F.col("x.start").alias("start_year"), F.col("x.end").alias("end_year"))


@query(f"WITH x AS ({_PAIR}) SELECT event_id, CAST(NULL AS BIGINT) AS se, CASE WHEN a IS NULL THEN c WHEN c IS NULL THEN a ELSE least(a, c) END AS sl, CASE WHEN b IS NULL THEN c WHEN c IS NULL THEN b ELSE greatest(b, c) END AS ee, CAST(NULL AS BIGINT) AS el FROM x")
def document_bounds(v: Views) -> DataFrame:
    return pair(v).select("event_id", temporal.document_bounds(two_spans(), F.lit("gn"), 2025).alias("x")).select("event_id", "x.*")


@query(f"""
WITH x AS ({_PAIR}), y AS (SELECT *, least(coalesce(a, 9999), coalesce(b, 9999), coalesce(c, 9999)) AS lo, greatest(coalesce(a, 0), coalesce(b, 0), coalesce(c, 0)) AS hi FROM x)
SELECT event_id, CASE WHEN coalesce(a, c) IS NOT NULL THEN lo END AS start_year, CASE WHEN coalesce(b, c) IS NOT NULL THEN hi END AS end_year, 1 AS rejected FROM y""")
def document_ranges(v: Views) -> DataFrame:
    odd = F.concat(two_spans(), F.array(temporal.span(s_in=F.lit(40_000).cast("long"))))
    return pair(v).select("event_id", temporal.document_range(odd, F.lit("gn"), 2025).alias("x")).select("event_id", F.col("x.start").alias("start_year"), F.col("x.end").alias("end_year"), "x.rejected")


@query("""
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 1000 + user_id WHEN 1 THEN -(user_id % 900) WHEN 2 THEN 1700 WHEN 3 THEN (user_id % 20) * 100 WHEN 4 THEN 1200 END AS year FROM events""")
def map_years(v: Views) -> DataFrame:
    u, k = F.col("user_id"), F.col("event_id") % 6
    t = F.when(k == 0, F.concat((1000 + u).cast("string"), F.lit("-03-15"))).when(k == 1, F.concat(F.lit("-0"), (u % 900).cast("string"))).when(k == 2, "~1700").when(k == 3, F.concat(F.lit("C"), (u % 20 + 1).cast("string"))).when(k == 4, "before:1200").otherwise("long ago")
    return v.events.select("event_id", temporal.map_year(t).alias("year"))


@query("""
WITH h AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 1835 ELSE 1200 + user_id % 120 END AS h FROM events WHERE event_id % 9 > 0), g AS (SELECT event_id, h, round_even(h * 0.970224 + 621.5, 0)::BIGINT AS g FROM h)
SELECT event_id, CASE WHEN h BETWEEN 1825 AND 1855 THEN h WHEN g BETWEEN 1800 AND 1880 THEN g ELSE 1840 END AS year FROM g""")
def hijri_years(v: Views) -> DataFrame:
    h = F.concat(F.lit("year "), F.when(F.col("event_id") % 4 == 0, F.lit(1835)).otherwise(1200 + F.col("user_id") % 120).cast("string"))
    return v.events.where("event_id % 9 > 0").select("event_id", temporal.hijri_year(h, 1830, 1850).alias("year"))


@query("""
WITH s AS (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 1840 + user_id % 60 END AS s, CASE WHEN event_id % 4 > 0 THEN 1890 + user_id % 60 END AS p FROM events) SELECT event_id, coalesce(s, p) AS start_year, coalesce(p, s) AS end_year FROM s""")
def sheet_years(v: Views) -> DataFrame:
    s, p = F.when(F.col("event_id") % 3 > 0, F.concat(F.lit("surveyed "), (1840 + F.col("user_id") % 60).cast("string"))), F.when(F.col("event_id") % 4 > 0, F.concat((1890 + F.col("user_id") % 60).cast("string"), F.lit(" ed.")))
    return v.events.select("event_id", temporal.sheet_years(s, p).alias("x")).select("event_id", F.col("x.start").alias("start_year"), F.col("x.end").alias("end_year"))


@query(f"""
WITH x AS ({_PAIR})
SELECT event_id, CASE WHEN a IS NULL THEN 1300 END AS s_earliest, CASE WHEN a IS NULL THEN b END AS s_latest, CASE WHEN b IS NULL THEN 1922 END AS e_latest,
  CASE WHEN a IS NULL AND b IS NULL THEN 2025 END AS listed_latest, CASE WHEN b IS NULL THEN 2025 END AS listed_earliest FROM x""")
def reigns_and_listings(v: Views) -> DataFrame:
    out = pair(v).select("event_id", temporal.reign(F.col("a"), F.col("b"), 1300, 1922)[0].alias("r"), temporal.listed(F.col("a"), F.col("b"), 2025)[0].alias("l"), F.col("a"), F.col("b"))
    return out.select(
        "event_id", F.col("r.start.earliest").alias("s_earliest"), F.col("r.start.latest").alias("s_latest"), F.col("r.end.latest").alias("e_latest"),
        F.when(F.col("a").isNull() & F.col("b").isNull(), F.col("l.start.latest")).alias("listed_latest"), F.col("l.end.earliest").alias("listed_earliest"),
    )
