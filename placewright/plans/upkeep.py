"""Queries of resumed loads, kept sketches, label anchors, simplified lines, grid coordinates and hierarchy matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import project, shapes
from ..operators import areas, hierarchy, sketches, stages
from ..operators.durable import shared_folder
from ..operators.within import distance_to
from ..sources import loads, readers, writers
from .queries import query
from .views import Views


@query("""
SELECT 'n' || (c_nationkey % 3) AS space, count(*) AS rows, sum(c_custkey)::BIGINT AS keys, count(*) FILTER (c_nationkey % 3 = 1 AND c_custkey % 2 = 0) AS renamed,
  'loaded' AS first, 'unchanged' AS second, CASE WHEN c_nationkey % 3 = 1 THEN 'loaded' ELSE 'unchanged' END AS third FROM customer GROUP BY c_nationkey % 3""")
def resumed_loads(v: Views) -> DataFrame:
    """Three sources are loaded, loaded again, and then once more when one has had a file added."""
    at = shared_folder(v.spark, "loads")
    rows = v.customer.select("c_custkey", "c_name", (F.col("c_nationkey") % 3).alias("part"))
    sources = {f"n{i}": f"{at}/given/{i}" for i in range(3)}
    for i in range(3):
        rows.where(F.col("part") == i).select("c_custkey", "c_name").coalesce(1).write.parquet(f"{at}/given/{i}")
    ways = [loads.load(v.spark, sources, f"{at}/kept", lambda b: b, 1) for _ in range(2)]
    rows.where("part = 1 and c_custkey % 2 = 0").select("c_custkey", F.concat("c_name", F.lit("!")).alias("c_name")).coalesce(1).write.mode("append").parquet(sources["n1"])
    ways.append(loads.load(v.spark, sources, f"{at}/kept", lambda b: b, 1))
    kept = loads.current(v.spark, f"{at}/kept", "c_custkey").groupBy("space").agg(F.count("*").alias("rows"), F.sum("c_custkey").alias("keys"), F.count_if(F.endswith("c_name", F.lit("!"))).alias("renamed"))
    told = v.spark.createDataFrame([(s, *(w[s] for w in ways)) for s in sources], "space string, first string, second string, third string")
    return kept.join(F.broadcast(told), "space")


@query("""
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS near, true AS ranked FROM events GROUP BY event_type""")
def day_sketches(v: Views) -> DataFrame:
    """From sketches of days: distinct users within three errors of their number, quartiles within two rank errors; the exact figures stand beside them to be compared."""
    daily = sketches.sketched(v.events.withColumn("day", F.to_date("ts")), ["day", "event_type"], "user_id", "value")
    whole = sketches.merged(daily, ["event_type"], [0.25, 0.5, 0.75])
    exact = v.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    both = whole.join(exact, "event_type")
    ranks = v.events.join(both.select("event_type", "quantiles"), "event_type").groupBy("event_type").agg(*(F.avg((F.col("value") <= F.col("quantiles")[i]).cast("double")).alias(f"r{i}") for i in range(3)))
    fine = lambda i, r: F.abs(F.col(f"r{i}") - r) <= 2 * sketches.RANK_ERROR + 1 / F.col("n")
    near = F.abs(F.col("distinct") - F.col("users")) <= F.greatest(3 * sketches.DISTINCT_ERROR * F.col("users"), F.lit(1.0))
    return both.join(ranks, "event_type").select("event_type", "n", "users", near.alias("near"), (fine(0, 0.25) & fine(1, 0.5) & fine(2, 0.75)).alias("ranked"))


@query("""
SELECT event_type, user_id AS value, n AS low, n AS high FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS r FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL)) WHERE r <= 5""")
def frequent_users(v: Views) -> DataFrame:
    days = sketches.frequent(v.events.withColumn("day", F.to_date("ts")), ["day", "event_type"], "user_id", 1_000_000)
    return sketches.most_frequent(days, ["event_type"], ["day", "event_type"], 5)


@query("SELECT DISTINCT c_custkey AS id, least(1 + c_custkey % 7, 1 + c_custkey % 5, CASE WHEN c_custkey % 3 = 0 THEN 2 * 99 ELSE 99 END)::DOUBLE / 2 AS room, true AS inside FROM customer")
def label_anchors(v: Views) -> DataFrame:
    """Boxes of different sides; of every third a corner is cut off that leaves its room as it is."""
    k = F.col("c_custkey")
    w, h = (1 + k % 7).cast("double"), (1 + k % 5).cast("double")
    x, y = (k % 100).cast("double"), (k % 70).cast("double")
    cut = F.least(w, h) * 0.1
    five = F.array(shapes.point(x, y), shapes.point(x + w, y), shapes.point(x + w, y + h - cut), shapes.point(x + w - cut, y + h), shapes.point(x, y + h), shapes.point(x, y))
    rings = F.when(k % 3 == 0, F.array(five)).otherwise(shapes.rectangle(x, y, x + w, y + h))
    at = areas.anchored(v.customer.select(k.alias("id"), rings.alias("rings")), "id", 0.004)
    return at.select("id", F.round("at.distance", 2).alias("room"), shapes.contains(F.col("rings"), F.col("at.x"), F.col("at.y")).alias("inside"))


@query("SELECT l_orderkey AS id, count(DISTINCT l_linenumber) AS points, true AS near, true AS ends FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linenumber) > 2")
def simplified_lines(v: Views) -> DataFrame:
    """Quantities of an order's lines as a line on the map: every point left out lies within the tolerance of what stays."""
    each = v.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    lines = each.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(shapes.point(F.col("l_linenumber"), F.col("q") / 4))).alias("line")).where("size(line) > 2")
    done = lines.withColumn("kept", shapes.peucker(F.col("line"), 1.5))
    off = F.array_max(F.transform("line", lambda p: distance_to(F.array(F.col("kept")), p["x"], p["y"])))
    ends = (F.element_at("kept", 1) == F.element_at("line", 1)) & (F.element_at("kept", -1) == F.element_at("line", -1)) & (F.size("kept") <= F.size("line"))
    return done.select("id", F.size("line").cast("long").alias("points"), (off <= 1.5 + 1e-9).alias("near"), ends.alias("ends"))


@query("SELECT c_custkey AS id, (100000 + c_custkey * 7919 % 500000)::DOUBLE AS east, (50000 + c_custkey * 104729 % 900000)::DOUBLE AS north, true AS there FROM customer")
def grid_round_trips(v: Views) -> DataFrame:
    """Grid metres to the world's degrees and back, to the centimetre."""
    k = F.col("c_custkey")
    rows = v.customer.select(k.alias("id"), (100_000 + k * 7919 % 500_000).cast("double").alias("e"), (50_000 + k * 104_729 % 900_000).cast("double").alias("n"))
    world = rows.withColumn("w", project.grid_to_world(F.col("e"), F.col("n")))
    back = world.withColumn("g", project.world_to_grid(F.col("w.lon"), F.col("w.lat")))
    return back.select("id", F.round("g.east", 2).alias("east"), F.round("g.north", 2).alias("north"), (F.col("w.lon").between(-8, 3) & F.col("w.lat").between(50, 59)).alias("there"))


@query(r"""
WITH unit AS (SELECT 'r' || r_regionkey AS unit, r_name AS name, 'province' AS level, NULL AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'D' || (n_nationkey % 9), 'district', 'r' || n_regionkey FROM nation),
place AS (SELECT c_custkey AS place_id, CASE WHEN c_custkey % 3 > 0 THEN lower(r_name) END AS p, 'd' || (c_custkey % 11) AS base, c_custkey % 4 = 0 AS long FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
under AS (SELECT lower(p.name) AS p, lower(d.name) AS k, min(d.unit) AS unit FROM unit d JOIN unit p ON p.unit = d.parent GROUP BY ALL),
alone AS (SELECT lower(name) AS k, min(unit) AS unit FROM unit WHERE level = 'district' GROUP BY ALL HAVING count(*) = 1)
SELECT place_id, r.unit AS province_unit, coalesce(u.unit, a.unit) AS district_unit, CASE WHEN u.unit IS NOT NULL THEN 'province' WHEN a.unit IS NOT NULL THEN 'name' END || CASE WHEN long THEN '-base' ELSE '' END AS how
FROM place LEFT JOIN unit r ON lower(r.name) = p LEFT JOIN under u ON u.p = place.p AND u.k = base LEFT JOIN alone a ON a.k = base""")
def matched_districts(v: Views) -> DataFrame:
    """Districts whose names repeat in several provinces; a fourth of the places name theirs with a word that belongs to the kind, some no province."""
    i = lambda c, letter: F.concat(F.lit(letter), F.col(c).cast("string"))
    units = v.region.select(i("r_regionkey", "r").alias("unit"), F.col("r_name").alias("name"), F.lit("province").alias("level"), F.lit(None).cast("string").alias("parent"))
    units = units.unionByName(v.nation.select(i("n_nationkey", "n").alias("unit"), F.concat(F.lit("D"), (F.col("n_nationkey") % 9).cast("string")).alias("name"), F.lit("district").alias("level"), i("n_regionkey", "r").alias("parent")))
    k = F.col("c_custkey")
    own = v.customer.join(v.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(v.region, F.col("r_regionkey") == F.col("n_regionkey"))
    district = F.concat(F.lit("D"), (k % 11).cast("string"), F.when(k % 4 == 0, " Kazası").otherwise(""))
    places = own.select(k.alias("place_id"), F.when(k % 3 > 0, F.initcap("r_name")).alias("province"), district.alias("district"))
    return hierarchy.matched(places, units, lambda c: F.regexp_replace(c, r"(?i)\s+kaza(sı)?$", ""))


# Map labels


@query("""
WITH l AS (SELECT c_custkey AS pin_id, c_name AS text, CASE WHEN c_custkey % 3 = 0 THEN 'farm' END AS token, CASE WHEN c_custkey % 3 = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name[:-2] || 'x' END END AS reading,
  CASE WHEN c_custkey % 5 > 0 THEN 'house' END AS kind FROM customer)
SELECT pin_id, CASE WHEN reading IS NOT NULL AND pin_id % 2 = 1 THEN reading ELSE text END AS text, CASE WHEN reading IS NULL THEN 'raw' WHEN pin_id % 2 = 1 THEN 'vlm' ELSE 'agree' END AS source,
  CASE WHEN reading IS NOT NULL THEN CASE WHEN pin_id % 2 = 1 THEN 'correction' ELSE 'match' END END AS rule, coalesce(token, CASE WHEN reading IS NOT NULL THEN kind END) AS token,
  CASE WHEN token IS NOT NULL THEN 'tier0' WHEN reading IS NULL THEN 'pending' WHEN kind IS NOT NULL THEN 'typed' ELSE 'read' END AS state,
  (CASE WHEN reading IS NOT NULL AND kind IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN reading IS NOT NULL AND pin_id % 2 = 1 THEN 1 ELSE 0 END)::BIGINT AS edits FROM l""")
def labelled_edition(v: Views) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_name")
    given = v.customer.select(k.alias("pin_id"), n.alias("text"), F.when(k % 3 == 0, "farm").alias("token"))
    second = F.when(k % 2 == 0, F.upper(n)).otherwise(F.concat(F.left(n, F.length(n) - 1), F.lit("x")))
    readings = v.customer.where(k % 3 < 2).select(k.alias("pin_id"), second.alias("reading"), F.when(k % 5 > 0, "house").alias("kind"), F.lit("roman").alias("style"), F.lit(True).alias("legible"))
    return stages.edition(given, readings, "v1").select("pin_id", "text", "source", "rule", "token", "state", F.size("edits").cast("long").alias("edits"))


_SHEETS = "sheet AS (SELECT n_name AS region, 1900 + n_nationkey % 4 AS published, 1850 + n_nationkey AS s, (n_nationkey * 14 % 320 - 165)::DOUBLE AS w, (n_nationkey * 22 % 130 - 75)::DOUBLE AS b FROM nation)"


@query(f"""
WITH {_SHEETS}, held AS (SELECT place_id, region, published, s FROM p_pt JOIN sheet ON lon + 0.03125 > w AND lon + 0.03125 < w + 40 AND lat + 0.03125 > b AND lat + 0.03125 < b + 30),
best AS (SELECT place_id, max((published, region, s)) AS m, count(*) > 1 AS ambiguous FROM held GROUP BY place_id)
SELECT p.place_id AS pin_id, m[2] AS sheet, m[3] AS start_year, m[1] AS end_year, ambiguous FROM p_pt p LEFT JOIN best USING (place_id)""")
def dated_labels(v: Views) -> DataFrame:
    """Labels by overlapping sheets: the one published last, ties by the last name."""
    n = F.col("n_nationkey")
    w, b = (n * 14 % 320 - 165).cast("double"), (n * 22 % 130 - 75).cast("double")
    sheets = v.nation.select(F.col("n_name").alias("region"), shapes.rectangle(w, b, w + 40, b + 30).alias("rings"), (1900 + n % 4).alias("published"), (1850 + n).alias("start"), (1900 + n % 4).alias("end"))
    labels = v.p_pt.select(F.col("place_id").alias("pin_id"), (F.col("lon") + 0.03125).alias("lon"), (F.col("lat") + 0.03125).alias("lat"))
    return stages.sheet_dated(labels, sheets).select("pin_id", "sheet", F.col("start").alias("start_year"), F.col("end").alias("end_year"), "ambiguous")


# Staged files written and read back


@query("""
SELECT 'cu:' || c_custkey AS place_id, upper(c_name) AS title, 'final' AS stage FROM customer UNION ALL SELECT 'su:' || s_suppkey, s_name, 'extract' FROM supplier""")
def staged_sources(v: Views) -> DataFrame:
    """Extracts of two sources as JSON lines, of one also its last stage as Parquet: the latest stage of each is read."""
    at = shared_folder(v.spark, "staged")
    kinds = "place_id string, title string, stage string"
    row = lambda df, space, key, title, stage: df.select(F.concat(F.lit(f"{space}:"), F.col(key).cast("string")).alias("place_id"), title.alias("title"), F.lit(stage).alias("stage"))
    row(v.customer, "cu", "c_custkey", F.col("c_name"), "extract").write.json(f"{at}/cu_extract.jsonl")
    row(v.supplier, "su", "s_suppkey", F.col("s_name"), "extract").write.json(f"{at}/su_extract.jsonl")
    row(v.customer, "cu", "c_custkey", F.upper("c_name"), "final").write.parquet(f"{at}/cu_final.parquet")
    return readers.staged(v.spark, at, "cu", kinds).select("place_id", "title", "stage").unionByName(readers.staged(v.spark, at, "su", kinds).select("place_id", "title", "stage"))


@query("""
SELECT CASE WHEN c_custkey % 10 < 8 THEN 'train' WHEN c_custkey % 10 < 9 THEN 'val' ELSE 'test' END AS split, count(*) AS n, count(*) FILTER (c_custkey % 3 > 0) AS listed, sum(c_custkey)::BIGINT AS keys FROM customer GROUP BY 1""")
def written_splits(v: Views) -> DataFrame:
    """Rows appended in two goes to a table cut by their split, then read back: empty lists have become null."""
    at, k = shared_folder(v.spark, "splits"), F.col("c_custkey")
    names = F.when(k % 3 > 0, F.array("c_name")).otherwise(F.array().cast("array<string>"))
    rows = v.customer.select(k.alias("id"), names.alias("names"), (k % 2).cast("int").alias("part"), F.when(k % 10 < 8, "train").when(k % 10 < 9, "val").otherwise("test").alias("split"))
    for part in (0, 1):
        writers.write_staged(rows.where(F.col("part") == part).withColumn("part", F.lit(part)), at, 1, "split")
    return v.spark.read.parquet(at).groupBy("split").agg(F.count("*").alias("n"), F.count("names").alias("listed"), F.sum("id").alias("keys"))
