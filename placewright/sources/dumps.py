"""Readers of outside dumps as DataFrames: entity dumps, map elements, linked places, authority records, SQL dumps, delimited tables, census series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import temporal

#: Tags of which a map element needs one, besides a name, to be a place.
PLACE_TAGS = ["place", "natural", "water", "waterway", "historic", "landuse", "boundary"]


def entities(lines: DataFrame) -> DataFrame:
    """Places of an entity dump, one entity a line: id, English label, coordinates, population, years of its first inception and end, and its concept id.

    Lines without a coordinate claim are left out before they are parsed, and so are lines that aren't JSON.
    """
    raw = lines.where(F.contains("value", F.lit('"P625"'))).select(F.try_parse_json(F.regexp_replace(F.trim("value"), ",$", "")).alias("e"))
    claim = lambda p, path, kind: F.try_variant_get("e", f"$.claims.{p}[0].mainsnak.datavalue.value{path}", kind)
    year = lambda p: F.regexp_extract(claim(p, ".time", "string"), r"^([+-]\d+)-", 1).try_cast("long")
    out = raw.select(
        F.concat(F.lit("wd:"), F.try_variant_get("e", "$.id", "string")).alias("place_id"), F.try_variant_get("e", "$.labels.en.value", "string").alias("title"),
        claim("P625", ".longitude", "double").alias("lon"), claim("P625", ".latitude", "double").alias("lat"), F.regexp_extract(claim("P1082", ".amount", "string"), r"^\+?(\d+)", 1).try_cast("long").alias("population"),
        year("P571").alias("start"), year("P576").alias("end"), claim("P1014", "", "string").try_cast("long").alias("aat_id"),
    )
    return out.where("place_id is not null and lon is not null and lat is not null")


def map_places(elements: DataFrame, space: str, keys: list[str] | None = None) -> DataFrame:
    """Places of map elements (kind, id, tags map): those with a name and one of the tags; the id carries its kind's letter, names their language."""
    tagged = F.exists(F.map_keys("tags"), lambda k: k.isin(keys or PLACE_TAGS))
    named = elements.where((F.coalesce(F.element_at("tags", "name"), F.lit("")) != "") & tagged)
    entry = F.filter(F.map_entries("tags"), lambda e: (e["key"] == "name") | F.startswith(e["key"], F.lit("name:")))
    names = F.array_sort(F.transform(entry, lambda e: F.concat(e["value"], F.lit("@"), F.when(e["key"] == "name", "und").otherwise(F.substring(e["key"], F.lit(6), F.length(e["key"]))))))
    kind = F.array_min(F.transform(F.filter(F.map_entries("tags"), lambda e: e["key"].isin(keys or PLACE_TAGS)), lambda e: F.struct(e["key"].alias("label"), e["value"].alias("identifier"))))
    spans = temporal.lifespan(temporal.map_year(F.element_at("tags", "start_date")), temporal.map_year(F.element_at("tags", "end_date")))
    return named.select(F.concat(F.lit(f"{space}:"), F.left("kind", F.lit(1)), F.col("id").cast("string")).alias("place_id"), F.element_at("tags", "name").alias("title"), names.alias("toponyms"), kind.alias("type"), spans.alias("spans"))


def linked_places(features: DataFrame, space: str) -> DataFrame:
    """Documents of linked-place features (src_id, title, names[toponym, lang], types[identifier, label], links[type, identifier], relations[type, to], start, end, pos).

    A name without a language gets `und`; the second and later features of one id get a number after it; years are text or numbers.
    """
    twin = F.row_number().over(W.partitionBy("src_id").orderBy("pos"))
    own = F.concat(F.lit(f"{space}:"), F.col("src_id"), F.when(twin > 1, F.concat(F.lit("_"), twin.cast("string"))).otherwise(""))
    names = F.transform(F.filter("names", lambda n: F.coalesce(F.trim(n["toponym"]), F.lit("")) != ""), lambda n: F.concat(F.trim(n["toponym"]), F.lit("@"), F.coalesce(F.nullif(n["lang"], F.lit("")), F.lit("und"))))
    related = F.transform("relations", lambda r: F.struct(r["type"].alias("relation_type"), r["to"].alias("related_place_id")))
    year = lambda c: temporal.coerce_year(F.col(c).cast("string"))
    return features.select(own.alias("place_id"), "title", F.array_distinct(names).alias("toponyms"), "types", "links", related.alias("relations"), temporal.lifespan(year("start"), year("end")).alias("spans"))


def authority_links(lines: DataFrame) -> DataFrame:
    """(record, place_id, exact) of authority records in JSON lines (@id, exact[], close[] of URIs): those that name a place of two known sources."""
    r = lines.select(F.from_json("value", "`@id` string, exact array<string>, close array<string>").alias("r")).where("r is not null")
    each = r.select(F.col("r.@id").alias("record"), F.explode(F.concat(_flagged("r.exact", True), _flagged("r.close", False))).alias("x"))
    uri = F.col("x.uri")
    gn, wd = F.regexp_extract(uri, r"geonames\.org/(\d+)", 1), F.regexp_extract(uri, r"wikidata\.org/(?:entity|wiki)/(Q\d+)", 1)
    place = F.when(gn != "", F.concat(F.lit("gn:"), gn)).when(wd != "", F.concat(F.lit("wd:"), wd))
    return each.where(place.isNotNull()).groupBy("record", place.alias("place_id")).agg(F.max("x.exact").alias("exact"))


def _flagged(column: str, exact: bool) -> Column:
    none = F.array().cast("array<struct<uri:string,exact:boolean>>")
    return F.coalesce(F.transform(column, lambda u: F.struct(u.alias("uri"), F.lit(exact).alias("exact"))), none)


#: A quoted text with its escapes, and a tuple of such texts and plain values.
_TEXT = r"'(?:[^'\\]|\\.|'')*'"


def sql_rows(lines: DataFrame, table: str) -> DataFrame:
    """(fields) of the tuples that INSERT lines of an SQL dump give a table, as lists of text; NULL is null, escapes are undone."""
    begin = rf"(?i)^\s*INSERT\s+INTO\s+[`\"]?{table}[`\"]?[^'(]*(?:\([^)]*\)\s*)?VALUES\s*"
    body = F.regexp_replace("value", begin, "")
    tuples = F.regexp_extract_all(body, F.lit(rf"\((?:[^()']|{_TEXT})*\)"), 0)
    raw = lambda t: F.regexp_extract_all(F.substring(t, F.lit(2), F.length(t) - 2), F.lit(rf"\s*({_TEXT}|[^,']+)\s*(?:,|$)"), 1)

    def value(x: Column) -> Column:
        x = F.trim(x)
        inner = F.regexp_replace(F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit("''"), F.lit("'")), r"\\(.)", "$1")
        return F.when(F.startswith(x, F.lit("'")), inner).when(F.upper(x) != "NULL", x)

    return lines.where(F.col("value").rlike(begin)).select(F.explode(tuples).alias("t")).select(F.transform(raw(F.col("t")), value).alias("fields"))


def looked_up(units: DataFrame, names: DataFrame, priority: list[str]) -> DataFrame:
    """Units (unit, start, end) with their names (unit, name, kind) in order of the kinds' priority, then name, the first as title, and their lifespan."""
    rank = F.coalesce(*(F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(priority)), F.lit(len(priority)))
    listed = names.groupBy("unit").agg(F.array_sort(F.collect_set(F.struct(rank.alias("r"), "name"))).alias("n"))
    out = units.join(listed, "unit", "left").withColumn("names", F.array_distinct(F.transform("n", lambda x: x["name"])))
    return out.select("unit", F.get("names", F.lit(0)).alias("title"), "names", temporal.lifespan(F.col("start"), F.col("end")).alias("spans"))


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Rows of a delimited file with a header, in any encoding; malformed ones are dropped."""
    return spark.read.schema(schema).options(header=True, sep=sep, encoding=encoding, mode="DROPMALFORMED", multiLine=encoding != "UTF-8").csv(path)


def census_documents(snapshots: DataFrame) -> DataFrame:
    """One document per unit of (unit, year, name, rings): a geometry for each census, and each name from its first to its last, both bounded by the censuses of the series around them."""
    series = snapshots.select("year").distinct().withColumn("all", F.lit(1))
    w = W.partitionBy("all").orderBy("year")  # of the census years, a few dozen
    near = series.select("year", F.lag("year").over(w).alias("before"), F.coalesce(F.lead("year").over(w), F.col("year") + 10).alias("after"))
    dated = snapshots.join(F.broadcast(near), "year")
    shape = F.struct("year", temporal.bounded(F.col("before"), F.col("year"), F.col("year"), F.col("after")).alias("spans"), "rings")
    shapes = dated.groupBy("unit").agg(F.array_sort(F.collect_list(shape)).alias("geometries"))
    first, last = F.min(F.struct("year", "before")).alias("f"), F.max(F.struct("year", "after")).alias("l")
    used = dated.groupBy("unit", "name").agg(first, last)
    span = temporal.bounded(F.col("f.before"), F.col("f.year"), F.col("l.year"), F.col("l.after"))
    names = used.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("name", span.alias("spans")))).alias("names"))
    return shapes.join(names, "unit")
