"""Properties of places as table cells: extraction, wrapping as lists of strings, and the pivot of ids by properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import shapes

#: The names of the properties.
PROPERTIES = (
    "id_short id_object names_canonical names_array names_summary geometry_geojson geometry_wkt geometry_centroid geometry_bbox countries_codes countries_objects "
    "types_objects classes_codes classes_objects temporal_objects temporal_years"
).split()


def wrapped(value: Column, kind: str) -> Column:
    """A list of strings: nothing for null, text itself, numbers as text, objects as JSON, the members of a list each."""
    one = (lambda x, k: x if k == "string" else F.to_json(x) if k.startswith(("struct", "array", "map")) else x.cast("string"))
    if kind.startswith("array<"):
        return F.coalesce(F.transform(value, lambda x: one(x, kind[6:-1])), F.array().cast("array<string>"))
    return F.when(value.isNotNull(), F.array(one(value, kind))).otherwise(F.array().cast("array<string>"))


def _names() -> Column:
    given = F.concat(F.array("title"), F.coalesce(F.col("names"), F.array().cast("array<string>")))
    return F.nullif(F.array_distinct(F.filter(given, lambda x: x.isNotNull() & (x != ""))), F.array().cast("array<string>"))


def _years() -> Column:
    """Distinct (begin, end) of all spans' exact years."""
    pairs = F.transform("spans", lambda s: F.struct(s["start"]["in"].alias("begin"), s["end"]["in"].alias("end")))
    return F.array_distinct(pairs)


def property_column(name: str, country_names: Column, class_names: Column) -> Column | None:
    """A property of places (place_id, title, names, point, rings, ccodes, types, fclasses, spans), null where a place lacks it; null for other names."""
    label = lambda names, c: F.coalesce(F.element_at(names, c), c)
    year = lambda y: F.coalesce(y.cast("string"), F.lit("?"))
    dated = F.filter(_years(), lambda s: s["begin"].isNotNull() | s["end"].isNotNull())
    some = lambda a: F.when(F.size(a) > 0, a)
    known = {
        "id_short": F.col("place_id"),
        "id_object": F.struct(F.col("place_id").alias("id"), F.coalesce("title", F.lit("")).alias("label")),
        "names_canonical": F.nullif(F.col("title"), F.lit("")),
        "names_array": F.transform(_names(), lambda x: F.struct(x.alias("toponym"))),
        "names_summary": _names(),
        "geometry_geojson": F.when(F.col("rings").isNotNull(), F.array(shapes.geojson(F.col("rings")))),
        "geometry_wkt": F.when(F.col("rings").isNotNull(), F.array(shapes.wkt(F.col("rings")))),
        "geometry_centroid": F.when(F.col("point").isNotNull(), F.array(F.concat_ws(", ", F.col("point.lat").cast("string"), F.col("point.lon").cast("string")))),
        "geometry_bbox": F.when(F.col("rings").isNotNull(), F.array(F.concat_ws(", ", *(x.cast("string") for x in shapes.box(F.col("rings")))))),
        "countries_codes": some(F.col("ccodes")),
        "countries_objects": some(F.transform("ccodes", lambda c: F.struct(c.alias("code"), label(country_names, c).alias("label")))),
        "types_objects": some(F.transform("types", lambda t: F.struct(*(F.coalesce(t[f], F.lit("")).alias(f) for f in ("identifier", "label", "sourceLabel"))))),
        "classes_codes": some(F.col("fclasses")),
        "classes_objects": some(F.transform("fclasses", lambda c: F.struct(c.alias("code"), F.coalesce(F.element_at(class_names, c), F.lit("Unknown")).alias("label")))),
        "temporal_objects": some(_years()),
        "temporal_years": some(F.transform(dated, lambda s: F.concat(year(s["begin"]), F.lit("-"), year(s["end"])))),
    }
    return known.get(name)


def extend(places: DataFrame, ids: DataFrame, properties: list[str], country_names: Column, class_names: Column) -> DataFrame:
    """(pos, asked, property, cell) of each asked id (pos, asked) and property: the cell is a list of strings, empty where the place or the property isn't there."""
    schema = {}
    for p in properties:
        c = property_column(p, country_names, class_names)
        schema[p] = (c, places.select(c.alias("x")).dtypes[0][1]) if c is not None else None
    cells = [F.struct(F.lit(p).alias("property"), (wrapped(*schema[p]) if schema[p] else F.array().cast("array<string>")).alias("cell")) for p in properties]
    found = places.select("place_id", F.array(*cells).alias("cells"))
    none = F.array(*(F.struct(F.lit(p).alias("property"), F.array().cast("array<string>").alias("cell")) for p in properties))
    asked = ids.withColumn("place_id", F.regexp_replace("asked", "^place:", ""))
    return asked.join(found, "place_id", "left").select("pos", "asked", F.explode(F.coalesce("cells", none)).alias("c")).select("pos", "asked", "c.property", "c.cell")
