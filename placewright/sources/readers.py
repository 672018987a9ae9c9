"""Readers of staged tables and outside formats: lines or files in, place rows, patches, triples and features out."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import temporal

#: Stages of a source, the latest first; kinds of alternate names that name no place.
STAGES = ("final", "h3_merged", "boundary_merged", "update_merged", "extract")
NOT_NAMES = ("post", "iata", "icao", "faac", "unlc", "tcid", "abbr")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store Spark reads it from."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table or a file of JSON lines, by its suffix; blank and malformed lines are dropped. JSON needs a schema, so that no pass infers one."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError("JSON lines need a schema")
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def staged(spark: SparkSession, folder: str, namespace: str, schema: str | None = None, stages: Sequence[str] = STAGES) -> DataFrame:
    """The latest stage of a source that exists, Parquet before JSON lines."""
    for stage in stages:
        for suffix in ("parquet", "jsonl"):
            path = f"{folder}/{namespace}_{stage}.{suffix}"
            if exists(spark, path):
                return scan(spark, path, schema)
    raise FileNotFoundError(f"no stage of {namespace} in {folder}")


def _members(member: str | None):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    names = [n for n in z.namelist() if not n.endswith("/")]
                    if member is None and len(names) != 1:
                        raise ValueError(f"{len(names)} members; name one of {names[:9]}")
                    held: list[str] = []
                    with z.open(member or names[0]) as f:
                        for line in io.TextIOWrapper(f, "utf-8", errors="replace", newline="\n"):
                            held.append(line.rstrip("\r\n"))
                            if len(held) == 10_000:
                                yield pa.record_batch({"value": pa.array(held, pa.string())})
                                held = []
                    yield pa.record_batch({"value": pa.array(held, pa.string())})

    return read


def text_lines(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """Lines of text, gzip or zip files as `value`. A zip of several members needs the name of one; each archive is one task."""
    if not path.endswith(".zip"):
        return spark.read.text(path)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_members(member), "value string")


def _fields(lines: DataFrame) -> DataFrame:
    return lines.where("trim(value) <> '' and not startswith(value, '#')").select(F.split("value", "\t", -1).alias("f"))


def _field(i: int) -> Column:
    return F.nullif(F.get("f", F.lit(i)), F.lit(""))


def _toponym(name: Column, lang: Column) -> Column:
    """name@lang; a name that has its language already stays."""
    return F.when(F.contains(name, F.lit("@")), name).otherwise(F.concat(name, F.lit("@"), lang))


def geonames_places(lines: DataFrame, namespace: str = "gn") -> DataFrame:
    """Places of the 19-column table of places. Height is that measured, else that of the terrain model; there are no years.

    Lines without an id or with coordinates that are no numbers are dropped.
    """
    codes = F.filter(F.concat(F.array(F.coalesce(_field(8), F.lit(""))), F.transform(F.split(F.coalesce(_field(9), F.lit("")), ","), lambda c: F.trim(c))), lambda c: c != "")
    kind = F.struct(F.coalesce(_field(7), _field(6)).alias("identifier"), _field(6).alias("label"), F.concat_ws(".", _field(6), _field(7)).alias("sourceLabel"))
    name = _toponym(_field(1), F.lit("und"))
    out = _fields(lines).select(
        F.concat(F.lit(f"{namespace}:"), _field(0)).alias("place_id"), _field(1).alias("title"), F.array_compact(F.array(name)).alias("toponyms"), codes.alias("ccodes"),
        _field(5).try_cast("double").alias("lon"), _field(4).try_cast("double").alias("lat"), F.array(kind).alias("types"),
        F.coalesce(_field(15).try_cast("long"), _field(16).try_cast("long")).alias("elevation"), _field(14).try_cast("long").alias("population"),
    )
    return out.where("place_id is not null and lon is not null and lat is not null")


def geonames_names(lines: DataFrame, namespace: str = "gn") -> DataFrame:
    """One patch per place of the table of alternate names: a preferred name as title, names with their years in use, and relations.

    Each name is kept once, as its first line has it; order is that of the lines' ids. Codes that name no place are skipped.
    """
    lang = F.coalesce(_field(2), F.lit(""))
    relation = F.when(lang == "wkdt", F.struct(F.lit("sameAs").alias("relation_type"), F.concat(F.lit("wd:"), _field(3)).alias("related_place_id"), F.lit("Wikidata").alias("label"))).when(
        lang == "link", F.struct(F.lit("describedBy").alias("relation_type"), _field(3).alias("related_place_id"), F.lit("External Link").alias("label"))
    )
    name = _toponym(_field(3), F.when(lang == "", "und").otherwise(F.replace(lang, F.lit("_"), F.lit("-"))))
    year = lambda i: F.trim(_field(i)).try_cast("long")
    rows = _fields(lines).select(
        F.concat(F.lit(f"{namespace}:"), _field(1)).alias("place_id"), _field(0).try_cast("long").alias("at"), relation.alias("relation"),
        F.when(relation.isNull(), name).alias("toponym_id"), temporal.lifespan(year(8), year(9)).alias("timespans"), (F.coalesce(_field(4), F.lit("")) == "1").alias("preferred"), _field(3).alias("value"), lang.alias("lang"),
    )
    rows = rows.where(F.col("value").isNotNull() & F.col("place_id").isNotNull() & ~F.col("lang").isin(*NOT_NAMES))
    first = rows.groupBy("place_id", "toponym_id", "relation").agg(F.min(F.struct("at", "timespans", "preferred")).alias("x"))
    named, related = F.col("toponym_id").isNotNull(), F.col("relation").isNotNull()
    listed = lambda keep, *fields: F.transform(F.sort_array(F.collect_list(F.when(keep, F.struct("x.at", *fields)))), lambda s: s.dropFields("at"))
    title = F.min_by(F.substring_index("toponym_id", "@", 1), F.when(named & F.col("x.preferred"), F.col("x.at")))
    return first.groupBy("place_id").agg(title.alias("title"), listed(named, "toponym_id", "x.timespans").alias("toponyms_to_add"), listed(related, "relation.*").alias("relations_to_add"))


def ntriples(lines: DataFrame) -> DataFrame:
    """subject, predicate, object, lang, is_uri of N-Triples lines; others are dropped. Escapes of four and eight digits are decoded."""
    pattern = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<[^>]*>)?)\s*\.\s*$'
    g = lambda i: F.regexp_extract("value", pattern, i)
    decoded = F.get(F.from_json(F.concat(F.lit('["'), _wide(g(4)), F.lit('"]')), "array<string>"), F.lit(0))
    uri = g(3) != ""
    return lines.where(F.col("value").rlike(pattern)).select(g(1).alias("subject"), g(2).alias("predicate"), F.when(uri, g(3)).otherwise(F.coalesce(decoded, g(4))).alias("object"), F.nullif(g(5), F.lit("")).alias("lang"), uri.alias("is_uri"))


def _wide(text: Column) -> Column:
    """Escapes of eight hexadecimal digits as their characters; those of four stay. What stands right behind an escaped backslash stays too."""
    parts = F.split(text, r"(?<!\\)\\U(?=[0-9A-Fa-f]{8})")
    more = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p: F.concat(F.decode(F.unhex(F.left(p, F.lit(8))), "UTF-32"), F.substring(p, F.lit(9), F.length(p))))
    return F.when(F.contains(text, F.lit("\\U")), F.concat(F.get(parts, F.lit(0)), F.array_join(more, ""))).otherwise(text)


def two_hop_labels(triples: DataFrame, term: str, literal: str) -> DataFrame:
    """(subject, label, lang): subject -term-> node -literal-> label."""
    terms = triples.where((F.col("predicate") == term) & F.col("is_uri")).select("subject", F.col("object").alias("node"))
    labels = triples.where((F.col("predicate") == literal) & ~F.col("is_uri")).select(F.col("subject").alias("node"), F.col("object").alias("label"), "lang")
    return terms.join(labels, "node").select("subject", "label", "lang")


def geojson_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A row per feature of GeoJSON collections: id, the named properties, the geometry's type and its JSON. A file is one task."""
    schema = f"features array<struct<id:string,properties:struct<{properties}>,geometry:variant>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return rows.select("f.id", "f.properties.*", F.try_variant_get("f.geometry", "$.type", "string").alias("geometry_type"), F.to_json("f.geometry").alias("geometry"))
