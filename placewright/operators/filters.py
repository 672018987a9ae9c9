"""Predicates of requests on nested places, identifiers and tiles; each is a column, so that Spark pushes down what it can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands for no identifier.
NO_ID = ["none", "null", "undefined", "nan", ""]
#: Columns of a place that a request may name, and which of them are lists.
LISTS = ["names", "ccodes", "types", "geometries", "links", "descriptions", "depictions", "relations", "fclasses", "timespans"]
SCALARS = ["repr_point", "population", "elevation", "boundary"]


def any_country(codes: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap("ccodes", F.array(*map(F.lit, codes))), F.lit(False))


def any_type(field: str, values: list[str]) -> Column:
    """One of the place's types has one of the values in a field."""
    return F.coalesce(F.exists("types", lambda t: t[field].isin(values)), F.lit(False))


def concept_ids(asked: Column) -> Column:
    """Of a list of asked types, the concept ids: numbers, with or without `aat:`."""
    bare = F.transform(asked, lambda t: F.regexp_replace(F.trim(t), "^(?i)aat:", ""))
    return F.transform(F.filter(bare, lambda t: t.rlike(r"^\d+$")), lambda t: t.cast("long"))


def native_types(asked: Column) -> Column:
    """Of a list of asked types, those of sources' own vocabularies."""
    return F.filter(asked, lambda t: ~F.trim(t).rlike(r"^((?i)aat:.*|\d+)$"))


def any_concept(ids: list[int]) -> Column:
    """A type is one of the concepts, by its ids or identifier, or lies below one on any of its paths."""
    named = [x for i in ids for x in (str(i), f"aat:{i}")]
    below = lambda t: F.exists(t["aat_paths"], lambda p: F.arrays_overlap(F.split(p, r"\."), F.array(*(F.lit(str(i)) for i in ids))))
    of = lambda t: F.coalesce(F.exists(t["aat_ids"], lambda i: i.isin(ids)), F.lit(False)) | F.coalesce(t["identifier"].isin(named), F.lit(False)) | F.coalesce(below(t), F.lit(False))
    return F.coalesce(F.exists("types", of), F.lit(False))


def in_scope(own_datasets: list[str]) -> Column:
    """Published, or pending in one of the asker's own datasets."""
    return (F.col("dataset_status") == "published") | (F.coalesce(F.col("dataset_status") == "pending", F.lit(False)) & F.col("dataset_id").isin(own_datasets))


def namespaced(place_id: Column) -> Column:
    """Something on both sides of the first colon, not a word for nothing; a `wd:` id begins with a letter."""
    space, rest = F.substring_index(place_id, ":", 1), F.regexp_extract(place_id, "^[^:]*:(.*)$", 1)
    fine = F.contains(place_id, F.lit(":")) & (space != "") & ~F.lower(rest).isin(NO_ID)
    return F.coalesce(fine & ((space != "wd") | rest.rlike(r"^\p{L}")), F.lit(False))


def has_geometries(kind: Column, members: Column) -> Column:
    """A geometry's type is given; of a collection, members too."""
    return F.coalesce(F.when(kind == "GeometryCollection", F.size(members) > 0).otherwise(kind != ""), F.lit(False))


def requested(docs: DataFrame, fields: list[str] | None, keep: list[str]) -> DataFrame:
    """Lists that weren't asked for become empty, scalars null; those in `keep` and, without a request, all stay."""
    if fields is None:
        return docs
    out = lambda c, t: F.col(c) if c in keep or c in fields else (F.array().cast(t) if t.startswith("array") else F.lit(None).cast(t)).alias(c)
    return docs.select(*(out(c, t).alias(c) for c, t in docs.dtypes))


def source_fields(geometry: str = "repr_point", region: bool = False, clustering: bool = False) -> list[str]:
    """Columns to read of a place: `geometry` is full or repr_point; a region test needs covers, clustering its fuel."""
    out = ["place_id", "namespace", "title", "ccodes", "types", "links", "relations", "toponyms"]
    out += ["geometries"] if geometry == "full" or region else ["repr_point"]
    return out + (["cell", "cover"] if region or clustering else []) + (["aat_ids", "aat_paths", "timespans"] if clustering else [])


def nothing_asked(query: str | None, scope: bool, filters: bool) -> bool:
    """Whether a request can match nothing by itself: no name, no scope and no filter."""
    return not (query or "").strip() and not scope and not filters


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, of the same columns, without a scan."""
    return df.sparkSession.createDataFrame([], df.schema)


def defects(geometries: DataFrame) -> DataFrame:
    """Of each namespace of (namespace, geom_class, has_geom, cover, ccodes): lines and areas without geometry, areas without a cover, rows, and whether none has a country code."""
    shape = F.col("geom_class").isin("area", "line")
    return geometries.groupBy("namespace").agg(
        F.count("*").alias("n"), F.count_if(shape & ~F.coalesce("has_geom", F.lit(False))).alias("dangling"),
        F.count_if((F.col("geom_class") == "area") & (F.coalesce(F.size("cover"), F.lit(0)) <= 0)).alias("uncovered"), F.max(F.coalesce(F.size("ccodes"), F.lit(0)) > 0).alias("coded"),
    )


def tile_bucket(namespace: Column, admin_level: Column, kind: Column, codes: dict[str, list[str]], misc: list[str]) -> Column:
    """The tile set of a place: by its administrative level (0 to 11), by a list of kinds for its source, `misc` of some sources, else by its source."""
    level = admin_level.try_cast("int")
    listed = F.coalesce(*(F.when((namespace == n) & kind.isin(own), F.lit(f"{n}_listed")) for n, own in codes.items()))
    return F.when(level.between(0, 11), F.concat(F.lit("admin_"), level.cast("string"))).otherwise(F.coalesce(listed, F.when(namespace.isin(misc), "misc").otherwise(namespace)))


def first_band(bands: list[tuple[str, Column]]) -> Column:
    """The name of the first band whose condition holds; null if none does."""
    return F.coalesce(*(F.when(c, F.lit(name)) for name, c in bands))


def download(redistributable: Column, records: Column, most: int = 250_000) -> Column:
    """Whether a source may be downloaded, and why not: its licence forbids it (unknown: it doesn't), or it has more records than allowed."""
    allowed, many = F.coalesce(redistributable, F.lit(True)), F.coalesce(records > most, F.lit(False))
    return F.struct((allowed & ~many).alias("downloadable"), F.when(~allowed, "licence-restricted").when(many, "volume-exceeds-cap").alias("reason"))


def request_kind(query: Column, scope: Column, filters: Column) -> Column:
    """How a request is answered: `nothing` without a name, a scope and filters, `spatial` by its scope alone, `filtered` by its filters, else `named`."""
    named = F.coalesce(F.trim(query), F.lit("")) != ""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(named, "named").when(yes(filters), "filtered").when(yes(scope), "spatial").otherwise("nothing")
