"""Queries through written indexes of names and vectors; each builds its index from the whole table first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import knn, name_index, vector_index
from ..operators.durable import shared_folder
from .queries import ORACLES, query
from .views import Views


def _names(v: Views) -> str:
    """An index of all names, written in two parts, the second as names that came later."""
    path = shared_folder(v.spark, "names")
    later = F.crc32("toponym_id") % 4 == 0
    name_index.append(v.t_att.where(~later), path)
    name_index.append(v.t_att.where(later | F.col("toponym_id").endswith("@en")), path)
    return path


@query()
def indexed_prefix_names(v: Views) -> DataFrame:
    return name_index.starts(v.spark, _names(v), "Co").select("toponym_id", "score")


@query()
def indexed_infix_names(v: Views) -> DataFrame:
    return name_index.infix(v.spark, _names(v), "DGE").select("toponym_id")


@query()
def indexed_fuzzy_names(v: Views) -> DataFrame:
    return name_index.fuzzy(v.spark, _names(v), "cold widgat").select("toponym_id", "score")


# The same rows as by a scan of all names.
ORACLES.update({f"indexed_{n}": ORACLES[n] for n in ("prefix_names", "infix_names", "fuzzy_names")})


def _vectors(v: Views) -> tuple[str, DataFrame]:
    e = v.embeddings.select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("e"))
    path = shared_folder(v.spark, "vectors")
    vector_index.build(e, path)
    return path, e


@query()
def indexed_neighbours(v: Views) -> DataFrame:
    """Every vector whose id is divisible by 50 against the index of all."""
    path, e = _vectors(v)
    return vector_index.search(v.spark, path, e.where("id % 50 = 0"), 10, 8).select("query", F.col("id").alias("vec_id"), "score", "rank")


@query()
def indexed_recall(v: Views) -> DataFrame:
    """Vectors three quarters that of an id divisible by 50 and a quarter the next one's, as of a name spelled otherwise: how many of their ten nearest at 0.7 or more the index finds, and the share of all pairs it looks at."""
    path, e = _vectors(v)
    other = e.select((F.col("id") - 1).alias("id"), F.col("e").alias("next"))
    asked = e.where("id % 50 = 0").join(other, "id").select((-F.col("id") - 1).alias("id"), F.lit(0).alias("label"), F.zip_with("e", "next", lambda a, b: a * 0.75 + b * 0.25).alias("e"))
    exact = knn.nearest(asked, e.withColumn("label", F.lit(0)), 10, 0.7).select("query", "id")
    found = vector_index.search(v.spark, path, asked, 10, 8).select("query", "id")
    both = exact.join(found.withColumn("hit", F.lit(1)), ["query", "id"], "left").agg(F.count("*").alias("wanted"), F.count("hit").alias("found"))
    seen = vector_index.scanned(v.spark, path, asked, 8)
    return both.crossJoin(F.broadcast(seen)).crossJoin(F.broadcast(asked.agg(F.count("*").alias("queries")))).select(
        "wanted", "found", F.round(F.try_divide("found", "wanted"), 4).alias("recall"), F.round(F.try_divide("compared", F.col("rows") * F.col("queries")), 4).alias("scanned"))
