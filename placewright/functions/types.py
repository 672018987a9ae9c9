"""Dotted paths of a type tree, root first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ancestors(path: Column) -> Column:
    """All prefixes of a path, the path itself last."""
    parts = F.split(path, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "."))


def wu_palmer(a: Column, b: Column) -> Column:
    """Twice the shared prefix over the sum of depths; 0 for an empty path."""
    x, y = F.split(a, r"\."), F.split(b, r"\.")
    both = F.transform(F.sequence(F.lit(1), F.least(F.size(x), F.size(y))), lambda i: (F.slice(x, F.lit(1), i) == F.slice(y, F.lit(1), i)).cast("int"))
    shared = F.aggregate(both, F.lit(0), lambda s, v: s + v)
    return F.when((a == "") | (b == ""), 0.0).otherwise(2 * shared / (F.size(x) + F.size(y)))


def within(path: Column, root: Column) -> Column:
    """The path is root or below it, segment by segment."""
    return (path == root) | F.startswith(path, F.concat(root, F.lit(".")))


def legacy_label(label: Column, known: Column) -> Column:
    """A label without case, brackets and outer space, `other` if nothing is left of it, and the confidence that a map of known labels gives (`none` if it has none)."""
    plain = F.trim(F.regexp_replace(F.lower(label), r"\s*[\[(].*$", ""))
    plain = F.when(plain.rlike(r"\p{L}"), plain).otherwise("other")
    return F.struct(plain.alias("label"), F.coalesce(F.element_at(known, plain), F.lit("none")).alias("confidence"))


def mapping_report(terms: DataFrame, vocabulary: str, mapped: Column) -> DataFrame:
    """Of each vocabulary, its terms, how many are mapped, and their share."""
    out = terms.groupBy(vocabulary).agg(F.count("*").alias("terms"), F.count_if(mapped).alias("mapped"))
    return out.withColumn("share", F.round(F.col("mapped") / F.col("terms"), 6))


def vocabulary_counts(docs: DataFrame, types: str, field: str) -> DataFrame:
    """How often each term stands among the documents' types."""
    return docs.select(F.explode(F.col(types)).alias("t")).groupBy(F.col("t")[field].alias("term")).agg(F.count("*").alias("n"))


def best_wu_palmer(a: Column, b: Column) -> Column:
    """The largest similarity of two lists of paths; 0 if either is empty."""
    return F.coalesce(F.array_max(F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: wu_palmer(x, y))))), F.lit(0.0))
