"""Vectors in arrays: cosine, quantising to signed bytes and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 if either is zero."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def quantise(a: Column) -> Column:
    """Signed bytes of 127 times each component, halves to even."""
    return F.transform(a, lambda x: F.greatest(F.lit(-128.0), F.least(F.lit(127.0), F.rint(x.cast("double") * 127))).cast("int"))


def dequantise(a: Column) -> Column:
    return F.transform(a, lambda x: x / 127.0)


def pooled(rows: Column, bins: int, width: int) -> Column:
    """The means of a list of vectors in `bins` runs of about equal length, one after the other; an empty run gives zeros, no vectors or only zeros give null."""
    n = F.size(rows)
    edge = lambda i: F.floor(i * n / bins).cast("int")

    def one(i: Column) -> Column:
        part = F.slice(rows, edge(i) + 1, edge(i + 1) - edge(i))
        mean = lambda d: F.when(F.size(part) > 0, F.aggregate(part, F.lit(0.0), lambda s, r: s + r[d]) / F.size(part)).otherwise(0.0)
        return F.array(*(mean(d) for d in range(width)))

    out = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), one))
    return F.when((n > 0) & F.exists(out, lambda x: x != 0), out)
