"""Staged rows before they are written, patches on live tables, repairs and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import space

#: States of a dataset.
STATUSES = ("draft", "pending", "published", "private_permanent", "submitted")


def with_dataset(docs: DataFrame, statuses: tuple[str, ...] = STATUSES, contributed: str = "contributed") -> DataFrame:
    """dataset_status defaults to published and dataset_id to the namespace; rows of the contributed namespace must bring both. Unknown states raise."""
    ours = F.col("namespace") != contributed
    status = F.coalesce("dataset_status", F.when(ours, "published"))
    bad = status.isNull() | ~status.isin(*statuses)
    status = F.when(bad, F.raise_error(F.concat(F.lit("dataset_status of "), F.col("place_id")))).otherwise(status)
    return docs.withColumn("dataset_status", status.cast("string")).withColumn("dataset_id", F.coalesce("dataset_id", F.when(ours, F.col("namespace"))))


def compact_lists(docs: DataFrame) -> DataFrame:
    """Empty lists become null, as a columnar file holds absence."""
    return docs.select(*(F.when(F.size(c) > 0, F.col(c)).alias(c) if t.startswith("array") else F.col(c) for c, t in docs.dtypes))


def apply_list_patch(docs: DataFrame, patch: DataFrame, key: str, column: str) -> DataFrame:
    """A patch's list replaces a document's; an empty one removes it, an absent one leaves it."""
    new = patch.select(key, F.col(column).alias("_new"))
    value = F.when(F.col("_new").isNull(), F.col(column)).when(F.size("_new") > 0, F.col("_new"))
    return docs.join(new, key, "left").withColumn(column, value).drop("_new")


def repair_points(docs: DataFrame) -> tuple[DataFrame, Column]:
    """Longitudes folded into [-180, 180) and points beyond the poles dropped; with them, the condition that a row changed."""
    out = docs.withColumns({"_lon": F.col("lon"), "_lat": F.col("lat")})
    off = F.abs("_lat") > 90
    out = out.withColumns({"lon": F.when(~F.coalesce(off, F.lit(False)), F.when(F.col("_lon") == 180, -180.0).otherwise(space.wrap_longitude(F.col("_lon")))), "lat": F.when(~F.coalesce(off, F.lit(False)), F.col("_lat"))})
    changed = ~(F.col("lon").eqNullSafe(F.col("_lon")) & F.col("lat").eqNullSafe(F.col("_lat")))
    return out, changed


def manifest(docs: DataFrame, family: str, columns: list[str]) -> DataFrame:
    """Rows of each family and a digest that doesn't depend on their order: the sum of 32-bit MD5 prefixes."""
    line = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    return docs.groupBy(family).agg(F.count("*").alias("n_rows"), F.sum(F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")).alias("digest"))


def write_staged(docs: DataFrame, path: str, files: int | None = None, by: str | None = None) -> None:
    """Append staged rows as Parquet, by a partition column if named, in a given number of files without a shuffle."""
    out = compact_lists(docs)
    writer = (out.coalesce(files) if files else out).write.mode("append")
    (writer.partitionBy(by) if by else writer).parquet(path)
