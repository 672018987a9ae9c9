"""Results written to the shared folder, and components of links, by steps that each start from a written table."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str = "table") -> str:
    """A new folder under spark.checkpoint.dir; only where the session and its context name none and all runs in one process (as in tests), a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isEmpty():
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp())
            held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get()
    return f"{base}/{name}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def durable(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """df, written as Parquet to the shared folder and read back, so that lineage ends and its size is known. A table that it stands in for, itself written here, is deleted."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    if instead_of is not None:
        remove(instead_of)
    return out


def remove(table: DataFrame) -> None:
    """Delete the files of a durable() table that nothing reads any more."""
    spark = table.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(table._folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def star_components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of links (a, b): the smallest id that links reach.

    Large-star and small-star steps alternate until the links stand still, which takes about the logarithm of the longest
    chain. Each step groups by one end with partial aggregation and joins on it, so a star of any size is spread by a broadcast of
    what is measured to be small, or by Spark's skew handling. Null ends and links of an id with itself are left out; no links give no rows.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        joined = both.join(least, "a")
        if large:
            return joined.where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.where("a <> m").select("a", F.col("m").alias("b"))).distinct()

    edges = durable(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before, still = None, edges.isEmpty()
    while not still:
        edges = durable(star(star(edges, True), False), instead_of=edges)
        now = tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first())
        before, still = now, now == before
    roots = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("id"), "component").distinct())
