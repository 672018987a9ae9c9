"""Inverted lists of vectors around centroids: a search reads the lists nearest to each query.

Centroids are fitted on a bounded sample; every vector is written in the list of its nearest centroid. A folder holds `lists` (list, id, label, e, unit
vectors), cut by list, and `centroids` (list, e). Vectors that are null or zero are in no list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .durable import durable

#: Rows that centroids are fitted on, at most about; lists, at most, so that their centroids can be broadcast; rows of a list that one task compares.
SAMPLE, LISTS, BLOCK = 20_000, 4096, 16_384


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def usable(e: Column) -> Column:
    return F.coalesce(F.exists(e, lambda v: v != 0) & ~F.exists(e, lambda v: v.isNull() | F.isnan(v)), F.lit(False))


def centroids_of(vectors: DataFrame, lists: int, sample: int = SAMPLE, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centroids by rounds of nearest assignment on about `sample` rows chosen by hash."""
    n = vectors.count()
    share = min(1.0, sample / max(1, n))
    x = vectors.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("id", "e").toArrow().sort_by("id")
    if not len(x):
        return np.zeros((0, 0), np.float32)
    x = unit(matrix(x["e"]))
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.sqrt((sums * sums).sum(1))
        c = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], c)
    return c.astype(np.float32)


def assigned(vectors: DataFrame, c: np.ndarray, most: int = 1) -> DataFrame:
    """(list, id, label, e) of vectors (id, label, e): unit, in their `most` nearest lists."""
    held = vectors.sparkSession.sparkContext.broadcast(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch["e"]))
            s = x @ c.T
            near = np.argsort(-s, 1, kind="stable")[:, :most]
            own = np.repeat(np.arange(len(x)), near.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(near.ravel(), pa.int32()), batch["id"].take(pa.array(own)), batch["label"].take(pa.array(own)), pa.array(list(x[own]), pa.list_(pa.float32()))], ["list", "id", "label", "e"])

    rows = vectors.where(usable(F.col("e"))).select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), F.col("e").cast("array<float>").alias("e"))
    return rows.mapInArrow(run, "list int, id long, label int, e array<float>")


def build(vectors: DataFrame, path: str, lists: int | None = None, sample: int = SAMPLE) -> None:
    """Writes the index of vectors (id, label, e); by default the square root of their number of lists."""
    good = vectors.where(usable(F.col("e")))
    n = lists or int(min(LISTS, max(1, round(good.count() ** 0.5))))
    c = centroids_of(good, n, sample)
    spark = vectors.sparkSession
    spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(c)], "list int, e array<float>").write.parquet(f"{path}/centroids")
    append(vectors, path)


def append(vectors: DataFrame, path: str) -> None:
    """Adds vectors to the lists of an index, whose centroids stay."""
    rows = assigned(vectors, centroids(vectors.sparkSession, path))
    rows.hint("rebalance", "list").write.mode("append").partitionBy("list").parquet(f"{path}/lists")


def centroids(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/centroids").toArrow().sort_by("list")
    return matrix(rows["e"]) if len(rows) else np.zeros((0, 0), np.float32)


def search(spark: SparkSession, path: str, queries: DataFrame, k: int, probes: int, least: float = 0.7, keep: Column | None = None) -> DataFrame:
    """(query, id, score, rank): of the vectors in each query's `probes` nearest lists, where `keep` holds, the k with the largest cosines of at least `least`, ties by id; the query's own id left out.

    Lists are read that some query probes, and compared block by block; a query travels to the blocks of its lists.
    """
    asked = durable(assigned(queries, centroids(spark, path), probes).select("list", F.col("id").alias("query"), "e"))
    rows = spark.read.schema("id long, label int, e array<float>, list int").parquet(f"{path}/lists").where(F.col("list").isin([r[0] for r in asked.select("list").distinct().collect()]))
    kept = rows if keep is None else rows.where(keep)
    blocks = kept.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = kept.join(blocks, "list").select("list", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "e")
    sent = asked.join(blocks, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "query", "e")

    def best(key: tuple, own: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(own) and len(wanted):
            ids, x, q = np.asarray(own["id"]), matrix(own["e"]).astype(float), matrix(wanted["e"]).astype(float)
            order = np.argsort(ids)
            ids, x = ids[order], x[order]
            for query, v in zip(wanted["query"].to_pylist(), q, strict=True):
                s = np.round(x @ v, 6)
                near = np.flatnonzero((s >= least) & (ids != query))
                near = near[np.argsort(-s[near], kind="stable")[:k]]
                out += [(query, int(ids[i]), float(s[i])) for i in near]
        a, b, c = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"query": pa.array(a, pa.int64()), "id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    found = dealt.groupBy("list", "block").cogroup(sent.groupBy("list", "block")).applyInArrow(best, "query long, id long, score double")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def scanned(spark: SparkSession, path: str, queries: DataFrame, probes: int) -> DataFrame:
    """(rows, compared): vectors of the index, and how many pairs of a query and a vector a search looks at."""
    sizes = spark.read.parquet(f"{path}/lists").groupBy("list").agg(F.count("*").alias("n"))
    asked = assigned(queries, centroids(spark, path), probes).groupBy("list").agg(F.count("*").alias("q"))
    return sizes.join(asked, "list", "left").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.coalesce("q", F.lit(0))).alias("compared"))
