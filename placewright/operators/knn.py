"""Exact nearest vectors of a stated query set, by matrix products of blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUERIES, VECTORS = 2048, 16384


def blocks(queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows (q, v, side, id, label, e) of each block of queries with each block of vectors, both (id, label, e), dealt by hash.

    A vector travels once for each block of queries, a query once for each block of vectors; no pair is made before the task that measures it.
    """
    n_q, n_v = (max(1, -(-df.count() // size)) for df, size in ((queries, QUERIES), (vectors, VECTORS)))
    own = lambda df, n: df.select("id", "label", F.col("e").cast("array<double>").alias("e"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("own"))
    other = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    a = own(queries, n_q).select(F.col("own").alias("q"), "id", "label", "e", F.lit(0).alias("side"), other(n_v, "v"))
    b = own(vectors, n_v).select(F.col("own").alias("v"), "id", "label", "e", F.lit(1).alias("side"), other(n_q, "q"))
    return a.unionByName(b)


def _sides(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and unit vectors of both sides; a zero vector stays one."""
    out, side = [], np.asarray(table["side"])
    for s in (0, 1):
        t = table.filter(pa.array(side == s))
        x = np.array(t["e"].to_pylist(), float).reshape(len(t), -1)
        size = np.sqrt((x * x).sum(1))
        out.append((np.asarray(t["id"]), np.asarray(t["label"].combine_chunks().fill_null(-1)), x / np.where(size > 0, size, 1)[:, None]))
    return out


def nearest(queries: DataFrame, vectors: DataFrame, k: int, least: float = -1.0) -> DataFrame:
    """(query, id, score): the k vectors with the largest cosines of at least `least`, ties by id, the query's own id left out."""

    def best(key: tuple, table: pa.Table) -> pa.Table:
        (q, _, x), (v, _, y) = _sides(table)
        rows: list[tuple] = []
        if len(q) and len(v):
            order = np.argsort(v)
            v, y = v[order], y[order]
            for i in range(len(q)):
                s = np.round(y @ x[i], 9)
                s[v == q[i]] = -2
                top = np.argsort(-s, kind="stable")[:k] if len(s) <= 4 * k else (p := np.flatnonzero(s >= np.partition(s, -k)[-k]))[np.argsort(-s[p], kind="stable")][:k]
                rows += [(int(q[i]), int(v[j]), float(s[j])) for j in top if s[j] >= max(least, -1.5)]
        a, b, c = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"query": pa.array(a, pa.int64()), "id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    own = blocks(queries, vectors).groupBy("q", "v").applyInArrow(best, "query long, id long, score double")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "id"))
    return own.withColumn("rank", rank).where(F.col("rank") <= k)


def first_right(queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query, rank): the place, among all vectors by falling dot product, then id, of the first with the query's label; null if there is none."""
    product = lambda x, y, i: np.round(y @ x[i], 12)

    def best(key: tuple, table: pa.Table) -> pa.Table:
        (q, ql, x), (v, vl, y) = _sides(table)
        rows = []
        for i in range(len(q) if len(v) else 0):
            s, fine = product(x, y, i), (vl == ql[i]) & (v != q[i])
            if fine.any():
                top = s[fine].max()
                rows.append((int(q[i]), float(top), int(v[fine & (s == top)].min())))
        a, b, c = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"query": pa.array(a, pa.int64()), "s": pa.array(b, pa.float64()), "id": pa.array(c, pa.int64())})

    found = blocks(queries, vectors).groupBy("q", "v").applyInArrow(best, "query long, s double, id long").groupBy("query").agg(F.min(F.struct((-F.col("s")).alias("s"), "id")).alias("b"))
    known = queries.join(found, queries.id == found.query).select("id", "e", F.col("b.id").cast("long").alias("label"), (-F.col("b.s")).alias("s"))
    kept = known.select("id", "label", F.concat(F.col("e").cast("array<double>"), F.array("s")).alias("e"))
    padded = vectors.select("id", "label", F.concat(F.col("e").cast("array<double>"), F.array(F.lit(0.0))).alias("e"))

    def ahead(key: tuple, table: pa.Table) -> pa.Table:
        side = np.asarray(table["side"])
        a, b = table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1))
        rows = []
        if len(a) and len(b):
            x, y, v = np.array(a["e"].to_pylist(), float), np.array(b["e"].to_pylist(), float)[:, :-1], np.asarray(b["id"])
            unit = lambda m: m / np.where((n := np.sqrt((m * m).sum(1))) > 0, n, 1)[:, None]
            x, y, least = unit(x[:, :-1]), unit(y), x[:, -1]
            for i, (query, first) in enumerate(zip(a["id"].to_pylist(), a["label"].to_pylist(), strict=True)):
                s = product(x, y, i)
                rows.append((query, int(((v != query) & ((s > least[i]) | ((s == least[i]) & (v < first)))).sum())))
        q, n = zip(*rows, strict=True) if rows else ((), ())
        return pa.table({"query": pa.array(q, pa.int64()), "n": pa.array(n, pa.int64())})

    counted = blocks(kept, padded).groupBy("q", "v").applyInArrow(ahead, "query long, n long").groupBy("query").agg((F.sum("n") + 1).alias("rank"))
    return queries.select(F.col("id").alias("query")).join(counted, "query", "left")


def retrieval(ranks: DataFrame, at: Column | None = None) -> DataFrame:
    """n, at_1, at_5, at_10, at_20, mrr and mean_rank of (query, rank)."""
    hit = lambda n: F.count_if(F.col("rank") <= n).alias(f"at_{n}")
    return ranks.agg(F.count("*").alias("n"), *map(hit, (1, 5, 10, 20)), F.round(F.avg(F.coalesce(1 / F.col("rank"), F.lit(0.0))), 9).alias("mrr"), F.round(F.avg("rank"), 6).alias("mean_rank"))
