"""Exact near-duplicate vectors by dual traversal of cover trees.

Unit vectors with cosine >= t lie within sqrt(2 - 2 t) of each other. Equal vectors are one class. Cells around pivots, drawn from a
bounded sample, are the top of the tree; each holds chunks of about `chunk` vectors. A vector goes to another cell only
if its distance to that cell's boundary and its covering radius allow a link. A task gets two chunks, builds a tree of
nested nets with halving radii for each and walks both: node pairs are dropped or linked whole where their covering radii decide,
and compared in double precision where they don't. Tasks return counts and spanning links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import durable, star_components
from .spread import Unions

EPS = 1e-9
LEAF = 256
SAMPLE = 4096


@dataclass
class Node:
    """Points of one node in their tree's order [a, b), its centre, covering radius and children."""

    a: int
    b: int
    centre: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)


def build(x: np.ndarray) -> tuple[np.ndarray, Node]:
    """Order of the points and the root: levels halve the radius, a node's points lie within its level's radius of its centre."""
    order = np.arange(len(x))

    def split(a: int, b: int, level: float) -> Node:
        own = x[order[a:b]]
        centre = own[0]
        d = np.sqrt(np.maximum(0, ((own - centre) ** 2).sum(1)))
        node = Node(a, b, centre, float(d.max()))
        if b - a <= LEAF or node.radius < 1e-12:
            return node
        while level >= node.radius:
            level /= 2
        owner, n = np.full(b - a, -1), 0
        while (rest := np.flatnonzero(owner < 0)).size:  # a net: each new centre covers what is near it
            if n > 8 and (n + rest.size) * 4 > b - a and rest.size * 8 > (b - a) * 7:
                return node  # nothing is near anything: compare directly
            near = ((own[rest] - own[rest[0]]) ** 2).sum(1) <= level * level
            owner[rest[near]] = n
            n += 1
            if n > 64 and n * 16 > (owner >= 0).sum():
                owner[owner < 0] = n
                n += 1
                if (owner == n - 1).all():
                    return node
                break
        by = np.argsort(owner, kind="stable")
        order[a:b] = order[a:b][by]
        edge = a + np.searchsorted(owner[by], np.arange(n + 1))
        node.children = [split(int(s), int(e), level) for s, e in zip(edge[:-1], edge[1:], strict=True)]
        return node

    return order, split(0, len(x), 2.0)


def link(x: np.ndarray, weight: np.ndarray, sides: tuple[int, bool], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the points linked with each, and a label that linked points share.

    sides: (n, False) compares the first n points with the others, (n, True) all with each other (their own weight not counted).
    """
    n, same = sides
    tau = np.sqrt(2 - 2 * cosine)
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    parts = [build(unit)] if same else [build(unit[:n]), build(unit[n:])]
    order = parts[0][0] if same else np.r_[parts[0][0], parts[1][0] + n]
    u, w = unit[order], weight[order]
    count, unions = np.zeros(len(x)), Unions(len(x))
    off = 0 if same else n
    stack = [(parts[0][1], parts[-1][1])]
    while stack:
        p, q = stack.pop()
        if same and p.a > q.a and not (p.a >= q.a and p.b <= q.b):
            continue  # its mirror image is walked
        a, b, c, d = p.a, p.b, q.a + off, q.b + off
        apart = float(np.sqrt(((p.centre - q.centre) ** 2).sum()))
        if apart - p.radius - q.radius > tau + EPS:
            continue
        if apart + p.radius + q.radius < tau - EPS:
            if same and (a, b) == (c, d):
                count[a:b] += w[a:b].sum() - w[a:b]
            else:
                count[a:b] += w[c:d].sum()
                count[c:d] += w[a:b].sum()
            unions.join(a, np.r_[unions.roots(a, b), unions.roots(c, d)])
            continue
        if same and p is q and p.children:
            kids = p.children
            stack.extend((kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids)))
            continue
        if p.children and (not q.children or p.radius >= q.radius):
            stack.extend((k, q) for k in p.children)
            continue
        if q.children:
            stack.extend((p, k) for k in q.children)
            continue
        for s in range(a, b, LEAF):
            e = min(b, s + LEAF)
            near = u[s:e] @ u[c:d].T >= cosine
            if same and p is q:
                near[np.arange(s, e) - s, np.arange(s, e) - c] = False
            if not near.any():
                continue
            count[s:e] += near @ w[c:d]
            if not (same and p is q):
                count[c:d] += w[s:e] @ near
            for i in np.flatnonzero(near.any(1)):
                unions.join(s + int(i), unions.roots(c, d)[near[i]])
    out, label = np.zeros(len(x)), np.zeros(len(x), np.int64)
    out[order], label[order] = count, order[unions.roots(0, len(x))]
    return out, label


def pivots_of(sample: np.ndarray, k: int) -> np.ndarray:
    """k nested-net centres, farthest first: any first m of them are a net of the coarser level."""
    chosen, d = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(k, len(sample)):
        d = np.minimum(d, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        far = int(d.argmax())
        if d[far] <= 1e-18:
            break
        chosen.append(far)
    return sample[chosen]


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, chunk: int = 8192) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    n_links counts other rows within the cosine, equal vectors included; component_id is the smallest vec_id that links reach, its own included;
    kept is vec_id = component_id. Vectors that are null, empty, zero or hold null or non-finite components, and those with a null vec_id,
    link with nothing; vectors link with those of their length only. Repeated rows count as one and give repeated results. Other columns,
    labels among them, are not read.
    """
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"  # as given, so that no copy grows
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    fine = F.coalesce(F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0), F.lit(False))
    good = given.where(fine & F.col("vec_id").isNotNull()).dropDuplicates()
    classes = durable(good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("m")).withColumn("dim", F.size("v")))
    n, parts = classes.count(), 1 << 30
    pick = F.pmod(F.xxhash64("id"), F.lit(parts)) < min(parts, parts * SAMPLE // max(1, n))
    tops: dict[int, np.ndarray] = {}
    sample = classes.where(pick).select("dim", "v").toArrow()
    dims = np.asarray(sample["dim"])
    for dim in np.unique(dims):
        x = np.array(sample["v"].filter(pa.array(dims == dim)).to_pylist(), float)
        tops[int(dim)] = pivots_of(x / np.abs(x).max(1)[:, None] / np.sqrt(((x / np.abs(x).max(1)[:, None]) ** 2).sum(1))[:, None], max(1, min(SAMPLE, -(-n // chunk))))
    tau = float(np.sqrt(2 - 2 * cosine))
    shared = vectors.sparkSession.sparkContext.broadcast(tops)

    def units(batch: pa.RecordBatch) -> list[np.ndarray]:
        flat = batch["v"].flatten().to_numpy(zero_copy_only=False).astype(float)
        out = []
        for x in np.split(flat, np.cumsum(batch["dim"].to_numpy())[:-1]):
            x = x / np.abs(x).max()
            out.append(x / np.sqrt(x @ x))
        return out

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, radius, others = [], [], []
            for x in units(batch) if batch.num_rows else []:
                p = shared.value.get(len(x))
                if p is None:
                    cell.append(0)
                    radius.append(0.0)
                    others.append([])
                    continue
                d2 = np.maximum(0, 2 - 2 * (p @ x))
                c = int(d2.argmin())
                gap = np.sqrt(np.maximum(1e-300, 2 - 2 * (p @ p[c])))
                # Not farther from the bisector of both pivots than a link reaches.
                reach = np.flatnonzero((d2 - d2[c]) / (2 * gap) <= tau + EPS)
                cell.append(c)
                radius.append(float(np.sqrt(d2[c])))
                others.append([int(r) for r in reach if r != c])
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in ("id", "m", "dim", "v")), pa.array(cell, pa.int32()), pa.array(others, pa.list_(pa.int32()))], ["id", "m", "dim", "v", "cell", "others"])

    placed = durable(classes.mapInArrow(cells, f"id long, m long, dim int, v {kind}, cell int, others array<int>"))
    counts = placed.groupBy("dim", "cell").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / chunk)).cast("int").alias("chunks"))
    mine = placed.join(F.broadcast(counts), ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id", F.lit(2)), F.col("chunks")).cast("int"))
    own = mine.withColumn("to", F.explode(F.concat(F.array("cell"), "others")))
    target = counts.select("dim", F.col("cell").alias("to"), F.col("chunks").alias("to_chunks"))
    sent = own.join(F.broadcast(target), ["dim", "to"]).withColumn("to_part", F.explode(F.sequence(F.lit(0), F.col("to_chunks") - 1)))
    here, there = F.struct("cell", "part"), F.struct(F.col("to").alias("cell"), F.col("to_part").alias("part"))
    sent = sent.withColumn("lo", F.least(here, there)).withColumn("hi", F.greatest(here, there)).withColumn("first", F.col("lo") == here)
    tasks = sent.select("dim", F.col("lo.cell").alias("c1"), F.col("lo.part").alias("p1"), F.col("hi.cell").alias("c2"), F.col("hi.part").alias("p2"), "first", "id", "m", "v")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        dim, c1, p1, c2, p2 = (k.as_py() for k in key)
        same = (c1, p1) == (c2, p2)
        table = table.sort_by([("first", "descending"), ("id", "ascending")])
        x = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
        x = x / np.abs(x).max(1)[:, None]
        ids, m = table["id"].to_numpy(), table["m"].to_numpy()
        n = int(np.count_nonzero(np.asarray(table["first"])))
        if not same and (n == 0 or n == len(ids)):
            return pa.table({"id": ids[:0], "links": ids[:0], "to": ids[:0]})
        count, label = link(x, m.astype(float), (n, same), cosine)
        some = count > 0
        return pa.table({"id": ids[some], "links": np.rint(count[some]).astype(np.int64), "to": ids[label[some]]})

    found = durable(tasks.groupBy("dim", "c1", "p1", "c2", "p2").applyInArrow(compare, "id long, links long, to long"))
    totals = found.groupBy("id").agg(F.sum("links").alias("links"))
    labels = star_components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    of_class = classes.join(totals, "id", "left").join(labels.withColumnRenamed("component", "reach"), "id", "left").select("v", "id", "m", "links", "reach")
    component = F.coalesce("reach", "id", "vec_id")
    out = given.where(fine & F.col("vec_id").isNotNull()).join(of_class, "v")
    linked = out.select("vec_id", F.coalesce(F.col("links") + F.col("m") - 1, F.lit(0)).alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
    alone = given.where(~fine | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    return linked.unionByName(alone)
