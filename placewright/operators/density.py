"""Clusters by density: of points on the map, and of the names of one place."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import space
from . import graph
from .durable import durable, remove, star_components

#: The least cosine of a place's only two names; neighbours that make a name's core distance; the distance below which groups aren't parted.
PAIR, SAMPLES, EPSILON = 0.5, 2, 0.2


def dense(points: DataFrame, km: float, core: int = 2) -> DataFrame:
    """(grp, place_id, cluster) of points (grp, place_id, lon, lat): density clusters within each group, by their least core place; cluster is null for noise.

    A place is core if `core` places, itself included, are within km of it. Core places within km of each other are of one cluster; another
    place is of its nearest core's, ties by id. Places of one position are one point with their number as its weight, so a popular one makes no pairs.
    Places without a position are noise.
    """
    own = points.where("lon is not null and lat is not null").withColumn("grp", F.coalesce(F.col("grp").cast("string"), F.lit("")))
    spots = durable(own.groupBy("grp", "lon", "lat").agg(F.count("*").alias("weight"), F.min("place_id").alias("spot")))
    key = F.struct("grp", "spot")
    near = durable(graph._spots_within(spots.select(key.alias("place_id"), "lon", "lat", "grp"), km, space.haversine_km, by="grp"))
    both = near.select(F.col("place_id").alias("a"), F.col("other").alias("b"), "km").unionByName(near.select(F.col("other").alias("a"), F.col("place_id").alias("b"), "km"))
    weights = spots.select(key.alias("id"), "weight")
    reached = both.join(weights.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.sum("weight").alias("more"))
    cores = durable(weights.join(reached.withColumnRenamed("a", "id"), "id", "left").where(F.col("weight") + F.coalesce("more", F.lit(0)) >= core).select("id"))
    to_core = both.join(cores.withColumnRenamed("id", "b"), "b")
    joined = star_components(to_core.join(cores.withColumnRenamed("id", "a"), "a", "left_semi").select("a", "b"))
    of = durable(cores.join(joined, "id", "left").select("id", F.coalesce("component", "id").alias("cluster")))
    edge = to_core.join(cores.withColumnRenamed("id", "a"), "a", "left_anti").groupBy("a").agg(F.min(F.struct("km", "b")).alias("to"))
    border = edge.select(F.col("a").alias("place"), F.col("to.b").alias("id")).join(of, "id").select(F.col("place").alias("id"), "cluster")
    known = of.unionByName(border).select("id.grp", "id.spot", F.col("cluster.spot").alias("cluster"))
    placed = own.join(spots.select("grp", "lon", "lat", "spot"), ["grp", "lon", "lat"]).join(known, ["grp", "spot"], "left").select("grp", "place_id", "cluster")
    out = durable(placed.unionByName(points.where("lon is null or lat is null").select(F.coalesce(F.col("grp").cast("string"), F.lit("")).alias("grp"), "place_id", F.lit(None).cast("string").alias("cluster"))))
    for t in (spots, near, cores, of):
        remove(t)
    return out


def coherent_clusters(scored: DataFrame, points: DataFrame, least: float = 0.4, wide_km: float = 100.0, near_km: float = 50.0, core: int = 2) -> DataFrame:
    """(place_id, cluster) of pairs (place_a, place_b, score) at or above `least`, joined by links; a cluster whose corners are more than wide_km apart is split by density.

    Noise stands alone. Places without a position go with the largest part of their cluster, ties by its least place. The id is a hash of the least place.
    """
    links = scored.where(F.col("score") >= least).select(F.col("place_a").alias("a"), F.col("place_b").alias("b"))
    first = star_components(links)
    at = durable(first.join(points.select(F.col("place_id").alias("id"), "lon", "lat"), "id", "left"))
    reach = at.groupBy("component").agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"))
    wide = durable(reach.where(space.haversine_km(F.col("w"), F.col("s"), F.col("e"), F.col("n")) > wide_km).select("component"))
    parted = dense(at.join(wide, "component", "left_semi").select(F.col("component").alias("grp"), F.col("id").alias("place_id"), "lon", "lat"), near_km, core)
    sizes = parted.where("cluster is not null").groupBy("grp", "cluster").agg(F.count("*").alias("n"))
    main = sizes.groupBy("grp").agg(F.min(F.struct((-F.col("n")).alias("n"), "cluster")).alias("m")).select("grp", F.col("m.cluster").alias("main"))
    lost = at.where("lon is null or lat is null").select(F.col("id").alias("place_id"))
    told = parted.join(lost.withColumn("lost", F.lit(True)), "place_id", "left").join(main, "grp", "left")
    split = told.select(F.col("place_id").alias("id"), F.coalesce("cluster", F.when(F.col("lost"), F.col("main")), "place_id").alias("component"))
    whole = at.join(wide, "component", "left_anti").select("id", "component").unionByName(split)
    return whole.select(F.col("id").alias("place_id"), F.concat(F.lit("c_"), F.substring(F.sha2("component", 256), 1, 16)).alias("cluster"))


def spellings(names: DataFrame, pair: float = PAIR, samples: int = SAMPLES, epsilon: float = EPSILON) -> DataFrame:
    """(place_id, toponym_id, spelling): names of a place (place_id, toponym_id, vector) grouped by density of cosine distances, by their least id.

    Two names are one spelling from a cosine of `pair` on; three or more by hierarchical density, see density_groups(). Noise and names
    without a vector stand alone. A place's names come together in one task, which holds their vectors and a row of distances.
    """
    known = names.where("vector is not null").select("place_id", "toponym_id", "vector")

    def group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("toponym_id", ignore_index=True)
        x = np.array(rows["vector"].tolist(), float)
        size = np.sqrt((x * x).sum(1))
        unit = x / np.where(size > 0, size, 1)[:, None]
        ids = rows["toponym_id"].tolist()
        if len(ids) == 2:
            label = np.zeros(2, int) if size.all() and unit[0] @ unit[1] >= pair else np.array([-1, -1])
        else:
            label = density_groups(unit, samples, epsilon) if len(ids) > 2 else np.array([-1])
        least: dict[int, str] = {}
        for i, k in zip(ids, label.tolist(), strict=True):
            least.setdefault(k, i)
        return pd.DataFrame({"place_id": rows["place_id"], "toponym_id": ids, "spelling": [i if k < 0 else least[k] for i, k in zip(ids, label.tolist(), strict=True)]})

    kind = lambda c: names.schema[c].dataType.simpleString()
    found = known.groupBy("place_id").applyInPandas(group, f"place_id {kind('place_id')}, toponym_id {kind('toponym_id')}, spelling {kind('toponym_id')}")
    return found.unionByName(names.where("vector is null").select("place_id", "toponym_id", F.col("toponym_id").alias("spelling")))


def spanning_tree(unit: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (n - 1, 2) and weights, ascending, of a least spanning tree of mutual reachability: the largest of two points' cosine distance and core distances."""
    n = len(unit)
    far = lambda i: np.maximum(0.0, 1 - unit @ unit[i])
    core = np.array([np.partition(np.where(np.arange(n) == i, 0.0, far(i)), min(samples, n - 1))[min(samples, n - 1)] for i in range(n)])
    best, at, left = np.full(n, np.inf), np.zeros(n, int), np.ones(n, bool)
    edges, weights, i = [], [], 0
    for _ in range(n - 1):
        left[i] = False
        d = np.maximum(np.maximum(far(i), core), core[i])
        closer = left & (d < best)
        best[closer], at[closer] = d[closer], i
        i = int(np.argmin(np.where(left, best, np.inf)))
        edges.append((int(at[i]), i))
        weights.append(best[i])
    order = np.argsort(weights, kind="stable")
    return np.array(edges)[order], np.array(weights)[order]


def density_groups(unit: np.ndarray, samples: int = SAMPLES, epsilon: float = EPSILON) -> np.ndarray:
    """Labels of three or more unit vectors, -1 for noise: the clusters of at least two with the most excess of mass, all of them as one among these; groups that part below epsilon stay one."""
    edges, weights = spanning_tree(unit, samples)
    n = len(unit)
    density = lambda d: 1 / d if d > 0 else np.inf
    up = list(range(n))
    tree: dict[int, tuple[int, int, float]] = {}  # a merge's two parts and its density

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for k, ((a, b), w) in enumerate(zip(edges.tolist(), weights.tolist(), strict=True)):
        x, y = top(a), top(b)
        tree[n + k] = (x, y, density(w))
        up.append(n + k)
        up[x] = up[y] = n + k
    # From the top: where two clusters or more come together they part, single points are lost. All that meets at one distance is one merge.
    born, parts, lost, parent = [0.0], [[]], [[]], [-1]
    stack = [(2 * n - 2, 0)]
    while stack:
        node, c = stack.pop()
        d, todo, met = tree[node][2], [node], []
        while todo:
            m = todo.pop()
            if m >= n and tree[m][2] == d:
                todo += tree[m][:2]
            else:
                met.append(m)
        lost[c] += [(m, d) for m in met if m < n]
        large = [m for m in met if m >= n]
        for m in large:
            if len(large) > 1:
                born.append(d)
                parts.append([])
                lost.append([])
                parent.append(c)
                parts[c].append(len(born) - 1)
            stack.append((m, len(born) - 1 if len(large) > 1 else c))
    size = [0] * len(born)
    for c in reversed(range(len(born))):
        size[c] = len(lost[c]) + sum(size[p] for p in parts[c])
    gain = lambda d, c: 0.0 if d == born[c] else d - born[c]
    mass, chosen = [0.0] * len(born), [True] * len(born)
    for c in reversed(range(len(born))):
        own = sum(gain(d, c) for _, d in lost[c]) + sum(gain(born[p], c) * size[p] for p in parts[c])
        below = sum(mass[p] for p in parts[c])
        chosen[c] = not below > own
        mass[c] = own if chosen[c] else below
    picked, todo = [], [0]
    while todo:
        c = todo.pop()
        if chosen[c]:
            picked.append(c)
        else:
            todo += parts[c]
    if picked != [0]:  # those that part below epsilon: the first cluster above that came to be at or above it
        raised = set()
        for c in picked:
            while c and 1 / born[c] < epsilon:
                c = parent[c]
            raised.add(c)
        picked = sorted(raised)
    label = np.full(n, -1)
    todo = [(0, -1)]
    while todo:
        c, k = todo.pop()
        k = picked.index(c) if c in picked else k
        for point, d in lost[c]:
            if picked != [0] and k >= 0 and picked[k] or picked == [0] and d >= 1 / epsilon:  # of all points as one cluster, those that are near enough
                label[point] = k
        todo += [(p, k) for p in parts[c]]
    return label
