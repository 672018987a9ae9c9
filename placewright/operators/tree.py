"""Type hierarchies of (child, parent) links with several parents: walks, inherited classes, nearest mapped ancestors, what a tree shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .durable import durable


def walk(links: DataFrame, entries: list[int], excluded: list[int] | None = None, depth: int = 32) -> DataFrame:
    """(node, path, depth, ancestors) of all nodes below the entries, level by level: the least depth counts, then the first parent's, then the least id.

    Excluded nodes and what only they lead to are left out. Links may form cycles; levels end with the deepest node, or at `depth`.
    """
    spark, out = links.sparkSession, []
    out_of = F.col("node").isin(excluded or [])
    level = spark.createDataFrame([(n, [i, n]) for i, n in enumerate(entries)], "node long, key array<long>")
    seen = level.where(~out_of).withColumn("depth", F.lit(0))
    level, seen = durable(level.where(~out_of)), durable(seen)
    for d in range(1, depth + 1):
        below = level.join(links.select(F.col("parent").alias("node"), "child"), "node").select(F.col("child").alias("node"), F.concat("key", F.array("child")).alias("key"))
        new = durable(below.where(~out_of).join(seen.select("node"), "node", "left_anti").groupBy("node").agg(F.min("key").alias("key")))
        if new.isEmpty():
            break
        out.append(new)
        seen, level = durable(seen.unionByName(new.withColumn("depth", F.lit(d))), instead_of=seen), new
    ids = F.slice("key", 2, F.size("key") - 1)
    return seen.select("node", F.array_join(ids.cast("array<string>"), ".").alias("path"), "depth", ids.alias("ancestors"))


def ancestors(links: DataFrame, depth: int = 32) -> DataFrame:
    """(node, ancestor, hops) by all parents, the node itself at 0 hops; each ancestor once, at its nearest."""
    pairs = durable(links.select(F.col("child").alias("node")).union(links.select("parent")).distinct().select("node", F.col("node").alias("ancestor"), F.lit(0).alias("hops")))
    for d in range(1, depth + 1):
        up = pairs.where(F.col("hops") == d - 1).join(links.select(F.col("child").alias("ancestor"), "parent"), "ancestor").select("node", F.col("parent").alias("ancestor")).distinct()
        new = durable(up.join(pairs, ["node", "ancestor"], "left_anti").withColumn("hops", F.lit(d)))
        if new.isEmpty():
            break
        pairs = durable(pairs.unionByName(new), instead_of=pairs)
    return pairs


def inherited(links: DataFrame, classes: DataFrame, depth: int = 32) -> DataFrame:
    """(node, classes): the distinct classes, in order, of a node and all its ancestors, by a table (node, class)."""
    of = classes.select(F.col("node").alias("ancestor"), "class")
    return ancestors(links, depth).join(F.broadcast(of), "ancestor").groupBy("node").agg(F.array_sort(F.collect_set("class")).alias("classes"))


def nearest_mapped(links: DataFrame, mapped: DataFrame, depth: int = 4) -> DataFrame:
    """(node, target, hops): what the nearest ancestor in `mapped` (node, target) maps to, of several the least; at most `depth` hops up, the node itself not counted."""
    of = mapped.select(F.col("node").alias("ancestor"), "target")
    hits = ancestors(links, depth).where("hops > 0").join(of, "ancestor")
    return hits.groupBy("node").agg(F.min(F.struct("hops", "ancestor", "target")).alias("b")).select("node", F.col("b.target").alias("target"), F.col("b.hops").alias("hops"))


def children_shown(nodes: DataFrame, path: str, skipped: list[int], promoted: list[int]) -> DataFrame:
    """Nodes (node, path, depth, term, is_place_type) shown below a path: its place-type children; skipped ones give way to theirs, promoted ones stand elsewhere."""
    parts = F.size(F.split(F.lit(path), r"\."))
    below = nodes.where(F.startswith(F.col("path"), F.lit(path + ".")) & F.col("is_place_type"))
    level = F.col("depth") - parts
    direct = below.where((level == 0) & ~F.col("node").isin(skipped) & ~F.col("node").isin(promoted))
    parent = F.element_at(F.split("path", r"\."), -2).cast("long")
    moved = below.where((level == 1) & parent.isin(skipped) & ~F.col("node").isin(promoted))
    return direct.unionByName(moved).orderBy("term", "node")


def find_labels(nodes: DataFrame, words: list[str]) -> DataFrame:
    """Nodes whose term holds all the words, guide terms and bare ids apart."""
    term = F.lower("term")
    hit = F.forall(F.array(*map(F.lit, words)), lambda w: F.array_contains(F.regexp_extract_all(term, F.lit(r"[\p{L}\p{N}]+"), 0), w))
    return nodes.where(hit & ~F.startswith(F.col("term"), F.lit("<")) & ~F.col("term").rlike(r"^aat:\d+$"))


def enriched_types(types: Column, curated: Column, hierarchy: Column, vocabulary: Column) -> Column:
    """Concept ids of a place's types (identifier, label), in order, each once, of those that the hierarchy (id -> path) holds.

    An `aat:` identifier names its concept; else the curated map of identifiers counts, then the vocabulary's map of labels.
    """
    own = lambda t: F.regexp_extract(t["identifier"], r"^aat:(\d+)$", 1).try_cast("long")
    ids = F.transform(types, lambda t: F.coalesce(own(t), F.element_at(curated, t["identifier"]), F.element_at(vocabulary, F.lower(t["label"]))))
    return F.array_distinct(F.filter(ids, lambda i: i.isNotNull() & F.element_at(hierarchy, i).isNotNull()))


def tile_types(paths: Column) -> Column:
    """All segments of dotted paths, each once, in order, as `;a;b;`; null without any."""
    segments = F.array_sort(F.array_distinct(F.flatten(F.transform(paths, lambda p: F.split(p, r"\.")))))
    return F.when(F.size(segments) > 0, F.concat(F.lit(";"), F.array_join(segments, ";"), F.lit(";")))
