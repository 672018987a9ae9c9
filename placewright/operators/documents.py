"""Whole place documents: merging rows of one place, appended lists, inherited links, back-fills, audits and inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Lists of a document and what tells their items apart; relations that name the same place.
IDENTITY = {"toponyms": ["toponym_id"], "types": ["identifier", "label"], "relations": ["relation_type", "related_place_id"], "links": ["type", "identifier"], "ccodes": []}
MATCHES = ("sameAs", "exactMatch", "closeMatch")


def _key(item: Column, fields: list[str]) -> Column:
    return F.struct(*(item[f].alias(f) for f in fields)) if fields else item


def union_by(items: Column, fields: list[str]) -> Column:
    """Items in order, of those with equal fields the first; of plain values, each once."""
    if not fields:
        return F.array_distinct(items)
    keys = F.transform(items, lambda x: _key(x, fields))
    return F.filter(items, lambda x, i: F.array_position(keys, _key(x, fields)) == i + 1)


def append_new(existing: Column, additions: Column, fields: list[str]) -> Column:
    """The existing list and those additions whose fields are all set and stand neither in it nor in an earlier addition."""
    whole = F.filter(additions, lambda x: ~F.exists(F.array(*(x[f].isNull() for f in fields)), lambda n: n))
    keys = F.coalesce(F.transform(existing, lambda x: _key(x, fields)), F.transform(F.slice(additions, 1, 0), lambda x: _key(x, fields)))
    new = F.filter(union_by(whole, fields), lambda x: ~F.array_contains(keys, _key(x, fields)))
    return F.concat(F.coalesce(existing, F.slice(additions, 1, 0)), F.coalesce(new, F.slice(additions, 1, 0)))


def merge_documents(rows: DataFrame, order: str, lists: dict[str, list[str]] | None = None) -> DataFrame:
    """One document per place_id: of each scalar the first that isn't empty, by `order`; lists united in order; geometries with equal content are one, which keeps the first cover that any of them has, and are numbered anew.

    A list that no row has stays null. Rows of one place are one group, so it is meant for the few that a source repeats.
    """
    lists = lists or {k: f for k, f in IDENTITY.items() if k in rows.columns}
    plain = [c for c in rows.columns if c not in (*lists, "geometries", "place_id", order)]
    kinds = dict(rows.dtypes)
    filled = lambda c: F.col(c).isNotNull() & (F.col(c) != "" if kinds[c] == "string" else F.lit(True))
    scalars = [F.min_by(c, F.when(filled(c), F.col(order))).alias(c) for c in plain]
    gathered = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(order, c)))), lambda x: x[c]))
    united = [F.when(F.count(c) > 0, union_by(gathered(c), f)).alias(c) for c, f in lists.items()]
    shapes = [F.when(F.count("geometries") > 0, _merged(gathered("geometries"), rows)).alias("geometries")] if "geometries" in rows.columns else []
    return rows.groupBy("place_id").agg(*scalars, *united, *shapes)


def _merged(items: Column, rows: DataFrame) -> Column:
    fields = [f.name for f in rows.schema["geometries"].dataType.elementType.fields]
    own = [f for f in fields if f not in ("geometry_index", "cell", "cover")]
    first = union_by(items, own)
    salvage = lambda g, f: F.coalesce(g[f], F.get(F.filter(F.transform(F.filter(items, lambda x: _key(x, own) == _key(g, own)), lambda x: x[f]), lambda x: x.isNotNull()), F.lit(0)))
    value = lambda g, i, f: i.cast("int") if f == "geometry_index" else salvage(g, f) if f in ("cell", "cover") else g[f]
    return F.transform(first, lambda g, i: F.struct(*(value(g, i, f).alias(f) for f in fields)))


def inherited_links(places: DataFrame, holders: DataFrame, prefix: str, part: str) -> DataFrame:
    """(place_id, links): a place's links (type, identifier) and those of the records it matches whose ids begin with `prefix` and whose identifier holds `part`, each identifier once."""
    targets = places.select("place_id", F.explode("relations").alias("r")).where(F.startswith("r.related_place_id", F.lit(prefix)) & F.col("r.relation_type").isin(*MATCHES)).select("place_id", F.col("r.related_place_id").alias("from"))
    lent = holders.select(F.col("place_id").alias("from"), F.explode("links").alias("l")).where(F.contains("l.identifier", F.lit(part)))
    given = targets.join(lent, "from").groupBy("place_id").agg(F.array_sort(F.collect_set(F.struct(F.coalesce("l.type", F.lit("seeAlso")).alias("type"), F.col("l.identifier").alias("identifier")))).alias("more"))
    none = F.array().cast("array<struct<type:string,identifier:string>>")
    return places.join(given, "place_id", "left").select("place_id", append_new(F.coalesce("links", none), F.coalesce("more", none), ["identifier"]).alias("links"))


def lent_areas(asked: DataFrame, edges: DataFrame, areas: DataFrame, most: int = 50, relations: tuple[str, ...] = ("sameAs", "exactMatch")) -> DataFrame:
    """Places with an area that are linked as identical with an asked one (place_id) without being asked themselves: the first `most` by id."""
    both = edges.where(F.col("relation_type").isin(*relations)).select(F.col("place_a").alias("place_id"), F.col("place_b").alias("far"))
    both = both.unionByName(both.select(F.col("far").alias("place_id"), F.col("place_id").alias("far")))
    far = both.join(asked, "place_id", "left_semi").select(F.col("far").alias("place_id")).distinct().join(asked, "place_id", "left_anti")
    return far.join(areas.select("place_id"), "place_id", "left_semi").orderBy("place_id").limit(most)


def without_namespaces(docs: DataFrame, selected: list[str]) -> DataFrame:
    """Rows of the selected sources alone."""
    return docs.where(F.col("namespace").isin(selected))


def merged_attestations(live: DataFrame, new: DataFrame, namespace: str) -> DataFrame:
    """Names (toponym_id, attestations, namespaces, primary) after a source is loaded anew: its former attestations go, the new ones come, others stay; a name keeps its primary source if it has one."""
    mine = lambda a: F.startswith(a, F.lit(f"{namespace}:"))
    none = F.array().cast("array<string>")
    both = live.join(new.select("toponym_id", F.col("attestations").alias("fresh")), "toponym_id", "full_outer")
    kept = F.filter(F.coalesce("attestations", none), lambda a: ~mine(a))
    all_of = F.array_sort(F.array_union(kept, F.coalesce("fresh", none)))
    others = F.filter(F.coalesce("namespaces", none), lambda n: n != namespace)
    spaces = F.when(F.col("fresh").isNotNull(), F.array_union(others, F.array(F.lit(namespace)))).otherwise(others)
    return both.select("toponym_id", all_of.alias("attestations"), F.array_sort(spaces).alias("namespaces"), F.coalesce("primary", F.when(F.col("fresh").isNotNull(), F.lit(namespace))).alias("primary"))


def changed(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """Rows of `after` whose column differs from before's, null being a value; rows that are new are left out."""
    old = before.select(key, F.col(column).alias("_before"))
    return after.join(old, key).where(~F.col(column).eqNullSafe(F.col("_before"))).drop("_before")


def filled_points(docs: DataFrame) -> DataFrame:
    """Of rows with a point (lon, lat), what is missing of bounds [w, s, e, n] and cell comes from it."""
    from ..functions.space import cell

    has = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    box = F.when(has, F.array("lon", "lat", "lon", "lat"))
    return docs.withColumns({"bounds": F.coalesce("bounds", box), "cell": F.coalesce("cell", F.when(has, cell(F.col("lon"), F.col("lat"), 14)))})


def dangling(docs: DataFrame, store: DataFrame) -> DataFrame:
    """Rows that claim a geometry (has_geom) that the store (geom_key) doesn't hold."""
    return docs.where("has_geom").join(store.select("geom_key"), "geom_key", "left_anti")


def parity(staged: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """Counts of each key in both tables and their difference, of keys in either."""
    count = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    both = count(staged, "staged").join(count(live, "live"), key, "full_outer")
    out = both.select(key, F.coalesce("staged", F.lit(0)).alias("staged"), F.coalesce("live", F.lit(0)).alias("live"))
    return out.withColumn("difference", F.col("staged") - F.col("live"))


def pending_datasets(docs: DataFrame) -> DataFrame:
    """Of each dataset of (dataset_id, owner, ts): rows, first and last time, and the owner of most rows (the first by name on ties)."""
    per = docs.groupBy("dataset_id", "owner").agg(F.count("*").alias("c"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    best = F.min_by("owner", F.struct(-F.col("c"), F.col("owner")))
    return per.groupBy("dataset_id").agg(F.sum("c").alias("n"), F.min("a").alias("first"), F.max("b").alias("last"), best.alias("owner"))


def barrier(events: DataFrame, required: list[str], passing: tuple[str, ...] = ("completed", "skipped")) -> DataFrame:
    """Of each namespace of (namespace, stage, status, at): whether the last status of every required stage passes, and the stages that don't, in order."""
    last = events.groupBy("namespace", "stage").agg(F.max_by("status", "at").alias("status"))
    good = last.where(F.col("status").isin(*passing)).groupBy("namespace").agg(F.collect_set("stage").alias("good"))
    stages = F.array(*map(F.lit, required))
    missing = F.array_sort(F.array_except(stages, F.coalesce("good", F.array().cast("array<string>"))))
    return events.select("namespace").distinct().join(good, "namespace", "left").select("namespace", (F.size(missing) == 0).alias("passed"), missing.alias("missing"))


def inventory(extents: DataFrame, coverage: DataFrame, counts: DataFrame, key: str = "namespace") -> DataFrame:
    """One row per source with its records, extent and number of cells; what a source lacks is null."""
    return counts.join(extents, key, "left").join(coverage, key, "left")


def batches_by_size(rows: DataFrame, group: str, order: str, size: str, most: int) -> DataFrame:
    """Rows of each group in order, dealt into batches whose sizes add up to at most `most`; a larger row is a batch of its own.

    Each batch begins where the one before is full, so a group is folded as one list: it is meant for inventories of some thousand rows.
    """
    listed = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, size))).alias("rows"))
    start = F.struct(F.lit(0).cast("long").alias("batch"), F.lit(0).cast("long").alias("full"), F.array().cast("array<bigint>").alias("out"))

    def step(state: Column, row: Column) -> Column:
        over = (state["full"] > 0) & (state["full"] + row[size] > most)
        batch = state["batch"] + F.when(over, 1).otherwise(0)
        return F.struct(batch.cast("long").alias("batch"), F.when(over, row[size]).otherwise(state["full"] + row[size]).cast("long").alias("full"), F.concat(state["out"], F.array(batch.cast("long"))).alias("out"))

    folded = listed.withColumn("batches", F.aggregate("rows", start, step)["out"])
    return folded.select(group, F.explode(F.arrays_zip("rows", "batches")).alias("x")).select(group, f"x.rows.{order}", F.col("x.batches").alias("batch"))


def balanced_shards(items: DataFrame, group: str, item: str, cost: str, shards: int, large: int = 0) -> DataFrame:
    """(group, item, shard): the `large` costliest items of a group have shards of their own, numbered first; each other, the costliest first, goes to the shard with the least load.

    A group's items are folded as one list, since each choice depends on all before: it is meant for plans of some thousand items.
    """
    listed = items.groupBy(group).agg(F.array_sort(F.collect_list(F.struct((-F.col(cost)).alias("c"), F.col(item).alias("i")))).alias("all"))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        at = F.array_position(state["load"], F.array_min(state["load"]))
        load = F.transform(state["load"], lambda l, i: F.when(i == at - 1, l - x["c"].cast("long")).otherwise(l))
        return F.struct(load.alias("load"), F.concat(state["out"], F.array(at.cast("int") - 1 + large)).alias("out"))

    rest = F.slice("all", large + 1, 1 << 30)
    own = F.transform(F.slice("all", 1, large), lambda x, i: F.struct(x["i"].alias("i"), i.cast("int").alias("shard")))
    dealt = F.zip_with(rest, F.aggregate(rest, start, step)["out"], lambda x, s: F.struct(x["i"].alias("i"), s.alias("shard")))
    return listed.select(group, F.explode(F.concat(own, dealt) if large else dealt).alias("x")).select(group, F.col("x.i").alias(item), F.col("x.shard").alias("shard"))


def hash_shard(key: Column, shards: int) -> Column:
    """A shard by the first four bytes of the key's MD5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % shards


def sampled(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows with the least seeded hashes of their keys, which reruns choose again."""
    return rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def quotas(pairs: DataFrame, kinds: tuple[str, str], same: Column, order: Column, quota: int, share: float = 0.2) -> DataFrame:
    """Pairs in order, at most `quota` for each two kinds in either order, of which those that are the same at most a share.

    As in one pass that skips what is full: the first of the same kind up to their share, then all in order up to the quota.
    """
    key = [F.least(*kinds).alias("_k1"), F.greatest(*kinds).alias("_k2")]
    marked = pairs.select("*", *key, same.alias("_same"), order.alias("_order"))
    own = W.partitionBy("_k1", "_k2", "_same").orderBy("_order")
    kept = marked.withColumn("_r", F.row_number().over(own)).where(~F.col("_same") | (F.col("_r") <= int(quota * share)))
    every = W.partitionBy("_k1", "_k2").orderBy("_order")
    return kept.withColumn("_r", F.row_number().over(every)).where(F.col("_r") <= quota).drop("_k1", "_k2", "_same", "_order", "_r")
