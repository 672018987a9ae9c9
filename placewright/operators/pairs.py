"""Pairs of places and names: harvested links, positives and negatives, signals, calibration, training pairs and triplets."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import space, temporal, text, types, vectors
from . import graph, vector_index
from .distinct import FEW, MANY, listed, ordered_pairs
from .durable import durable, star_components

#: Sources whose places links may name; the mix of negatives that are alike in name or near; the least similarity of names in two scripts, and in one.
KNOWN = ["gn", "wd", "osm", "tgn", "gb", "pl", "iv", "nl", "dp", "un"]
MIX, CROSS, SAME = 0.33, 0.35, 0.6


def harvested(places: DataFrame, known: list[str] | None = None) -> DataFrame:
    """Links of (place_id, relations) to places of other known sources, ends in order, with the place's own source."""
    space_of = lambda c: F.split_part(c, F.lit(":"), F.lit(1))
    r = places.where(F.contains("place_id", F.lit(":"))).select("place_id", F.explode("relations").alias("r"))
    target = F.col("r.related_place_id")
    fine = F.col("r.relation_type").isin(graph.IDENTITY) & F.contains(target, F.lit(":")) & (space_of(target) != space_of(F.col("place_id"))) & space_of(target).isin(known or KNOWN)
    return r.where(fine).select(
        F.least("place_id", target).alias("place_a"), F.greatest("place_id", target).alias("place_b"), F.col("r.relation_type").alias("relation_type"),
        F.lit("authority").alias("source_category"), space_of(F.col("place_id")).alias("source_id"),
    )


def record_links(links: DataFrame) -> DataFrame:
    """Links between what one record (record, place_id, exact) names in several sources: sameAs if it is exact about both, else closeMatch."""
    own = durable(links.select("record", "place_id", "exact", F.split_part("place_id", F.lit(":"), F.lit(1)).alias("space")))
    b = listed(own.select("record", F.col("place_id").alias("other"), F.col("exact").alias("too"), F.col("space").alias("beside")), "other", MANY)
    both = ordered_pairs(listed(own, "place_id", FEW), b, "record", "place_id", "other", F.col("space") != F.col("beside"))
    return both.select("record", F.col("place_id").alias("place_a"), F.col("other").alias("place_b"), F.when(F.col("exact") & F.col("too"), "sameAs").otherwise("closeMatch").alias("relation_type"))


def replayed(place_links: DataFrame, matches: DataFrame, attestations: DataFrame, valid) -> DataFrame:
    """Contributors' links as closeMatch (of a valid second id; of matches with their basis), and attestations with their own relation; the source is the contributor."""
    source = F.concat(F.lit("contributor:"), F.col("user_id").cast("string"), F.lit(":legacy_v3_2"))

    def row(df: DataFrame, relation: Column, why: Column) -> DataFrame:
        kept = df.where("place_a is not null and place_b is not null and user_id is not null and place_a <> place_b")
        return kept.select(F.least("place_a", "place_b").alias("place_a"), F.greatest("place_a", "place_b").alias("place_b"), relation.alias("relation_type"), F.lit("contributor").alias("source_category"), source.alias("source_id"), why.alias("justification"))

    out = row(place_links.where(valid(F.col("place_b"))), F.lit("closeMatch"), F.lit("place_link"))
    return out.unionByName(row(matches, F.lit("closeMatch"), F.concat(F.lit("close_match:"), F.coalesce("basis", F.lit(""))))).unionByName(row(attestations, F.col("relation_type"), F.lit("attestation")))


def positives(edges: DataFrame, source: str, n: int, seed: int = 13) -> DataFrame:
    """n linked pairs, chosen by hash: of authorities' sameAs and exactMatch, of contributors, or of both."""
    authority = F.col("relation_type").isin("sameAs", "exactMatch") & (F.col("source_category") == "authority")
    kind = {"authority": authority, "contributor": F.col("source_category") == "contributor", "both": authority | (F.col("source_category") == "contributor")}[source]
    return edges.where(kind).select("place_a", "place_b").distinct().orderBy(F.xxhash64("place_a", "place_b", F.lit(seed)), "place_a", "place_b").limit(n)


def not_coreferent(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs whose ends no chain of identity links joins."""
    of = graph.components(edges.where(F.col("relation_type").isin(graph.IDENTITY)))
    end = lambda c: of.select(F.col("place_id").alias(c), F.col("component").alias(f"_{c}"))
    marked = pairs.join(end("place_a"), "place_a", "left").join(end("place_b"), "place_b", "left")
    return marked.where(~F.coalesce(F.col("_place_a") == F.col("_place_b"), F.lit(False))).select(*pairs.columns)


def assembled(random: DataFrame, named: DataFrame, near: DataFrame, target: int, exclude: DataFrame) -> DataFrame:
    """`target` negatives: pairs of one name and near ones up to their part of the mix, the rest from random pairs, then from what is left; none of `exclude`, each once."""
    hard = int(target * MIX)
    tagged = [d.select("place_a", "place_b", F.lit(i).alias("kind")) for i, d in enumerate((named, near, random))]
    every = tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).join(exclude.select("place_a", "place_b"), ["place_a", "place_b"], "left_anti")
    one = every.groupBy("place_a", "place_b").agg(F.min("kind").alias("kind"))
    ranked = one.withColumn("r", F.row_number().over(W.partitionBy("kind").orderBy(F.xxhash64("place_a", "place_b"), "place_a", "place_b")))
    turn = F.when((F.col("kind") < 2) & (F.col("r") <= hard), F.col("kind")).when(F.col("kind") == 2, 2).otherwise(3)
    return ranked.withColumn("turn", turn).orderBy("turn", "r", "place_a", "place_b").limit(target).select("place_a", "place_b")


def signals(pairs: DataFrame, places: DataFrame) -> DataFrame:
    """name, spatial, temporal and type of each pair by both places' (place_id, vector, lon, lat, start, end, paths): pairs with an unknown place are left out, an unknown signal is 0."""
    end = lambda c, s: places.select(F.col("place_id").alias(c), *(F.col(x).alias(f"{x}_{s}") for x in ("vector", "lon", "lat", "start", "end", "paths")))
    both = pairs.join(end("place_a", "a"), "place_a").join(end("place_b", "b"), "place_b")
    km = space.haversine_km(F.col("lon_a"), F.col("lat_a"), F.col("lon_b"), F.col("lat_b"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return both.select(
        *pairs.columns, zero(vectors.cosine(F.col("vector_a"), F.col("vector_b"))).alias("name"), space.nearness(km).alias("spatial"),
        zero(temporal.overlap(F.col("start_a"), F.col("end_a"), F.col("start_b"), F.col("end_b"))).alias("temporal"), types.best_wu_palmer(F.col("paths_a"), F.col("paths_b")).alias("type"),
    )


def calibrated(features: DataFrame, names: list[str], link: float = 0.15, sample: int = 40_000, l2: float = 1.0, rate: float = 0.5, steps: int = 3000) -> dict[str, float]:
    """Weights of the signals, which add up to 1 - link, from a logistic fit to at most `sample` rows of (signals, label), chosen by hash; the intercept isn't held small."""
    rows = features.orderBy(F.xxhash64(*features.columns)).limit(sample).select(*names, "label").toArrow()
    x = np.c_[np.ones(len(rows)), np.stack([np.asarray(rows[n], float) for n in names], 1)] if len(rows) else np.ones((0, len(names) + 1))
    y, w, free = np.asarray(rows["label"], float), np.zeros(len(names) + 1), np.r_[0.0, np.ones(len(names))]
    for _ in range(steps if len(rows) else 0):
        w -= rate * (x.T @ (1 / (1 + np.exp(-(x @ w))) - y) + l2 * free * w) / len(rows)
    size = np.abs(w[1:])
    share = size / size.sum() if size.sum() else np.full(len(names), 1 / len(names))
    return {**dict(zip(names, (share * (1 - link)).tolist(), strict=True)), "link": link}


def thresholds(theta: Column) -> Column:
    """The cut for queries, and the stricter ones for bridges and syntheses."""
    above = lambda d: F.round(F.least(F.lit(0.99), theta + d), 3)
    return F.struct(F.round(theta, 3).alias("query"), above(0.10).alias("bridge"), above(0.15).alias("synth"))


def clusters(scored: DataFrame, points: DataFrame, least: float = 0.4, wide_km: float = 100.0, near_km: float = 50.0) -> DataFrame:
    """(place_id, cluster) of pairs (place_a, place_b, score) at or above `least`: those that links join; of a cluster wider than wide_km, those that steps of at most near_km join. The cluster's id is a hash of its least place."""
    links = scored.where(F.col("score") >= least).select(F.col("place_a").alias("a"), F.col("place_b").alias("b"))
    first = durable(star_components(links))
    at = first.join(points.select(F.col("place_id").alias("id"), "lon", "lat"), "id")
    reach = at.groupBy("component").agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"))
    wide = reach.where(space.haversine_km(F.col("w"), F.col("s"), F.col("e"), F.col("n")) > wide_km).select("component")
    apart = durable(at.join(wide, "component"))
    steps = graph.pairs_within(apart.select(F.col("id").alias("place_id"), "lon", "lat"), near_km, space.haversine_km)
    own = lambda c, n: apart.select(F.col("id").alias(c), F.col("component").alias(n))
    inside = steps.join(own("place_id", "ca"), "place_id").join(own("other", "cb"), "other").where("ca = cb").select(F.col("place_id").alias("a"), F.col("other").alias("b"))
    second = star_components(inside)
    split = apart.select("id").join(second, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    whole = first.join(wide, "component", "left_anti").select("id", "component").unionByName(split)
    return whole.select(F.col("id").alias("place_id"), F.concat(F.lit("c_"), F.substring(F.sha2("component", 256), 1, 16)).alias("cluster"))


def fuel(places: DataFrame, most: int = 128) -> DataFrame:
    """What a client clusters by, of (place_id, covers, spans, types): the first cells, outer and core years, concept ids and paths, each once and in order."""
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(c)))
    (a, b), (c, d) = temporal.outer_range(F.col("spans")), temporal.core_range(F.col("spans"))
    return places.select(
        "place_id", F.slice(flat("covers"), 1, most).alias("cover"), F.when(F.size("spans") > 0, F.array(a, b)).alias("range"), F.when(c.isNotNull(), F.array(c, d)).alias("core"),
        flat(F.transform("types", lambda t: F.coalesce(t["aat_ids"], F.array().cast("array<bigint>")))).alias("aat_ids"), flat(F.transform("types", lambda t: F.coalesce(t["aat_paths"], F.array().cast("array<string>")))).alias("aat_paths"),
    )


def grouped_names(names: DataFrame, least: float = 0.8, most: int = 50) -> DataFrame:
    """(place_id, toponym_id, spelling): names of a place (place_id, toponym_id, vector), of the first `most` by id, that chains of cosines of at least `least` join, by their least id; others stand alone."""
    ranked = names.withColumn("r", F.row_number().over(W.partitionBy("place_id").orderBy("toponym_id"))).where(F.col("r") <= most).drop("r")
    other = ranked.select("place_id", F.col("toponym_id").alias("b"), F.col("vector").alias("v"))
    near = ranked.join(other, "place_id").where((F.col("toponym_id") < F.col("b")) & (vectors.cosine(F.col("vector"), F.col("v")) >= least))
    key = lambda c: F.struct("place_id", F.col(c).alias("t"))
    joined = star_components(near.select(key("toponym_id").alias("a"), key("b").alias("b"))).select("id.place_id", F.col("id.t").alias("toponym_id"), F.col("component.t").alias("spelling"))
    return names.join(joined, ["place_id", "toponym_id"], "left").select("place_id", "toponym_id", F.coalesce("spelling", "toponym_id").alias("spelling"))


# Training pairs


def candidate_pairs(names: DataFrame, most: int = 50, sample: int = 20) -> DataFrame:
    """Pairs of names of one place, of the first `most` by id: all in two scripts or one language, and of others in one script `sample` per cent, by hash."""
    ranked = names.withColumn("r", F.row_number().over(W.partitionBy("place_id").orderBy("toponym_id"))).where(F.col("r") <= most)
    cols = ["toponym_id", "name", "script", "lang"]
    a = ranked.select("place_id", *(F.col(c).alias(f"{c}_a") for c in cols))
    b = ranked.select("place_id", *(F.col(c).alias(f"{c}_b") for c in cols))
    both = a.join(b, "place_id").where("toponym_id_a < toponym_id_b")
    kept = (F.col("script_a") != F.col("script_b")) | F.coalesce(F.col("lang_a") == F.col("lang_b"), F.lit(False))
    return both.where(kept | (F.conv(F.substring(F.md5(F.concat("toponym_id_a", F.lit("|"), "toponym_id_b")), 1, 8), 16, 10).cast("long") % 100 < sample))


def scored_pairs(pairs: DataFrame) -> DataFrame:
    """Candidate pairs with their similarity, those alike enough for one script or two; each pair of names once."""
    from ..functions import script

    same = F.col("script_a") == F.col("script_b")
    s = F.when(same & (F.col("name_a") == F.col("name_b")), 1.0).otherwise(text.phonetic_similarity(script.alnum(F.col("name_a")), script.alnum(F.col("name_b"))))
    scored = pairs.withColumn("similarity", s).where(F.col("similarity") >= F.when(same, SAME).otherwise(CROSS))
    return scored.groupBy("toponym_id_a", "toponym_id_b").agg(*(F.min(c).alias(c) for c in ("script_a", "script_b", "similarity")))


def strangers(anchors: DataFrame, own: DataFrame, bucket: Column, seed: int, most: int) -> DataFrame:
    """(anchor, step, negative): of names (toponym_id, name, script, places), the first `most` after an anchor that share no place with it, in the order of hashes of its bucket and script.

    The next names in the order of hashes are as good as random ones. Eight are looked at, then for anchors with fewer than `most` twice as many, and
    so on, so no two large sets are crossed: only an anchor that shares a place with nearly every name goes on to the end.
    """
    size = own.groupBy("script", bucket.alias("prefix")).agg(F.count("*").alias("n"))
    keyed = own.withColumn("prefix", bucket).join(size, ["script", "prefix"])
    ranked = durable(keyed.withColumn("at", F.row_number().over(W.partitionBy("script", "prefix").orderBy(F.xxhash64("toponym_id", F.lit(seed)), "toponym_id")) - 1))
    here = ranked.select(F.col("toponym_id").alias("anchor"), "script", "prefix", "n", "at", F.col("places").alias("mine"))
    out, left, first, width = [], durable(anchors.join(here, "anchor").where("n > 1")), 1, 8
    while not left.isEmpty():
        tries = left.withColumn("step", F.explode(F.sequence(F.lit(first), F.least(F.lit(first + width - 1), F.col("n") - 1)))).withColumn("at", (F.col("at") + F.col("step")) % F.col("n"))
        met = tries.join(ranked.select("script", "prefix", "at", F.col("toponym_id").alias("negative"), "places"), ["script", "prefix", "at"])
        fine = met.where(~F.arrays_overlap("mine", "places"))
        out.append(durable(fine.select("anchor", "step", "negative")))
        found = reduce(DataFrame.unionByName, out).groupBy("anchor").agg(F.count("*").alias("found")).where(F.col("found") >= most)
        first, width = first + width, width * 2
        left = durable(left.where(F.col("n") > first).join(found, "anchor", "left_anti"))
    return reduce(DataFrame.unionByName, out) if out else anchors.select("anchor", F.lit(0).alias("step"), F.lit(None).cast("string").alias("negative")).where("false")


def triplets(pairs: DataFrame, names: DataFrame, hard: bool, seed: int = 1) -> DataFrame:
    """(anchor, positive, negative): another name of the same script, if `hard` with the same first two letters, that shares no place with the anchor, chosen by hash; without one, any by hash.

    Negatives are found once an anchor, see strangers(); two are kept, as one of them may be the positive. Only an anchor that shares a
    place with every name of its script is without one, and left out.
    """
    left = durable(pairs.select(F.col("toponym_id_a").alias("anchor"), F.col("toponym_id_b").alias("positive")).distinct())
    own = durable(names.groupBy("toponym_id").agg(F.min("name").alias("name"), F.min("script").alias("script"), F.collect_set("place_id").alias("places")))
    arms = ([F.lower(F.left("name", F.lit(2)))] if hard else []) + [F.lit("*")]
    out = []
    for bucket in arms:
        near = strangers(left.select("anchor").distinct(), own, bucket, seed, 2)
        two = durable(near.groupBy("anchor").agg(F.slice(F.array_sort(F.collect_list(F.struct("step", "negative"))), 1, 2).alias("near")))
        other = F.filter("near", lambda x: x["negative"] != F.col("positive"))
        out.append(durable(left.join(two, "anchor").withColumn("negative", F.get(other, F.lit(0))["negative"]).where("negative is not null").select("anchor", "positive", "negative")))
        left = durable(left.join(out[-1], ["anchor", "positive"], "left_anti"))
    return reduce(DataFrame.unionByName, out)


def bucket_negatives(names: DataFrame, letters: int, seed: int = 1) -> DataFrame:
    """(toponym_id, negative): a name with the same first letters, in the same script and without a common place, chosen by hash as strangers() does. A name without one in its bucket is left out."""
    own = durable(names.groupBy("toponym_id").agg(F.min("name").alias("name"), F.min("script").alias("script"), F.collect_set("place_id").alias("places")))
    near = strangers(own.select(F.col("toponym_id").alias("anchor")), own, F.left("name", F.lit(letters)), seed, 1)
    return near.groupBy(F.col("anchor").alias("toponym_id")).agg(F.min_by("negative", "step").alias("negative"))


def hard_negatives(near: DataFrame, names: DataFrame, seed: int = 1) -> DataFrame:
    """(toponym_id, negative): of the nearest vectors (toponym_id, other), one in the same script and without a common place, chosen by hash."""
    own = names.groupBy("toponym_id").agg(F.min("script").alias("script"), F.collect_set("place_id").alias("places"))
    there = own.select(F.col("toponym_id").alias("other"), F.col("script").alias("s"), F.col("places").alias("p"))
    fine = near.join(own, "toponym_id").join(there, "other").where((F.col("toponym_id") != F.col("other")) & (F.col("script") == F.col("s")) & ~F.arrays_overlap("places", "p"))
    return fine.groupBy("toponym_id").agg(F.min_by("other", F.struct(F.xxhash64("toponym_id", "other", F.lit(seed)), "other")).alias("negative"))


def first_negatives(near: DataFrame, names: DataFrame, seed: int = 1) -> DataFrame:
    """hard_negatives() of names with a list of their nearest each (toponym_id, others): the first by hash is looked at, then for names that it doesn't fit the next two, four and so on, as nearly all need but one."""
    own = durable(names.groupBy("toponym_id").agg(F.min("script").alias("script"), F.collect_set("place_id").alias("places")))
    order = F.array_sort(F.transform("others", lambda o: F.struct(F.xxhash64("toponym_id", o, F.lit(seed)).alias("h"), o.alias("other"))))
    there = own.select(F.col("toponym_id").alias("other"), F.col("script").alias("s"), F.col("places").alias("p"))
    left = durable(near.select("toponym_id", order.alias("order")).join(own, "toponym_id"))
    out, first, width = [], 1, 1
    while not left.isEmpty():
        tries = left.select("toponym_id", "script", "places", F.posexplode(F.slice("order", first, width)).alias("at", "o")).select("toponym_id", "script", "places", "at", F.col("o.other").alias("other"))
        fine = tries.join(there, "other").where((F.col("toponym_id") != F.col("other")) & (F.col("script") == F.col("s")) & ~F.arrays_overlap("places", "p"))
        out.append(durable(fine.groupBy("toponym_id").agg(F.min_by("other", "at").alias("negative"))))
        first, width = first + width, width * 2
        left = durable(left.where(F.size("order") >= first).join(out[-1], "toponym_id", "left_anti"), instead_of=left)
    return reduce(DataFrame.unionByName, out) if out else near.select("toponym_id", F.lit(None).cast("string").alias("negative")).where("false")


def vector_negatives(vectors: DataFrame, names: DataFrame, path: str, k: int = 20, probes: int = 8, seed: int = 1) -> DataFrame:
    """(toponym_id, negative) by hard_negatives() of the k nearest of names' vectors (toponym_id, vector), ties by a hash of the name, through an index that is written at path. A name none of whose neighbours fits is left out.

    Equal vectors are one in the index and as a query, under the least hash of their names. Of its names the first k + 1 alone can be among any name's nearest.
    """
    good = vectors.where(vector_index.usable(F.col("vector"))).withColumn("key", F.unhex(F.md5(F.to_json(F.struct("vector"))))).withColumn("id", F.xxhash64("toponym_id"))
    spots = durable(good.groupBy("key").agg(F.first("vector").alias("e"), F.min("id").alias("spot")))
    keyed = durable(good.select("toponym_id", "id", "key").join(spots.select("key", "spot"), "key").select("toponym_id", "id", "spot"))
    ranked = keyed.withColumn("place", F.row_number().over(W.partitionBy("spot").orderBy("id"))).where(F.col("place") <= k + 1)
    members = durable(ranked.groupBy("spot").agg(F.collect_list(F.struct("id", "toponym_id")).alias("members")))
    asked = spots.select(F.col("spot").alias("id"), F.lit(0).alias("label"), "e")
    vector_index.build(asked, path)
    found = vector_index.search(vectors.sparkSession, path, asked, k, probes, least=-1.0).select("query", F.col("id").alias("spot"), "score")
    found = found.unionByName(spots.select(F.col("spot").alias("query"), "spot", F.lit(1.0).alias("score")))
    each = F.transform("members", lambda m: F.struct((-F.col("score")).alias("far"), m["id"].alias("id"), m["toponym_id"].alias("name")))
    nearest = found.join(members, "spot").groupBy(F.col("query").alias("spot")).agg(F.slice(F.array_sort(F.flatten(F.collect_list(each))), 1, k + 1).alias("near"))
    others = F.transform(F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k), lambda x: x["name"])
    return first_negatives(keyed.join(nearest, "spot").select("toponym_id", others.alias("others")), names, seed)


def balanced(rows: DataFrame, bin_: str, key: str, target: int, least: int, most: int = 3) -> DataFrame:
    """Rows of bins of at least `least`, with a number for each copy: the first `target` of larger ones by hash, and of smaller ones the first again until there are `target`, or `most` times as many."""
    counts = rows.groupBy(F.col(bin_).alias("_bin")).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    ranked = rows.withColumn("_r", F.row_number().over(W.partitionBy(bin_).orderBy(F.md5(F.col(key).cast("string")), key))).where(F.col("_r") <= target)
    sized = ranked.join(counts, F.col(bin_).eqNullSafe(F.col("_bin")))
    wanted = F.least(F.lit(target), F.col("_n") * most)
    copies = F.floor((wanted - F.col("_r")) / F.col("_n")) + 1
    return sized.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), copies).cast("int")))).drop("_bin", "_n", "_r")


def with_features(pairs: DataFrame, features: DataFrame, phase: int) -> DataFrame:
    """Pairs (a, b) with both names' features (toponym_id, vector) and the phase that they train; those without features are left out."""
    end = lambda c, n: features.select(F.col("toponym_id").alias(c), F.col("vector").alias(n))
    return pairs.join(end("a", "vector_a"), "a").join(end("b", "vector_b"), "b").withColumn("phase", F.lit(phase))
