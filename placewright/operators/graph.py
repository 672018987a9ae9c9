"""Hard links between places: harvest, expansion, components, pair signals, thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .distinct import FEW, MANY, listed, ordered_pairs
from .durable import durable, star_components

IDENTITY = ["sameAs", "exactMatch", "closeMatch"]
#: Weights and the link bonus of the calibrated score.
WEIGHTS = {"names": 0.14, "spatial": 0.29, "temporal": 0.361, "type": 0.058, "link": 0.15}


def valid_links() -> Column:
    """Ends in order and different, a known relation and kind of source."""
    return F.coalesce((F.col("place_a") < F.col("place_b")) & F.col("relation_type").isin([*IDENTITY, "distinct"]) & F.col("source_category").isin("authority", "contributor"), F.lit(False))


def insert_or_ignore(store: DataFrame, new: DataFrame) -> DataFrame:
    """New valid links whose key (ends, relation, source) isn't stored, each once."""
    key = ["place_a", "place_b", "relation_type", "source_id"]
    return new.where(valid_links()).join(store.select(*key), key, "left_anti").dropDuplicates(key)


def one_hop(edges: DataFrame, ids: DataFrame, most: int = 2000) -> DataFrame:
    """Edges that touch the ids (place_id): those within them, and up to `most` others in order of ends, relation and source."""
    own = ids.select("place_id").distinct()
    a = edges.join(own.withColumnRenamed("place_id", "place_a").withColumn("in_a", F.lit(1)), "place_a", "left").join(own.withColumnRenamed("place_id", "place_b").withColumn("in_b", F.lit(1)), "place_b", "left")
    near = a.withColumn("inside", F.coalesce(F.col("in_a"), F.lit(0)) + F.coalesce(F.col("in_b"), F.lit(0)) == 2).where("in_a = 1 or in_b = 1").drop("in_a", "in_b")
    out = near.where("not inside").orderBy("place_a", "place_b", "relation_type", "source_id").limit(most)
    return near.where("inside").unionByName(out)


def batch_over_live(batch: DataFrame, live: DataFrame) -> DataFrame:
    """Union of two stores; for equal ends and relation the batch's row wins, then the least source."""
    both = batch.withColumn("rank", F.lit(0)).unionByName(live.withColumn("rank", F.lit(1)))
    first = both.withColumn("place", F.row_number().over(W.partitionBy("place_a", "place_b", "relation_type").orderBy("rank", "source_id")))
    return first.where("place = 1").drop("place", "rank")


def components(edges: DataFrame) -> DataFrame:
    """(place_id, component) of each end: the least id reachable, also of ends linked only with themselves."""
    named = star_components(edges.select(F.col("place_a").alias("a"), F.col("place_b").alias("b"))).withColumnRenamed("id", "place_id")
    alone = edges.where("place_a = place_b").select(F.col("place_a").alias("place_id")).distinct().join(named, "place_id", "left_anti")
    return named.unionByName(alone.withColumn("component", F.col("place_id")))


def youden(scores: DataFrame) -> DataFrame:
    """Of cut points 0.01 to 0.99 for (score, label 0/1), the first with the largest true less false positive rate."""
    cuts = F.transform(F.sequence(F.lit(1), F.lit(99)), lambda i: i / 100)
    counted = scores.withColumn("cut", F.explode(cuts)).groupBy("cut").agg(
        F.count_if((F.col("score") >= F.col("cut")) & (F.col("label") == 1)).alias("tp"), F.count_if((F.col("score") >= F.col("cut")) & (F.col("label") == 0)).alias("fp"),
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"),
    )
    j = counted.withColumn("j", F.round(F.col("tp") / F.col("pos") - F.col("fp") / F.col("neg"), 9))
    return j.orderBy(F.col("j").desc(), "cut").limit(1).select("cut", "j")


def composite(names: Column, spatial: Column, time: Column, kind: Column, linked: Column) -> Column:
    """Weighted signals of a pair, missing ones 0, and a bonus for a link between them."""
    parts = zip(("names", "spatial", "temporal", "type"), (names, spatial, time, kind), strict=True)
    return sum((F.coalesce(c, F.lit(0.0)) * WEIGHTS[n] for n, c in parts), F.lit(0.0)) + F.when(linked, WEIGHTS["link"]).otherwise(0.0)


def pairs_within(points: DataFrame, km: float, distance, by: str | None = None, digits: int | None = None) -> DataFrame:
    """Pairs of points (place_id, lon, lat), of one value of `by` if it is given, within km: equi-joined on rows of latitude and, away from the poles, columns of longitude, then measured. Points of one position are measured as one, and their distance, if `digits` are given, is rounded once."""
    own = [by] if by else []
    known = points.where("lon is not null and lat is not null")
    spots = durable(known.groupBy("lon", "lat", *own).agg(F.min("place_id").alias("place_id")))
    held = durable(known.join(spots.withColumnRenamed("place_id", "spot"), ["lon", "lat", *own]).select("spot", "place_id"))
    apart = durable(_spots_within(spots, km, distance, by).select(F.col("place_id").alias("spot"), F.col("other").alias("to"), "km"))
    alone = spots.select(F.col("place_id").alias("spot"), F.col("place_id").alias("to"), distance(F.col("lon"), F.col("lat"), F.col("lon"), F.col("lat")).alias("km")).where(F.col("km") <= km)
    near = apart.unionByName(apart.select(F.col("to").alias("spot"), F.col("spot").alias("to"), "km")).unionByName(alone)
    if digits is not None:
        near = near.withColumn("km", F.round("km", digits))
    at = listed(held, "place_id", FEW).join(near, "spot").drop("spot").withColumnRenamed("to", "spot")
    return ordered_pairs(at, listed(held.withColumnRenamed("place_id", "other"), "other", MANY), "spot", "place_id", "other").select("place_id", "other", "km")


def _spots_within(points: DataFrame, km: float, distance, by: str | None = None) -> DataFrame:
    """pairs_within() of points no two of which have one position. A point is sent to the cells around it; these copies are dealt to tasks whose number doesn't shrink with their compressed bytes, and never broadcast."""
    step = km / 111.0 * 1.01
    row = F.floor(F.col("lat") / step)
    spread = lambda r: F.least(F.lit(360.0), step / F.greatest(F.lit(1e-3), F.cos(F.radians(F.least(F.lit(89.9), (F.abs(r) + 2) * step)))))
    cols = lambda r: F.greatest(F.lit(1), F.floor(360 / spread(r)))
    col = lambda lon, r: F.pmod(F.floor((lon + 180) / 360 * cols(r)), cols(r))
    around = points.withColumn("r2", F.explode(F.array(row - 1, row, row + 1))).withColumn("c2", F.explode(F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.pmod(col(F.col("lon"), F.col("r2")) + i, cols(F.col("r2")))))))
    own = [by] if by else []
    other = points.select(F.col("place_id").alias("other"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"), row.alias("r2"), *own)
    other = other.withColumn("c2", col(F.col("lon2"), F.col("r2")))
    tasks = max(64, 16 * points.sparkSession.sparkContext.defaultParallelism)
    cell = ["r2", "c2", *own]
    pairs = around.repartition(tasks, *cell).hint("merge").join(other.repartition(tasks, *cell), cell).where(F.col("place_id") < F.col("other"))
    return pairs.withColumn("km", distance(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2"))).where(F.col("km") <= km).select("place_id", "other", "km")


def record_score(names: Column, others: Column, similarity) -> Column:
    """The largest similarity of any name of one record with any of another; 0 if either has none."""
    return F.coalesce(F.array_max(F.flatten(F.transform(names, lambda x: F.transform(others, lambda y: similarity(x, y))))), F.lit(0.0))


def at_thresholds(scores: DataFrame, cuts: list[float]) -> DataFrame:
    """Precision, recall, F1 and F5 of (score, label 0/1) at each cut."""
    each = scores.withColumn("cut", F.explode(F.array(*map(F.lit, cuts))))
    counted = each.groupBy("cut").agg(F.count_if((F.col("score") >= F.col("cut")) & (F.col("label") == 1)).alias("tp"), F.count_if(F.col("score") >= F.col("cut")).alias("found"), F.count_if(F.col("label") == 1).alias("right"))
    f = lambda b: F.round((1 + b * b) * F.col("tp") / (F.col("found") + b * b * F.col("right")), 9)
    return counted.select("cut", F.round(F.col("tp") / F.col("found"), 9).alias("precision"), F.round(F.col("tp") / F.col("right"), 9).alias("recall"), f(1).alias("f1"), f(5).alias("f5"))
