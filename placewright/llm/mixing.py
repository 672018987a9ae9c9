"""Mixing sources to target weights by Sainte-Laguë apportionment of token blocks, in DataFrame operations only.

Documents are dealt by hash into shards of about `shard_words` words. Within a shard the documents of a source, in seeded order,
are one stream cut into equal blocks of about `block_words` words. A shard's blocks are apportioned by the highest
quotients w / 1, w / 3, w / 5 ..., w being the blocks that the source's target asks of this shard. A quota takes
all blocks as often as it can and the rest by seeded order; a block is taken at most three times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.durable import durable

MOST = 3


def source_targets(sized: DataFrame, most: int = MOST) -> DataFrame:
    """source, source_size, target: weights 1, 2, 3, repeating by code point (null last) share all sizes, none above `most` times its own.

    With sources in order of the share at which they fill up, one is full if the share left for it and those after it
    reaches that; the first that isn't full fixes the share of all others.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double")).withColumn("cap", F.col("source_size") * float(most))
    fills = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after, every = fills.rowsBetween(W.unboundedPreceding, -1), fills.rowsBetween(0, W.unboundedFollowing), fills.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    share = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    shared = weighed.withColumn("share", share).withColumn("full", F.col("cap") <= F.col("share") * F.col("weight"))
    rest = shared.withColumn("rest", F.max(F.when(~F.col("full"), F.col("share"))).over(every))
    return rest.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("rest") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, block_words: int = 64, shard_words: int = 100_000, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, row, ranges [(first, end, copies)] of its words.

    Size is the number of runs without ASCII white space (null text: 0). taken = sum of copies * (end - first) <= 3 * size.
    Null sources are one source, last in order; null or repeated doc_id are documents like others; an empty table gives no rows.
    Results depend on the rows and the seed, not on their order. `row` numbers the documents as read; other columns are not read.
    """
    sized = durable(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
            F.xxhash64("doc_id", "text", F.lit(seed)).alias("h"),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    targets = source_targets(sized)
    same = F.col("source").eqNullSafe(F.col("t_source"))
    dealt = sized.withColumn("shard", F.pmod(F.col("h"), F.lit(shards))).withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))

    stream = W.partitionBy("shard", "key")
    placed = (
        dealt.withColumn("end", F.sum("size").over(stream.orderBy(F.xxhash64("h", F.lit(1)), "doc_id", "row").rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("words", F.sum("size").over(stream))
        .withColumn("blocks", F.greatest(F.lit(1), F.round(F.col("words") / block_words).cast("long")))
    )
    owned = placed.groupBy("shard", "key").agg(F.first("source").alias("source"), F.first("words").alias("words"), F.first("blocks").alias("blocks"))
    asked = owned.where("words > 0").join(F.broadcast(targets.withColumnRenamed("source", "t_source")), same).withColumn("asked", F.col("target") / F.col("source_size") * F.col("blocks"))
    shard = W.partitionBy("shard")
    asked = asked.withColumn("pad", F.count("*").over(shard) / 2 + 2).withColumn("seats", F.round(F.sum("asked").over(shard)).cast("long"))
    asked = asked.withColumn("sure", F.least(MOST * F.col("blocks"), F.greatest(F.lit(0), F.floor(F.col("asked") - F.col("pad")))).cast("long")).withColumn("open", F.col("seats") - F.sum("sure").over(shard))
    # Rounding moves no quota by more than half the shard's sources, so only quotients near it are ranked.
    to = F.least(MOST * F.col("blocks"), F.ceil(F.col("asked") + F.col("pad")).cast("long"))
    seats = asked.withColumn("k", F.explode(F.when(to > F.col("sure"), F.sequence(F.col("sure") + 1, to))))
    first = seats.withColumn("place", F.row_number().over(shard.orderBy((F.col("asked") / (2 * F.col("k") - 1)).desc(), F.xxhash64("key", "shard", "k"), "key"))).where("place <= open")
    won = first.groupBy("shard", "key").agg(F.count("*").alias("won"))
    quotas = asked.join(won, ["shard", "key"], "left").select("shard", "key", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("quota"))

    begin = F.col("end") - F.col("size")
    block = lambda token: F.floor(token * F.col("blocks") / F.col("words")).cast("long")
    edge = lambda b: F.floor((b * F.col("words") + F.col("blocks") - 1) / F.col("blocks")).cast("long")
    cut = placed.join(quotas, ["shard", "key"], "left").withColumn("begin", begin)
    cut = cut.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(block(F.col("begin")), block(F.col("end") - 1)))))
    rank = F.dense_rank().over(stream.orderBy(F.col("block").isNull(), F.xxhash64("block", "shard", "key", F.lit(seed)), "block"))
    copies = F.floor(F.col("quota") / F.col("blocks")) + (rank <= F.col("quota") % F.col("blocks")).cast("int")
    taken = cut.withColumn("copies", F.coalesce(copies, F.lit(0))).withColumn("from", F.greatest(F.col("begin"), edge(F.col("block")))).withColumn("to", F.least(F.col("end"), edge(F.col("block") + 1)))
    piece = F.when(F.col("copies") > 0, F.struct((F.col("from") - F.col("begin")).alias("first"), (F.col("to") - F.col("begin")).alias("end"), F.col("copies").cast("long").alias("copies")))
    per = taken.groupBy("row", "doc_id", "source", "size").agg(
        F.coalesce(F.sum(F.when(F.col("copies") > 0, F.col("copies") * (F.col("to") - F.col("from")))), F.lit(0)).cast("long").alias("taken"), F.sort_array(F.collect_list(piece)).alias("ranges"), F.first("h").alias("h")
    )
    return per.join(F.broadcast(targets.withColumnRenamed("source", "t_source")), same).select("doc_id", "size", "source_size", "target", "taken", "source", "row", "ranges", "h")


def apply_mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mixed documents: a row for each epoch in which words of a document are taken, with these words; other columns stay, whatever their names, and n_chars is set anew."""
    mixed = mix(docs, seed=seed).where("taken > 0").select("h", "row", "size", "ranges")
    keyed = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.col("doc_id").cast("long"), "text", F.lit(seed)).alias("h"))
    # Equal (doc_id, text) share a hash: their plans are paired off in order, one for each of the rows.
    twin = lambda f, by: f.withColumn("twin", F.row_number().over(W.partitionBy("h").orderBy(by)))
    both = twin(keyed, F.col("doc.doc_id")).join(twin(mixed, "row"), ["h", "twin"])
    epochs = both.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.array_max(F.transform("ranges", lambda r: r["copies"])).cast("int") - 1)))
    epochs = epochs.withColumn("own", F.filter("ranges", lambda r: r["copies"] > F.col("epoch")))
    whole = F.aggregate("own", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["first"]) == F.col("size")
    split = F.filter(F.split("doc.text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    part = lambda words: F.flatten(F.transform("own", lambda r: F.slice(words, (r["first"] + 1).cast("int"), (r["end"] - r["first"]).cast("int"))))
    # The words are an argument of a function, so a text is split once, not once a range.
    text = F.when(whole, F.col("doc.text")).otherwise(F.concat_ws(" ", F.transform(F.array(split), part)[0]))
    out = epochs.select("doc", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*(new[c].alias(c) if c in new else F.col("doc").getField(c).alias(c) for c in docs.columns))
