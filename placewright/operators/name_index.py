"""A written index of names: postings of beginnings, n-grams and words in buckets, so that a search reads the buckets of its own grams alone.

A folder holds `postings` (kind, bucket, gram, word, size, toponym_id), cut by kind and bucket, and `names` (bucket, toponym_id, name), cut by bucket. Kinds:
`edge`, the first characters of a name and of its words, up to EDGE; `gram`, runs of two and three characters; `word`, whole words under their first
two letters. More names are appended; a name that is there already changes nothing. Searches give the rows of operators.search.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import script, text

BUCKETS, EDGE = 64, 20


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return (F.crc32(key) % buckets).cast("int")


def append(names: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Writes names (toponym_id, name) behind those of an index, or begins one. Names without an id or a text are left out."""
    # Cutting names takes time, not bytes: a fixed number of tasks share it, however few the bytes.
    tasks = 4 * names.sparkSession.sparkContext.defaultParallelism
    given = names.where("toponym_id is not null and name is not null").select("toponym_id", "name").distinct().repartition(tasks, "toponym_id")
    words, folded = F.col("words"), F.col("folded")
    edge = lambda t: script.edge_ngrams(t, 1, EDGE)
    post = lambda kind, gram, word: F.struct(F.lit(kind).alias("kind"), gram.alias("gram"), word.alias("word"))
    none = F.lit(None).cast("string")
    cut = given.withColumn("folded", script.fold(F.col("name"))).withColumn("words", F.array_distinct(text.tokens(F.col("folded"))))
    # Texts are made distinct kind by kind, by hash; rows of several columns would be compared pair by pair.
    each = F.concat(
        F.transform(F.array_distinct(F.flatten(F.transform(F.array_append(words, folded), edge))), lambda g: post("edge", g, none)),
        F.transform(F.array_distinct(F.concat(text.ngrams(folded, 2), text.ngrams(folded, 3))), lambda g: post("gram", g, none)),
        F.transform(words, lambda w: post("word", F.left(w, F.lit(2)), w)),
    )
    rows = cut.select("toponym_id", F.explode(each).alias("p")).select("p.*", "toponym_id")
    rows = rows.withColumn("bucket", bucket_of(F.col("gram"), buckets)).withColumn("size", F.length("word"))
    # Large buckets are split over tasks, small ones share them.
    rows.hint("rebalance", "kind", "bucket").sortWithinPartitions("kind", "bucket", "gram").write.mode("append").partitionBy("kind", "bucket").parquet(f"{path}/postings")
    given.select(bucket_of(F.col("toponym_id"), buckets).alias("bucket"), "toponym_id", "name").hint("rebalance", "bucket").sortWithinPartitions("bucket", "toponym_id").write.mode("append").partitionBy("bucket").parquet(f"{path}/names")


def postings(spark: SparkSession, path: str, kind: str, grams: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(gram, word, size, toponym_id) of some grams: their buckets alone are listed and read."""
    own = sorted({zlib.crc32(g.encode()) % buckets for g in grams})
    return spark.read.parquet(f"{path}/postings").where((F.col("kind") == kind) & F.col("bucket").isin(own) & F.col("gram").isin(grams)).select("gram", "word", "size", "toponym_id")


def named(spark: SparkSession, path: str, found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """found (toponym_id, ...), a row for each id, with names, from the buckets that its ids fall in; a name appended again is one, once it is found."""
    keyed = found.withColumn("bucket", bucket_of(F.col("toponym_id"), buckets))
    return spark.read.parquet(f"{path}/names").join(keyed, ["bucket", "toponym_id"]).distinct().drop("bucket")


def folded(spark: SparkSession, query: str) -> str:
    return spark.range(1).select(script.fold(F.lit(query))).first()[0]


def starts(spark: SparkSession, path: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """search.starts(): one gram is looked up; a query longer than EDGE is then compared whole."""
    q = folded(spark, query)
    found = named(spark, path, postings(spark, path, "edge", [q[:EDGE]], buckets).select("toponym_id").distinct(), buckets)
    if len(q) > EDGE:
        name = script.fold(F.col("name"))
        found = found.where(F.startswith(name, F.lit(q)) | F.exists(text.tokens(name), lambda t: F.startswith(t, F.lit(q))))
    return found.withColumn("score", F.lit(1.0))


def infix(spark: SparkSession, path: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """search.infix(): names that hold all grams of the query, then compared. A query of one character reads all names."""
    q = folded(spark, query)
    n = min(3, len(q))
    grams = sorted({q[i : i + n] for i in range(len(q) - n + 1)}) if n > 1 else []
    hold = F.contains(script.fold(F.col("name")), F.lit(q))
    if not grams:
        return spark.read.parquet(f"{path}/names").select("toponym_id", "name").distinct().where(hold).withColumn("score", F.lit(1.0))
    ids = postings(spark, path, "gram", grams, buckets).groupBy("toponym_id").agg(F.countDistinct("gram").alias("n")).where(F.col("n") == len(grams)).select("toponym_id")
    return named(spark, path, ids, buckets).where(hold).withColumn("score", F.lit(1.0))


def fuzzy(spark: SparkSession, path: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """search.fuzzy(): words under the first two letters of each query word, of a length that its edits allow, are compared once each, not once a name."""
    wanted = [folded(spark, t) for t in query.lower().split() if t]
    edits = [0 if len(t) <= 2 else 1 if len(t) <= 5 else 2 for t in query.lower().split() if t]
    found = postings(spark, path, "edge", [folded(spark, query)[:EDGE]], buckets).select("toponym_id", F.lit(-1).alias("at"))
    for k, (q, d) in enumerate(zip(wanted, edits, strict=True)):
        near = postings(spark, path, "word", [q[:2]], buckets).where(F.col("size").between(len(q) - d, len(q) + d))
        close = near.select("word").distinct().where(F.levenshtein("word", F.lit(q)) <= d)
        found = found.unionByName(near.join(close, "word", "left_semi").select("toponym_id", F.lit(k).alias("at")))
    hits = found.groupBy("toponym_id").agg(F.countDistinct(F.when(F.col("at") >= 0, F.col("at"))).alias("hits"))
    scored = named(spark, path, hits, buckets).withColumn("score", F.col("hits") * 3.0 + F.when(F.lower("name") == query.lower(), 5.0).otherwise(0.0))
    return scored.where("score > 0").select("toponym_id", "name", "score")
