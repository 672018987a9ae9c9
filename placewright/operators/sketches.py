"""Sketches kept for each day and source, from which distinct counts, quantiles and the most frequent values of any union are answered without the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bits of a distinct sketch (relative error 1.04 / 2**(bits / 2)), size of a quantile sketch (rank error under 1.4 / size**0.95), counts that a part keeps.
BITS, SIZE, KEPT = 12, 200, 1000
DISTINCT_ERROR, RANK_ERROR = 1.04 / 2 ** (BITS / 2), 0.0133


def sketched(rows: DataFrame, parts: list[str], distinct: str, value: str) -> DataFrame:
    """One row for each part (as day and source): rows, a sketch of the distinct values of one column, a sketch of another's quantiles. A few KB, whatever the rows."""
    return rows.groupBy(*parts).agg(F.count("*").alias("n"), F.hll_sketch_agg(distinct, F.lit(BITS)).alias("seen"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SIZE)).alias("spread"))


def merged(sketches: DataFrame, by: list[str], ranks: list[float]) -> DataFrame:
    """(by, n, distinct, quantiles) of sketched() parts put together."""
    one = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("seen").alias("seen"), F.kll_merge_agg_double("spread").alias("spread"))
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("spread", F.lit(r)) for r in ranks])
    return one.select(*by, "n", F.hll_sketch_estimate("seen").alias("distinct"), quantiles.alias("quantiles"))


def frequent(rows: DataFrame, parts: list[str], value: str, kept: int = KEPT) -> DataFrame:
    """(parts, value, n, least): the `kept` most frequent values of each part, and how often any other may occur in it at most."""
    counts = rows.groupBy(*parts, F.col(value).alias("value")).agg(F.count("*").alias("n"))
    ranked = counts.withColumn("r", F.row_number().over(W.partitionBy(*parts).orderBy(F.col("n").desc(), "value")))
    edge = ranked.where(F.col("r") == kept + 1).select(*parts, F.col("n").alias("least"))
    top = ranked.where(F.col("r") <= kept).drop("r")
    same: Column = F.lit(True)
    for p in parts:
        same &= F.col(f"t.{p}").eqNullSafe(F.col(f"e.{p}"))
    return top.alias("t").join(edge.alias("e"), same, "left").select("t.*", F.coalesce("e.least", F.lit(0)).alias("least"))


def most_frequent(kept: DataFrame, by: list[str], parts: list[str], k: int) -> DataFrame:
    """(by, value, low, high): of frequent() parts put together, the k values with the highest counts that are sure, and how often they occur at most."""
    least = kept.select(*{*by, *parts}, "least").distinct().groupBy(*by).agg(F.sum("least").alias("open"))
    sums = kept.groupBy(*by, "value").agg(F.sum("n").alias("low"), F.sum("least").alias("own"))
    ranked = sums.join(least, by) if by else sums.crossJoin(F.broadcast(least))
    bounded = ranked.withColumn("high", F.col("low") + F.col("open") - F.col("own"))
    return bounded.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy(F.col("low").desc(), "value"))).where(F.col("r") <= k).select(*by, "value", "low", "high")
