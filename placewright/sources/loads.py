"""Loads that can be stopped and taken up again: unchanged sources are skipped, batches are written once, whatever is repeated.

A target folder holds `rows` (space, run, batch, columns), `log` (space, fingerprint, run, done_at) and the streams' checkpoints. A run is named by the
fingerprint of what it reads. A batch that is done again replaces itself; rows count once their run is in the log, so half a run is never seen.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LOG = "space string, fingerprint string, done_at timestamp"


def fingerprint(spark: SparkSession, path: str) -> str:
    """What would change if a source were written anew: its files' number, and names, sizes and times of change, by hash. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    n, h = files.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")), F.lit(0))).first()
    return f"{n}-{int(h) % (1 << 61):x}"


def log(spark: SparkSession, target: str) -> DataFrame:
    """(space, fingerprint, done_at) of the runs that are done; none if there is no log yet."""
    try:
        return spark.read.schema(LOG).parquet(f"{target}/log")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LOG)


def last_runs(runs: DataFrame) -> DataFrame:
    """The last run of each space."""
    return runs.groupBy("space").agg(F.max_by("fingerprint", F.struct("done_at", "fingerprint")).alias("fingerprint"))


def load(spark: SparkSession, sources: dict[str, str], target: str, transform: Callable[[DataFrame], DataFrame], files: int = 100) -> dict[str, str]:
    """`loaded` or `unchanged` for each source: Parquet files of a space, taken `files` at a time through transform. A source whose fingerprint is the last run's isn't read."""
    done = {r.space: r.fingerprint for r in last_runs(log(spark, target)).collect()}
    out = {}
    for space, path in sources.items():
        mark = fingerprint(spark, path)
        if done.get(space) == mark:
            out[space] = "unchanged"
            continue

        def write(batch: DataFrame, k: int, space: str = space, mark: str = mark) -> None:
            transform(batch).write.mode("overwrite").parquet(f"{target}/rows/space={space}/run={mark}/batch={k}")

        given = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)
        stream = given.writeStream.foreachBatch(write).option("checkpointLocation", f"{target}/checkpoints/{space}-{mark}").trigger(availableNow=True).start()
        stream.awaitTermination()
        spark.createDataFrame([(space, mark)], "space string, fingerprint string").withColumn("done_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{target}/log")
        out[space] = "loaded"
    return out


def current(spark: SparkSession, target: str, key: str | None = None) -> DataFrame:
    """Rows of each space's last run; with a key, of rows that repeat it the one of the latest batch."""
    runs = last_runs(log(spark, target)).collect()  # a row for each source
    parts = [spark.read.option("basePath", f"{target}/rows").parquet(f"{target}/rows/space={r.space}/run={r.fingerprint}") for r in runs]
    rows = reduce(DataFrame.unionByName, parts)
    if key:
        last = W.partitionBy("space", key).orderBy(F.col("batch").desc(), F.xxhash64(*[c for c in rows.columns if c not in ("space", "run", "batch")]))
        rows = rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    return rows.drop("run", "batch")
