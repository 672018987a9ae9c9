"""Structured Streaming: live links, stage states and event windows, each over an append-only log or a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.durable import shared_folder  # noqa: F401
from ..operators.stages import last_write


def events_stream(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """New Parquet files at a path, at most `files` in a batch."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)


def run_available(stream: DataFrame, path: str) -> DataFrame:
    """Append all that is there now to a Parquet log, exactly once by its checkpoint, and read the log."""
    (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}-checkpoint")
        .trigger(availableNow=True).start(path).awaitTermination()
    )
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def windows(stream: DataFrame, ts: str, width: str, late: str, *keys: str, slide: str | None = None) -> DataFrame:
    """Counts of event-time windows, emitted once the watermark has passed their end; later events are dropped."""
    stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    grouped = stream.withWatermark(ts, late).groupBy(F.window(ts, width, slide).alias("w"), *keys).agg(F.count("*").alias("n"))
    return grouped.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def assertions(stream: DataFrame, a: str, b: str) -> DataFrame:
    """Valid link operations with ordered ends: a link needs two different ends."""
    return stream.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).withColumns({"place_a": F.least(a, b), "place_b": F.greatest(a, b)})


def live(log: DataFrame, key: list[str], order: str, op: str = "op", revoke: str = "revoke") -> DataFrame:
    """Links of a log as they stand: the last operation of each key counts, unless it revokes. Repeated operations change nothing."""
    return last_write(log, key, F.col(order)).where(F.coalesce(F.col(op), F.lit("")) != revoke)


def batch_first(batch: DataFrame, log: DataFrame, key: list[str]) -> DataFrame:
    """The batch table and those live rows that it lacks."""
    return batch.unionByName(log.join(batch.select(*key), key, "left_anti").select(*batch.columns))
