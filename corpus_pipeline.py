"""Documents to packed training sequences: five stages, each over all rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewright.llm.jaccard import jaccard_components
from placewright.llm.language import identify
from placewright.llm.mixing import apply_mix
from placewright.llm.packing import pack
from placewright.llm.substrings import duplicated_words
from placewright.operators.durable import shared_folder

#: Deviations of a language's fitted texts, below which a document is not taken to be in it.
UNUSUAL = -8.0


def whole(docs: DataFrame) -> DataFrame:
    """The columns that stages read, beside the whole row as one struct, so that columns of any names and types pass untouched."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.struct("*").alias("doc"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and so do those whose trigrams are far from usual in the language found, as in letter junk or a language not learned."""
    good = identify(whole(docs), columns=True).where(F.col("lang_pred").isNotNull() & (F.col("lang_pred") != "und") & (F.col("typical") >= UNUSUAL))
    return good.select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by sets of five-word shingles with a similarity of 0.8 or more, the smallest doc_id stays.

    Documents without words stay, and so do rows without a doc_id, which are never compared. Rows that repeat both doc_id and text are one
    document; rows of a doc_id with different texts are compared like any others. What stays is always a whole row, the first by its other columns as JSON.
    """
    rows = whole(docs).where("doc_id is not null").withColumn("rid", F.xxhash64("doc_id", "text"))
    found = jaccard_components(rows.select(F.col("rid").alias("doc_id"), "text"), k=5, num=80, den=100).select(F.col("doc_id").alias("rid"), "component_id")
    least = found.distinct().join(rows.select("rid", "doc_id").distinct(), "rid").groupBy("component_id").agg(F.min(F.struct("doc_id", "rid")).alias("least"))
    others = [F.col("doc").getField(c).alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    kept = rows.join(least.select("least.rid"), "rid", "left_semi").groupBy("rid").agg(F.min_by("doc", order).alias("doc"))
    return kept.select("doc.*").unionByName(docs.where("doc_id is null"))


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 13-word windows that an earlier document holds go; a document left without words goes with them, a changed one gets its kept text."""
    others = [F.col("doc").getField(c).alias(c) for c in docs.columns if c != "text"]  # a text travels once
    given = whole(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.struct(*others).alias("doc"))
    left = duplicated_words(given, window=13, columns=["doc"]).where("n_words > n_removed")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return left.select(*(new[c].alias(c) if c in new else F.col("doc").getField(c).alias(c) for c in docs.columns))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of each source are taken as its target asks, once or up to three times."""
    return apply_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, piece by piece."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_removal", substring_removal),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Trained models, hashes and tokenizers are beyond SQL; tests/llm/test_pipeline.py checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again."""
    docs, at = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}-{name}")
        docs = spark.read.parquet(f"{at}/{k}-{name}")
    return docs
