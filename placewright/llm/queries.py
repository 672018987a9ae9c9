"""Queries of the numbered operators over their whole tables, and the same in DuckDB's SQL where that can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .covertree import near_duplicates
from .jaccard import jaccard_components
from .language import identify
from .licenses import scan
from .media import describe_media, store_texts
from .merkle import manifest, tampered_text
from .mixing import mix
from .oracles import OP11, OP12
from .ordinal import grade_quality
from .packing import pack
from .privacy import KINDS, personal_data
from .substrings import substring_digest
from .suffixtree import score_texts
from .turns import damaged, repaired_conversations


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def grades(labels: DataFrame) -> DataFrame:
    """Graded ratings of labels: 0 toxic, 1 low quality, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def op1_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.95)


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = describe_media(store_texts(_docs(spark, sf_dir)), tiles=True)
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_docs(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_docs(spark, sf_dir)).drop("ids")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_docs(spark, sf_dir)).drop("spans")


def op7_suffixtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_docs(spark, sf_dir))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digest(_docs(spark, sf_dir), window=13)


def op9_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade_quality(_docs(spark, sf_dir), grades(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_docs(spark, sf_dir), k=4, num=85, den=100)


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired_conversations(given, damaged(given))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(_docs(spark, sf_dir), tampered_text()).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_docs(spark, sf_dir)).select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_covertree, op2_media, op3_mixing, op4_language, op5_packing, op6_licenses, op7_suffixtree, op8_substrings, op9_ordinal, op10_jaccard, op11_turns, op12_merkle, op13_privacy)
}

#: Links to components, by label propagation over a table `links(a, b)` holding both directions.
_REACH = """
, reach(id, component) USING KEY (id) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT links.a, min(reach.component) FROM reach JOIN links ON links.b = reach.id JOIN recurring.reach own ON own.id = links.a
  WHERE reach.component < own.component GROUP BY links.a
)
"""

ORACLES: dict[str, str] = {
    "op1_covertree": r"""
WITH RECURSIVE fine AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), unit AS (SELECT DISTINCT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM fine),
nodes AS (SELECT DISTINCT vec_id AS id FROM unit),
links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM unit x JOIN unit y ON x.vec_id <> y.vec_id
  WHERE list_dot_product(x.v, y.v) / (x.size * y.size) >= 0.95
)""" + _REACH + r"""
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(r.component, e.vec_id)::BIGINT AS component_id, coalesce(e.vec_id = coalesce(r.component, e.vec_id), false) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id LEFT JOIN reach r ON r.id = e.vec_id
""",
    "op8_substrings": r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS key FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split WHERE len(w) >= 13)
), least AS (SELECT key, min(doc_id) AS first FROM windows GROUP BY key),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM (SELECT doc_id, i FROM windows JOIN least USING (key) WHERE first < doc_id)),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split) p ANTI JOIN gone ON gone.doc_id = p.doc_id AND gone.i = p.i GROUP BY p.doc_id
)
SELECT s.doc_id, len(s.w)::BIGINT AS n_words, (len(s.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
""",
    "op10_jaccard": r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM split WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
nodes AS (SELECT doc_id AS id FROM sizes),
links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
)""" + _REACH + r"""
SELECT s.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(r.component, s.doc_id)::BIGINT AS component_id
FROM split s LEFT JOIN sizes n ON n.doc_id = s.doc_id LEFT JOIN reach r ON r.id = s.doc_id
""",
    "op11_turns": OP11,
    "op12_merkle": OP12,
}
