"""License scans by diagonal voting: word bigrams of all texts joined with template positions, votes counted by offset.

A hit of a text's bigram at word p with a template's at word q votes for diagonal p - q, if the words themselves are equal, not only
their hashes. Neighbouring diagonals merge, so a few inserted or missing words don't break a span; a span is verified by the share of
its template's bigrams that stand there. Templates are names, openings and whole texts of licenses. A phrase, or a template of up to `SHORT` words, needs all its bigrams on one diagonal, which is the phrase itself. Such a template
doesn't count where a longer one that begins with it stands.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .license_texts import OPENINGS, PHRASES, TEXTS
from .spread import small_batches
from .words import ALNUM, rolling, slices, window_starts, words

TEMPLATES = OPENINGS | TEXTS

#: Bigrams of two of these words don't vote for templates; they stand in any text.
COMMON = set("a and any at by for in is it of or that the this to with you".split())
MARK = -1
SHORT = 8


def template_rows(phrases: dict[str, str], templates: dict[str, str]) -> tuple[list[tuple], list[tuple]]:
    """(h, said, tid, tpos) of voting bigrams, and (tid, label, need, phrase, exact, root) of templates, root being the shortest template that they begin with; the row tid -1 marks texts."""
    grams, kinds = [(MARK, None, -1, 0)], []
    own = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    roots = sorted((own(t) for t in templates), key=len)
    for tid, (text, label, phrase) in enumerate([*((t, l, True) for t, l in phrases.items()), *((t, l, False) for t, l in templates.items())]):
        w = own(text)
        h = rolling(words(pa.array([text]), ALNUM, lower=True).hashes, 2).view(np.int64)
        votes = [i for i in range(len(w) - 1) if phrase or len(w) <= SHORT or not {w[i], w[i + 1]} <= COMMON]
        grams += [(int(h[i]), f"{w[i]} {w[i + 1]}", tid, i) for i in votes]
        root = None if phrase else " ".join(next(r for r in roots if w[: len(r)] == r))
        kinds.append((tid, label, len(votes), phrase, phrase or len(w) <= SHORT, root))
    return grams, kinds


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, coverage: float = 0.6, drift: int = 3) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    A-Z are lower-cased; words are runs of a-z, digits and non-ASCII. Short templates need all their words in a row. n_base counts the places of `phrases`, first_word and
    last_word are their least and largest start (else null). labels adds those of spans that hold at least `coverage` of a
    template's voting bigrams on diagonals within `drift` of each other; spans [(label, first, end, coverage)] are theirs
    and the phrases'. score is the largest coverage found (1 for a phrase, 0 without any). Null and empty texts have no words.
    Each input row gives a row, null and repeated doc_id included; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(docs.sparkSession)
    rows, labelled = template_rows(phrases, templates)
    asked = np.array([r[0] for r in rows], np.int64)
    grams = spark.createDataFrame(rows, "h long, said string, tid int, tpos int")
    kinds = spark.createDataFrame(labelled, "tid int, label string, need int, phrase boolean, exact boolean, root string")
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch, size=1 << 20):
                w = words(t["text"], ALNUM, lower=True)
                rid = t["rid"].to_numpy()
                at = np.flatnonzero(window_starts(w.offsets, 2))
                own = w.doc[at]
                h = np.r_[rolling(w.hashes, 2)[at].view(np.int64), np.full(len(rid), MARK)]
                pos = np.r_[at - w.offsets[own], np.diff(w.offsets)].astype(np.int32)
                ids = pa.chunked_array([pa.nulls(len(at), pa.int64()), *t["doc_id"].chunks]).combine_chunks()
                said = np.full(len(h), None, object)
                for i in np.flatnonzero(np.isin(h[: len(at)], asked)):
                    a = at[i]
                    said[i] = b" ".join(w.buf[w.starts[j] : w.ends[j]].tobytes() for j in (a, a + 1)).decode()
                yield from pa.table({"rid": np.r_[rid[own], rid], "doc_id": ids, "pos": pos, "h": h, "here": pa.array(said, pa.string())}).to_batches(max_chunksize=100_000)

    hits = texts.mapInArrow(bigrams, "rid long, doc_id long, pos int, h long, here string").join(F.broadcast(grams), "h").where(F.col("here").eqNullSafe(F.col("said")))
    votes = hits.groupBy("rid", "tid", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.max("doc_id").alias("doc_id"), F.collect_set("tpos").alias("places"), F.min("pos").alias("lo"), F.max("pos").alias("hi")
    )
    votes = votes.join(F.broadcast(kinds), "tid", "left")
    lane = W.partitionBy("rid", "tid").orderBy("diagonal")
    far = F.col("phrase").isNull() | F.col("exact") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(lane) > drift, F.lit(True))
    runs = votes.withColumn("run", F.sum(F.when(far, 1).otherwise(0)).over(lane))
    spans = runs.groupBy("rid", "tid", "run").agg(
        F.first("label").alias("label"), F.first("phrase").alias("phrase"), F.first("exact").alias("exact"), F.first("root").alias("root"), F.first("need").alias("need"), F.max("doc_id").alias("doc_id"), F.min("diagonal").alias("diagonal"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes"),
    )
    share = F.least(F.lit(1.0), F.col("votes") / F.col("need"))
    place = F.col("phrase") & (F.col("votes") == F.col("need"))
    whole = F.when(F.col("exact"), F.col("votes") == F.col("need")).otherwise(share >= coverage)
    beside = W.partitionBy("rid", "root", "diagonal")
    longest = F.max(F.when(F.col("exact") & ~F.col("phrase") & whole, F.col("need"))).over(beside)
    spans = spans.withColumn("covered", F.coalesce(~F.col("phrase") & F.col("exact") & (F.col("need") < longest), F.lit(False)))
    found = place | (~F.col("phrase") & whole & ~F.col("covered"))
    span = F.struct("label", F.col("lo").cast("long").alias("first"), (F.col("hi") + 2).cast("long").alias("end"), share.alias("coverage"))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    out = spans.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max(F.when(F.col("tid") == -1, F.col("diagonal"))).cast("long").alias("n_words"), F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("diagonal"))).cast("long").alias("first_word"), F.max(F.when(place, F.col("diagonal"))).cast("long").alias("last_word"), joined(place).alias("base_labels"),
        joined(found).alias("labels"), F.coalesce(F.max(F.when(found | ~F.col("phrase"), share)), F.lit(0.0)).alias("score"), F.sort_array(F.collect_list(F.when(found, span))).alias("spans"),
    )
    return out.drop("rid")
