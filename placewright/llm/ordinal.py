"""Ordinal quality grades: cumulative-link regression on hashed words with shared weights and ordered thresholds.

P(grade <= k) = sigmoid(threshold_k - weights . features). Features are whether each hashed lower-cased word stands in the whole text,
whether words with the same first six bytes stand there 2, 4 or 8 times, and a few measures of its form. The model is fitted by full-batch gradient steps on a bounded sample of rated rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import small_batches
from .words import ALNUM, NONSPACE, Words, mix, slices, words

DIMS = 1 << 15
FORM = 8


def stems(w: Words) -> np.ndarray:
    """Keys of the first six bytes of words that begin 2, 4 or 8 words of a text."""
    own = np.flatnonzero(w.ends - w.starts >= 6)
    if not len(own):
        return np.zeros(0, np.int64)
    at = w.starts[own]
    first = np.zeros(len(own), np.uint64)
    for j in range(6):
        first |= w.buf[at + j].astype(np.uint64) << np.uint64(8 * j)
    doc = w.doc[own]
    order = np.lexsort((first, doc))
    doc, first = doc[order], first[order]
    heads = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (first[1:] != first[:-1])])
    count = np.diff(np.r_[heads, len(doc)])
    doc, first = doc[heads], first[heads]
    return np.concatenate([doc[count >= k] * DIMS + (mix(first[count >= k] * np.uint64(31) + np.uint64(k)) % np.uint64(DIMS)).astype(np.int64) for k in (2, 4, 8)])


def features(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words of each text (flat, with n + 1 offsets), and its form: shares of symbols, digits, long and repeated words, line ends, size."""
    w = words(column, ALNUM, lower=True)
    n = len(w.offsets) - 1
    key = np.unique(w.doc * DIMS + (w.hashes % np.uint64(DIMS)).astype(np.int64)) if len(w.hashes) else np.zeros(0, np.int64)
    types = np.bincount(key // DIMS, minlength=n)
    key = np.unique(np.r_[key, stems(w)])
    at = np.searchsorted(key, np.arange(n + 1) * DIMS)
    size, begin = np.maximum(1, np.diff(w.bytes_at)), w.bytes_at[:-1]
    count = np.diff(w.offsets)
    share = lambda mask: np.add.reduceat(mask.astype(np.int64), begin) / size if n else np.zeros(0)
    symbol = NONSPACE[w.buf] & ~ALNUM[w.buf]
    long = np.bincount(w.doc, weights=(w.ends - w.starts) > 14, minlength=n)
    form = np.stack([
        np.ones(n), np.minimum(1, 4 * share(symbol)), np.minimum(1, 4 * share((w.buf >= 48) & (w.buf < 58))), long / np.maximum(1, count),
        1 - types / np.maximum(1, count), np.minimum(1, 20 * share(w.buf == 10)), np.log1p(count) / 10, share(w.buf == 124) * 10,
    ], 1)
    return key % DIMS, at, np.minimum(form, 2)


@dataclass
class OrdinalModel:
    """Weights of words and form, and thresholds in ascending order; grades 0 to len(thresholds)."""

    words: np.ndarray
    form: np.ndarray
    thresholds: np.ndarray

    def tails(self, column: pa.ChunkedArray) -> np.ndarray:
        """P(grade > k) for each text and threshold."""
        key, at, form = features(column)
        sums = np.r_[0.0, np.cumsum(self.words[key])]
        z = sums[at[1:]] - sums[at[:-1]] + form @ self.form
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds, -60, 60)))


def fit_ordinal(columns: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, steps: int = 400, l2: float = 2e-4, least: int = 8, z_least: float = 4.0) -> OrdinalModel:
    """columns: (hashed words, form) of each sampled text. Words in fewer than `least` of them, or whose
    presence shifts no grade by `z_least` standard errors, get no weight: a rare word says nothing about other texts."""
    levels = int(grades.max(initial=1))
    n = len(grades)
    flat = np.concatenate([k for k, _ in columns]) if columns else np.zeros(0, np.int64)
    row = np.repeat(np.arange(n), [len(k) for k, _ in columns])
    seen = np.bincount(flat, minlength=DIMS)
    screened = np.zeros(DIMS, bool)
    for k in range(levels):
        up = grades > k
        p = up.mean() if n else 0.5
        z = (np.bincount(flat, weights=up[row], minlength=DIMS) - seen * p) / np.sqrt(np.maximum(seen * p * (1 - p), 1e-9))
        screened |= np.abs(z) >= z_least
    keep = (screened & (seen >= least))[flat]
    flat, row = flat[keep], row[keep]
    form = np.stack([f for _, f in columns]) if columns else np.zeros((0, FORM))
    w, f, t = np.zeros(DIMS), np.zeros(FORM), np.linspace(-1, 1, levels) if levels > 1 else np.zeros(1)
    weight = 1 / np.maximum(1, np.bincount(grades, minlength=levels + 1))[grades]
    weight = weight / weight.sum() if n else weight
    above = grades[:, None] > np.arange(levels)
    moments = [np.zeros(DIMS), np.zeros(FORM), np.zeros(levels)]
    second = [np.zeros(DIMS), np.zeros(FORM), np.zeros(levels)]
    for step in range(1, steps + 1 if n else 1):
        z = np.bincount(row, weights=w[flat], minlength=n) + form @ f
        p = 1 / (1 + np.exp(-np.clip(z[:, None] - t, -60, 60)))
        g = (p - above) * weight[:, None]
        grads = [np.bincount(flat, weights=g.sum(1)[row], minlength=DIMS) + l2 * w, form.T @ g.sum(1), -g.sum(0)]
        for x, grad, m, s, rate in zip((w, f, t), grads, moments, second, (0.02, 0.05, 0.05), strict=True):
            m += 0.1 * (grad - m)
            s += 0.01 * (grad * grad - s)
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
        t.sort()
    return OrdinalModel(w, f, t)


def grade_quality(docs: DataFrame, ratings: DataFrame, sample: int = 12000, keep_above: int = 0) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail_probability, kept.

    ratings holds (doc_id, grade), grades from 0; rows without either, or with a negative grade, are left out. About `sample` rated documents, chosen by hash, are fitted
    (all, if there are fewer); without any, every tail is 0.5. tail_probability is P(grade > keep_above), kept whether it is at least
    0.5. Null texts are empty ones; repeated rows give repeated results; a null doc_id is graded like others. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    small_batches(docs.sparkSession)
    rated = ratings.where("doc_id is not null and grade >= 0").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("grade").cast("int")).alias("grade"))
    n, parts = rated.count(), 1 << 30
    chosen = rated.where(F.pmod(F.xxhash64("doc_id", F.lit("rated")), F.lit(parts)) < min(parts, parts * sample // max(1, n)))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch):
                key, at, form = features(t["text"])
                keys = [key[a:b].astype(np.uint16).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield from pa.table({"grade": t["grade"], "keys": pa.array(keys, pa.binary()), "form": pa.array([x.tobytes() for x in form], pa.binary())}).to_batches()

    # The sample is bounded by a parameter, so it may be broadcast to the texts.
    # Rows that repeat one rating's text are fitted once.
    got: pd.DataFrame = texts.join(F.broadcast(chosen), "doc_id").select("grade", "text").mapInArrow(extract, "grade int, keys binary, form binary").dropDuplicates(["grade", "keys", "form"]).toArrow().to_pandas()
    got = got.sort_values(["grade", "keys"], kind="stable")
    model = fit_ordinal([(np.frombuffer(k, np.uint16).astype(np.int64), np.frombuffer(f)) for k, f in zip(got["keys"], got["form"], strict=True)], got["grade"].to_numpy(int))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch):
                tails = shared.value.tails(t["text"])
                tail = tails[:, min(keep_above, tails.shape[1] - 1)]
                yield from pa.table({"doc_id": t["doc_id"], "expected_grade": tails.sum(1), "tail_probability": tail, "kept": tail >= 0.5}).to_batches()

    return texts.mapInArrow(grade, "doc_id long, expected_grade double, tail_probability double, kept boolean")
