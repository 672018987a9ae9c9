"""Hierarchical language identification: first the family, then one-versus-one linear SVMs within it.

Features are relative frequencies of lower-cased byte trigrams, hashed into `DIMS` columns, over the whole text. Families come
from a fixed table; a language outside it is a family of its own. The model is a small matrix fitted on a bounded
sample of labelled rows (`per_language` of each language, chosen by hash), so it can be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .spread import small_batches
from .words import LOWER, buffer, slices

#: Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": "da de en is nl no sv",
    "romance": "ca es fr gl it pt ro",
    "slavic": "bg cs hr pl ru sk sl sr uk",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

DIMS = 1 << 14
PAIR = np.dtype([("c", "<u2"), ("v", "<f4")])


def after(b: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The byte after each byte of texts that stand between two spaces in b; a space after a text's own, whatever text comes next."""
    out = b[2:].copy()
    out[begin[1:] - 1] = 32
    return out


def hashed(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    return ((first | (second << np.uint32(8)) | (third << np.uint32(16))) * np.uint32(2654435761) >> np.uint32(32 - 14)).astype(np.int32)


def trigrams(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts in order, and n + 1 offsets; each text begins after a space."""
    buf, begin = buffer(column)
    b = np.r_[np.uint8(32), LOWER[buf], np.uint8(32)].astype(np.uint32)
    return hashed(b[:-2], b[1:-1], after(b, begin)), begin


def letter_trigrams(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams, A-Z and À-Þ lower-cased, with all but letters taken as spaces; n + 1 offsets; which of them hold two letters or more."""
    buf, begin = buffer(column)
    b = np.r_[np.uint8(32), LOWER[buf], np.uint8(32)]
    b[1:] += np.where((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E), 32, 0).astype(np.uint8)
    b = np.where(((b >= 97) & (b <= 122)) | (b >= 128), b, 32).astype(np.uint32)
    three = b[:-2], b[1:-1], after(b, begin)
    return hashed(*three), begin, sum((x != 32).astype(np.int8) for x in three) >= 2


@dataclass
class Sparse:
    """Rows of few columns: each entry's row, column and value, in order of rows."""

    n: int
    row: np.ndarray
    col: np.ndarray
    value: np.ndarray

    def where(self, keep: np.ndarray) -> Sparse:
        place, own = np.cumsum(keep) - 1, keep[self.row]
        return Sparse(int(keep.sum()), place[self.row[own]], self.col[own], self.value[own])

    def dense(self) -> np.ndarray:
        out = np.zeros((self.n, DIMS), np.float32)
        out[self.row, self.col] = self.value
        return out


def linear_svm(x: Sparse, y: np.ndarray, scale: np.ndarray, steps: int = 150, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by accelerated gradient descent; y is 1 or -1, classes weigh the same."""
    value = x.value * scale[x.col]
    c = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) / 2
    size = np.bincount(x.row, weights=value * value, minlength=x.n)
    w, v, b, rate = np.zeros(DIMS), np.zeros(DIMS), 0.0, 1 / (2 * (size.max(initial=0.0) + 1) + l2)
    u, t = 0.0, 1.0
    for _ in range(steps):
        m = np.maximum(0, 1 - y * (np.bincount(x.row, weights=value * v[x.col], minlength=x.n) + u)) * y * c * 2
        w2, b2, t2 = v - rate * (l2 * v - np.bincount(x.col, weights=value * m[x.row], minlength=DIMS)), u + rate * m.sum(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, u = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w * scale, b


@dataclass
class LanguageModel:
    """Weights of all classifiers side by side: one for each family against the rest, then one for each pair within a family."""

    families: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray
    usual: dict[str, tuple[np.ndarray, float, float, float]]

    def predict(self, column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language, score and typical of each text; the score is the family's probability times the language's within it."""
        code, begin = trigrams(column)
        n = np.diff(begin)
        if not len(n):
            return np.zeros(0, object), np.zeros(0), np.zeros(0)
        raw = np.stack([np.add.reduceat(w[code], begin[:-1]) for w in self.weights], 1) / n[:, None] + self.bias
        sigmoid = lambda m: 1 / (1 + np.exp(-np.clip(4 * m, -50, 50)))
        f = sigmoid(raw[:, : len(self.families)])
        f /= f.sum(1, keepdims=True)
        best = f.argmax(1)
        lang, score = np.empty(len(n), object), f.max(1)
        for i, family in enumerate(self.families):
            rows, names = np.flatnonzero(best == i), self.members[family]
            votes, sure = np.zeros((len(rows), len(names))), np.ones((len(rows), len(names)))
            for j, (a, b) in enumerate(self.pairs):
                if a in names:
                    p = sigmoid(raw[rows, len(self.families) + j])
                    x, y = names.index(a), names.index(b)
                    votes[:, x] += p > 0.5
                    votes[:, y] += p <= 0.5
                    sure[:, x] = np.minimum(sure[:, x], p)
                    sure[:, y] = np.minimum(sure[:, y], 1 - p)
            own = (votes + sure / 2).argmax(1) if len(rows) else np.zeros(0, int)
            lang[rows] = np.array(names, object)[own]
            score[rows] *= sure[np.arange(len(rows)), own]
        names = sorted(self.usual)
        at = np.searchsorted(names, lang.astype(str))
        log_p = np.stack([self.usual[k][0] for k in names])
        middle, spread, each = np.array([self.usual[k][1:] for k in names])[at].T
        code, begin, two = letter_trigrams(column)
        used = np.add.reduceat(two.astype(np.int64), begin[:-1])
        mean = np.add.reduceat(np.where(two, log_p[np.repeat(at, n), code], 0.0), begin[:-1]) / np.maximum(used, 1)
        return lang, score, np.where(used > 0, (mean - middle) / np.sqrt(spread**2 + each**2 / np.maximum(used, 1)), 0.0)


def usual_trigrams(x: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """Of a language's fitted texts: log frequencies of trigrams; median and spread of a text's mean of them, each half by the other's; spread of one trigram."""

    def logs(rows: np.ndarray) -> np.ndarray:
        return np.log(0.8 * rows.mean(0) + 0.2 / DIMS)

    if len(x) < 8:  # too few to tell what is usual
        return logs(x).astype(np.float32), 0.0, np.inf, 0.0
    mean, square = np.zeros(len(x)), np.zeros(len(x))
    for h in (0, 1):
        other = logs(x[1 - h :: 2])
        mean[h::2], square[h::2] = x[h::2] @ other, x[h::2] @ other**2
    middle = np.median(mean)
    # A sixth of how far all but the least usual texts reach, if that is more: clean texts vary more than a normal distribution.
    spread = max(1.4826 * np.median(np.abs(mean - middle)), (middle - np.quantile(mean, 0.005)) / 6)
    return logs(x).astype(np.float32), middle, spread, np.sqrt(max(0.0, np.median(square - mean**2)) + 1e-6)


def _packed(own: np.ndarray, code: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Each text's distinct columns and their shares of its n trigrams."""
    key, count = np.unique(own.astype(np.int64) * DIMS + code, return_counts=True)
    pair = np.empty(len(key), PAIR)
    pair["c"], pair["v"] = key % DIMS, count / n[key // DIMS]
    edge = np.searchsorted(key, np.arange(len(n) + 1) * DIMS)
    return [pair[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]


def _sparse(column: list[bytes]) -> Sparse:
    pair = np.frombuffer(b"".join(column), PAIR)
    return Sparse(len(column), np.repeat(np.arange(len(column)), [len(x) // PAIR.itemsize for x in column]), pair["c"].astype(np.int64), pair["v"].astype(float))


def svms(spark: SparkSession, x: Sparse, scale: np.ndarray, jobs: list[tuple[list[str], list[str]]], classes: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """One linear SVM for each job (classes for, classes against), each fitted by a task on the broadcast sample."""
    data = spark.sparkContext.broadcast((x, scale, jobs, classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, scale, jobs, classes = data.value
        for batch in batches:
            for k in batch["id"].to_pylist():
                good, keep = np.isin(classes, jobs[k][0]), np.isin(classes, [*jobs[k][0], *jobs[k][1]])
                w, b = linear_svm(x.where(keep), np.where(good[keep], 1.0, -1.0), scale)
                yield pa.RecordBatch.from_pylist([{"id": k, "w": w.astype(np.float32).tobytes(), "b": float(b)}])

    got = spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, "id long, w binary, b double").toArrow().sort_by("id")
    data.unpersist()
    return [(np.frombuffer(w, np.float32), b) for w, b in zip(got["w"].to_pylist(), got["b"].to_pylist(), strict=True)]


def fit(docs: DataFrame, training: Column, per_language: int = 600) -> LanguageModel | None:
    """Fit on about `per_language` distinct rows of each language (all, if it has fewer) where `training` holds and text and lang aren't null.

    Every language is learned. The sample has at most about per_language rows of each, the model 64 KB for each family and each pair within one.
    """
    rows = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    parts = 1 << 30
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(parts, parts * per_language // n))))
    own = F.xxhash64("doc_id", "text")
    chosen = rows.withColumn("own", own).where(F.pmod(F.xxhash64("own", F.lit("sample")), F.lit(parts)) < share[F.col("lang")])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch):
                code, begin = trigrams(t["text"])
                n = np.diff(begin)
                text = np.repeat(np.arange(len(n)), n)
                letter, _, two = letter_trigrams(t["text"])
                used = np.bincount(text[two], minlength=len(n))
                columns = [t["own"].combine_chunks(), t["lang"].combine_chunks(), pa.array(_packed(text, code, n), pa.binary()), pa.array(_packed(text[two], letter[two], used), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["own", "lang", "x", "letters"])

    # Repeated rows are fitted once, so that one row's copies can't fill the sample.
    got = chosen.select("own", "text", "lang").mapInArrow(features, "own long, lang string, x binary, letters binary").dropDuplicates(["own", "lang"]).toArrow().sort_by([("lang", "ascending"), ("own", "ascending")])
    langs, y, letters = sorted(counts), np.array(got["lang"].to_pylist(), object), got["letters"].to_pylist()
    usual = {}
    for k in langs:
        mine = [v for v, at in zip(letters, y == k, strict=True) if at]
        usual[k] = usual_trigrams(_sparse(mine).dense()) if mine else (np.zeros(DIMS, np.float32), 0.0, np.inf, 0.0)
    x = _sparse(got["x"].to_pylist())
    square = np.bincount(x.col, weights=x.value**2, minlength=DIMS)
    scale = np.where(square > 0, 1 / np.sqrt(square / max(1, x.n) + 1e-9) / np.sqrt(max(1, np.count_nonzero(square))), 0.0)
    members: dict[str, list[str]] = {}
    for code in langs:
        members.setdefault(FAMILY_OF.get(code, code), []).append(code)
    families = sorted(members)
    pairs = [p for f in families for p in combinations(members[f], 2)]
    jobs = [(members[f], [c for c in langs if c not in members[f]]) for f in families] + [([a], [b]) for a, b in pairs]
    fitted = [(np.zeros(DIMS), 1.0)] if len(langs) == 1 else svms(docs.sparkSession, x, scale, jobs, y.astype(str))
    if len(families) == 1:
        fitted[0] = (np.zeros(DIMS), 1.0)
    return LanguageModel(families, members, pairs, np.stack([w for w, _ in fitted]).astype(np.float32), np.array([b for _, b in fitted]), usual)


def identify(docs: DataFrame, held_out: Column | None = None, per_language: int = 600, columns: bool = False) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1).

    Learns from text and non-null lang of the rows that aren't held out; predicts from the whole text alone. A null text, or one
    without a letter, gives `und` and score 0; so does every text if there is nothing to learn from. Repeated rows give
    repeated results. By default rows with crc32(doc_id) mod 4 = 2 are held out. With `columns`, all columns of docs are returned
    before these three and `typical` (which replace any of the same names); else only doc_id is. typical says by how many
    deviations of the language's fitted texts the text's letter trigrams are more usual in it, or less (negative), for a text of its length; it does
    not depend on the other languages. It is 0 for `und` and for a language with under 8 fitted texts.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)) if held_out is None else held_out
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held.alias("held_out"))
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, ~F.col("held_out"), per_language))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch):  # a batch or a table of them
                lang, score, typical = np.full(len(t), None, object), np.zeros(len(t)), np.zeros(len(t))
                if model.value is not None:
                    lang, score, typical = model.value.predict(t["text"])
                letters = np.asarray(t["letters"])
                lang, score, typical = np.where(letters, lang, None), np.where(letters, score, 0.0), np.where(letters, typical, 0.0)
                lang[lang == None] = "und"  # noqa: E711
                yield from pa.table({"doc_id": t["doc_id"], "held_out": t["held_out"], "lang_pred": pa.array(lang.tolist(), pa.string()), "score": score, "typical": typical}).to_batches()

    letters = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))
    new = ("held_out", "lang_pred", "score", "typical")
    if not columns:
        return rows.select("doc_id", "text", "held_out", letters.alias("letters")).mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, typical double").drop("typical")
    own = [c for c in docs.columns if c.lower() not in new]
    packed = docs.select(F.struct(*own).alias("row"), F.col("text").cast("string").alias("text"), held.alias("held_out"), letters.alias("letters"))

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            got = pa.Table.from_batches(list(predict([t.append_column("doc_id", pa.nulls(len(t), pa.int64()))])), pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("typical", pa.float64())]))
            yield from pa.table({"row": t["row"], **{n: got[n] for n in new}}).to_batches()

    kinds = StructType([StructField("row", packed.schema["row"].dataType)]).add("held_out", "boolean").add("lang_pred", "string").add("score", "double").add("typical", "double")
    return packed.mapInArrow(beside, kinds).select("row.*", *new)
