"""Language-model scores by a probabilistic suffix tree, and unigram scores of words.

Symbols are lower-cased bytes and a boundary. Training texts are counted in grams of seven symbols. A context of up to six
symbols is kept if it occurs at least `least` times and its next-symbol distribution differs from that of its longest kept
suffix: count * KL divergence >= `divergence`. Both are absolute, so more text keeps more contexts. A kept context's
distribution is smoothed towards its longest kept suffix's. A text's score adds each symbol's log10 probability after the longest
kept suffix, in steps of 1 / STEP.

Neither word counts nor the tree fit a broadcast. Texts are written as groups of a few MB; each sends its distinct word hashes
and grams, packed by hash bucket, so that a common one reaches its bucket once a group. Buckets sum the counts and pass the grams on
by their last three symbols of context; there all deeper contexts are whole and the tree is grown. Its upper levels have
at most 2^24 grams (some ten thousand in practice) and are broadcast. Probabilities return the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.durable import durable
from .spread import binaries, buckets_for, by_bucket, group_rows, release, release_counts, squeeze, squeeze_counts, text_groups
from .words import LOWER, Words, buffer, mix, slices, words

DEPTH, END, STEP = 6, 255, 4096  # UTF-8 has no byte 255
LOW = 2
#: Texts whose places are sorted together with their codes.
TEXTS = 128


def grams(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """At each byte and at each text's end (a boundary): the symbols before it, the nearest highest, and its own, in 56 bits; where texts begin."""
    buf, begin = buffer(column)
    s = LOWER[buf].astype(np.int64)
    s[begin[1:] - 1] = END
    place = np.arange(len(s)) - np.repeat(begin[:-1], np.diff(begin))
    code, before = s.copy(), s
    for j in range(1, DEPTH + 1):
        before = np.r_[np.int64(END), before[:-1]]
        code |= np.where(place >= j, before, END) << (8 * (DEPTH + 1 - j))
    return code, begin


def at_depth(code: np.ndarray, depth: int) -> np.ndarray:
    """The last `depth` symbols of each context and the next symbol."""
    return ((code >> 8 * (DEPTH + 1 - depth)) << 8) | (code & 255)


def grow(code: np.ndarray, count: np.ndarray, p: np.ndarray, depths: range, least: int, divergence: float, strength: float) -> np.ndarray:
    """Probabilities of grams after their longest kept context, `depths` deeper than those given; all grams of a context must be among them."""
    for d in depths:
        key, first, at = np.unique(at_depth(code, d), return_index=True, return_inverse=True)
        n, parent = np.bincount(at, weights=count, minlength=len(key)), p[first]
        heads = np.flatnonzero(np.r_[True, np.diff(key >> 8) != 0]) if len(key) else np.zeros(0, np.int64)
        if not len(heads):
            break
        total = np.add.reduceat(n, heads)
        fit = np.add.reduceat(n * np.log(np.where(n > 0, n, 1) / parent), heads)
        kept = (total >= least) & (fit - total * np.log(np.maximum(total, 1)) >= divergence)
        size = np.diff(np.r_[heads, len(key)])
        total, kept = np.repeat(total, size), np.repeat(kept, size)
        p = np.where(kept, (n + strength * parent) / (total + strength), parent)[at]
    return p


def upper(counts: pa.Table, least: int, divergence: float, strength: float) -> tuple[np.ndarray, np.ndarray]:
    """Grams of the tree's upper levels, ascending, and their probabilities."""
    order = np.argsort(np.asarray(counts["low"]))
    low, n = np.asarray(counts["low"])[order], np.asarray(counts["n"])[order]
    code = ((low >> 8) << 8 * (DEPTH + 1 - LOW)) | (low & 255)
    root = (np.bincount(low & 255, weights=n, minlength=256) + 0.5) / (n.sum() + 0.5 * 256)
    return low, grow(code, n, root[low & 255], range(1, LOW + 1), least, divergence, strength)


def _words(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word hashes of a table's texts, lower-cased, each word's place among them, and each word's row."""
    parts, own, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for t in slices(table):
        w: Words = words(t["text"], lower=True)
        parts.append(w.hashes)
        own.append(w.doc + at)
        at += len(t)
    values, place = np.unique(np.concatenate(parts), return_inverse=True)
    return values, place, np.concatenate(own)


def _runs(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For TEXTS texts at a time: the first one's row, distinct grams ascending, how often each occurs, and the text of each occurrence."""
    at = 0
    for t in slices(table):
        code, begin = grams(t["text"])
        for first in range(0, len(t), TEXTS):
            last = min(first + TEXTS, len(t))
            a, b = begin[first], begin[last]
            key = np.sort((code[a:b] << 7) | np.repeat(np.arange(last - first), np.diff(begin[first : last + 1])))
            heads = np.flatnonzero(np.r_[True, np.diff(key >> 7) != 0])
            yield at + first, key[heads] >> 7, np.diff(np.r_[heads, len(key)]), (key & 127).astype(np.uint8)
        at += len(t)


def score_texts(docs: DataFrame, held_out: Column | None = None, least: int = 32, divergence: float = 40.0, strength: float = 8.0) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are runs of bytes without ASCII white space, after lower-casing A-Z, and one end. base_score is the sum over tokens
    of log10((c + 0.1) / (N + 0.1 (V + 1))) with the token's count c, all N and distinct V of the texts not held
    out; n_known counts tokens with c > 0. score is the suffix tree's log10 probability of the lower-cased text and its end.
    Null texts are empty ones (only an end). By default rows with crc32(doc_id) mod 10 = 0 are held out; a null doc_id trains. Each
    row gives a row; other columns are not read; without training texts every count is 0.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False)) if held_out is None else held_out
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), held.alias("held_out"))
    groups = text_groups(texts)
    n_buckets = buckets_for(spark, groups.agg(F.sum("n_bytes")).first()[0] or 0)
    ends = texts.agg(F.count_if(~F.col("held_out"))).first()[0]

    def dealt(values: np.ndarray) -> list[tuple[int, np.ndarray]]:
        return by_bucket((mix(values.astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group's distinct words, and in buckets from n_buckets its distinct grams, with their counts in its training texts."""
        for batch in batches:
            for g, data in zip(batch["g"].to_pylist(), batch["data"], strict=True):
                table = group_rows(data.as_py())
                train = ~np.asarray(table["held_out"]).astype(bool)
                values, at, own = _words(table)
                c = np.bincount(at, weights=train[own], minlength=len(values))
                parts = [(0, values, c)]
                keys = [np.zeros(0, np.int64)]
                for t, learn in zip(slices(table), np.split(train, np.cumsum([len(t) for t in slices(table)])[:-1]), strict=True):
                    code, begin = grams(t["text"])
                    keys.append((code << 1) | np.repeat(learn, np.diff(begin)))
                key = np.sort(np.concatenate(keys))
                heads = np.flatnonzero(np.r_[True, np.diff(key >> 1) != 0])
                parts.append((n_buckets, key[heads] >> 1, np.add.reduceat(key & 1, heads)))
                rows = [(base + b, squeeze(v[x]), squeeze_counts(n[x].astype(np.int64))) for base, v, n in parts for b, x in dealt(v)]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array([g] * len(rows), pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["bucket", "g", "keys", "counts"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        """kind 0: counts of a group's words, in its order; 1: a bucket's tokens n and types m; 2: grams and their counts, for a bucket of the tree; 3: a group's places among the grams."""
        b, g = key[0].as_py(), table["g"].to_pylist()
        gram = b >= n_buckets
        parts = [release(k, "i8" if gram else "u8") for k in binaries(table["keys"])]
        values, at = np.unique(np.concatenate(parts), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([release_counts(c) for c in binaries(table["counts"])]), minlength=len(values)).astype(np.int64)
        places = np.split(at, np.cumsum([len(x) for x in parts])[:-1])
        if gram:
            rows = [(3, b, i, 0, 0, None, squeeze_counts(np.diff(x, prepend=0))) for i, x in zip(g, places, strict=True)]
            rows += [(2, t, b, 0, 0, squeeze(values[x]), squeeze_counts(n[x])) for t, x in by_bucket((mix((values >> 32).astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64))]
        else:
            rows = [(0, b, i, 0, 0, None, squeeze_counts(n[x])) for i, x in zip(g, places, strict=True)]
            rows.append((1, b, 0, int(n.sum()), int((n > 0).sum()), None, None))
        columns, kinds = list(zip(*rows, strict=True)), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["kind", "bucket", "g", "n", "m", "keys", "counts"])

    asked = groups.select("g", "data").mapInArrow(ask, "bucket int, g long, keys binary, counts binary")
    answers = durable(asked.groupBy("bucket").applyInArrow(add, "kind int, bucket int, g long, n long, m long, keys binary, counts binary"))
    tokens, types = answers.where("kind = 1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("m"), F.lit(0))).first()
    N, V = tokens + ends, types + (ends > 0)

    def lows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                low, at = np.unique(at_depth(release(keys, "i8"), LOW), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(np.bincount(at, weights=release_counts(counts)).astype(np.int64))], ["low", "n"])

    low = answers.where("kind = 2").select("keys", "counts").mapInArrow(lows, "low long, n long").groupBy("low").agg(F.sum("n").alias("n"))
    top = spark.sparkContext.broadcast(upper(low.toArrow(), least, divergence, strength))

    def tree(key: tuple, table: pa.Table) -> pa.Table:
        """The grams that a bucket of grams sent, and their probabilities as steps of log10."""
        parts = [release(k, "i8") for k in binaries(table["keys"])]
        code = np.concatenate(parts)
        known, p = top.value
        p = p[np.searchsorted(known, at_depth(code, LOW))]
        p = grow(code, np.concatenate([release_counts(c) for c in binaries(table["counts"])]), p, range(LOW + 1, DEPTH + 1), least, divergence, strength)
        q = np.minimum(np.rint(-np.log10(p) * STEP), 65535).astype(np.uint16)
        steps = [squeeze(x) for x in np.split(q, np.cumsum([len(x) for x in parts])[:-1])]
        return pa.table({"bucket": table["g"].cast(pa.int32()), "keys": table["keys"], "counts": pa.array(steps, pa.binary())})

    def reply(key: tuple, grown: pa.Table, places: pa.Table) -> pa.Table:
        """Steps for each group's grams of a bucket, in its order."""
        code, q = np.concatenate([release(k, "i8") for k in binaries(grown["keys"])]), np.concatenate([release(c, "u2") for c in binaries(grown["counts"])])
        q = q[np.argsort(code)]
        own = [squeeze(q[np.cumsum(release_counts(c))]) for c in binaries(places["counts"])]
        return pa.table({"g": places["g"], "bucket": places["bucket"], "counts": pa.array(own, pa.binary())})

    grown = answers.where("kind = 2").groupBy("bucket").applyInArrow(tree, "bucket int, keys binary, counts binary")
    scored = grown.groupBy("bucket").cogroup(answers.where("kind = 3").select("bucket", "g", "counts").groupBy("bucket")).applyInArrow(reply, "g long, bucket int, counts binary")

    def finish(key: tuple, groups: pa.Table, replies: pa.Table) -> pa.Table:
        table = group_rows(groups["data"][0].as_py())
        by = dict(zip(replies["bucket"].to_pylist(), binaries(replies["counts"]), strict=True))
        values, at, own = _words(table)
        c, n_docs = np.zeros(len(values), np.int64), len(table)
        for b, x in dealt(values):
            c[x] = release_counts(by[b])
        logs = lambda x: np.log10(x + 0.1)
        n_tokens = np.bincount(own, minlength=n_docs) + 1
        base = np.bincount(own, weights=logs(c)[at], minlength=n_docs) + logs(ends) - n_tokens * np.log10(N + 0.1 * (V + 1))
        known = np.bincount(own, weights=(c > 0)[at], minlength=n_docs).astype(np.int64) + int(ends > 0)
        runs = list(_runs(table))
        code = np.unique(np.concatenate([r[1] for r in runs]))
        q, steps = np.zeros(len(code)), np.zeros(n_docs)
        for b, x in dealt(code):
            q[x] = release(by[n_buckets + b], "u2")
        for first, own_code, times, text in runs:
            sums = np.bincount(text, weights=np.repeat(q[np.searchsorted(code, own_code)], times))
            steps[first : first + len(sums)] += sums
        return pa.table({"doc_id": table["doc_id"], "held_out": table["held_out"], "n_tokens": n_tokens, "n_known": known, "train_tokens": np.full(n_docs, N, np.int64), "base_score": base, "score": -steps / STEP})

    replies = answers.where("kind = 0").select("g", "bucket", "counts").unionByName(scored)
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return groups.select("g", "data").groupBy("g").cogroup(replies.groupBy("g")).applyInArrow(finish, out)
