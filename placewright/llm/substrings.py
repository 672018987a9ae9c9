"""Exact removal of passages that an earlier document holds, by fixed-block anchors.

Every document is a reference: its non-overlapping blocks of `(window + 1) // 2` words are the index, and any
`window` equal words hold one whole block of the reference. All rolling blocks of all documents probe the index. Hits
are extended to windows of equal words, and neighbouring windows merge into maximal exact repeats.

1. Texts are dealt into groups of a few MB by a hash. A group sends each distinct rolling block hash once (the
   document that has it first), packed by hash bucket with a flag for index blocks; a bucket answers which of
   them stand in more than one group. Blocks shared within a group are known there.
2. Around hits, the 64-bit hashes of whole windows go the same way, with their document; a bucket answers which have
   a smaller document elsewhere. What is shared within a group is again decided there.
3. The group takes out the words of those windows.

A passage of a third of all documents reaches its bucket once per group, not once per document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .spread import binaries, by_bucket, group_of, pack, sizes, small_batches, unpack
from .words import Words, mix, rolling, slices, window_starts, words

SENT = "bucket int, g int, hashes binary, places binary, extra binary"
ANSWER = "g int, places binary"


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _read(table: pa.Table) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a whole group with the document of each word, and all texts' ids."""
    parts, at, heads, starts, ends, bufs, offsets = [], 0, 0, [], [], [], [np.zeros(1, np.int64)]
    for t in slices(table):
        w = words(t["text"])
        parts.append(w.hashes)
        bufs.append(w.buf)
        starts.append(w.starts + heads)
        ends.append(w.ends + heads)
        offsets.append(w.offsets[1:] + at)
        at += len(w.hashes)
        heads += len(w.buf)
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    w = Words(cat(bufs, np.uint8), cat(starts, np.int64), cat(ends, np.int64), cat(parts, np.uint64), np.concatenate(offsets), np.zeros(0))
    ids = table["doc_id"].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
    return w, ids, w.doc


def _table(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


_SENT = [("bucket", pa.int32()), ("g", pa.int32()), ("hashes", pa.binary()), ("places", pa.binary()), ("extra", pa.binary())]
_ANSWER = [("g", pa.int32()), ("places", pa.binary())]


def _shared(h: np.ndarray, doc: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items in order of their documents: which have a hash that a document with another id shares; which belong to the first id with their hash."""
    order = np.argsort(h, kind="stable")
    s, own = h[order], ids[doc[order]]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    run = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    first = own[heads]
    last = own[np.r_[heads[1:], len(s)] - 1] if len(s) else first
    shared, leads = np.zeros(len(s), bool), np.zeros(len(s), bool)
    shared[order] = (first != last)[run] if len(s) else shared
    leads[order] = own == first[run] if len(s) else leads
    return shared, leads


def duplicated_words(docs: DataFrame, window: int = 13, columns: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, spans [(first, end)] of removed words, n_removed, kept_text, kept_sha256.

    A word goes if a window of `window` consecutive words covers it whose words also start in a document with a smaller
    doc_id; windows are judged on the input. Words are maximal runs without ASCII white space, unchanged.
    Null and empty texts have no words. Rows with equal doc_id don't remove each other's words (repeated rows give
    repeated results); a null doc_id is neither a reference nor changed. Only the other columns named in `columns` are read; with
    them, text and these are returned too.
    """
    block = (window + 1) // 2
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *([F.struct(*columns).alias("row")] if columns else []))
    small_batches(docs.sparkSession)
    n_groups, n_buckets = sizes(texts)
    grouped = texts.where("doc_id is not null").withColumn("g", group_of(n_groups, "doc_id", "text"))

    def probe(key: tuple, table: pa.Table) -> pa.Table:
        w, ids, doc = _read(_ordered(table))
        h, ok = rolling(w.hashes, block), window_starts(w.offsets, block)
        at = np.flatnonzero(ok)
        h, own = h[at], doc[at]
        shared, leads = _shared(h, own, ids)
        index = shared | ((at - w.offsets[own]) % block == 0)
        h, at, index = h[leads], at[leads], index[leads]
        g, rows = key[0].as_py(), []
        for b, x in by_bucket(((h >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)):
            rows.append((b, g, h[x].astype(np.uint32).tobytes(), pack(at[x]), np.packbits(index[x]).tobytes()))
        return _table(rows, _SENT)

    def meet(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint32) for x in binaries(table["hashes"])]
        flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)) for x, p in zip(binaries(table["extra"]), parts, strict=True)]
        h, flag = np.concatenate(parts), np.concatenate(flags).astype(bool)
        row = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
        order = np.argsort(h, kind="stable")
        s, r = h[order], row[order]
        heads = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        size = np.diff(np.r_[heads, len(s)])
        good = (r[heads] != r[heads + size - 1]) & np.logical_or.reduceat(flag[order], heads)
        hit = np.zeros(len(s), bool)
        hit[order] = np.repeat(good, size)
        return _answers(table, [len(p) for p in parts], hit)

    def candidates(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        w, ids, doc = _read(_ordered(texts))
        ok7 = window_starts(w.offsets, block)
        at = np.flatnonzero(ok7)
        h = rolling(w.hashes, block)[at]
        hit = np.zeros(len(w.hashes) + 1, np.int32)
        hit[at] = _shared(h, doc[at], ids)[0]
        for x in binaries(answers["places"]):
            hit[unpack(x)] = 1
        total = np.r_[0, np.cumsum(hit)]
        full, ok = rolling(w.hashes, window), window_starts(w.offsets, window)
        i = np.arange(len(ok))
        at = np.flatnonzero(ok & (total[i + window - block + 1] > total[i]))
        h, own = full[at], doc[at]
        _, leads = _shared(h, own, ids)
        h, at, own = h[leads], at[leads], own[leads]
        g, rows = key[0].as_py(), []
        for b, x in by_bucket((mix(h) % np.uint64(n_buckets)).astype(np.int64)):
            rows.append((b, g, h[x].tobytes(), pack(at[x]), ids[own[x]].tobytes()))
        return _table(rows, _SENT)

    def least(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in binaries(table["hashes"])]
        h, who = np.concatenate(parts), np.concatenate([np.frombuffer(x, np.int64) for x in binaries(table["extra"])])
        order = np.argsort(h, kind="stable")
        s = h[order]
        heads = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        size = np.diff(np.r_[heads, len(s)])
        hit = np.zeros(len(s), bool)
        hit[order] = who[order] > np.repeat(np.minimum.reduceat(who[order], heads), size)
        return _answers(table, [len(p) for p in parts], hit)

    def remove(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        table = _ordered(texts)
        w, ids, doc = _read(table)
        full, ok = rolling(w.hashes, window), window_starts(w.offsets, window)
        at = np.flatnonzero(ok)
        _, leads = _shared(full[at], doc[at], ids)
        hit = np.zeros(len(w.hashes) + 1, np.int64)
        hit[at[~leads]] = 1
        for x in binaries(answers["places"]):
            hit[unpack(x)] = 1
        total = np.r_[0, np.cumsum(hit)]
        i = np.arange(len(w.hashes))
        gone = total[i + 1] > total[np.maximum(i - window + 1, 0)]
        return beside(_kept(w, ids, gone), table)

    probes = grouped.groupBy("g").applyInArrow(probe, SENT)
    hits = probes.groupBy("bucket").applyInArrow(meet, ANSWER)
    wide = grouped.groupBy("g").cogroup(hits.groupBy("g")).applyInArrow(candidates, SENT)
    covered = wide.groupBy("bucket").applyInArrow(least, ANSWER)

    def beside(out: pa.Table, table: pa.Table) -> pa.Table:
        return out.append_column("text", table["text"]).append_column("row", table["row"]) if columns else out

    schema = StructType.fromDDL("doc_id long, n_words long, spans array<struct<first:long,end:long>>, n_removed long, kept_text string, kept_sha256 string")
    if columns:
        schema.add("text", "string").add(StructField("row", texts.schema["row"].dataType))
    known = grouped.groupBy("g").cogroup(covered.groupBy("g")).applyInArrow(remove, schema)

    def unchanged(batches):
        for t in batches:
            for part in slices(t):
                w = words(part["text"], hashed=False)
                out = _kept(w, np.zeros(len(w.offsets) - 1, np.int64), np.zeros(len(w.starts), bool))
                yield from beside(out.set_column(0, "doc_id", pa.nulls(len(out), pa.int64())), part).to_batches()

    out = known.unionByName(texts.where("doc_id is null").mapInArrow(unchanged, schema))
    return out.select(*(c for c in out.columns if c != "row"), *(F.col("row")[c].alias(c) for c in columns)) if columns else out


def _answers(table: pa.Table, lengths: list[int], hit: np.ndarray) -> pa.Table:
    """For each group that sent rows, the places of its items that hit."""
    edges, rows = np.r_[0, np.cumsum(lengths)], []
    for k, (g, places) in enumerate(zip(table["g"].to_pylist(), binaries(table["places"]), strict=True)):
        own = hit[edges[k] : edges[k + 1]]
        if own.any():
            rows.append((g, pack(unpack(places)[own])))
    return _table(rows, _ANSWER)


def _kept(w: Words, ids: np.ndarray, gone: np.ndarray) -> pa.Table:
    """Rows of the result: the kept words of each text joined by one space."""
    edge = np.zeros(len(w.buf) + 1, np.int8)
    edge[w.starts[~gone]] += 1
    np.add.at(edge, np.minimum(w.ends[~gone] + 1, len(w.buf)), -1)  # with the white space after it
    keep = np.cumsum(edge[:-1], dtype=np.int8) > 0
    buf = w.buf.copy()
    last = w.ends[~gone]
    buf[last] = 32
    place = np.r_[0, np.cumsum(keep)]
    out = buf[keep].tobytes()
    cum = np.r_[0, np.cumsum(gone)]
    rows = []
    for k, i in enumerate(ids):
        a, b = int(w.offsets[k]), int(w.offsets[k + 1])
        text = out[place[w.starts[a]] : place[w.ends[b - 1] + 1 if b - 1 < len(w.ends) else -1]][:-1] if b > a and cum[b] - cum[a] < b - a else b""
        spans = []
        if cum[b] > cum[a]:
            own = np.diff(gone[a:b].view(np.int8), prepend=np.int8(0), append=np.int8(0))
            spans = [{"first": int(x), "end": int(y)} for x, y in zip(np.flatnonzero(own == 1), np.flatnonzero(own == -1), strict=True)]
        rows.append((int(i), b - a, spans, int(cum[b] - cum[a]), text.decode(), hashlib.sha256(text).hexdigest()))
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    return _table(rows, [("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", span), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def substring_digest(docs: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of duplicated_words()."""
    return duplicated_words(docs, window).select("doc_id", "n_words", "n_removed", "kept_sha256")
