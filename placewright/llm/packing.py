"""Hierarchical multi-length packing of tokenised documents.

A task packs the documents of its input split in groups of about `GROUP` tokens, without a shuffle. A document is cut into full
windows of the longest tier; the rest is routed to the shortest tier that holds it. Tiers are packed from the longest:
a window begins with one of its own pieces, and its gap is filled by the longest fitting pieces of shorter tiers, the
last of them cut to fill it. What remains of the last windows is cut into windows of powers of two, so none needs padding.
Sequences are then dealt into step groups so that each has about the same number of tokens of each tier.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import small_batches
from .words import slices

TIERS = (256, 512, 1024, 2048)
GROUP = 2_000_000
STEP = 64


_encoders: dict = {}


def encoder(path: str | None = None) -> Callable[[str], np.ndarray]:
    """Ids of a text by the tokenizers library's byte-level BPE file at `path`, without those that it would add; strings of its special tokens get their ids.

    The same vocabulary is applied by tiktoken, which is faster; a text that its pattern matching refuses, as very long runs of
    white space, goes to the tokenizers library itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    if path in _encoders:
        return _encoders[path]
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"]: t["id"] for t in held.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in held["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    whole = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its pattern matching ran out of stack
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)

    _encoders[path] = encode
    return encode


def plan(lengths: np.ndarray, tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (tier, pieces (document, start, length)) that hold each token once; all are full windows or powers of two."""
    top, out = tiers[-1], []
    pools: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # (length, document, start), ascending
    for d, n in enumerate(lengths.tolist()):
        for s in range(0, n - top + 1, top):
            out.append((top, [(d, s, top)]))
        if r := n % top:
            pools[next(i for i, t in enumerate(tiers) if r <= t)].append((r, d, n - r))
    for p in pools:
        p.sort()

    def put(piece: tuple[int, int, int]) -> None:
        pool = pools[next(i for i, t in enumerate(tiers) if piece[0] <= t)]
        pool.insert(bisect_right(pool, piece), piece)

    for level in range(len(tiers) - 1, -1, -1):
        tier, pool = tiers[level], pools[level]
        while pool:
            n, d, s = pool.pop()
            row, gap = [(d, s, n)], tier - n
            while gap:
                fit = None
                for p in pools[level::-1]:
                    i = bisect_right(p, (gap, 1 << 60, 0))
                    if i and (fit is None or p[i - 1] > fit[1][i_fit]):
                        fit, i_fit = (0, p), i - 1
                        break
                if fit is not None and (fit[1][i_fit][0] * 4 >= gap or gap <= 64):
                    n, d, s = fit[1].pop(i_fit)
                    row.append((d, s, n))
                    gap -= n
                    continue
                longer = next((p for p in pools[: level + 1] if p and p[-1][0] > gap), None)
                if longer is None and fit is None:
                    break
                if longer is None:
                    n, d, s = fit[1].pop(i_fit)
                    row.append((d, s, n))
                    gap -= n
                    continue
                n, d, s = longer.pop()
                row.append((d, s, gap))
                put((n - gap, d, s + gap))
                gap = 0
            if not gap:
                out.append((tier, row))
                continue
            left = tier - gap
            for bit in range(left.bit_length() - 1, -1, -1):
                if left >> bit & 1:
                    need, part = 1 << bit, []
                    while need:
                        d, s, n = row.pop(0)
                        m = min(n, need)
                        part.append((d, s, m))
                        need -= m
                        if n > m:
                            row.insert(0, (d, s + m, n - m))
                    out.append((1 << bit, part))
    return out


def step_groups(sequences: list[tuple[int, list]], step: int = STEP) -> list[list[int]]:
    """Groups of at most `step` sequences, each with its share of each tier."""
    groups = max(1, -(-len(sequences) // step))
    by_tier = sorted(range(len(sequences)), key=lambda i: -sequences[i][0])
    return [by_tier[g::groups] for g in range(groups)]


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, ids.

    A document's ids are those of its whole text (null: empty), then end_id. Every id lies in one piece, every
    sequence is gapless from 0. Rows with equal or null doc_id are documents of their own; other columns are not read; an
    empty table gives no rows. sequence_id counts within the task's partition, whose number stands above bit 40.
    Sequences of a step_group, at most STEP, are trained on together; each has its share of every tier.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    small_batches(docs.sparkSession)
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int64()), ("step_group", pa.int64()), ("ids", pa.list_(pa.int32()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        base, step, ids, held, tokens = TaskContext.get().partitionId() << 40, TaskContext.get().partitionId() << 40, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, step, tokens
            sequences = plan(np.array([len(x) for x in held]), tiers)
            columns: list[list] = [[] for _ in range(9)]
            values, sizes = [], [0]
            groups = step_groups(sequences)
            for k, (group, i) in enumerate((step + j, i) for j, own in enumerate(groups) for i in own):
                at = 0
                for d, s, n in sequences[i][1]:
                    own = held[d][s : s + n]
                    for column, x in zip(columns, (ids[d], s, n, zlib.crc32(own.tobytes()), len(held[d]), base + k, at, sequences[i][0], group), strict=True):
                        column.append(x)
                    values.append(own)
                    sizes.append(sizes[-1] + n)
                    at += n
            flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat))
            yield from pa.table([*(pa.array(c, pa.int64()) for c in columns), lists], names=[n for n, _ in kinds]).to_batches(max_chunksize=2000)
            base, step, tokens = base + len(sequences), step + len(groups), 0
            ids.clear()
            held.clear()

        for batch in batches:
            for t in slices(batch):
                for i, text in zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True):
                    x = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                    ids.append(i)
                    held.append(x)
                    tokens += len(x)
                    if tokens >= GROUP:
                        yield from flush()
        if held:
            yield from flush()

    return texts.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, step_group long, ids array<int>")
