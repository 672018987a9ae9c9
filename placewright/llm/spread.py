"""Shared Spark plumbing: text groups, hash buckets packed as binary columns, unions of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.durable import durable
from .words import slices

GROUP_BYTES = 4 << 20
#: Bits of a filter of ids, at most: 4 MB.
FILTER_BITS = 1 << 25
BUCKET_BYTES = 8 << 20


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python by at most so many rows at a time in this session, as a batch of long ones is held several times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column, by one pruned scan."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def buckets_for(spark: SparkSession, n_bytes: int) -> int:
    """Hash buckets for a text of this size: each holds a bounded part of it."""
    return max(partitions(spark), -(-n_bytes // BUCKET_BYTES))


def sizes(docs: DataFrame) -> tuple[int, int]:
    """Numbers of text groups and of hash buckets: each holds a bounded part of the input at any size of it."""
    n = text_bytes(docs)
    return max(partitions(docs.sparkSession), -(-n // GROUP_BYTES)), buckets_for(docs.sparkSession, n)


def group_of(n: int, *columns: str) -> Column:
    """A group below n, by a hash of a row's own values, so that reruns agree whatever the partitions."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def place_in_filter(column: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(bits))


def filter_of(ids: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """Words of a filter that every value of the column passes, and its bits: some eight for each row, FILTER_BITS at most. About an eighth of other values pass too, more if there are many rows."""
    bits = min(FILTER_BITS, max(1 << 16, 1 << (8 * ids.count()).bit_length()))
    at = ids.select(place_in_filter(column, bits).alias("h"))
    got = at.groupBy(F.shiftright("h", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("v")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got["w"].to_numpy()] = got["v"].to_numpy()
    return out.view(np.uint64), bits


def passing(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def text_groups(rows: DataFrame) -> DataFrame:
    """(g, n_bytes, data): consecutive rows with about GROUP_BYTES of `text` each, as a compressed Arrow stream, written so that a group stays as it is.

    Groups follow the input, so equal rows spread like any others; a longer text is a group of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, n = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal base
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for t in held:
                    out.write_table(t)
            base += 1
            return pa.RecordBatch.from_arrays([pa.array([base - 1], pa.int64()), pa.array([n], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["g", "n_bytes", "data"])

        for batch in batches:
            for t in slices(batch):
                size = pa.compute.sum(pa.compute.binary_length(t["text"])).as_py() or 0
                if held and n + size > GROUP_BYTES:
                    yield flush()
                    held, n = [], 0
                held.append(t)
                n += size
        if held:
            yield flush()

    small_batches(rows.sparkSession)
    return durable(rows.mapInArrow(run, "g long, n_bytes long, data binary"))


def group_rows(data: bytes) -> pa.Table:
    """The rows of a group of text_groups()."""
    return pa.ipc.open_stream(data).read_all()


def narrow(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the fewest bytes that hold them."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32 if top < 1 << 32 else np.uint64)


def pack(x: np.ndarray) -> bytes:
    """Ascending places as differences in the fewest bytes."""
    d = narrow(np.diff(x.astype(np.int64), prepend=0))
    return bytes([d.itemsize]) + d.tobytes()


def unpack(b: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(b, f"u{b[0]}", offset=1).astype(np.int64))


def squeeze(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, as the high ones compress well, and compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(planes).to_bytes(6, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def release(b: bytes, kind: str) -> np.ndarray:
    """The numbers of squeeze(), of that type."""
    raw = pa.decompress(b[6:], int.from_bytes(b[:6], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def squeeze_counts(x: np.ndarray) -> bytes:
    """Numbers from 0 in the fewest bytes, compressed."""
    x = narrow(x)
    return bytes([x.itemsize]) + squeeze(x)


def release_counts(b: bytes) -> np.ndarray:
    return release(b[1:], f"u{b[0]}").astype(np.int64)


def binaries(column: pa.ChunkedArray) -> list[bytes]:
    return column.to_pylist()


def by_bucket(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, rows in order) of every bucket with rows."""
    if not len(bucket):
        return []
    if int(bucket.max()) < 65536:
        bucket = bucket.astype(np.uint16)  # sorted by digits
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    return [(int(own[a]), order[a:b]) for a, b in zip(heads, [*heads[1:], len(own)], strict=True)]


class Unions:
    """Labels of linked points, joined by spanning links."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = int(self.up[i])
        return i

    def roots(self, a: int, b: int) -> np.ndarray:
        r = self.up[a:b]
        while ((s := self.up[r]) != r).any():
            r = s
        return r

    def join(self, i: int, others: np.ndarray) -> None:
        """Link i with all others (by their roots)."""
        r = self.root(i)
        for o in np.unique(others).tolist():
            o = self.root(o)
            if o != r:
                self.up[max(o, r)] = min(o, r)
                r = min(o, r)
