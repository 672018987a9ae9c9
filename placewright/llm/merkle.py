"""Merkle manifest of a dataset: a tree of digests for each language over its rows, a tree of these above, proofs and their checks.

Leaves lie in aligned blocks of 8**4, each a contiguous numpy matrix of 64-byte hex digests. A block is reshaped by the fanout and hashed row by
row, level by level; siblings are found by index arithmetic alone. Block roots are the leaves of the next tier, so no task holds more than a block.

Rows without a doc_id come first, equal ids in the order of their leaves, equal rows in any (their digests are the same). No rows give no rows.
A lone leaf is its own root, with no siblings: its proof is the hash of nothing. Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.durable import durable, remove
from .spread import partitions

FANOUT = 8
#: Levels of a block, which so has up to 8**4 leaves.
LEVELS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(data: bytes) -> bytes:
    """64 bytes of lower-case hex."""
    return hashlib.sha256(data).hexdigest().encode()


def leaf_of(*columns: Column) -> Column:
    """Hash of the values in order, each as its length in UTF-8 bytes, a colon and itself, or a hyphen for null."""
    told = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*told), 256)


def ranked(rows: DataFrame, key: str, *by: str) -> DataFrame:
    """rows with `i`, their place from 0 among those of their key by the given columns, and `total`, how many these are.

    Ranges of (key, order) are sorted in parallel; a place is the range's first place plus the place in it, so a key with most rows is split like any other.
    Equal rows are parted by their place in the input. The table is written, as ranges are sampled and must not move.
    """
    order = [key, *by]
    cut = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(partitions(rows.sparkSession), *order, "_salt").sortWithinPartitions(*order, "_salt")
    placed = durable(cut.drop("_salt").select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    held = placed.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_of")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    own = Window.partitionBy("_key")
    spans = held.select("*", F.sum("_n").over(own).alias("total"), (F.sum("_n").over(own.orderBy("_of").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n") - F.col("_first")).alias("_shift"))
    joined = placed.join(spans, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of")))
    return durable(joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("i"), "total"), instead_of=placed)


def levels_of(leaves: np.ndarray, total: int, levels: int = LEVELS) -> list[np.ndarray]:
    """The block's matrices from its leaves up: to its one root if the tree is not larger than a block, else through all levels of a block."""
    out = [leaves]
    while (len(out) <= levels) if total > FANOUT**levels else len(out[-1]) > 1:
        d = out[-1]
        full = len(d) // FANOUT
        runs = [*d[: full * FANOUT].reshape(full, FANOUT * 64)]
        if len(d) % FANOUT:
            runs.append(d[full * FANOUT :].reshape(-1))
        out.append(np.frombuffer(b"".join(digest(r.tobytes()) for r in runs), np.uint8).reshape(-1, 64))
    return out


def matrix(column: list[str]) -> np.ndarray:
    return np.frombuffer("".join(column).encode(), np.uint8).reshape(-1, 64)


def siblings(tree: list[np.ndarray], i: int) -> list[tuple[bytes, bytes]]:
    """Digests before and after node i's own in its run, for each level below the block's root."""
    out = []
    for d in tree[:-1]:
        first = i - i % FANOUT
        out.append((d[first:i].tobytes(), d[i + 1 : first + FANOUT].tobytes()))
        i //= FANOUT
    return out


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (key, block) after another, from input sorted by these."""
    held: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if held and (r["key"], r["block"]) != (held[0]["key"], held[0]["block"]):
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def climb(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tiers of (key, i, total, digest): the given one, then its blocks' roots, up to one node for each key."""

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches):
            top = levels_of(matrix([r["digest"] for r in rows]), rows[0]["total"], levels)[-1]
            yield pa.RecordBatch.from_pylist([{"key": rows[0]["key"], "i": rows[0]["block"], "total": -(-rows[0]["total"] // FANOUT**levels), "digest": top.tobytes().decode()}], schema)

    schema = pa.schema([("key", pa.string()), ("i", pa.int64()), ("total", pa.int64()), ("digest", pa.string())])
    out = [nodes]
    while (out[-1].agg(F.max("total")).first()[0] or 0) > 1:
        given = out[-1].select("key", F.expr(f"i div {FANOUT**levels}").alias("block"), "i", "total", "digest")
        tasks = given.repartition(partitions(nodes.sparkSession), "key", "block").sortWithinPartitions("key", "block", "i")
        out.append(durable(tasks.mapInArrow(roots, "key string, i long, total long, digest string")))
    return out


def told(tree: list[np.ndarray], i: int, above: str) -> str:
    """A node's way to the root, as lines of the digests before and after its own, continued by its block's."""
    own = "".join(f"{a.decode()} {b.decode()}\n" for a, b in siblings(tree, i))
    return own + above


def descend(tiers: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """(key, i, subroot, root, path) of each block of the lowest tier, its path being that of its root; tops has (key, subroot, root, path) of the last tier's."""

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches):
            top, rows = rows[0], rows[1:]
            tree = levels_of(matrix([r["digest"] for r in rows]), rows[0]["total"], levels)
            yield pa.RecordBatch.from_pylist([{"key": r["key"], "i": r["i"], "subroot": top["subroot"], "root": top["root"], "path": told(tree, k, top["path"])} for k, r in enumerate(rows)], schema)

    schema = pa.schema([("key", pa.string()), ("i", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("path", pa.string())])
    out = tops.select("key", F.lit(0).cast("long").alias("i"), "subroot", "root", "path")
    for nodes in reversed(tiers[1:-1]):
        out = durable(below(nodes, out, levels).mapInArrow(paths, "key string, i long, subroot string, root string, path string"))
    return out


def below(nodes: DataFrame, ways: DataFrame, levels: int, *columns: str) -> DataFrame:
    """Nodes by block, each block behind the row that tells its root's way up."""
    given = nodes.select("key", F.expr(f"i div {FANOUT**levels}").alias("block"), "i", "total", "digest", *columns)
    heads = ways.select("key", F.col("i").alias("block"), F.lit(-1).cast("long").alias("i"), "subroot", "root", "path")
    return given.unionByName(heads, allowMissingColumns=True).repartition(partitions(nodes.sparkSession), "key", "block").sortWithinPartitions("key", "block", "i")


def fold(leaf: bytes, way: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for before, after in way:
        leaf = digest(before + leaf + after)
    return leaf


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """(doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    tampered is the text of the rows as they are now (default: the given one). Roots and proofs are of the given rows; folded_root is what
    the leaf of the present text gives with the proof, and verified says whether it is the root.
    """
    given = docs.select("doc_id", "source", "lang", "n_chars", "text", (F.col("text") if tampered is None else tampered).alias("now"))
    said = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = given.select("doc_id", F.col("lang").alias("key"), leaf_of(*said, F.col("text")).alias("digest"), F.when(~F.col("text").eqNullSafe(F.col("now")), leaf_of(*said, F.col("now"))).alias("now"))
    tiers = climb(ranked(leaves, "key", "doc_id", "digest"), levels)
    subroots = tiers[-1].select(F.lit("").alias("key"), F.col("key").alias("lang"), "digest")
    upper = climb(ranked(subroots.withColumn("known", F.col("lang").isNotNull()), "key", "known", "lang"), levels)

    # Ways of the languages' roots through the tree above them.
    def upward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches):
            top, rows = rows[0], rows[1:]
            tree = levels_of(matrix([r["digest"] for r in rows]), rows[0]["total"], levels)
            yield pa.RecordBatch.from_pylist([{"key": r["lang"], "subroot": r["digest"], "root": top["root"], "path": told(tree, k, top["path"])} for k, r in enumerate(rows)], tops)

    tops = pa.schema([("key", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("path", pa.string())])
    root = upper[-1].select("key", F.lit("").alias("subroot"), F.col("digest").alias("root"), F.lit("").alias("path"))
    ways = durable(below(upper[0], descend(upper, root, levels), levels, "lang").mapInArrow(upward, "key string, subroot string, root string, path string"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches):
            top, rows = rows[0], rows[1:]
            tree = levels_of(matrix([r["digest"] for r in rows]), rows[0]["total"], levels)
            above = [tuple(x.encode() for x in line.split(" ")) for line in top["path"].splitlines()]
            rest = b"".join(a + b for a, b in above)
            out = []
            for k, r in enumerate(rows):
                own = siblings(tree, k)
                proof = digest(b"".join(a + b for a, b in own) + rest)
                folded = fold((r["now"] or r["digest"]).encode(), own + above)
                out.append((r["doc_id"], r["key"], r["digest"], top["subroot"], top["root"], proof.decode(), folded.decode(), folded.decode() == top["root"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), result, strict=True)], schema=result)

    result = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("lang", "leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())])
    tasks = below(tiers[0], descend(tiers, ways, levels), levels, "doc_id", "now")
    out = durable(tasks.mapInArrow(check, "doc_id long, lang string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))
    for t in (*tiers, *upper, ways):
        remove(t)
    return out


def tampered_text() -> Column:
    """The text, with A-Z lower-cased where 3 divides the row's checksum of doc_id."""
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
