"""Similarity join of documents on sets of word shingles, by PartEnum signatures.

Sizes fall into bands whose ends differ by the similarity; two similar sets are of one band or of neighbours, and each
set also signs for the next band. In a band similar sets differ in at most k elements. Elements are dealt by hash into more
than k / 2 first-level partitions of three second-level ones, so some first-level partition has at most one
difference, and two of its three parts are equal: these subsets of two are enumerated and signed by a commutative hash of
their elements (all elements, where k is 0). Empty subsets sign only for a set too thin to be found without them. So no
similar pair is lost.

Two sets differ no more if elements are left out of both. So elements of many sets, as of a common line, don't sign where a set
has enough others that k differences can't hide it; else it signs by the others and by all, and two such sets meet by the latter.
Which elements are left out changes what is compared, never what is linked.

Equal sets are one class from the start. Classes that share enough signatures, directly or through others, form a cluster; its
sets lie in parts, those of one large signature group together, and a set travels once to each pair of parts in which a
signature has a partner for it. There all intersections are counted by a matrix product. Tasks return spanning links, never all pairs, so no
link between different sets is lost. The work within a signature group larger than a part grows with the square of its
distinct sets: whether near-threshold copies are linked can't be told without comparing them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import durable, remove, star_components
from .spread import Unions, binaries, by_bucket, filter_of, narrow, pack, passing, place_in_filter, sizes, small_batches, unpack
from .words import GOLD, M1, mix, shingle_sets, slices, words

FLUSH = 500_000
#: Bytes of an element's hash that are sent to compare two sets.
WIDTH = 6
#: Size of a part of a large cluster, about, each set counting its elements and SET more (so at most 2,000 sets); distinct elements in a matrix product.
CHUNK, SET, COLUMNS = 500_000, 250, 2048
#: Members of a signature group whose pairs are counted.
LIGHT = 32
#: Sets of which an element is left out of signatures, the most such elements, elements counted together in a task, and sets there that make one count.
OFTEN, MOST_OFTEN, COUNTED, TIMES = 4 * LIGHT, 1 << 16, 1 << 20, 4
#: Second-level partitions of a first-level one.
PARTS = 3


def bands(most: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Last sizes of the bands up to beyond `most`, the most elements k in which two similar sets differ there, and first-level partitions."""
    ends, first = [], 1
    while len(ends) < 2 or ends[-2] < most:
        ends.append(first * den // num)
        first = ends[-1] + 1
    ends = np.array(ends)
    k = 2 * ends * (den - num) // (den + num)
    return ends, k, np.where(k > 0, (k + 2) // 2 + (k + 1) // 14, 1)


def signatures(values: np.ndarray, offsets: np.ndarray, num: int, den: int, often: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of consecutive sets, the set of each, in order, and how many first-level partitions of each set may lack one. often: elements left out where a set can be found without them, ascending."""
    n = np.diff(offsets)
    ends, k, firsts = bands(int(n.max(initial=1)), num, den)
    band = np.searchsorted(ends, n)
    own = np.repeat(np.arange(len(n)), n)
    rare = np.ones(len(values), bool) if often is None or not len(often) else often[np.minimum(np.searchsorted(often, values), len(often) - 1)] != values
    some = np.bincount(own, weights=~rare, minlength=len(n)) > 0
    v = mix(values ^ GOLD)
    low, high = (v & np.uint64(0xFFFFFFFF)).astype(float), (v >> np.uint64(32)).astype(float)
    out, who, thin = [], [], np.zeros(len(n), np.int64)
    for b in (band, band + 1):
        width = np.where(n > 0, firsts[b] * PARTS, 0)
        base = np.r_[0, np.cumsum(width)]
        at = base[own] + (values % width[own].astype(np.uint64)).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), width // PARTS)
        place = (np.arange(len(doc)) - base[doc] // PARTS).astype(np.uint64)
        seed = mix((place + np.uint64(1)) * GOLD + b[doc].astype(np.uint64))
        every = k[b][doc] == 0

        def signed(of: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
            """By these elements: signatures without each part, whether any are left there, partitions that may lack one, and sets that k differences may hide: two in a partition, or one where only one part is filled."""
            filled = np.bincount(at[of], minlength=base[-1]).reshape(-1, PARTS)
            sums = np.bincount(at[of], weights=low[of], minlength=base[-1]).astype(np.uint64) + (np.bincount(at[of], weights=high[of], minlength=base[-1]).astype(np.uint64) << np.uint64(32))
            sums = mix(sums + (np.arange(base[-1]) % PARTS).astype(np.uint64) * M1).reshape(-1, PARTS)
            parts = (filled > 0).sum(1)
            thick, single = (np.bincount(doc, weights=x, minlength=len(n)).astype(np.int64) for x in (parts > 1, parts == 1))
            total, whole = sums.sum(1, dtype=np.uint64), filled.sum(1)
            signs = [mix(np.where(every, total, total - sums[:, j]) + seed + np.where(every, np.uint64(0), np.uint64(j + 1))) for j in range(PARTS)]
            return signs, [whole > filled[:, j] for j in range(PARTS)], width // PARTS - thick, 2 * thick + single <= k[b]

        signs, left, lack, few = signed(rare)
        few = few | (k[b] == 0)
        signs_all, left_all, lack_all, few_all = signed(few[own])
        thin = np.maximum(thin, np.where(few, lack_all, lack))
        for j in range(PARTS):
            keep = left[j] & (some | ~few)[doc] & ~every
            keep_all = few[doc] & np.where(every, j == 0, few_all[doc] | left_all[j])
            out += [signs[j][keep], signs_all[j][keep_all]]
            who += [doc[keep], doc[keep_all]]
    order = np.argsort(np.concatenate(who), kind="stable")
    return np.concatenate(out)[order], np.concatenate(who)[order], thin


def elements(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // WIDTH, 8), np.uint8)
    out[:, :WIDTH] = np.frombuffer(packed, np.uint8).reshape(-1, WIDTH)
    return out.view(np.uint64).ravel()


def linked(sets: list[np.ndarray], first: int, num: int, den: int) -> np.ndarray:
    """A label that linked sets share, the place of one of them. If there are more than `first`, those are compared with the others only."""
    n, sizes_ = len(sets), np.array([len(x) for x in sets])
    own = np.repeat(np.arange(n), sizes_)
    _, at, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(seen > 1) - 1
    keep = (seen > 1)[at]
    own, at = own[keep], column[at[keep]]
    rest = slice(first, n) if first < n else slice(0, n)
    both = np.zeros((first, len(range(*rest.indices(n)))), np.float64)
    order = np.argsort(at, kind="stable")
    own, at = own[order], at[order]
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        s, e = np.searchsorted(at, (start, start + COLUMNS))
        x = np.zeros((n, COLUMNS), np.float32)
        x[own[s:e], at[s:e] - start] = 1
        both += x[:first] @ x[rest].T
    unions = Unions(n)
    for i in range(first):
        near = np.flatnonzero((both[i] > 0) & (den * both[i] >= num * (sizes_[i] + sizes_[rest] - both[i])))
        if len(near) > 1 or first < n and len(near):  # more than itself
            unions.join(i, unions.roots(rest.start, rest.stop)[near])
    return unions.roots(0, n)


def digests(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set, as signed longs."""
    sums = np.r_[np.uint64(0), np.cumsum(mix(values * GOLD + np.uint64(7)), dtype=np.uint64)]
    return mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64)


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, by links of den * |intersection| >= num * |union|.

    A-Z are lower-cased; a set holds the distinct k-word shingles of the whole text, or the whole sequence of fewer words.
    component_id is the smallest doc_id that links reach, the document's own included. Null and empty texts have empty
    sets and link with nothing; so do rows with a null doc_id, whose component_id is null. Repeated rows give repeated
    results. Other columns of docs are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    small_batches(docs.sparkSession)
    _, n_buckets = sizes(texts)

    def read(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, offsets = shingle_sets(words(t["text"], lower=True), k)
        return values, offsets, digests(values, offsets)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents (sets is null), and elements (digest) by the number of different sets that hold them, of those that several sets read together hold."""
        seen: set[int] = set()
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                value, n = np.unique(np.concatenate(held), return_counts=True)
                value, n = value[n >= TIMES], n[n >= TIMES]
                nulls = pa.nulls(len(n), pa.int64())
                yield pa.RecordBatch.from_arrays([nulls, nulls, pa.array(value.view(np.int64)), pa.array(n)], ["doc_id", "n_shingles", "digest", "sets"])
            held.clear()
            seen.clear()

        for batch in batches:
            for t in slices(batch):
                values, offsets, digest = read(t)
                n = np.diff(offsets)
                yield pa.RecordBatch.from_arrays([t["doc_id"].combine_chunks(), pa.array(n), pa.array(digest, mask=n == 0), pa.nulls(len(n), pa.int64())], ["doc_id", "n_shingles", "digest", "sets"])
                held.append(values[np.repeat(np.array([d not in seen and not seen.add(d) for d in digest.tolist()], bool), n)])
                if sum(len(x) for x in held) >= COUNTED:
                    yield from flush()
        yield from flush()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        ids: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if ids:
                h, who, digest = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]), np.concatenate([x for x, _ in ids])
                thin = narrow(np.concatenate([x for _, x in ids])).astype(np.uint32)
                rows = []
                for b, x in by_bucket(((h >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)):
                    own, at = np.unique(who[x], return_inverse=True)
                    rows.append((b, h[x].astype(np.uint32).tobytes(), pack(at), digest[own].tobytes(), thin[own].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3, 4))], ["bucket", "hashes", "who", "digests", "thin"])
            seen.clear()
            held.clear()
            ids.clear()

        for batch in batches:
            for t in slices(batch.filter(batch["doc_id"].is_valid())):
                values, offsets, digest = read(t)
                new = np.array([d not in seen and not seen.add(d) for d in digest.tolist()], bool) & (np.diff(offsets) > 0)
                keep = np.repeat(new, np.diff(offsets))
                n = np.diff(offsets)[new]
                if len(n):
                    at = sum(len(x) for x, _ in ids)
                    s, who, thin = signatures(values[keep], np.r_[0, np.cumsum(n)], num, den, often.value)
                    held.append((s, who + at))
                    ids.append((digest[new], thin))
                if sum(len(x) for x, _ in held) >= FLUSH:
                    yield from flush()
        yield from flush()

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint32) for x in binaries(table["hashes"])]
        h = np.concatenate(parts)
        who = [unpack(x) for x in binaries(table["who"])]
        digest = np.concatenate([np.frombuffer(d, np.int64)[w] for d, w in zip(binaries(table["digests"]), who, strict=True)])
        thin = np.concatenate([np.frombuffer(d, np.uint32)[w] for d, w in zip(binaries(table["thin"]), who, strict=True)]).astype(np.int32)
        order = np.argsort(h, kind="stable")
        s = h[order]
        first = np.r_[True, s[1:] != s[:-1]]
        alone = first & np.r_[first[1:], True]
        order = order[~alone]
        h, digest, thin = h[order], digest[order], thin[order]
        order = np.lexsort((digest, h))
        h, digest, thin = h[order], digest[order], thin[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (digest[1:] != digest[:-1])
        h, digest, thin = h[new], digest[new], thin[new]
        heads = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        size = np.diff(np.r_[heads, len(h)])
        many = np.repeat(size > 1, size)
        gid = (np.int64(key[0].as_py()) << 32) + h.astype(np.int64)
        return pa.table({"gid": gid[many], "digest": digest[many], "least": np.repeat(digest[heads] if len(h) else digest, size)[many], "thin": thin[many], "m": np.repeat(size, size)[many].astype(np.int32)})

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passing(wanted.value, batch["at"].to_numpy())))
            raw = batch["text"].cast(pa.large_binary()).to_pylist()
            z = [None if x is None else pa.compress(x, codec="zstd", asbytes=True) for x in raw]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(x or b"") for x in raw], pa.int64()), pa.array(z, pa.binary())], ["doc_id", "size", "z"])

    def restored(batch: pa.RecordBatch) -> Iterator[pa.Table]:
        """Rows of a batch with their texts, about a quarter of a MB of them at a time."""
        cut = np.cumsum(batch["size"].to_numpy()) // (1 << 18)
        for own in np.split(np.arange(len(cut)), np.flatnonzero(np.diff(cut)) + 1) if len(cut) else []:
            part = batch.slice(int(own[0]), len(own))
            raw = [None if z is None else pa.decompress(z, n, codec="zstd", asbytes=True) for z, n in zip(part["z"].to_pylist(), part["size"].to_pylist(), strict=True)]
            yield pa.Table.from_batches([part]).append_column("text", pa.array(raw, pa.large_binary()).cast(pa.large_string()))

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in restored(batch):
                values, offsets, digest = read(t)
                low = values.view(np.uint8).reshape(-1, 8)[:, :WIDTH]
                sets = [low[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield from pa.table({"doc_id": t["doc_id"], "digest": digest, "wanted": t["wanted"], "part": t["part"], "tasks": t["tasks"], "elements": pa.array(sets, pa.binary())}).to_batches()

    read_once = durable(texts.mapInArrow(describe, "doc_id long, n_shingles long, digest long, sets long"))
    described = read_once.where("sets is null").drop("sets")
    counts = read_once.where("sets is not null").groupBy("digest").agg(F.sum("sets").alias("sets")).where(F.col("sets") > OFTEN)
    top = counts.orderBy(F.desc("sets"), "digest").limit(MOST_OFTEN).toArrow()["digest"].to_numpy()
    often = docs.sparkSession.sparkContext.broadcast(np.sort(top.astype(np.int64).view(np.uint64)))
    classes = durable(described.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.min("n_shingles").alias("n")))
    signed = texts.mapInArrow(sign, "bucket int, hashes binary, who binary, digests binary, thin binary")
    groups = durable(signed.groupBy("bucket").applyInArrow(meet, "gid long, digest long, least long, thin int, m int"))

    # Similar sets share the signatures of all first-level partitions with at most one difference. Pairs within small groups are counted
    # against that bound; members of a large group go together uncounted.
    # Large groups with the same least set are taken as one: near copies share dozens of signatures, and few least sets. A set's leader is the least of
    # its largest group; sets with one leader are together anyway and aren't counted.
    heavy = groups.where(F.col("m") > LIGHT).groupBy("digest", F.col("least").alias("gid")).agg(F.max("m").alias("m"))
    leads = durable(heavy.groupBy("digest").agg(F.max(F.struct("m", "gid")).alias("lead")).select("digest", F.col("lead.gid").alias("leader")))
    light = groups.where(F.col("m") <= LIGHT).join(leads, "digest", "left")
    twice = light.select("gid", F.col("digest").alias("a"), "thin", "leader").join(light.select("gid", F.col("digest").alias("b"), F.col("thin").alias("other"), F.col("leader").alias("led")), "gid").where("a < b and not coalesce(leader = led, false)")
    counted = twice.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max(F.greatest("thin", "other")).alias("thin"))
    size = lambda c: classes.select(F.col("digest").alias(c), F.col("n").alias(f"n_{c}"))
    sized = counted.join(size("a"), "a").join(size("b"), "b").where(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)
    differ = lambda n: F.floor(n * (den - num) / (den + num))
    k_most = differ(2 * F.greatest("n_a", "n_b"))
    bound = F.floor((k_most + 2) / 2) + F.floor((k_most + 1) / 14) - F.floor(differ(F.col("n_a") + F.col("n_b")) / 2) - F.col("thin") - 1
    together = groups.where((F.col("m") > LIGHT) & (F.col("digest") != F.col("least"))).select(F.col("least").alias("a"), F.col("digest").alias("b"))
    near = durable(sized.where(F.col("shared") >= bound).select("a", "b"))
    clusters = star_components(together.unionByName(near).distinct())
    # Only sets of the same or neighbouring ranges of sizes can be similar.
    wide = math.log(den / num) * 1.0001
    members = classes.join(clusters.withColumnRenamed("id", "digest"), "digest").withColumn("range", F.floor(F.log("n") / wide).cast("int"))
    load = F.sum(F.col("n") + SET)
    members = durable(members.join(members.groupBy("component").agg(load.alias("all")), "component"))
    # Small clusters share tasks. A large one is cut into parts of a range, the sets of one large signature group together where a part holds them.
    shared = max(n_buckets, (members.agg(load).first()[0] or 0) // (2 * CHUNK))
    task = lambda x, y: F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.col("component").alias("c"))
    small = members.where(F.col("all") <= CHUNK).select("id", "digest", F.lit(0).cast("long").alias("part"), F.array(task(F.pmod(F.xxhash64("component"), F.lit(shared)), F.lit(-1))).alias("tasks"))
    pairs = near.groupBy(F.col("b").alias("digest")).agg(F.min("a").alias("partner"))
    big = members.where(F.col("all") > CHUNK).join(leads, "digest", "left").join(pairs, "digest", "left").withColumn("leader", F.coalesce("leader", "partner", "digest")).drop("partner")
    loads = big.groupBy("component", "range", "leader").agg(load.alias("load"))
    room = loads.where(F.col("load") <= CHUNK / 4).groupBy("component", "range").agg(F.ceil(F.sum("load") * 2 / CHUNK).alias("room"))
    own = F.when(F.col("load") > CHUNK / 4, F.xxhash64("component", "range", "leader", F.pmod(F.xxhash64("digest", F.lit(3)), F.ceil(F.col("load") / CHUNK))))
    part = F.shiftrightunsigned(F.coalesce(own, F.xxhash64("component", "range", F.pmod(F.xxhash64("leader"), F.col("room")))), 1)
    placed = durable(big.join(loads, ["component", "range", "leader"]).join(room, ["component", "range"], "left").select("id", "digest", "component", "range", part.alias("part")))
    # A set goes only where a signature has a partner for it: to the parts of its large groups, and to those of the sets it is counted near to.
    spot = lambda d, p: placed.select(F.col("digest").alias(d), F.col("part").alias(p), F.col("range").alias(f"{p}_range"))
    # Groups whose least sets have one leader are taken as one here: what shares a group shares that leader too.
    tops = leads.select(F.col("digest").alias("gid"), F.col("leader").alias("top"))
    led_by = heavy.select("gid", "digest").join(tops, "gid").select("digest", F.col("top").alias("gid")).distinct()
    met = led_by.join(spot("digest", "p"), "digest")
    beside = met.join(met.select("gid", F.col("p").alias("q"), F.col("p_range").alias("q_range")).distinct(), "gid").where(F.abs(F.col("p_range") - F.col("q_range")) <= 1).select("digest", "p", "q")
    both = durable(near.join(spot("a", "p"), "a").join(spot("b", "q"), "b"))  # read twice
    asked = beside.unionByName(both.select(F.col("a").alias("digest"), "p", "q")).unionByName(both.select(F.col("b").alias("digest"), F.col("q").alias("p"), F.col("p").alias("q"))).distinct()
    dealt = asked.join(placed.select("digest", "id", "component"), "digest").groupBy("id", "digest", F.col("p").alias("part")).agg(F.collect_list(task(F.least("p", "q"), F.greatest("p", "q"))).alias("tasks"))
    sent = durable(small.unionByName(dealt.select(small.columns)))
    for t in (groups, leads, near, members, placed, both):
        remove(t)
    # Texts of sets that go nowhere stay where they are, but for those that the filter passes by chance; the join is exact.
    words_, bits = filter_of(sent, "id")
    wanted = docs.sparkSession.sparkContext.broadcast(words_)
    zipped = texts.where("doc_id is not null").withColumn("at", place_in_filter("doc_id", bits)).mapInArrow(shrink, "doc_id long, size long, z binary")
    sets = zipped.join(sent.select(F.col("id").alias("doc_id"), F.col("digest").alias("wanted"), "part", "tasks").hint("merge"), "doc_id")  # the same plan at every size
    kinds = "doc_id long, digest long, wanted long, part long, tasks array<struct<x:long,y:long,c:long>>, elements binary"
    dealt = sets.mapInArrow(to_sets, kinds).where("digest = wanted").select("doc_id", "part", "elements", F.explode("tasks").alias("task"))
    keyed = dealt.select("doc_id", "part", "elements", F.col("task.c").alias("cluster"), F.col("task.x").alias("x"), F.col("task.y").alias("y"), F.when(F.col("task.y") >= 0, F.col("task.c")).alias("alone"))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        small = key[1].as_py() < 0
        table = table.sort_by([("cluster", "ascending"), ("part", "ascending"), ("doc_id", "ascending")])
        cluster, part, ids = table["cluster"].to_numpy(), table["part"].to_numpy(), table["doc_id"].to_numpy()
        held = [elements(x) for x in binaries(table["elements"])]
        edges = [0, *(np.flatnonzero(np.diff(cluster)) + 1), len(ids)] if small else [0, len(ids)]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            first = e - s if small or key[0].as_py() == key[1].as_py() else int(np.count_nonzero(part[s:e] == key[0].as_py()))
            label = linked(held[s:e], first, num, den)
            far = np.flatnonzero(label != np.arange(e - s))
            a.append(ids[s + far])
            b.append(ids[s + label[far]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    links = durable(keyed.groupBy("x", "y", "alone").applyInArrow(compare, "a long, b long"))
    labels = star_components(links)
    named = described.join(classes.select("digest", "id"), "digest", "left").join(labels, "id", "left")
    return named.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id")).alias("component_id"))
