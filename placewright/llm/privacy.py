"""Personal data in texts, and terms of which the corpus shows that they reveal it.

Base entities are found by four fixed patterns. Then, for every entity value and every term near it, co-occurrence over all documents gives the
pointwise mutual information log2(N n(e,t) / (n(e) n(t))): n(e,t) documents hold t within WINDOW words of e, n(t) hold it anywhere. A term discloses e
if that is at least DISCLOSED of the entity's own information log2(N / n(e)), and if at least SUPPORT different surroundings show the two together, so
that copies of one text prove nothing. In documents that hold e, such a term is generalised to its shape (what it is made of, and its length in bytes)
if the shape's information on e stays below the threshold, else removed. Base spans stay; terms are words outside them, A-Z lower-cased.

A null text is empty. Equal texts of different rows count as documents of their own. No rows give no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.durable import durable, remove
from .spread import small_batches
from .words import ALNUM, slices, words

KINDS = ("email", "ip", "card", "phone")
WINDOW = 8
SUPPORT = 2
DISCLOSED = 0.9

#: Bits of the filter through which a document's words pass before they are counted; its 4 MB are all that is broadcast, whatever the corpus.
FILTER_BITS = 25
#: Counts that a task holds before it hands them on.
HELD = 200_000

#: The patterns of the kinds, written so that no start within a run that failed is tried again.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What a text must hold to be looked at, by kind.
HINTS = (r"@[A-Za-z0-9-]+\.", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", r"(?:[0-9][ -]?){15}[0-9]", r"\+[0-9]")

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def luhn(digits: str) -> bool:
    """Whether the checksum of a card number is right."""
    own = [int(c) for c in reversed(digits)]
    return (sum(own[::2]) + sum(sum(divmod(2 * d, 10)) for d in own[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int, str]]:
    """Each domain, with what stands before its sign back to the match before."""
    end = 0
    for m in DOMAIN.finditer(text):
        a = m.start()
        while a > end and text[a - 1] in LOCAL:
            a -= 1
        if a < m.start():
            end = m.end()
            yield a, end, text[a:end].lower()


def entities(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) in code points, by kind as listed, then start."""
    out = [("email", a, b, v) for a, b, v in emails(text)] if "@" in text else []
    out += [("ip", *m.span(), m[0]) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in (("card", CARD, 16, 19), ("phone", PHONE, 8, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span(), digits))
    return out


def shape(term: str) -> str:
    """`~`, what the term is made of (digits, ASCII letters, or more) and its bytes."""
    raw = term.encode()
    return f"~{'#' if raw.isdigit() else 'a' if raw.isalpha() else 'x'}{len(raw)}"


def surroundings(text: str, found: list[tuple[str, int, int, str]], window: int) -> tuple[list[dict], list[dict]]:
    """What the text shows of its entities: (e, t, ctx, first) for e alone, each term near it and its shape, and each term near any (e is empty); and (t, a, b) of these terms wherever they stand."""
    taken = sorted((a, b) for _, a, b, _ in found)
    reach = list(itertools.accumulate((b for _, b in taken), max))  # the furthest end of those that begin so far
    own = []
    for m in TERM.finditer(text):
        k = bisect.bisect_left(taken, (m.end(),)) - 1
        if k < 0 or reach[k] <= m.start():
            own.append((m.start(), m.end(), m[0].translate(LOWER)))
    starts = [a for a, _, _ in own]
    seen: set[tuple] = set()
    pairs: set[tuple[str, str]] = set()
    shown, near = [], set()

    def show(e: str, t: str, ctx: int) -> None:
        if (e, t, ctx) not in seen:
            seen.add((e, t, ctx))
            shown.append({"e": e, "t": t, "ctx": ctx, "first": (e, t) not in pairs})
            pairs.add((e, t))

    for kind, a, b, value in found:
        e = f"{kind}:{value}"
        left, right = bisect.bisect_left(starts, a), bisect.bisect_left(starts, b)
        terms = [t for _, _, t in own[max(0, left - window) : left] + own[right : right + window]]
        ctx = xxhash.xxh64_intdigest("\x1f".join(terms)) - (1 << 63)
        show(e, "", 0)
        for t in terms:
            near.add(t)
            show(e, t, ctx)
            show(e, shape(t), ctx)
    for t in near:
        show("", t, 0)
    return shown, [{"t": t, "a": a, "b": b} for a, b, t in own if t in near]


SHOWN = pa.struct([("e", pa.string()), ("t", pa.string()), ("ctx", pa.int64()), ("first", pa.bool_())])
TERMS = pa.struct([("t", pa.string()), ("a", pa.int64()), ("b", pa.int64())])
NOTE = "array<struct<e:string,t:string,ctx:bigint,first:boolean>>", "array<struct<t:string,a:bigint,b:bigint>>"


def spans_text(spans: list[tuple]) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def noted(docs: DataFrame, window: int, carry: bool = False) -> DataFrame:
    """One row for each of docs: its base spans, and of texts with any what surrounds them. carry keeps the text. Written, as its row ids must stay."""
    schema = pa.schema([
        ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("base", pa.string()), ("shown", pa.list_(SHOWN)), ("terms", pa.list_(TERMS)),
        *([("text", pa.string())] if carry else []),
    ])
    nothing = (0, 0, 0, 0, hashlib.sha256().hexdigest(), "", None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch):
                hit = np.zeros(t.num_rows, bool)
                for hint in HINTS:
                    hit |= np.asarray(pc.fill_null(pc.match_substring_regex(t["text"], hint), False))
                out = [nothing] * t.num_rows
                for k in np.flatnonzero(hit).tolist():
                    text = t["text"][k].as_py()
                    found = entities(text)
                    if found:
                        counts = [sum(f[0] == kind for f in found) for kind in KINDS]
                        base = spans_text(found)
                        out[k] = (*counts, hashlib.sha256(base.encode()).hexdigest(), base, *surroundings(text, found, window))
                columns = [t["doc_id"].combine_chunks(), *(pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(schema)[1:9], strict=True)), *([t["text"].combine_chunks()] if carry else [])]
                yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=schema)

    small_batches(docs.sparkSession)
    kinds = "doc_id long, " + "".join(f"n_{k} long, " for k in KINDS) + f"base_sha256 string, base string, shown {NOTE[0]}, terms {NOTE[1]}" + (", text string" if carry else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kinds)
    return durable(rows.withColumn("id", F.monotonically_increasing_id()))


def filter_of(terms: DataFrame) -> np.ndarray:
    """A bit for the hash of each term, as words of 64 bits: gathered in Spark, at most 2**(FILTER_BITS - 6) rows whatever the terms."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = words(batch["t"], ALNUM).hashes >> np.uint64(64 - FILTER_BITS)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["slot", "bits"])

    found = terms.mapInArrow(bits, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[np.asarray(found["slot"])] = np.asarray(found["bits"])
    return out.view(np.uint64)


def document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(t, n): documents that hold each of the terms, and each shape of words, over the whole corpus.

    Each task counts what it reads; words that the filter surely excludes stay there, and what else is no term goes in the join.
    """
    mask = docs.sparkSession.sparkContext.broadcast(filter_of(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, counts = mask.value, Counter()

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["t", "n"])
            counts.clear()
            return out

        for batch in batches:
            for t in slices(batch):
                if len(counts) > HELD:
                    yield told()
                w = words(t["text"], ALNUM, lower=True)
                if not len(w.starts):
                    continue
                size, doc = w.ends - w.starts, w.doc
                digits = np.add.reduceat((w.buf >= 48) & (w.buf <= 57), w.starts, dtype=np.int64)
                letters = np.add.reduceat((w.buf >= 97) & (w.buf <= 122), w.starts, dtype=np.int64)
                kind = np.where(digits == size, 0, np.where(letters == size, 1, 2))
                seen = np.unique((size * 3 + kind) * len(w.offsets) + doc) // len(w.offsets)
                shapes, n_shapes = np.unique(seen, return_counts=True)
                at = w.hashes >> np.uint64(64 - FILTER_BITS)
                some = np.flatnonzero((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1))
                order = some[np.lexsort((doc[some], w.hashes[some]))]
                h, d = w.hashes[order], doc[order]
                order = order[np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]] if len(order) else order
                _, first, n = np.unique(w.hashes[order], return_index=True, return_counts=True)
                names = [w.buf[w.starts[i] : w.ends[i]].tobytes().decode() for i in order[first].tolist()]
                names += [f"~{'#ax'[s % 3]}{s // 3}" for s in shapes.tolist()]
                for name, more in zip(names, np.r_[n, n_shapes].tolist(), strict=True):
                    counts[name] += more
        yield told()

    small_batches(docs.sparkSession)
    return docs.select("text").mapInArrow(run, "t string, n long").groupBy("t").agg(F.sum("n").alias("n"))


def rules_of(notes: DataFrame, docs: DataFrame, support: int, disclosed: float) -> DataFrame:
    """(e, t, general): each term that discloses an entity, and whether its shape is general enough to stand for it."""
    shown = notes.where("shown is not null").select(F.explode("shown").alias("s")).select("s.*")
    pairs = durable(shown.groupBy("e", "t").agg(F.sum(F.col("first").cast("long")).alias("n_et"), F.countDistinct("ctx").alias("ways")))
    total = notes.count()
    held = pairs.where("t = ''").select("e", F.col("n_et").alias("n_e"))
    own = F.log2(F.lit(float(total)) / F.col("n_e"))
    share = F.log2(F.lit(float(total)) * F.col("n_et") / (F.col("n_e") * F.col("n")))
    reached = share >= F.lit(disclosed) * own
    told = pairs.where("t <> '' and e <> ''").join(held, "e")
    # A term that stands near too many entities can't disclose one, however rare it is elsewhere: it needn't be counted.
    near = pairs.where("e = ''").select("t", F.col("n_et").alias("n"))
    known = durable(told.where((F.col("ways") >= support) & ~F.col("t").startswith("~")).join(near, "t").where(reached).select("e", "t", "n_et", "n_e"))
    counts = durable(document_counts(docs, known.select("t").distinct()))
    high = told.where(F.col("t").startswith("~")).join(counts, "t").where(reached).select("e", "t")
    found = known.join(counts, "t").where(reached).select("e", "t")
    form = F.concat(F.lit("~"), F.when(F.col("t").rlike(r"\A[0-9]+\z"), "#").when(F.col("t").rlike(r"\A[a-z]+\z"), "a").otherwise("x"), F.octet_length("t").cast("string"))
    telling = high.select("e", F.col("t").alias("form"), F.lit(False).alias("general"))
    out = durable(found.withColumn("form", form).join(telling, ["e", "form"], "left").select("e", "t", F.coalesce("general", F.lit(True)).alias("general")))
    for t in (pairs, known, counts):
        remove(t)
    return out


def personal_data(docs: DataFrame, window: int = WINDOW, support: int = SUPPORT, disclosed: float = DISCLOSED, text: bool = False) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, terms) of every row, and `clean`, the sanitised text, if asked.

    spans are the base ones and, as kind `term`, those of disclosing terms; terms are structs of (t, a, b, general).
    """
    notes = noted(docs, window, carry=text)
    rules = rules_of(notes, docs, support, disclosed)
    some = notes.where("shown is not null")
    held = some.select("id", F.explode("shown").alias("s")).where("s.t <> '' and s.first").select("id", "s.e", "s.t")
    told = held.join(rules, ["e", "t"]).groupBy("id", "t").agg(F.min("general").alias("general"))
    each = some.select("id", F.explode("terms").alias("x")).select("id", "x.*").join(told, ["id", "t"])
    terms = each.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("a", "b", "t", "general"))).alias("terms"))
    out = notes.drop("terms", "shown").join(terms, "id", "left")
    more = F.array_join(F.transform("terms", lambda x: F.concat_ws(":", F.lit("term"), x.a.cast("string"), x.b.cast("string"))), ",")
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.concat_ws(",", "base", more))
    rows = out.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", spans.alias("spans"), F.coalesce("terms", F.array().cast("array<struct<a:bigint,b:bigint,t:string,general:boolean>>")).alias("terms"), *([cleaned(F.col("text"), F.col("base"), F.col("terms")).alias("clean")] if text else []))
    return rows


def sanitised(text: str | None, base: str, terms: list) -> str | None:
    """The text with its entities as [KIND] and its disclosing terms as their shape or gone."""
    if not base:
        return text
    spans = [(int(a), int(b), f"[{k.upper()}]") for k, a, b in (s.split(":") for s in base.split(","))]
    names = {"#": "number", "a": "word", "x": "term"}
    for t in terms if terms is not None else []:
        form = shape(t["t"])
        spans.append((t["a"], t["b"], f"[{names[form[1]]} of {form[2:]}]" if t["general"] else ""))
    out, at = [], 0
    for a, b, put in sorted(spans):
        if a < at:  # entities of two kinds may overlap: what is left of the later one goes with the first
            at = max(at, b)
            continue
        out += [text[at:a], put]
        at = b
    return "".join([*out, text[at:]])


def cleaned(text: Column, base: Column, terms: Column) -> Column:
    @F.pandas_udf("string")
    def run(text: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
        return pd.Series([sanitised(*x) for x in zip(text, base, terms, strict=True)])

    return run(text, base, terms)
