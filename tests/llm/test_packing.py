import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from placewright.llm.packing import encoder, pack, plan, step_groups


def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_ids_equal_the_library(text):
    assert list(encoder()(text)) == reference().encode(text, add_special_tokens=False).ids


def test_long_runs_and_special_strings():
    for text in (" " * 1_000_000, "\n" * 300_000 + "x", "a" * 50_000, "a<|endoftext|>b <|endoftext|>", "x" + "\u3000" * 200_000):
        assert list(encoder()(text)) == reference().encode(text, add_special_tokens=False).ids
    assert 50256 in encoder()("a<|endoftext|>")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=60))
def test_plan(lengths):
    seen = [np.zeros(n, int) for n in lengths]
    sequences = plan(np.array(lengths, int))
    for tier, row in sequences:
        n = sum(p[2] for p in row)
        assert n == tier and tier & (tier - 1) == 0 and tier <= 2048
        for d, s, m in row:
            seen[d][s : s + m] += 1
    assert all((x == 1).all() for x in seen)
    groups = step_groups(sequences)
    assert sorted(i for g in groups for i in g) == list(range(len(sequences))) and all(len(g) <= 64 for g in groups)
    for tier in {t for t, _ in sequences}:
        share = [sum(sequences[i][0] == tier for i in g) for g in groups]
        assert max(share) - min(share) <= 1


def test_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(9001, None), (9002, ""), (None, "a <|endoftext|> b"), (9003, "x " * 9000)], "doc_id long, text string"))
    got = pack(docs).collect()
    t, texts = reference(), {r.doc_id: r.text or "" for r in docs.collect()}
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert set(by) == set(texts)
    for d, rows in by.items():
        ids = [x for r in sorted(rows, key=lambda r: r.start) for x in r.ids]
        assert ids == [*t.encode(texts[d], add_special_tokens=False).ids, 1] and rows[0].doc_tokens == len(ids)
    step = {}
    for r in got:
        assert step.setdefault(r.sequence_id, r.step_group) == r.step_group
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert pack(docs.limit(0)).count() == 0
