import hashlib
import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from placewright.llm.media import decode, describe_media, difference_hash, encode_bmp, encode_pgm, npy_tile, resize, store, store_texts


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 20), st.integers(1, 20), st.booleans(), st.integers(0, 9))
def test_round_trips(h, w, colour, seed):
    x = np.random.default_rng(seed).integers(0, 256, (h, w, 3) if colour else (h, w)).astype(np.uint8)
    assert (decode(encode_pgm(x)) == x).all() and (decode(encode_bmp(x)) == x).all()
    grey = x if x.ndim == 2 else x[:, :, 0]
    small = resize(grey, 3, 2)
    big = np.kron(grey, np.ones((3, 2)))
    assert np.allclose(small, big.reshape(3, h, 2, w).mean((1, 3)))


def test_other_kinds():
    assert (decode(b"P2\n# note\n2 1\n255\n7 9\n") == [[7, 9]]).all() and (decode(b"P1 3 1 1 0 1") == [[0, 1, 0]]).all()
    assert (decode(b"P4 3 1\n" + bytes([0b10100000])) == [[0, 1, 0]]).all() and decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    for bad in (b"", b"BM", b"P9 1 1", b"P5 x"):
        with pytest.raises((ValueError, IndexError)):
            decode(bad)
    assert difference_hash(np.tile(np.arange(64, dtype=np.uint8), (8, 1))) == "f" * 16
    assert np.load(io.BytesIO(npy_tile(np.full((5, 7), 9, np.uint8)))).tolist() == [[9] * 32] * 32


def test_odd_images(spark):
    assert (decode(b"P1\n#c\n3\t1\r\n1\t0\r1") == [[0, 1, 0]]).all() and (decode(b"P2 2 1 255 # after\n7 9") == [[7, 9]]).all()
    assert decode(b"P5 0 0 255 ").size == 0
    for bad in (b"P1 2 1 2 0", b"P5 9999999 9999999 255 x", b"P2 2 2 255 1", b"BM" + bytes(52)):
        with pytest.raises((ValueError, IndexError)):
            decode(bad)
    rows = [(1, b"P5 0 0 255 ", 7, b"t"), (2, None, 8, None), (3, b"junk", 9, b""), (4, encode_pgm(np.zeros((3, 3))), 1, b"")]
    got = {r.id: r for r in describe_media(spark.createDataFrame(rows, "id int, media binary, Width int, tile binary")).collect()}
    assert (got[1].width, got[1].payload_bytes, got[1].tail_crc32, got[1].feature, got[1].tile) == (0, 0, 0, None, None)
    assert got[2].media_bytes is None and got[3].media_bytes == 4 and got[3].payload_bytes is None and got[4].width == 3 and len(got[4].tile) > 1024
    big = np.random.default_rng(1).integers(0, 256, (1000, 64)).astype(np.uint8)
    assert np.allclose(resize(big, 8, 8), big.reshape(8, 125, 8, 8).mean((1, 3)))


def test_texts(spark):
    rows = [(1, None), (2, ""), (3, "a" * 64), (4, "é" * 33), (4, "é" * 33), (None, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = describe_media(store_texts(docs)).collect()
    assert len(got) == 6
    want = {(i, len((t or "").encode())): (t or "").encode() for i, t in rows}
    for r in got:
        raw = want[r.doc_id, r.n_bytes]
        raw += bytes(-len(raw) % 64 or (64 if not raw else 0))
        assert r.payload_bytes == len(raw) and r.payload_sha256 == hashlib.sha256(raw).hexdigest() and r.tail_crc32 == zlib.crc32(raw[-64:])
        assert len(r.feature) == 16 and r.media_bytes == len(raw) + (1078 if zlib.crc32(raw) & 1 else len(b"P5\n64 %d\n255\n" % (len(raw) // 64)))
        assert r.media_sha256 == hashlib.sha256(store(raw)).hexdigest() and np.load(io.BytesIO(r.tile)).shape == (32, 32)
    assert describe_media(store_texts(docs.limit(0))).count() == 0
    odd = describe_media(spark.createDataFrame([(None,), (b"junk",)], "media binary")).collect()
    assert [r.payload_bytes for r in odd] == [None, None]
