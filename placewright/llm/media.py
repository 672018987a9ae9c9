"""Media columns: Netpbm and BMP bytes, decoded to arrays, resized by integral images, tiled as NPY, with difference hashes."""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import small_batches

ROW = 64


def encode_pgm(pixels: np.ndarray) -> bytes:
    """Binary Netpbm (P5 grey, P6 colour) of 8-bit samples."""
    kind = b"P5" if pixels.ndim == 2 else b"P6"
    return b"%s\n%d %d\n255\n" % (kind, pixels.shape[1], pixels.shape[0]) + pixels.astype(np.uint8).tobytes()


def encode_bmp(pixels: np.ndarray) -> bytes:
    """Uncompressed BMP: 8-bit grey with a palette, or 24-bit colour; rows from the bottom, padded to four bytes."""
    h, w = pixels.shape[:2]
    grey = pixels.ndim == 2
    palette = b"".join(bytes([i, i, i, 0]) for i in range(256)) if grey else b""
    body = pixels[::-1] if grey else pixels[::-1, :, ::-1]
    rows = body.reshape(h, -1).astype(np.uint8)
    rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 4)))
    at = 54 + len(palette)
    return b"BM" + struct.pack("<IHHIIiiHHIIiiII", at + rows.size, 0, 0, at, 40, w, h, 1, 8 if grey else 24, 0, rows.size, 2835, 2835, 256 if grey else 0, 0) + palette + rows.tobytes()


def decode(data: bytes) -> np.ndarray:
    """Pixels of Netpbm (P1 to P6) or uncompressed BMP (8, 24, 32 bits), perhaps none; ValueError or IndexError for anything else."""
    if data[:2] == b"BM" and len(data) >= 54:
        at, w, h, bits, packing = *struct.unpack_from("<I4xii", data, 10), *struct.unpack_from("<HI", data, 28)
        if packing or bits not in (8, 24, 32) or w < 0 or at < 54:
            raise ValueError("BMP kind")
        wide = -(-w * bits // 32) * 4
        rows = np.frombuffer(data, np.uint8, wide * abs(h), at).reshape(abs(h), wide)[:, : w * bits // 8]
        rows = rows[::-1] if h > 0 else rows
        if bits > 8:
            return rows.reshape(abs(h), w, bits // 8)[:, :, 2::-1].copy()
        palette = np.frombuffer(data, np.uint8, at - 54, 54).reshape(-1, 4)
        if (palette[:, :3] == np.arange(len(palette))[:, None]).all() and len(palette) == 256:
            return rows.copy()
        colours = palette[rows][:, :, 2::-1]
        return colours[:, :, 0].copy() if (palette[:, 0] == palette[:, 1]).all() and (palette[:, 1] == palette[:, 2]).all() else colours
    if data[:1] != b"P" or data[1:2] not in (b"1", b"2", b"3", b"4", b"5", b"6") or len(data) < 3:
        raise ValueError("not an image")
    kind = int(data[1:2])
    # Numbers between white space and comments, then one byte of white space, or samples as text.
    header = re.compile(rb"P\d" + rb"(?:\s|#[^\r\n]*[\r\n])+(\d+)" * (2 if kind in (1, 4) else 3)).match(data)
    if not header:
        raise ValueError("Netpbm header")
    w, h, top = (*map(int, header.groups()), 1)[:3]
    n, at = w * h * (3 if kind in (3, 6) else 1), header.end()
    if kind in (5, 6):
        pixels = np.frombuffer(data, ">u2" if top > 255 else np.uint8, n, at + 1)
    elif kind == 4:
        wide = -(-w // 8)
        pixels = 1 - np.unpackbits(np.frombuffer(data, np.uint8, wide * h, at + 1).reshape(h, wide), axis=1)[:, :w]
    else:
        body = re.sub(rb"#[^\r\n]*", b"", data[at:])
        pixels = 49 - np.frombuffer(re.sub(rb"\s", b"", body), np.uint8).astype(int)[:n] if kind == 1 else np.array(body.split(), int)[:n]
        if kind == 1 and not np.isin(pixels, (0, 1)).all():
            raise ValueError("Netpbm samples")
    return pixels.reshape((h, w, 3) if kind in (3, 6) else (h, w))


def resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of each cell's area (fractions of edge pixels count), from those rows of the integral image that cells begin or end in."""
    h, w = pixels.shape[:2]

    def at(n: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        x = np.arange(parts + 1) * n / parts
        i = np.minimum(x.astype(int), n - 1)
        return i, x - i

    i, fi = at(h, height)
    j, fj = at(w, width)
    cuts = np.unique(np.r_[i, i + 1])  # from 0 to h
    bands = np.add.reduceat(pixels, cuts[:-1], axis=0, dtype=float if pixels.dtype.kind == "f" else np.int64)
    s = np.zeros((len(cuts), w + 1), bands.dtype)
    np.cumsum(np.cumsum(bands, 0), 1, out=s[1:, 1:])
    rows = s[np.searchsorted(cuts, i)] * (1 - fi)[:, None] + s[np.searchsorted(cuts, i + 1)] * fi[:, None]
    corner = rows[:, j] * (1 - fj) + rows[:, j + 1] * fj
    return np.diff(np.diff(corner, axis=0), axis=1) * (height * width / (h * w))


def grey(pixels: np.ndarray) -> np.ndarray:
    return pixels if pixels.ndim == 2 else pixels.mean(2)


def difference_hash(pixels: np.ndarray) -> str:
    """64 bits, as hex: of an 8 x 9 reduction, which cells are darker than their right neighbour."""
    small = np.rint(resize(grey(pixels), 8, 9) * 256)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def npy_tile(pixels: np.ndarray, side: int = 32) -> bytes:
    """A side x side reduction as NPY bytes of 8-bit samples."""
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(resize(grey(pixels), side, side)), 0, 255).astype(np.uint8))
    return out.getvalue()


def store(payload: bytes) -> bytes:
    """A payload of whole rows of 64 samples as a grey image: by its own checksum, half of them as PGM and half as BMP."""
    pixels = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    return encode_bmp(pixels) if zlib.crc32(payload) & 1 else encode_pgm(pixels)


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text (null: empty), zero-filled to a positive multiple of 64 bytes, as a PGM or BMP 64 samples wide.

    Rows stay as they are, null and repeated doc_id included; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"))

    small_batches(docs.sparkSession)
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                raw = part["data"].to_pylist()
                media = [store(x + bytes(-len(x) % ROW if x else ROW)) for x in raw]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return texts.mapInArrow(write, "doc_id long, n_bytes long, media binary")


NEW = [("width", pa.int64()), ("height", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("tile", pa.binary())]


def describe_media(media: DataFrame, tiles: bool = True) -> DataFrame:
    """The other columns of media, and what its decoded bytes show: width, height, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, tile.

    These replace columns of media with the same names, without regard to case. Null media and bytes that no decoder reads give nulls, an
    image without pixels a null feature and tile. `tile` (NPY bytes) is null unless asked for.
    """
    names = [f.name for f in media.schema.fields if f.name.lower() not in {"media", *(n for n, _ in NEW)}]
    schema = "".join(f"`{n}` {media.schema[n].dataType.simpleString()}, " for n in names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch["media"].to_pylist():
                try:
                    pixels = decode(x or b"")
                except (ValueError, IndexError, OverflowError, struct.error):
                    rows.append((None,) * 5 + (None if x is None else len(x), None if x is None else hashlib.sha256(x).hexdigest(), None, None))
                    continue
                payload = pixels.tobytes()
                shown = (difference_hash(pixels), npy_tile(pixels) if tiles else None) if pixels.size else (None, None)
                rows.append((pixels.shape[1], pixels.shape[0], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(x), hashlib.sha256(x).hexdigest(), *shown))
            columns = list(zip(*rows, strict=True)) or [[]] * len(NEW)
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), *(pa.array(c, t) for c, (_, t) in zip(columns, NEW, strict=True))], [*names, *(n for n, _ in NEW)])

    kinds = "width long, height long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary"
    return media.select("media", *(F.col(f"`{n}`") for n in names)).mapInArrow(read, schema + kinds)
