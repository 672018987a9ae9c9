"""Binary formats as Spark data sources, cut into partitions by block: map extracts (PBF), shapefiles with their tables, spreadsheets.

register() makes them known; then spark.read.format("map_extract").load(path), and so on. Files are opened where tasks run, so the path must be one that
every executor sees. A broken file fails, it isn't skipped.
"""

from __future__ import annotations

import os
import posixpath
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from glob import glob
from xml.etree import ElementTree

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

POINT = "struct<x:double,y:double>"


def files(path: str, end: str) -> list[str]:
    """The files of a path, a folder or a pattern."""
    path = re.sub(r"^file:(//)?", "", path)
    found = sorted(glob(f"{path}/*{end}")) if os.path.isdir(path) else sorted(glob(path))
    if not found:
        raise FileNotFoundError(path)
    return found


class Cut(InputPartition):
    """A stretch of a file: from a place to another, in units of its format."""

    def __init__(self, file: str, first: int, last: int) -> None:
        self.file, self.first, self.last = file, first, last


# Map extracts


def varint(b: bytes, at: int) -> tuple[int, int]:
    """A number of seven bits a byte, lowest first, and the place behind it."""
    out = shift = 0
    while True:
        out |= (b[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if b[at - 1] < 128:
            return out, at


def message(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a message: numbers as they are, texts and messages as bytes."""
    at = 0
    while at < len(b):
        key, at = varint(b, at)
        if key & 7 == 0:
            value, at = varint(b, at)
        elif key & 7 == 2:
            n, at = varint(b, at)
            value, at = b[at : at + n], at + n
        else:
            n = {1: 8, 5: 4}[key & 7]
            value, at = b[at : at + n], at + n
        yield key >> 3, value


def packed(b: bytes, signed: bool = False, deltas: bool = False) -> np.ndarray:
    """Numbers of a packed field; signed ones alternate in sign, deltas are summed up."""
    raw = np.frombuffer(b, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(raw < 128)
    first = np.r_[0, last[:-1] + 1]
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    n = np.add.reduceat((raw & 127).astype(np.uint64) << (place * 7).astype(np.uint64), first)
    out = (n >> np.uint64(1)).view(np.int64) ^ -(n & np.uint64(1)).view(np.int64) if signed else n.view(np.int64)
    return np.cumsum(out) if deltas else out


def blobs(file: str) -> Iterator[tuple[int, int]]:
    """(place, bytes) of the data blocks of an extract, by their headers alone."""
    with open(file, "rb") as f:
        while head := f.read(4):
            fields = dict(message(f.read(struct.unpack(">I", head)[0])))
            if fields[1] == b"OSMData":
                yield f.tell(), fields[3]
            f.seek(fields[3], 1)


def elements(block: bytes) -> Iterator[tuple]:
    """(kind, id, lon, lat, tags, refs, members) of a block's nodes, ways and relations."""
    step, lat0, lon0, texts, groups = 100, 0, 0, [], []
    for field, value in message(block):
        if field == 1:
            texts = [s.decode() for _, s in message(value)]
        elif field == 2:
            groups.append(value)
        elif field == 17:
            step = value
        elif field in (19, 20):
            whole = value - (1 << 64) if value >> 63 else value
            lat0, lon0 = (whole, lon0) if field == 19 else (lat0, whole)
    degrees = lambda zero, n: round(1e-9 * (zero + step * int(n)), 9)
    one = lambda n: n >> 1 ^ -(n & 1)
    for group in groups:
        for field, value in message(group):
            own = dict(message(value))
            tags = lambda: {texts[k]: texts[v] for k, v in zip(packed(own.get(2, b"")), packed(own.get(3, b"")), strict=True)}  # noqa: B023, E731
            if field == 1:
                yield "node", one(own[1]), degrees(lon0, one(own[9])), degrees(lat0, one(own[8])), tags(), None, None
            elif field == 2:
                pairs, at = packed(own.get(10, b"")).tolist(), 0
                for i, lat, lon in zip(packed(own[1], True, True), packed(own[8], True, True), packed(own[9], True, True), strict=True):
                    named = {}
                    while at < len(pairs) and pairs[at]:
                        named[texts[pairs[at]]] = texts[pairs[at + 1]]
                        at += 2
                    at += 1
                    yield "node", int(i), degrees(lon0, lon), degrees(lat0, lat), named, None, None
            elif field == 3:
                yield "way", own[1], None, None, tags(), packed(own.get(8, b""), True, True).tolist(), None
            elif field == 4:
                roles, ids, kinds = packed(own.get(8, b"")), packed(own.get(9, b""), True, True), packed(own.get(10, b""))
                yield "relation", own[1], None, None, tags(), None, [(("node", "way", "relation")[k], int(i), texts[r]) for k, i, r in zip(kinds, ids, roles, strict=True)]


class MapExtract(DataSource):
    """Elements of map extracts; a partition is some consecutive blocks (option `blocks`, 16), which were made to be decoded alone."""

    @classmethod
    def name(cls) -> str:
        return "map_extract"

    def schema(self) -> str:
        return "kind string, id long, lon double, lat double, tags map<string,string>, refs array<long>, members array<struct<kind:string,id:long,role:string>>"

    def reader(self, schema):  # noqa: ANN001, ANN201
        return MapExtractReader(self.options["path"], int(self.options.get("blocks", 16)))


class MapExtractReader(DataSourceReader):
    def __init__(self, path: str, blocks: int) -> None:
        self.path, self.blocks = path, blocks

    def partitions(self) -> list[Cut]:
        out = []
        for file in files(self.path, ".pbf"):
            at = [a for a, _ in blobs(file)]
            out += [Cut(file, k, min(k + self.blocks, len(at))) for k in range(0, len(at), self.blocks)]
        return out

    def read(self, partition: Cut) -> Iterator[tuple]:
        own = list(blobs(partition.file))[partition.first : partition.last]
        with open(partition.file, "rb") as f:
            for at, n in own:
                f.seek(at)
                blob = dict(message(f.read(n)))
                yield from elements(zlib.decompress(blob[3]) if 3 in blob else blob[1])


# Shapefiles


def table_fields(file: str) -> tuple[int, int, list[tuple[str, str, int, int]]]:
    """Bytes of the head and of a row of a table, and (name, kind, place, width) of its fields; a number without decimals is an integer, kind I."""
    with open(file, "rb") as f:
        head = f.read(32)
        begin, width = struct.unpack("<HH", head[8:12])
        raw = f.read(begin - 32)
    out, at = [], 1
    for k in range(0, len(raw) - 31, 32):
        if raw[k] == 0x0D:
            break
        kind = chr(raw[k + 11])
        out.append((raw[k : k + 11].split(b"\0")[0].decode("latin-1"), "I" if kind == "N" and not raw[k + 17] else kind, at, raw[k + 16]))
        at += raw[k + 16]
    return begin, width, out


def table_value(kind: str, raw: bytes, encoding: str) -> object:
    text = raw.decode(encoding).strip()
    if not text or kind == "L" and text == "?":
        return None
    return int(text) if kind == "I" else float(text) if kind in "NF" else text in "YyTt" if kind == "L" else text


def shape_of(b: bytes) -> tuple[str, list] | None:
    """(kind, rings) of a record; a point is one ring of one point, heights and measures are left out."""
    kind = struct.unpack_from("<i", b)[0]
    if not kind:
        return None
    if kind % 10 == 1:
        return "point", [[struct.unpack_from("<2d", b, 4)]]
    if kind % 10 == 8:
        n = struct.unpack_from("<i", b, 36)[0]
        return "point", [[tuple(p)] for p in np.frombuffer(b, "<f8", 2 * n, 40).reshape(-1, 2).tolist()]
    parts, n = struct.unpack_from("<2i", b, 36)
    first = [*np.frombuffer(b, "<i4", parts, 44).tolist(), n]
    points = np.frombuffer(b, "<f8", 2 * n, 44 + 4 * parts).reshape(-1, 2).tolist()
    return "area" if kind % 10 == 5 else "line", [[tuple(p) for p in points[a:z]] for a, z in zip(first[:-1], first[1:], strict=True)]


class Shapefile(DataSource):
    """Records of shapefiles with the fields of their tables; a partition is some consecutive records (option `records`, 10000), found by the index file.

    Option `encoding` is that of the tables, UTF-8 by default. Rows marked as deleted are left out.
    """

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        kinds = {"I": "long", "N": "double", "F": "double", "L": "boolean"}
        _, _, fields = table_fields(re.sub(r"\.shp$", ".dbf", files(self.options["path"], ".shp")[0]))
        return "kind string, rings array<array<" + POINT + ">>" + "".join(f", `{n}` {kinds.get(k, 'string')}" for n, k, _, _ in fields)

    def reader(self, schema):  # noqa: ANN001, ANN201
        return ShapefileReader(self.options["path"], int(self.options.get("records", 10_000)), self.options.get("encoding", "UTF-8"))


class ShapefileReader(DataSourceReader):
    def __init__(self, path: str, records: int, encoding: str) -> None:
        self.path, self.records, self.encoding = path, records, encoding

    def partitions(self) -> list[Cut]:
        out = []
        for file in files(self.path, ".shp"):
            n = (os.path.getsize(file[:-1] + "x") - 100) // 8
            out += [Cut(file, k, min(k + self.records, n)) for k in range(0, n, self.records)]
        return out

    def read(self, partition: Cut) -> Iterator[tuple]:
        table = re.sub(r"\.shp$", ".dbf", partition.file)
        begin, width, fields = table_fields(table)
        with open(partition.file[:-1] + "x", "rb") as index, open(partition.file, "rb") as shapes, open(table, "rb") as rows:
            index.seek(100 + 8 * partition.first)
            rows.seek(begin + width * partition.first)
            for _ in range(partition.first, partition.last):
                at, n = struct.unpack(">2i", index.read(8))
                row = rows.read(width)
                if row[:1] == b"*":
                    continue
                shapes.seek(2 * at + 8)
                kind, rings = shape_of(shapes.read(2 * n)) or (None, None)
                yield (kind, rings, *(table_value(k, row[a : a + w], self.encoding) for _, k, a, w in fields))


# Spreadsheets

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def sheets(file: str) -> list[tuple[str, str]]:
    """(name, member) of a workbook's sheets in order."""
    with zipfile.ZipFile(file) as z:
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    return [(s.get("name"), posixpath.normpath(posixpath.join("/xl", targets[s.get(_REL + "id")])).lstrip("/")) for s in book.iter(_MAIN + "sheet")]


def column_of(place: str) -> int:
    """The number, from 0, of a cell's column of letters."""
    n = 0
    for c in re.match("[A-Z]+", place)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


class Spreadsheet(DataSource):
    """Rows of spreadsheets as lists of text, a cell left out as null; a partition is a sheet, whose rows are read one by one."""

    @classmethod
    def name(cls) -> str:
        return "spreadsheet"

    def schema(self) -> str:
        return "file string, sheet string, row int, cells array<string>"

    def reader(self, schema):  # noqa: ANN001, ANN201
        return SpreadsheetReader(self.options["path"])


class SpreadsheetReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[Cut]:
        return [Cut(f, k, k + 1) for f in files(self.path, ".xlsx") for k in range(len(sheets(f)))]

    def read(self, partition: Cut) -> Iterator[tuple]:
        name, member = sheets(partition.file)[partition.first]
        with zipfile.ZipFile(partition.file) as z:
            shared = []
            if "xl/sharedStrings.xml" in z.namelist():
                shared = ["".join(t.text or "" for t in s.iter(_MAIN + "t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
            with z.open(member) as f:
                for _, row in ElementTree.iterparse(f):
                    if row.tag != _MAIN + "row":
                        continue
                    cells: list[str | None] = []
                    for c in row:
                        at = column_of(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (at + 1 - len(cells))
                        value = c.find(_MAIN + "v")
                        if c.get("t") == "inlineStr":
                            cells[at] = "".join(t.text or "" for t in c.iter(_MAIN + "t"))
                        elif value is not None:
                            cells[at] = shared[int(value.text)] if c.get("t") == "s" else value.text
                    yield os.path.basename(partition.file), name, int(row.get("r", 0)), cells
                    row.clear()


def register(spark: SparkSession) -> None:
    for source in (MapExtract, Shapefile, Spreadsheet):
        spark.dataSource.register(source)
