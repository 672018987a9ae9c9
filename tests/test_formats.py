import struct
import zipfile
import zlib

from pyspark.sql import functions as F

from placewright.sources import dumps, formats


def varint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def zigzag(n):
    return (n << 1) ^ (n >> 63)


def field(k, v):
    return varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 2) + varint(len(v)) + v


def run(ns, signed=False, deltas=False):
    if deltas:
        ns = [b - a for a, b in zip([0, *ns], ns)]
    return b"".join(varint(zigzag(n) if signed else n) for n in ns)


def blob(kind, body, plain=False):
    data = field(1, body) if plain else field(2, len(body)) + field(3, zlib.compress(body))
    head = field(1, kind) + field(3, len(data))
    return struct.pack(">I", len(head)) + head + data


def block(texts, group, extra=b""):
    return field(1, b"".join(field(1, t.encode()) for t in texts)) + field(2, group) + extra


def extract(path, n):
    """n blocks of three dense nodes each, then plain nodes, a way and a relation."""
    out = blob(b"OSMHeader", field(4, b"OsmSchema-V0.6"))
    want = []
    for k in range(n):
        ids, lat, lon = [k * 10 + 5, k * 10 + 3, k * 10 + 9], [k * 10**6, -5 * 10**8, 7], [-(10**9) - k, 10**9, 0]
        pairs = [1, 2, 0, 0, 1, 3, 4, 2, 0]
        out += blob(b"OSMData", block(["", "name", "Köln", f"n{k}", "place"], field(2, field(1, run(ids, True, True)) + field(8, run(lat, True, True)) + field(9, run(lon, True, True)) + field(10, run(pairs)))), plain=k % 2)
        tags = [{"name": "Köln"}, {}, {"name": f"n{k}", "place": "Köln"}]
        want += [("node", i, round(x * 1e-7, 9), round(y * 1e-7, 9), t, None, None) for i, x, y, t in zip(ids, lon, lat, tags)]
    node = field(1, field(1, zigzag(-7)) + field(2, run([1])) + field(3, run([2])) + field(8, zigzag(20)) + field(9, zigzag(-30)))
    way = field(3, field(1, 77) + field(2, run([1])) + field(3, run([2])) + field(8, run([5, 3, 5], True, True)))
    rel = field(4, field(1, 88) + field(8, run([3, 0])) + field(9, run([77, -7], True, True)) + field(10, run([1, 0])))
    out += blob(b"OSMData", block(["", "name", "A", "outer"], node + way + rel, field(17, 1000) + field(19, -(10**9) & ((1 << 64) - 1)) + field(20, 10**9)))
    want += [("node", -7, round(1 - 30e-6, 9), round(-1 + 20e-6, 9), {"name": "A"}, None, None), ("way", 77, None, None, {"name": "A"}, [5, 3, 5], None), ("relation", 88, None, None, {}, None, [("way", 77, "outer"), ("node", -7, "")])]
    path.write_bytes(out)
    return want


def test_map_extracts(spark, tmp_path):
    formats.register(spark)
    want = extract(tmp_path / "a.pbf", 9) + extract(tmp_path / "b.pbf", 0)
    got = spark.read.format("map_extract").option("blocks", 2).load(str(tmp_path))
    assert got.rdd.getNumPartitions() == 6
    rows = [(r.kind, r.id, r.lon, r.lat, r.tags, r.refs, None if r.members is None else [tuple(m) for m in r.members]) for r in got.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, want))
    places = {r.place_id: r.title for r in dumps.map_places(got, "osm").collect()}
    assert places == {f"osm:n{k * 10 + 9}": f"n{k}" for k in range(9)}


def shapefile(path, records, fields):
    """records of (kind number, body, values), fields of (name, kind, width, decimals)."""
    shp, shx, at = b"", b"", 50
    for n, (kind, body, _) in enumerate(records):
        data = struct.pack("<i", kind) + body
        shx += struct.pack(">2i", at, len(data) // 2)
        shp += struct.pack(">2i", n + 1, len(data) // 2) + data
        at += 4 + len(data) // 2
    head = lambda size: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, 50 + size // 2) + struct.pack("<2i", 1000, 5) + bytes(64)
    path.with_suffix(".shp").write_bytes(head(len(shp)) + shp)
    path.with_suffix(".shx").write_bytes(head(len(shx)) + shx)
    width = 1 + sum(w for _, _, w, _ in fields)
    dbf = struct.pack("<4BIHH20x", 3, 99, 1, 1, len(records), 33 + 32 * len(fields), width)
    dbf += b"".join(n.encode().ljust(11, b"\0") + k.encode() + bytes(4) + bytes([w, d]) + bytes(14) for n, k, w, d in fields) + b"\r"
    for n, (_, _, values) in enumerate(records):
        dbf += (b"*" if n == 4 else b" ") + b"".join((v.encode() if isinstance(v, str) else str(v).encode()).ljust(w)[:w] for v, (_, _, w, _) in zip(values, fields))
    path.with_suffix(".dbf").write_bytes(dbf)


def parts(rings):
    points = [p for g in rings for p in g]
    firsts, n = [], 0
    for g in rings:
        firsts.append(n)
        n += len(g)
    return bytes(32) + struct.pack(f"<2i{len(rings)}i", len(rings), n, *firsts) + b"".join(struct.pack("<2d", *p) for p in points)


def test_shapefiles(spark, tmp_path):
    formats.register(spark)
    ring, hole = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (0.0, 0.0)], [(1.0, 2.0), (1.5, 2.0), (1.0, 2.5), (1.0, 2.0)]
    records = [(5, parts([ring, hole]), ("Ä one", 7, 1.5, "T")), (3, parts([ring[:2]]), ("", "", "", "?")), (1, struct.pack("<2d", 2.5, -3.0), ("p", -5, -0.25, "F")), (0, b"", ("nothing", 0, 0, "F")), (1, struct.pack("<2d", 0, 0), ("gone", 1, 1, "T"))]
    records += [(1, struct.pack("<2d", k, k), (f"r{k}", k, k / 2, "T")) for k in range(40)]
    shapefile(tmp_path / "u", records, [("NAME", "C", 12, 0), ("CODE", "N", 6, 0), ("AREA", "N", 10, 3), ("OK", "L", 1, 0)])
    got = spark.read.format("shapefile").option("records", 10).load(f"{tmp_path}/u.shp")
    assert got.rdd.getNumPartitions() == 5 and got.schema.simpleString().endswith("NAME:string,CODE:bigint,AREA:double,OK:boolean>")
    rows = [(r.kind, None if r.rings is None else [[tuple(p) for p in g] for g in r.rings], r.NAME, r.CODE, r.AREA, r.OK) for r in got.collect()]
    want = [("area", [ring, hole], "Ä one", 7, 1.5, True), ("line", [ring[:2]], None, None, None, None), ("point", [[(2.5, -3.0)]], "p", -5, -0.25, False), (None, None, "nothing", 0, 0.0, False)]
    assert sorted(map(str, rows)) == sorted(map(str, want + [("point", [[(float(k), float(k))]], f"r{k}", k, k / 2, True) for k in range(40)]))


def test_spreadsheets(spark, tmp_path):
    formats.register(spark)
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(tmp_path / "t.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="One" sheetId="1" r:id="a"/><sheet name="Zwei" sheetId="2" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="b" Target="/xl/worksheets/s1.xml"/><Relationship Id="a" Target="worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>Köln</t></si><si><r><t>two </t></r><r><t>runs</t></r></si></sst>')
        z.writestr("xl/worksheets/s2.xml", f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="3"><c r="AB3"><v>1.5</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet xmlns="{main}"><sheetData><row r="2"><c r="A2" t="inlineStr"><is><t>in</t></is></c><c t="b"><v>1</v></c></row></sheetData></worksheet>')
    got = spark.read.format("spreadsheet").load(str(tmp_path))
    assert got.rdd.getNumPartitions() == 2
    assert sorted(tuple(r) for r in got.collect()) == [("t.xlsx", "One", 1, ["Köln", None, "two runs"]), ("t.xlsx", "One", 3, [None] * 27 + ["1.5"]), ("t.xlsx", "Zwei", 2, ["in", "1"])]


def test_delimited_in_other_encodings(spark, tmp_path):
    (tmp_path / "g.csv").write_bytes("id,name,n\n1,Köln,2\n2,\"Łódź, a\",x\n3,São,4\n".encode("utf-16"))
    got = dumps.delimited(spark, str(tmp_path / "g.csv"), "id long, name string, n long", encoding="UTF-16")
    assert sorted(tuple(r) for r in got.select("id", "name", "n").collect()) == [(1, "Köln", 2), (3, "São", 4)]
    (tmp_path / "t.tsv").write_text("id\tname\n7\tÉté\n")
    assert [tuple(r) for r in dumps.delimited(spark, str(tmp_path / "t.tsv"), "id long, name string", sep="\t").collect()] == [(7, "Été")]
