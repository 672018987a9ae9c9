"""Shapes as rings of points, array<array<struct<x, y>>> with the first point repeated at the end: measures, tests and covers, in Spark's own functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .space import EARTH_KM, haversine_km

RINGS = "array<array<struct<x:double,y:double>>>"
DEGREE_KM = EARTH_KM * 3.141592653589793 / 180


def once(value: Column, use) -> Column:
    """A function of a value that is computed once a row, however often the function names it."""
    return F.transform(F.array(value), use)[0]


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(w: Column, s: Column, e: Column, n: Column) -> Column:
    return F.array(F.array(point(w, s), point(e, s), point(e, n), point(w, n), point(w, s)))


def segments(ring: Column) -> Column:
    """Pairs of consecutive points."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _sum(array: Column, term) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + term(x))


def box(rings: Column) -> tuple[Column, Column, Column, Column]:
    """West, south, east, north."""
    xs, ys = F.transform(F.flatten(rings), lambda p: p["x"]), F.transform(F.flatten(rings), lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def contains(rings: Column, x: Column, y: Column) -> Column:
    """Whether a ray from the point crosses the rings an odd number of times; holes count, the upper and right edges don't."""
    crossed = lambda s: ((s["a"]["y"] > y) != (s["b"]["y"] > y)) & (x < (s["b"]["x"] - s["a"]["x"]) * (y - s["a"]["y"]) / F.nullif(s["b"]["y"] - s["a"]["y"], F.lit(0.0)) + s["a"]["x"])
    count = F.aggregate(rings, F.lit(0), lambda n, r: n + F.size(F.filter(segments(r), lambda s: F.coalesce(crossed(s), F.lit(False)))))
    return count % 2 == 1


def signed_area(ring: Column) -> Column:
    """In square degrees, positive where the ring runs counter-clockwise."""
    return _sum(segments(ring), lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]) / 2


def area_km2(rings: Column) -> Column:
    """The outer ring's area less its holes', at the scale of the outer ring's middle latitude."""
    _, s, _, n = box(rings)
    degrees = F.abs(signed_area(rings[0])) - _sum(F.slice(rings, F.lit(2), F.size(rings)), lambda r: F.abs(signed_area(r)))
    return degrees * DEGREE_KM * DEGREE_KM * F.cos(F.radians((s + n) / 2))


def length_km(line: Column) -> Column:
    return _sum(segments(line), lambda s: haversine_km(s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]))


def centroid(ring: Column) -> Column:
    """The centre of a ring's area; of a ring without area, the mean of its points."""
    part = lambda r, a, c: _sum(segments(r), lambda s: (s["a"][c] + s["b"][c]) * (s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"])) / (6 * a)
    mean = lambda r, c: _sum(r, lambda p: p[c]) / F.size(r)
    middle = lambda r, a: point(*(F.when(a != 0, part(r, a, c)).otherwise(mean(r, c)) for c in "xy"))
    return once(ring, lambda r: once(signed_area(r), lambda a: middle(r, a)))


def inside_point(rings: Column) -> Column:
    """A point of the shape: its centroid if that lies inside, else the middle of the widest part of a line through half its height."""
    _, s, _, n = box(rings)
    at = (s + n) / 2 + (n - s) * 1e-6
    x_at = lambda g, y: g["a"]["x"] + (g["b"]["x"] - g["a"]["x"]) * (y - g["a"]["y"]) / (g["b"]["y"] - g["a"]["y"])
    cut = lambda y: F.array_sort(F.flatten(F.transform(rings, lambda r: F.transform(F.filter(segments(r), lambda g: (g["a"]["y"] > y) != (g["b"]["y"] > y)), lambda g: x_at(g, y)))))
    pieces = lambda xs: F.transform(F.sequence(F.lit(1), F.greatest(F.size(xs) - 1, F.lit(1)), F.lit(2)), lambda i: F.struct((F.get(xs, i) - F.get(xs, i - 1)).alias("w"), ((F.get(xs, i) + F.get(xs, i - 1)) / 2).alias("x")))
    widest = lambda y: point(F.array_max(F.filter(once(cut(y), pieces), lambda p: p["w"].isNotNull()))["x"], y)
    return once(centroid(rings[0]), lambda c: F.when(contains(rings, c["x"], c["y"]), c).otherwise(once(at, widest)))


def crosses_antimeridian(ring: Column) -> Column:
    """Two neighbouring points are more than 180 degrees of longitude apart."""
    return F.exists(segments(ring), lambda s: F.abs(s["b"]["x"] - s["a"]["x"]) > 180)


def split_at_antimeridian(ring: Column) -> Column:
    """A ring across the antimeridian as its part east of 180 degrees and the rest, each clipped to its side; others as they are."""
    wide = F.transform(ring, lambda p: point(F.when(p["x"] < 0, p["x"] + 360).otherwise(p["x"]), p["y"]))
    west = clip(wide, "x", 180.0, below=True)
    east = F.transform(clip(wide, "x", 180.0, below=False), lambda p: point(p["x"] - 360, p["y"]))
    return F.when(crosses_antimeridian(ring), F.filter(F.array(west, east), lambda r: F.size(r) > 3)).otherwise(F.array(ring))


def clip(ring: Column, axis: str, at: float | Column, below: bool) -> Column:
    """The part of a ring on one side of a line of constant x or y, closed again."""
    at = F.lit(at) if isinstance(at, float) else at
    other = "y" if axis == "x" else "x"
    inside = lambda p: (p[axis] <= at) if below else (p[axis] >= at)
    share = lambda s: (at - s["a"][axis]) / (s["b"][axis] - s["a"][axis])
    at_line = lambda s: s["a"][other] + (s["b"][other] - s["a"][other]) * share(s)
    meet = lambda s: point(at, at_line(s)) if axis == "x" else point(at_line(s), at)
    step = lambda s: F.when(inside(s["a"]) & inside(s["b"]), F.array(s["b"])).when(inside(s["a"]), F.array(meet(s))).when(inside(s["b"]), F.array(meet(s), s["b"])).otherwise(F.array().cast("array<struct<x:double,y:double>>"))
    ended = lambda kept: F.when(F.size(kept) > 0, F.concat(kept, F.slice(kept, 1, 1))).otherwise(kept)
    return once(ring, lambda r: once(F.flatten(F.transform(segments(r), step)), ended))


def clip_to_box(ring: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    return clip(clip(clip(clip(ring, "x", w, False), "x", e, True), "y", s, False), "y", n, True)


def overlap_share(rings: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    """The part of the outer ring's area that lies in a box; exact for convex shapes."""
    return F.abs(signed_area(clip_to_box(rings[0], w, s, e, n))) / F.nullif(F.abs(signed_area(rings[0])), F.lit(0.0))


def cover(rings: Column, zoom: int, most: int = 10_000) -> Column:
    """Cells of a zoom that may meet the shape: those whose middle lies in it, whose clip isn't empty, or in which a point of it lies; of the next coarser zoom where there would be more than `most`."""
    w, s, e, n = box(rings)

    def at(z: int) -> tuple[Column, Column]:
        size = 360.0 / (1 << z)
        col = lambda v: F.least(F.greatest(F.floor((v + 180) / size), F.lit(0)), F.lit((1 << z) - 1))
        row = lambda v: F.least(F.greatest(F.floor((v + 90) / size), F.lit(0)), F.lit((1 << (z - 1)) - 1))
        count = (col(e) - col(w) + 1) * (row(n) - row(s) + 1)
        meets = lambda x, y: F.size(clip_to_box(rings[0], x * size - 180, y * size - 90, (x + 1) * size - 180, (y + 1) * size - 90)) > 0
        cells = F.flatten(F.transform(F.sequence(col(w), col(e)), lambda x: F.transform(F.filter(F.sequence(row(s), row(n)), lambda y: meets(x, y)), lambda y: F.lit(z << 58) + x * F.lit(1 << 29) + y)))
        return cells, count

    fine, count = at(zoom)
    return F.when(count <= most, fine).otherwise(at(max(1, zoom - 2))[0])


def kind_of(kind: Column, members: Column) -> Column:
    """area, line or point of a geometry's type; of a collection, the largest of its members' kinds."""
    one = lambda k: F.when(F.endswith(k, F.lit("Polygon")), "area").when(F.endswith(k, F.lit("LineString")), "line").when(F.endswith(k, F.lit("Point")), "point")
    has = lambda x: F.exists(members, lambda m: one(m) == x)
    return F.when(kind == "GeometryCollection", F.when(has("area"), "area").when(has("line"), "line").when(has("point"), "point")).otherwise(one(kind))


def is_areal(geom_class: Column, has_geom: Column) -> Column:
    return F.coalesce(geom_class == "area", has_geom, F.lit(False))


def simplify(line: Column, tolerance: float) -> Column:
    """Points of a line without those that lie within the tolerance of the line from the last kept point to the next; both ends stay."""
    off = lambda a, p, b: F.abs((b["x"] - a["x"]) * (a["y"] - p["y"]) - (a["x"] - p["x"]) * (b["y"] - a["y"])) / F.greatest(F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])), F.lit(1e-12))
    inner = F.sequence(F.lit(2), F.size(line) - 1)
    kept = F.aggregate(inner, F.slice(line, 1, 1), lambda out, i: F.when(off(F.element_at(out, -1), F.element_at(line, i), F.element_at(line, i + 1)) > tolerance, F.concat(out, F.slice(line, i, F.lit(1)))).otherwise(out))
    return F.when(F.size(line) <= 2, line).otherwise(F.concat(kept, F.slice(line, -1, 1)))


#: Points whose distances are taken at once.
BATCH = 4096


def _distances(px: np.ndarray, py: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of points, how far inside the sides (a to b) they lie; negative outside."""
    d = b - a
    length = np.maximum((d * d).sum(1), 1e-300)
    gx, gy = px[:, None] - a[:, 0], py[:, None] - a[:, 1]
    t = np.clip((gx * d[:, 0] + gy * d[:, 1]) / length, 0, 1)
    far = np.sqrt(((gx - t * d[:, 0]) ** 2 + (gy - t * d[:, 1]) ** 2).min(1))
    up = (a[:, 1] > py[:, None]) != (b[:, 1] > py[:, None])
    at = a[:, 0] + d[:, 0] * gy / np.where(d[:, 1] == 0, 1, d[:, 1])
    return np.where((up & (px[:, None] < at)).sum(1) % 2 == 1, far, -far)


def deepest(rings: list[np.ndarray], tolerance: float) -> tuple[float, float, float]:
    """(x, y, distance) of the point of a shape that is farthest from its sides, within the tolerance: squares that may hold a better one than the best so far are cut in four, size by size."""
    a, b = np.concatenate([r[:-1] for r in rings]), np.concatenate([r[1:] for r in rings])
    (w, s), (e, n) = a.min(0), a.max(0)
    h = max(min(e - w, n - s), 1e-9) / 2
    xs, ys = (g.ravel() for g in np.meshgrid(np.arange(w + h, e + h, 2 * h), np.arange(s + h, n + h, 2 * h)))
    best = (-np.inf, 0.0, 0.0)
    xs, ys = np.r_[(w + e) / 2, xs], np.r_[(s + n) / 2, ys]
    while len(xs):
        d = np.concatenate([_distances(xs[k : k + BATCH], ys[k : k + BATCH], a, b) for k in range(0, len(xs), BATCH)])
        top = int(d.argmax())
        best = max(best, (float(d[top]), float(xs[top]), float(ys[top])))
        keep = d + h * 2**0.5 > best[0] + tolerance
        h /= 2
        xs, ys = ((v[keep, None] + np.array(step) * h).ravel() for v, step in ((xs, [-1, 1, -1, 1]), (ys, [-1, -1, 1, 1])))
    return best[1], best[2], best[0]


def anchor(rings: Column, tolerance: float = 0.01) -> Column:
    """(x, y, distance): where a label has most room in a shape, to the tolerance in degrees. Null without rings. A shape's sides are held at once."""

    @F.pandas_udf("x double, y double, distance double")
    def run(shapes: pd.Series) -> pd.DataFrame:
        out = [(None, None, None) if r is None or not len(r) else deepest([np.array([(p["x"], p["y"]) for p in g]) for g in r], tolerance) for r in shapes]
        return pd.DataFrame(out, columns=["x", "y", "distance"], dtype=float)

    return run(rings)


def peucker(line: Column, tolerance: float) -> Column:
    """Points of a line without those that lie within the tolerance of what is left, by cutting at the farthest point of each stretch; both ends stay. Closed lines keep their end and what is farthest from it."""

    @F.pandas_udf("array<struct<x:double,y:double>>")
    def run(lines: pd.Series) -> pd.Series:
        out = []
        for line in lines:
            if line is None or len(line) < 3:
                out.append(line)
                continue
            p = np.array([(q["x"], q["y"]) for q in line])
            keep, stack = np.zeros(len(p), bool), [(0, len(p) - 1)]
            keep[[0, -1]] = True
            while stack:
                i, j = stack.pop()
                if j - i < 2:
                    continue
                d = p[j] - p[i]
                g = p[i + 1 : j] - p[i]
                t = np.clip(g @ d / max(d @ d, 1e-300), 0, 1)
                off = np.sqrt(((g - t[:, None] * d) ** 2).sum(1))
                k = int(off.argmax())
                if off[k] > tolerance:
                    keep[i + 1 + k] = True
                    stack += [(i, i + 1 + k), (i + 1 + k, j)]
            out.append([{"x": x, "y": y} for x, y in p[keep].tolist()])
        return pd.Series(out)

    return run(line)


def hull(points: Column) -> Column:
    """The convex hull of points as a closed ring, counter-clockwise from the lowest of the leftmost."""
    ordered = F.array_sort(F.array_distinct(points))
    turn = lambda a, b, c: (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])
    none = F.array().cast("array<struct<x:double,y:double>>")

    def chain(given: Column) -> Column:
        """Each point ends what turns right before it."""
        def keep(out: Column, p: Column) -> Column:
            n = F.size(out)
            # The longest beginning of the chain from whose last two points the next one turns left.
            length = F.array_max(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: (k <= 1) | (turn(F.element_at(out, F.greatest(k - 1, F.lit(1))), F.element_at(out, k), p) > 0)))
            return F.when(n == 0, F.array(p)).otherwise(F.concat(F.slice(out, F.lit(1), length), F.array(p)))

        return F.aggregate(given, none, keep)

    most = lambda line: F.slice(line, F.lit(1), F.size(line) - 1)
    closed = lambda ring: F.concat(ring, F.slice(ring, 1, 1))
    around = lambda pts: F.when(F.size(pts) < 3, pts).otherwise(once(F.concat(once(chain(pts), most), once(chain(F.reverse(pts)), most)), closed))
    return once(ordered, around)


def _number(x: Column) -> Column:
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def wkt(rings: Column) -> Column:
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat(_number(p["x"]), F.lit(" "), _number(p["y"]))), ", "), F.lit(")"))
    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings, ring), ", "), F.lit(")"))


def geojson(rings: Column) -> Column:
    ring = F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    return F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates"))


def ewkb_point(text: Column) -> Column:
    """(lon, lat), to six places, of a point's extended well-known binary in hexadecimal digits; null for anything else."""
    turned = lambda h, n: F.regexp_replace(h, "(..)" * (n // 2), "".join(f"${k}" for k in range(n // 2, 0, -1)))
    order = lambda raw, h, n: F.when(F.startswith(raw, F.lit("01")), turned(h, n)).otherwise(h)

    def number(h: Column) -> Column:
        """A double of sixteen digits, highest first: sign, exponent, fraction."""
        half = lambda at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")

        def read(x: Column) -> Column:
            top, low = x["top"], x["low"]
            power = F.floor(top / (1 << 20)) % 2048
            part = (top % (1 << 20)) / float(1 << 20) + low / float(1 << 52)
            return F.when((power == 0) & (part == 0), 0.0).otherwise((1 - 2 * F.floor(top / (1 << 31))) * (1 + part) * F.pow(F.lit(2.0), power - 1023))

        return once(F.struct(half(1).alias("top"), half(9).alias("low")), read)

    def parts(raw: Column) -> Column:
        """The text, its kind and where its first number begins."""
        kind = F.conv(order(raw, F.substring(raw, 3, 8), 8), 16, 10).cast("long")
        return F.struct(raw.alias("raw"), kind.alias("kind"), F.when(F.floor(kind / (1 << 29)) % 2 == 1, 19).otherwise(11).alias("at"))

    def read_all(x: Column) -> Column:
        value = lambda i: F.round(once(order(x["raw"], F.substring(x["raw"], x["at"] + 16 * i, F.lit(16)), 16), number), 6)
        fine = x["raw"].rlike("^0[01][0-9A-F]{40,}$") & (x["kind"] % 256 == 1) & (F.length(x["raw"]) >= x["at"] + 31)
        return F.when(fine, F.struct(value(0).alias("lon"), value(1).alias("lat")))

    # Each step is computed once a row, however often the next one names it.
    return once(once(F.upper(text), parts), read_all)


def label_centre(lon: Column, lat: Column, text: Column, width: float, height: float) -> Column:
    """The middle of a level label whose lower left corner is given, each character `width` metres wide and `height` high."""
    metres = 111_320.0
    right = F.greatest(F.length(text), F.lit(1)) * width / 2 / (metres * F.greatest(F.cos(F.radians(lat)), F.lit(1e-6)))
    return point(lon + right, lat + height / 2 / metres)


#: How many bits a feature number leaves to its own id, and to one of two mixed sources.
ID_BITS, MIXED_BITS = 48, 52


def feature_id(space: Column, own: Column) -> Column:
    """A number below 2^53 of a source's number (five bits) and an id: a number's low 48 bits, or those of the first 56 of a text's SHA-256."""
    number = F.pmod(own.try_cast("long"), F.lit(1 << ID_BITS))
    return space.cast("long") * (1 << ID_BITS) + F.coalesce(number, F.conv(F.substring(F.sha2(own, 256), 3, 12), 16, 10).cast("long"))


def of_feature(number: Column) -> Column:
    """The source's number and the id of a feature number."""
    return F.struct(F.shiftright(number, ID_BITS).alias("space"), (number % (1 << ID_BITS)).alias("own"))
