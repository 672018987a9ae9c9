"""The British national grid: its transverse Mercator projection and the shift between its datum and the world's, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .shapes import once

#: Axes of the two ellipsoids, the grid's scale, origin and false origin, and the shift between datums (metres, parts, seconds of arc).
AIRY, WORLD = (6377563.396, 6356256.909), (6378137.0, 6356752.314245)
SCALE, LAT, LON, EAST, NORTH = 0.9996012717, 49.0, -2.0, 400000.0, -100000.0
SHIFT, GROWTH, TURN = (446.448, -125.157, 542.060), -20.4894e-6, (0.1502, 0.2470, 0.8421)


def _arc(lat: Column) -> Column:
    """Metres along the meridian from the grid's origin."""
    a, b = AIRY
    n = (a - b) / (a + b)
    low, high = lat - math.radians(LAT), lat + math.radians(LAT)
    return b * SCALE * ((1 + n + 5 / 4 * (n**2 + n**3)) * low - (3 * n + 3 * n**2 + 21 / 8 * n**3) * F.sin(low) * F.cos(high) + 15 / 8 * (n**2 + n**3) * F.sin(2 * low) * F.cos(2 * high) - 35 / 24 * n**3 * F.sin(3 * low) * F.cos(3 * high))


def _radii(lat: Column) -> Column:
    """Transverse radius, its ratio to the meridian's less one, tangent, sine and cosine of a latitude."""
    a, b = AIRY
    e2 = 1 - (b / a) ** 2
    nu = lambda s: a * SCALE / F.sqrt(1 - e2 * s * s)
    return F.struct(nu(F.sin(lat)).alias("nu"), ((1 - e2 * F.sin(lat) * F.sin(lat)) / (1 - e2) - 1).alias("eta"), F.tan(lat).alias("t"), F.sin(lat).alias("s"), F.cos(lat).alias("c"), ((a * SCALE) * (1 - e2) / F.pow(1 - e2 * F.sin(lat) * F.sin(lat), 1.5)).alias("rho"))


def grid_to_datum(east: Column, north: Column) -> Column:
    """(lon, lat) in degrees on the grid's own datum, by the inverse series."""
    a = AIRY[0]
    start = (north - NORTH) / (a * SCALE) + math.radians(LAT)
    lat = F.aggregate(F.sequence(F.lit(1), F.lit(8)), start, lambda p, _: p + (north - NORTH - _arc(p)) / (a * SCALE))

    def place(g: Column) -> Column:
        x, p, r = east - EAST, g["lat"], g["r"]
        nu, rho, t, sec, eta = r["nu"], r["rho"], r["t"], 1 / r["c"], r["eta"]
        up = t / (2 * rho * nu) * F.pow(x, 2) - t / (24 * rho * F.pow(nu, 3)) * (5 + 3 * t * t + eta - 9 * t * t * eta) * F.pow(x, 4) + t / (720 * rho * F.pow(nu, 5)) * (61 + 90 * t * t + 45 * F.pow(t, 4)) * F.pow(x, 6)
        along = sec / nu * x - sec / (6 * F.pow(nu, 3)) * (nu / rho + 2 * t * t) * F.pow(x, 3) + sec / (120 * F.pow(nu, 5)) * (5 + 28 * t * t + 24 * F.pow(t, 4)) * F.pow(x, 5) - sec / (5040 * F.pow(nu, 7)) * (61 + 662 * t * t + 1320 * F.pow(t, 4) + 720 * F.pow(t, 6)) * F.pow(x, 7)
        return F.struct((F.degrees(along) + LON).alias("lon"), F.degrees(p - up).alias("lat"))

    return once(once(lat, lambda p: F.struct(p.alias("lat"), _radii(p).alias("r"))), place)


def datum_to_grid(lon: Column, lat: Column) -> Column:
    """(east, north) in metres of degrees on the grid's own datum."""

    def place(g: Column) -> Column:
        r, x, p = g["r"], F.radians(lon - LON), g["lat"]
        nu, rho, t, s, c, eta = r["nu"], r["rho"], r["t"], r["s"], r["c"], r["eta"]
        north = _arc(p) + NORTH + nu / 2 * s * c * F.pow(x, 2) + nu / 24 * s * F.pow(c, 3) * (5 - t * t + 9 * eta) * F.pow(x, 4) + nu / 720 * s * F.pow(c, 5) * (61 - 58 * t * t + F.pow(t, 4)) * F.pow(x, 6)
        east = EAST + nu * c * x + nu / 6 * F.pow(c, 3) * (nu / rho - t * t) * F.pow(x, 3) + nu / 120 * F.pow(c, 5) * (5 - 18 * t * t + F.pow(t, 4) + 14 * eta - 58 * t * t * eta) * F.pow(x, 5)
        return F.struct(east.alias("east"), north.alias("north"))

    return once(once(F.radians(lat), lambda p: F.struct(p.alias("lat"), _radii(p).alias("r"))), place)


def _shifted(lon: Column, lat: Column, from_axes: tuple[float, float], to_axes: tuple[float, float], sign: int) -> Column:
    """Degrees on another datum: to a point in space, moved, grown and turned by small angles, and back."""
    (a, b), (c, d) = from_axes, to_axes
    e2, f2 = 1 - (b / a) ** 2, 1 - (d / c) ** 2
    turn = [sign * math.radians(x / 3600) for x in TURN]
    move, grow = [sign * x for x in SHIFT], 1 + sign * GROWTH

    def space(g: Column) -> Column:
        nu = a / F.sqrt(1 - e2 * F.sin(g["p"]) * F.sin(g["p"]))
        return F.struct((nu * F.cos(g["p"]) * F.cos(g["l"])).alias("x"), (nu * F.cos(g["p"]) * F.sin(g["l"])).alias("y"), ((1 - e2) * nu * F.sin(g["p"])).alias("z"))

    def moved(v: Column) -> Column:
        x = move[0] + v["x"] * grow - v["y"] * turn[2] + v["z"] * turn[1]
        y = move[1] + v["x"] * turn[2] + v["y"] * grow - v["z"] * turn[0]
        z = move[2] - v["x"] * turn[1] + v["y"] * turn[0] + v["z"] * grow
        return F.struct(x.alias("x"), y.alias("y"), z.alias("z"), F.sqrt(x * x + y * y).alias("r"))

    def back(v: Column) -> Column:
        step = lambda p, _: F.atan2(v["z"] + f2 * (c / F.sqrt(1 - f2 * F.sin(p) * F.sin(p))) * F.sin(p), v["r"])
        p = F.aggregate(F.sequence(F.lit(1), F.lit(8)), F.atan2(v["z"], v["r"] * (1 - f2)), step)
        return F.struct(F.degrees(F.atan2(v["y"], v["x"])).alias("lon"), F.degrees(p).alias("lat"))

    return once(once(once(F.struct(F.radians(lon).alias("l"), F.radians(lat).alias("p")), space), moved), back)


def grid_to_world(east: Column, north: Column) -> Column:
    """(lon, lat) in the world's degrees of grid metres; some five metres off where the grid's own survey is uneven."""
    return once(grid_to_datum(east, north), lambda g: _shifted(g["lon"], g["lat"], AIRY, WORLD, 1))


def world_to_grid(lon: Column, lat: Column) -> Column:
    """(east, north) in grid metres of the world's degrees."""
    return once(_shifted(lon, lat, WORLD, AIRY, -1), lambda g: datum_to_grid(g["lon"], g["lat"]))
