"""Distances, wrapping and a quadtree of square-degree cells: (zoom << 58) | (x << 29) | y in one long."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM, HALF_KM = 6371.0, 25.0


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def nearness(km: Column) -> Column:
    """1 at no distance, 0.5 at 25 km, 0 if unknown."""
    return F.coalesce(1 / (1 + km / HALF_KM), F.lit(0.0))


def wrap_longitude(lon: Column) -> Column:
    return F.when(lon.between(-180, 180), lon).otherwise(F.pmod(lon + 180, F.lit(360.0)) - 180)


def cell(lon: Column, lat: Column, zoom: int) -> Column:
    """The cell of a point; the edges 180 and 90 belong to the last cells."""
    n, m = 1 << zoom, 1 << (zoom - 1)
    x = F.least(F.floor((lon + 180) / 360 * n), F.lit(n - 1)).cast("long")
    y = F.least(F.floor((lat + 90) / 180 * m), F.lit(m - 1)).cast("long")
    return F.lit(zoom << 58) + x * F.lit(1 << 29) + y


def zoom_of(c: Column) -> Column:
    return F.shiftright(c, 58).cast("int")


def x_of(c: Column) -> Column:
    return F.shiftright(c, 29).bitwiseAND(F.lit((1 << 29) - 1))


def y_of(c: Column) -> Column:
    return c.bitwiseAND(F.lit((1 << 29) - 1))


def parent(c: Column, zoom: int | Column) -> Column:
    """The ancestor at a coarser zoom."""
    up = F.pow(F.lit(2), zoom_of(c) - zoom).cast("long")
    top = zoom.cast("long") * F.lit(1 << 58) if isinstance(zoom, Column) else F.lit(zoom << 58)
    return top + F.floor(x_of(c) / up) * F.lit(1 << 29) + F.floor(y_of(c) / up)


def children(c: Column) -> Column:
    """The four cells one level down."""
    z = F.lit(1 << 58) * (zoom_of(c) + 1).cast("long")
    return F.array(*(z + (x_of(c) * 2 + i) * F.lit(1 << 29) + y_of(c) * 2 + j for i in (0, 1) for j in (0, 1)))


def ring(c: Column, k: int) -> Column:
    """Cells within k steps, columns wrapping at the antimeridian, rows ending at the poles."""
    n, z = F.pow(F.lit(2), zoom_of(c)).cast("long"), F.lit(1 << 58) * zoom_of(c).cast("long")
    steps = [(i, j) for i in range(-k, k + 1) for j in range(-k, k + 1)]
    cells = F.array(*(F.when((y_of(c) + j >= 0) & (y_of(c) + j < n / 2), z + F.pmod(x_of(c) + i, n) * F.lit(1 << 29) + y_of(c) + j) for i, j in steps))
    return F.array_distinct(F.filter(cells, lambda x: x.isNotNull()))


def tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web-Mercator tile column and row."""
    r = F.radians(lat)
    return F.floor((lon + 180) / 360 * (1 << zoom)).cast("long"), F.floor((1 - F.ln(F.tan(r) + 1 / F.cos(r)) / F.pi()) / 2 * (1 << zoom)).cast("long")
