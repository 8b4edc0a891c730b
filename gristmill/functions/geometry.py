"""Boxes, tiles, grids and distances as column expressions (survey 2.N, J9, J10)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    p, q = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((q - p) / 2), F.lit(2)) + F.cos(p) * F.cos(q) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def ball(lon: Column, lat: Column) -> list[Column]:
    """The point of a place on a sphere, in metres from its centre."""
    p, q = F.radians(lat), F.radians(lon)
    return [EARTH_M * F.cos(p) * F.cos(q), EARTH_M * F.cos(p) * F.sin(q), EARTH_M * F.sin(p)]


def area(box: Column) -> Column:
    """Of an x, y, width, height box."""
    return F.get(box, 2) * F.get(box, 3)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two x, y, width, height boxes; 0 for empty ones."""
    g = F.get
    w = F.greatest(F.lit(0.0), F.least(g(a, 0) + g(a, 2), g(b, 0) + g(b, 2)) - F.greatest(g(a, 0), g(b, 0)))
    h = F.greatest(F.lit(0.0), F.least(g(a, 1) + g(a, 3), g(b, 1) + g(b, 3)) - F.greatest(g(a, 1), g(b, 1)))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def union_box(boxes: Column) -> Column:
    """The smallest box around an array of boxes."""
    x, y = F.array_min(F.transform(boxes, lambda b: b[0])), F.array_min(F.transform(boxes, lambda b: b[1]))
    x2, y2 = F.array_max(F.transform(boxes, lambda b: b[0] + b[2])), F.array_max(F.transform(boxes, lambda b: b[1] + b[3]))
    return F.array(x, y, x2 - x, y2 - y)


def letterbox(width: Column, height: Column, size: int) -> Column:
    """The scale that fits a frame into a square."""
    return F.least(F.lit(float(size)) / width, F.lit(float(size)) / height)


def tile_starts(length: Column, tile: int, stride: int) -> Column:
    """Starts of overlapping tiles, the last one flush with the end."""
    last = F.greatest(F.lit(0), length - tile)
    return F.array_union(F.sequence(F.lit(0), last, F.lit(stride)), F.array(last))


def clip(box: Column, x: Column, y: Column, tile: int) -> Column:
    """A box in the coordinates of the tile at (x, y), cut at its edges."""
    g = F.get
    x1, y1 = F.greatest(g(box, 0), x), F.greatest(g(box, 1), y)
    x2, y2 = F.least(g(box, 0) + g(box, 2), x + tile), F.least(g(box, 1) + g(box, 3), y + tile)
    return F.array(x1 - x, y1 - y, F.greatest(F.lit(0.0), x2 - x1), F.greatest(F.lit(0.0), y2 - y1))


def cell(x: Column, y: Column, size: float) -> Column:
    """The square grid cell of a point."""
    return F.struct(F.floor(x / size).alias("cx"), F.floor(y / size).alias("cy"))


def fold16(actions: Column) -> Column:
    """Base-16 fold of a list of moves."""
    return F.aggregate(actions, F.lit(0).cast("long"), lambda a, x: a * 16 + x)


def _cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def _dot(a: list[Column], b: list[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _unit(a: list[Column]) -> list[Column]:
    n = F.sqrt(_dot(a, a))
    return [x / n for x in a]


def project(point: list[Column], eye: list[Column], target: list[Column], focal_px: float, width: int, height: int) -> Column:
    """(u, v, depth) of a point in a pinhole camera that looks at a target, z up; u, v null behind it."""
    forward = _unit([t - e for t, e in zip(target, eye, strict=True)])
    right = _unit(_cross(forward, [F.lit(0.0), F.lit(0.0), F.lit(1.0)]))
    down = _cross(forward, right)
    ray = [p - e for p, e in zip(point, eye, strict=True)]
    z = _dot(ray, forward)
    seen = lambda c: F.when(z > 0, c)
    return F.struct(seen(focal_px * _dot(ray, right) / z + width / 2).alias("u"), seen(focal_px * _dot(ray, down) / z + height / 2).alias("v"), z.alias("depth"))


def rotated(point: list[Column], q: list[Column]) -> list[Column]:
    """A vector turned by a unit quaternion w, x, y, z."""
    w, axis = q[0], q[1:]
    t = [2 * c for c in _cross(axis, point)]
    return [p + w * a + b for p, a, b in zip(point, t, _cross(axis, t), strict=True)]


#: Fixed values of the GRS 80 ellipsoid and of the European equal-area grid (EPSG:3035).
GRS80_A, GRS80_F = 6_378_137.0, 1 / 298.257222101
GRID_LAT, GRID_LON, GRID_EAST, GRID_NORTH = 52.0, 10.0, 4_321_000.0, 3_210_000.0


def grid_to_lonlat(east: Column, north: Column) -> Column:
    """(lon, lat) in degrees of a point of the European equal-area grid."""
    e2 = GRS80_F * (2 - GRS80_F)
    e = math.sqrt(e2)
    q = lambda s: (1 - e2) * (s / (1 - e2 * s * s) + math.atanh(e * s) / e)
    lat0 = math.radians(GRID_LAT)
    radius = GRS80_A * math.sqrt(q(1.0) / 2)
    b0 = math.asin(q(math.sin(lat0)) / q(1.0))
    d = GRS80_A * math.cos(lat0) / math.sqrt(1 - e2 * math.sin(lat0) ** 2) / (radius * math.cos(b0))
    x, y = (east - GRID_EAST) / d, (north - GRID_NORTH) * d
    rho = F.sqrt(x * x + y * y)
    c = 2 * F.asin(rho / (2 * radius))
    beta = F.asin(F.cos(c) * math.sin(b0) + F.when(rho > 0, y * F.sin(c) * math.cos(b0) / rho).otherwise(F.lit(0.0)))
    lon = math.radians(GRID_LON) + F.when(rho > 0, F.atan2(x * F.sin(c), rho * math.cos(b0) * F.cos(c) - y * math.sin(b0) * F.sin(c))).otherwise(F.lit(0.0))
    lat = beta + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * beta) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * beta) + 761 * e2**3 / 45360 * F.sin(6 * beta)
    return F.struct(F.degrees(lon).alias("lon"), F.degrees(lat).alias("lat"))
