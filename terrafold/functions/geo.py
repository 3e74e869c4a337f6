"""Distances, projection and planar geometry as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
METRES_PER_DEGREE = 111_000.0

# GRS80 and the two-degree transverse Mercator grid with central meridian 121 E.
_A, _FLATTENING, _K0, _FALSE_EASTING, _MERIDIAN = 6378137.0, 1 / 298.257222101, 0.9999, 250000.0, 121.0
_N = _FLATTENING / (2 - _FLATTENING)
_RECTIFYING = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Krüger series to the third order: grid to sphere, sphere to grid, conformal to geodetic latitude.
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle metres between two points in degrees."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def metres_to_degrees(metres) -> Column:
    return (F.lit(metres) if not isinstance(metres, Column) else metres) / METRES_PER_DEGREE


def grid_to_wgs84(x: str | Column, y: str | Column) -> tuple[Column, Column]:
    """(lat, lon) of easting and northing on the 121 E grid."""
    xi = _c(y).cast("double") / (_K0 * _RECTIFYING)
    eta = (_c(x).cast("double") - _FALSE_EASTING) / (_K0 * _RECTIFYING)
    xi1, eta1 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(lat), F.lit(_MERIDIAN) + F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1)))


def wgs84_to_grid(lat: str | Column, lon: str | Column) -> tuple[Column, Column]:
    """(easting, northing) on the 121 E grid of a point in degrees."""
    phi, lam = F.radians(_c(lat).cast("double")), F.radians(_c(lon).cast("double") - _MERIDIAN)
    e = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(phi)
    atanh = lambda v: F.log((1 + v) / (1 - v)) / 2
    t = F.sinh(atanh(s) - e * atanh(e * s))
    xi1, eta1 = F.atan2(t, F.cos(lam)), atanh(F.sin(lam) / F.sqrt(1 + t * t))
    xi, eta = xi1, eta1
    for j, a in enumerate(_ALPHA, 1):
        xi = xi + a * F.sin(2 * j * xi1) * F.cosh(2 * j * eta1)
        eta = eta + a * F.cos(2 * j * xi1) * F.sinh(2 * j * eta1)
    return F.lit(_FALSE_EASTING) + _K0 * _RECTIFYING * eta, _K0 * _RECTIFYING * xi


def cell(value: str | Column, size: float) -> Column:
    """The number of the grid cell of a coordinate."""
    return F.floor(_c(value) / F.lit(size)).cast("long")


def cells(low: str | Column, high: str | Column, size: float) -> Column:
    """All cell numbers from one coordinate to another."""
    return F.sequence(cell(low, size), cell(high, size))


def in_box(lat, lon, min_lat, max_lat, min_lon, max_lon) -> Column:
    """Inside a box, edges included."""
    lat, lon = _c(lat), _c(lon)
    return (lat >= _c(min_lat)) & (lat <= _c(max_lat)) & (lon >= _c(min_lon)) & (lon <= _c(max_lon))


def boxes_overlap(min_lat, max_lat, min_lon, max_lon, south, north, west, east) -> Column:
    """Two boxes touch or overlap."""
    return (_c(max_lat) >= south) & (_c(min_lat) <= north) & (_c(max_lon) >= west) & (_c(min_lon) <= east)


def on_edge(x, y, x1, y1, x2, y2, tolerance: float = 1e-12) -> Column:
    """Whether a point lies on a segment."""
    x, y, x1, y1, x2, y2 = map(_c, (x, y, x1, y1, x2, y2))
    cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    boxed = (x >= F.least(x1, x2)) & (x <= F.greatest(x1, x2)) & (y >= F.least(y1, y2)) & (y <= F.greatest(y1, y2))
    return (F.abs(cross) <= tolerance) & boxed


def ray_crosses(x, y, x1, y1, x2, y2) -> Column:
    """Whether the ray from a point to the east crosses a segment (upper end excluded)."""
    x, y, x1, y1, x2, y2 = map(_c, (x, y, x1, y1, x2, y2))
    apart = (y1 > y) != (y2 > y)
    return apart & (x < (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1)


def nearest_on_segment(x, y, x1, y1, x2, y2) -> tuple[Column, Column]:
    """The point of a segment nearest to a point, in the plane of its coordinates."""
    x, y, x1, y1, x2, y2 = map(_c, (x, y, x1, y1, x2, y2))
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = F.when(length > 0, ((x - x1) * dx + (y - y1) * dy) / F.nullif(length, F.lit(0.0))).otherwise(F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return x1 + t * dx, y1 + t * dy
