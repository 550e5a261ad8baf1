"""PRJ-9 / PRJ-10: great-circle distance and unordered pair keys, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicstream.schemas import EARTH_RADIUS_M


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lat1, lon1, lat2, lon2, radius_m: float = EARTH_RADIUS_M) -> Column:
    """Haversine distance in metres. ``least(1, a)`` guards asin against rounding."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * radius_m) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def pair_key(a, b, sep: str = "|") -> Column:
    """Order-independent key of two ids: ``min|max``."""
    return F.concat_ws(sep, F.least(_c(a), _c(b)), F.greatest(_c(a), _c(b)))


def unit_sphere_cells(lat, lon, cell_m: float, radius_m: float = EARTH_RADIUS_M):
    """Cell indices of a point on a 3-D grid of ``cell_m`` metres over the sphere.

    Two points at great-circle distance <= d are at chord distance <= d, so a grid in
    Cartesian space finds all close pairs without any latitude/pole special case.
    Returns three integer columns (x, y, z cell) and the fractional positions inside
    the cell (used to pick the adjacent cell on the nearer side).
    """
    la, lo = F.radians(_c(lat)), F.radians(_c(lon))
    xyz = [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]
    scaled = [v * F.lit(radius_m / cell_m) for v in xyz]
    return [F.floor(s).cast("long") for s in scaled], [s - F.floor(s) for s in scaled]
