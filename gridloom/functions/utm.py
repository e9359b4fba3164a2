"""Transverse Mercator on WGS 84 by the Krueger series to sixth order, as column expressions.

Every formula takes the functions it needs from ``m``, so the same series serves columns,
Python numbers and SQL text.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

A, FLAT, K0, FALSE_EAST = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
N = FLAT / (2 - FLAT)
E2 = FLAT * (2 - FLAT)
E = math.sqrt(E2)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64 + N**6 / 256)
# The published series' coefficients, by powers of n from the term's own order up.
FORWARD = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
INVERSE = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)
LATITUDE = (
    (2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675),
    (7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945),
    (56 / 15, -136 / 35, -1262 / 105, 73814 / 2835),
    (4279 / 630, -332 / 35, -399572 / 14175),
    (4174 / 315, -144838 / 6237),
    (601676 / 22275,),
)


def _terms(series: tuple) -> list[float]:
    return [sum(c * N ** (j + k) for k, c in enumerate(row)) for j, row in enumerate(series, 1)]


ALPHA, BETA, DELTA = _terms(FORWARD), _terms(INVERSE), _terms(LATITUDE)
NUMBERS = SimpleNamespace(**{k: getattr(math, k) for k in ("sin", "cos", "tan", "sinh", "cosh", "asinh", "atanh", "atan", "asin", "atan2", "sqrt", "radians", "degrees")})
COLUMNS = SimpleNamespace(**{k: getattr(F, k) for k in ("sin", "cos", "tan", "sinh", "cosh", "asinh", "atanh", "atan", "asin", "atan2", "sqrt", "radians", "degrees")})

# numpy's names for arrays, where a task works on a whole tile.
ARRAYS = SimpleNamespace(
    sin=np.sin, cos=np.cos, tan=np.tan, sinh=np.sinh, cosh=np.cosh, asinh=np.arcsinh, atanh=np.arctanh, atan=np.arctan, asin=np.arcsin, atan2=np.arctan2, sqrt=np.sqrt, radians=np.radians, degrees=np.degrees
)


def central_meridian(epsg: int) -> float:
    if not 32601 <= epsg <= 32660:
        raise ValueError(f"EPSG:{epsg} is no northern UTM zone")
    return (epsg - 32600) * 6 - 183.0


def _meridian(epsg):
    """A zone's central meridian; a column of zones gives a column."""
    return central_meridian(epsg) if isinstance(epsg, int) else (epsg - 32600) * 6 - 183.0


def _conformal(tau, m):
    """The tangent of the conformal latitude for the tangent of the latitude."""
    s = m.sinh(E * m.atanh(E * tau / m.sqrt(1 + tau * tau)))
    return tau * m.sqrt(1 + s * s) - s * m.sqrt(1 + tau * tau)


def project(lon, lat, epsg, m=COLUMNS):
    """(easting, northing) of a position in degrees."""
    lam = m.radians(lon - _meridian(epsg))
    tau = _conformal(m.tan(m.radians(lat)), m)
    xi, eta = m.atan2(tau, m.cos(lam)), m.asinh(m.sin(lam) / m.sqrt(tau * tau + m.cos(lam) * m.cos(lam)))
    north, east = xi, eta
    for j, a in enumerate(ALPHA, 1):
        north = north + a * m.sin(2 * j * xi) * m.cosh(2 * j * eta)
        east = east + a * m.cos(2 * j * xi) * m.sinh(2 * j * eta)
    return FALSE_EAST + K0 * RADIUS * east, K0 * RADIUS * north


def unproject(x, y, epsg, m=COLUMNS):
    """(lon, lat) in degrees of a projected position."""
    xi, eta = y / (K0 * RADIUS), (x - FALSE_EAST) / (K0 * RADIUS)
    up, along = xi, eta
    for j, b in enumerate(BETA, 1):
        up = up - b * m.sin(2 * j * xi) * m.cosh(2 * j * eta)
        along = along - b * m.cos(2 * j * xi) * m.sinh(2 * j * eta)
    conformal = m.asin(m.sin(up) / m.cosh(along))
    lat = conformal
    for j, d in enumerate(DELTA, 1):
        lat = lat + d * m.sin(2 * j * conformal)
    return _meridian(epsg) + m.degrees(m.atan2(m.sinh(along), m.cos(up))), m.degrees(lat)


def bounds_projected(bbox: tuple[float, float, float, float], epsg: int, points: int = 21) -> tuple[float, float, float, float]:
    """The projected bounds of a box in degrees, each edge walked in ``points`` further steps."""
    west, south, east, north = bbox
    steps = [i / (points + 1) for i in range(points + 2)]
    ring = [(west + t * (east - west), y) for t in steps for y in (south, north)] + [(x, south + t * (north - south)) for t in steps for x in (west, east)]
    xs, ys = zip(*(project(lon, lat, epsg, NUMBERS) for lon, lat in ring), strict=True)
    return min(xs), min(ys), max(xs), max(ys)
