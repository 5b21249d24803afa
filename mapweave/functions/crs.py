"""Coordinate transformations between a fixed set of reference systems.

4326 (longitude, latitude), 3857, 2056, 21781 and the UTM zones 32601-32660 /
32701-32760.  Coordinates are always X, Y.  The Swiss systems use the published
rigorous oblique conformal formulas with the three-parameter datum shift; UTM
uses the Krueger series.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wkb as W
from .geometry import GEOMETRY, arrow_geometries, col, declared_srid, parse_crs, shapes

# Ellipsoids (semi-major axis, inverse flattening).
WGS84_A, WGS84_RF = 6378137.0, 298.257223563
BESSEL_A, BESSEL_E2 = 6377397.155, 0.006674372230614
# Projection origin of the Swiss grid and its datum shift (m).
SWISS_LAT = np.radians(46 + 57 / 60 + 8.66 / 3600)
SWISS_LON = np.radians(7 + 26 / 60 + 22.50 / 3600)
SWISS_SHIFT = np.array([674.374, 15.056, 405.346])
SWISS_ORIGIN = {2056: (2600000.0, 1200000.0), 21781: (600000.0, 200000.0)}

_F = 1 / WGS84_RF
_E2 = _F * (2 - _F)
_N = _F / (2 - _F)


def known(srid: int) -> bool:
    return srid in (4326, 3857, 2056, 21781) or 32601 <= srid <= 32660 or 32701 <= srid <= 32760


def is_geographic(srid: int) -> bool:
    return srid == 4326


def transform_xy(x, y, source: int, target: int):
    """Coordinate arrays from ``source`` to ``target``; unknown codes fail."""
    for srid in (source, target):
        if not known(srid):
            raise ValueError(f"Unsupported coordinate reference system: {srid}")
    if source == target:
        return x, y
    if source in SWISS_ORIGIN and target in SWISS_ORIGIN:
        (ax, ay), (bx, by) = SWISS_ORIGIN[source], SWISS_ORIGIN[target]
        return x - ax + bx, y - ay + by
    lon, lat = _to_geographic(np.asarray(x, float), np.asarray(y, float), source)
    return _from_geographic(lon, lat, target)


def _to_geographic(x, y, srid):
    if srid == 4326:
        return x, y
    if srid == 3857:
        return np.degrees(x / WGS84_A), np.degrees(2 * np.arctan(np.exp(y / WGS84_A)) - np.pi / 2)
    if srid in SWISS_ORIGIN:
        return _swiss_inverse(x, y, *SWISS_ORIGIN[srid])
    return _utm_inverse(x, y, srid)


def _from_geographic(lon, lat, srid):
    if srid == 4326:
        return lon, lat
    if srid == 3857:
        return (
            WGS84_A * np.radians(lon),
            WGS84_A * np.log(np.tan(np.pi / 4 + np.radians(lat) / 2)),
        )
    if srid in SWISS_ORIGIN:
        return _swiss_forward(lon, lat, *SWISS_ORIGIN[srid])
    return _utm_forward(lon, lat, srid)


# -- Swiss grid --------------------------------------------------------------

_SE = np.sqrt(BESSEL_E2)
_SR = BESSEL_A * np.sqrt(1 - BESSEL_E2) / (1 - BESSEL_E2 * np.sin(SWISS_LAT) ** 2)
_SALPHA = np.sqrt(1 + BESSEL_E2 / (1 - BESSEL_E2) * np.cos(SWISS_LAT) ** 4)
_SB0 = np.arcsin(np.sin(SWISS_LAT) / _SALPHA)


def _isometric(lat):
    s = _SE * np.sin(lat)
    return np.log(np.tan(np.pi / 4 + lat / 2)) - _SE / 2 * np.log((1 + s) / (1 - s))


_SK = np.log(np.tan(np.pi / 4 + _SB0 / 2)) - _SALPHA * _isometric(SWISS_LAT)


def _geocentric(lon, lat, a, e2):
    n = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    return np.array(
        [n * np.cos(lat) * np.cos(lon), n * np.cos(lat) * np.sin(lon), n * (1 - e2) * np.sin(lat)]
    )


def _geodetic(xyz, a, e2):
    x, y, z = xyz
    p = np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - e2))
    for _ in range(6):
        n = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        lat = np.arctan2(z + e2 * n * np.sin(lat), p)
    return np.arctan2(y, x), lat


def _swiss_forward(lon, lat, east, north):
    shift = SWISS_SHIFT.reshape(3, *([1] * np.ndim(lon)))
    xyz = _geocentric(np.radians(lon), np.radians(lat), WGS84_A, _E2) - shift
    lam, phi = _geodetic(xyz, BESSEL_A, BESSEL_E2)
    b = 2 * (np.arctan(np.exp(_SALPHA * _isometric(phi) + _SK)) - np.pi / 4)
    turn = _SALPHA * (lam - SWISS_LON)
    l2 = np.arctan2(np.sin(turn), np.sin(_SB0) * np.tan(b) + np.cos(_SB0) * np.cos(turn))
    b2 = np.arcsin(np.cos(_SB0) * np.sin(b) - np.sin(_SB0) * np.cos(b) * np.cos(turn))
    return east + _SR * l2, north + _SR / 2 * np.log((1 + np.sin(b2)) / (1 - np.sin(b2)))


def _swiss_inverse(x, y, east, north):
    l2 = (x - east) / _SR
    b2 = 2 * (np.arctan(np.exp((y - north) / _SR)) - np.pi / 4)
    b = np.arcsin(np.cos(_SB0) * np.sin(b2) + np.sin(_SB0) * np.cos(b2) * np.cos(l2))
    turn = np.arctan2(np.sin(l2), np.cos(_SB0) * np.cos(l2) - np.sin(_SB0) * np.tan(b2))
    lam = SWISS_LON + turn / _SALPHA
    target = (np.log(np.tan(np.pi / 4 + b / 2)) - _SK) / _SALPHA
    phi = b
    for _ in range(8):
        s = _SE * np.sin(phi)
        phi = 2 * np.arctan(np.exp(target + _SE / 2 * np.log((1 + s) / (1 - s)))) - np.pi / 2
    shift = SWISS_SHIFT.reshape(3, *([1] * np.ndim(x)))
    lon, lat = _geodetic(_geocentric(lam, phi, BESSEL_A, BESSEL_E2) + shift, WGS84_A, _E2)
    return np.degrees(lon), np.degrees(lat)


# -- UTM ---------------------------------------------------------------------

_UTM_A = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Krueger coefficients to the fourth order.
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_UTM_K = 0.9996


def _utm_zone(srid):
    south = srid > 32700
    return np.radians((srid % 100) * 6 - 183), 1e7 if south else 0.0


def _utm_forward(lon, lat, srid):
    lon0, north = _utm_zone(srid)
    lam, phi = np.radians(lon) - lon0, np.radians(lat)
    e = np.sqrt(_E2)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y = y + a * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return 500000 + _UTM_K * _UTM_A * x, north + _UTM_K * _UTM_A * y


def _utm_inverse(x, y, srid):
    lon0, north = _utm_zone(srid)
    xi, eta = (y - north) / (_UTM_K * _UTM_A), (x - 500000) / (_UTM_K * _UTM_A)
    a, b = xi, eta
    for j, k in enumerate(_BETA, 1):
        a = a - k * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
        b = b - k * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
    t = np.sin(a) / np.hypot(np.sinh(b), np.cos(a))
    e = np.sqrt(_E2)
    phi = np.arctan(t)
    for _ in range(6):
        # Newton steps on the conformal latitude.
        s = np.sin(phi)
        f = np.arctanh(s) - e * np.arctanh(e * s) - np.arcsinh(t)
        phi = phi - f * np.cos(phi) * (1 - _E2 * s * s) / (1 - _E2)
    return np.degrees(lon0 + np.arctan2(np.sinh(b), np.cos(a))), np.degrees(phi)


# -- columns -----------------------------------------------------------------

XY = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


@F.arrow_udf(XY)
def _points(x: pa.Array, y: pa.Array, source: pa.Array, target: pa.Array) -> pa.Array:
    xs, ys = (a.to_numpy(zero_copy_only=False).astype(float) for a in (x, y))
    codes = source.to_numpy(zero_copy_only=False), target.to_numpy(zero_copy_only=False)
    out_x, out_y = np.empty(len(xs)), np.empty(len(xs))
    for a, b in {*zip(*codes)}:
        pick = (codes[0] == a) & (codes[1] == b)
        out_x[pick], out_y[pick] = transform_xy(xs[pick], ys[pick], int(a), int(b))
    null = np.isnan(out_x) | np.isnan(out_y)
    return pa.StructArray.from_arrays(
        [pa.array(out_x), pa.array(out_y)], names=["x", "y"], mask=pa.array(null)
    )


def transform_points(x, y, source: int, target: int) -> Column:
    """``STRUCT<x, y>`` of transformed point columns.

    The closed forms (4326 to and from 3857, and between the Swiss grids) are
    plain expressions; other pairs run the numpy formulas on Arrow batches.
    """
    x, y = col(x).cast("double"), col(y).cast("double")
    for srid in (source, target):
        if not known(srid):
            raise ValueError(f"Unsupported coordinate reference system: {srid}")
    if source == target:
        out = x, y
    elif (source, target) == (4326, 3857):
        out = (
            F.lit(WGS84_A) * F.radians(x),
            F.lit(WGS84_A) * F.log(F.tan(F.lit(np.pi / 4) + F.radians(y) / 2)),
        )
    elif (source, target) == (3857, 4326):
        out = (
            F.degrees(x / WGS84_A),
            F.degrees(2 * F.atan(F.exp(y / WGS84_A)) - F.lit(np.pi / 2)),
        )
    elif source in SWISS_ORIGIN and target in SWISS_ORIGIN:
        (ax, ay), (bx, by) = SWISS_ORIGIN[source], SWISS_ORIGIN[target]
        out = x - ax + bx, y - ay + by
    else:
        return _points(x, y, F.lit(source), F.lit(target))
    return F.struct(out[0].alias("x"), out[1].alias("y"))


@F.arrow_udf(GEOMETRY)
def _shapes(geom: pa.Array, source: pa.Array, target: pa.Array) -> pa.Array:
    def one(item, a, b):
        if item is None:
            return None
        shape, srid = item
        a = srid if a is None else a
        if not a or not b:
            raise ValueError("A source and a target CRS are required")

        def move(block):
            block = block.copy()
            block[:, 0], block[:, 1] = transform_xy(block[:, 0], block[:, 1], a, b)
            return block

        return (shape if a == b else W.map_coords(shape, move)), b

    return arrow_geometries(
        one(*row) for row in zip(shapes(geom), source.to_pylist(), target.to_pylist())
    )


def transform(geom, target, source=None) -> Column:
    """Copy of a geometry in the target CRS.

    An explicit ``source`` overrides the geometry's SRID; having neither is an
    error.  ``target`` may be a column of SRIDs.
    """
    code = target if isinstance(target, Column) else F.lit(_required(target))
    given = F.lit(None) if source in (None, "") else F.lit(_required(source))
    return _shapes(col(geom), given.cast("int"), code.cast("int"))


def _required(crs) -> int:
    code = parse_crs(crs)
    if not known(code):
        raise ValueError(f"Unsupported coordinate reference system: {crs}")
    return code


def in_raster_crs(df, geom: str, explicit, raster_srid: Column, fixed: int | None = None) -> Column:
    """Geometry in the raster's CRS.

    When the zone CRS (explicit or declared by the column) and the raster's
    CRS (``fixed``) are known and equal, nothing is added to the plan.
    Otherwise only rows whose CRS differs reach the kernel.
    """
    g = F.col(geom)
    known_srid = _required(explicit) if explicit not in (None, "") else declared_srid(df, geom)
    if known_srid is not None and known_srid == fixed:
        return g
    source = F.lit(known_srid) if explicit not in (None, "") else g["srid"]
    differs = g.isNotNull() & (source != raster_srid)
    moved = _shapes(F.when(differs, g), source.cast("int"), raster_srid.cast("int"))
    return F.when(differs, moved).otherwise(g)
