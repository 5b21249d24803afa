"""GeoJSON and JSON-FG geometry objects, used inside Arrow functions.

Numbers are kept as their text (:class:`Number`), so that ids and properties
come out digit by digit as they went in.
"""

from __future__ import annotations

import json
import re
from json.encoder import encode_basestring
from math import isfinite

import numpy as np

from . import wkb as W

# Profiles and the conformance classes of JSON-FG 1.0.
PROFILES = ("AUTO", "RFC7946", "LEGACY2008", "JSONFG10")
CONF = "http://www.opengis.net/spec/json-fg-1/1.0/conf/"
CLASSES = ("core", "circular-arcs", "measures", "types-schemas")
# GeoJSON names of the geometry types.
TYPE_NAMES = {
    "Point": W.POINT,
    "LineString": W.LINESTRING,
    "Polygon": W.POLYGON,
    "MultiPoint": W.MULTIPOINT,
    "MultiLineString": W.MULTILINESTRING,
    "MultiPolygon": W.MULTIPOLYGON,
    "GeometryCollection": W.COLLECTION,
    "CircularString": W.CIRCULARSTRING,
    "CompoundCurve": W.COMPOUNDCURVE,
    "CurvePolygon": W.CURVEPOLYGON,
    "MultiCurve": W.MULTICURVE,
    "MultiSurface": W.MULTISURFACE,
}
KIND_NAMES = {code: name for name, code in TYPE_NAMES.items()}
CURVE_NAMES = {KIND_NAMES[k] for k in W.CURVES}


class Number(str):
    """A JSON number with its exact text."""


class FieldError(ValueError):
    """A rejected value together with the column it came from."""

    def __init__(self, field, message):
        super().__init__(message)
        self.field = field


def _reject(token):
    raise ValueError(f"Invalid JSON number: {token}")


class _Decoder(json.JSONDecoder):
    """One decoder for all rows; a task makes its own."""

    def __init__(self):
        super().__init__(parse_int=Number, parse_float=Number, parse_constant=_reject)

    def __reduce__(self):
        return _Decoder, ()


_DECODER = _Decoder()


def parse(text: str):
    return _DECODER.decode(text)


def dump(value) -> str:
    if isinstance(value, str):
        return str(value) if isinstance(value, Number) else encode_basestring(value)
    if isinstance(value, dict):
        return "{" + ",".join([encode_basestring(k) + ":" + dump(v) for k, v in value.items()]) + "}"
    if isinstance(value, list):
        return "[" + ",".join([dump(v) for v in value]) + "]"
    return "null" if value is None else "true" if value is True else "false"


def is_number(value) -> bool:
    return isinstance(value, Number)


def is_text(value) -> bool:
    return isinstance(value, str) and not isinstance(value, Number)


def number(value: float) -> Number:
    """Shortest text of a double; whole numbers without a fraction."""
    return Number(str(int(value)) if value == int(value) and abs(value) < 1e15 else repr(float(value)))


# -- reference systems -----------------------------------------------------------

_CRS84 = re.compile(
    r"(?:OGC:|urn:ogc:def:crs:OGC:[^:]*:|https?://www\.opengis\.net/def/crs/OGC/[^/]+/)?CRS84h?", re.I
)
_EPSG = re.compile(r"(?:EPSG:|urn:ogc:def:crs:EPSG:[^:]*:|https?://www\.opengis\.net/def/crs/EPSG/[^/]+/)(\d+)", re.I)


def is_crs84(ref) -> bool:
    if isinstance(ref, dict):
        return ref.get("type") == "Reference" and is_crs84(ref.get("href"))
    return is_text(ref) and _CRS84.fullmatch(ref) is not None


def srid_of(ref) -> int:
    """SRID of a declared reference system; 0 when it has none."""
    if isinstance(ref, dict):
        inner = ref.get("href") or (ref.get("properties") or {}).get("name")
        return srid_of(inner) if inner is not None else 0
    if not is_text(ref):
        return 0
    if is_crs84(ref):
        return 4326
    found = _EPSG.fullmatch(ref.strip())
    return int(found.group(1)) if found else 0


def _swapped(ref) -> bool:
    """Reference systems whose own axis order is latitude, longitude."""
    return not is_crs84(ref) and srid_of(ref) == 4326


# -- geometry objects --------------------------------------------------------------


def read_geometry(obj, curves: bool, measured: bool, swap: bool = False) -> W.Shape:
    """Shape of a geometry object.

    ``curves`` allows the JSON-FG curve types, ``measured`` says that the last
    ordinate of a position is M.
    """
    if not isinstance(obj, dict):
        raise ValueError("A geometry must be a JSON object or null")
    name = obj.get("type")
    if name not in TYPE_NAMES or (name in CURVE_NAMES and not curves):
        raise ValueError(f"Unsupported geometry type: {name}")
    dims = _dimension(obj)
    if dims is None:
        dims = 2 + measured
    if not 2 <= dims <= 3 + measured:
        raise ValueError("Positions need two or three coordinates")
    m = measured and dims > 2
    z = dims - m == 3
    return _shape(obj, dims, z, m, swap)


def _dimension(obj):
    """Number of ordinates, equal in all positions of the object."""
    sizes = set()

    def walk(value):
        if isinstance(value, list):
            if value and is_number(value[0]):
                sizes.add(len(value))
            else:
                for v in value:
                    walk(v)
        elif isinstance(value, dict):
            for key in ("coordinates", "geometries"):
                walk(value.get(key))

    walk(obj)
    if len(sizes) > 1:
        raise ValueError("All positions must have the same coordinate dimension")
    return sizes.pop() if sizes else None


def _block(positions, dims, swap):
    if not isinstance(positions, list):
        raise ValueError("Coordinates must be an array")
    for p in positions:
        if not isinstance(p, list) or len(p) != dims or not all([isinstance(v, Number) for v in p]):
            raise ValueError("Invalid position")
    out = np.array([[float(v) for v in p] for p in positions], float).reshape(len(positions), dims)
    if not np.isfinite(out).all():
        raise ValueError("Non-finite coordinate")
    if swap:
        out[:, [0, 1]] = out[:, [1, 0]]
    return out


def _shape(obj, dims, z, m, swap):
    kind = TYPE_NAMES.get(obj.get("type") if isinstance(obj, dict) else None)
    if kind is None:
        raise ValueError("Unsupported geometry member")
    nested = kind in (W.COLLECTION, W.COMPOUNDCURVE, W.CURVEPOLYGON, W.MULTICURVE, W.MULTISURFACE)
    member = obj.get("geometries" if nested else "coordinates")
    if not isinstance(member, list):
        raise ValueError("Geometry without coordinates")
    if nested:
        parts = [_shape(g, dims, z, m, swap) for g in member]
        if any(p.kind not in W.MEMBERS[kind] for p in parts):
            raise ValueError("Member geometry does not fit its container")
        return W.Shape(kind, z, m, parts)
    if kind == W.POINT:
        return W.Shape(kind, z, m, _block([member] if member else [], dims, swap))
    if kind in (W.LINESTRING, W.CIRCULARSTRING):
        block = _block(member, dims, swap)
        if len(block) == 1 or (kind == W.CIRCULARSTRING and len(block) and len(block) % 2 == 0):
            raise ValueError("Invalid number of curve positions")
        return W.Shape(kind, z, m, block)
    if kind == W.POLYGON:
        return W.Shape(kind, z, m, _rings(member, dims, swap))
    single = {W.MULTIPOINT: W.POINT, W.MULTILINESTRING: W.LINESTRING, W.MULTIPOLYGON: W.POLYGON}[kind]
    parts = []
    for item in member:
        if single == W.POINT:
            parts.append(W.Shape(single, z, m, _block([item], dims, swap)))
        elif single == W.LINESTRING:
            parts.append(W.Shape(single, z, m, _block(item, dims, swap)))
        else:
            parts.append(W.Shape(single, z, m, _rings(item, dims, swap)))
    return W.Shape(kind, z, m, parts)


def _rings(member, dims, swap):
    if not isinstance(member, list):
        raise ValueError("Polygon coordinates must be an array")
    rings = [_block(r, dims, swap) for r in member]
    for ring in rings:
        if len(ring) < 4 or (ring[0, :2] != ring[-1, :2]).any():
            raise ValueError("Polygon rings must be closed and have four positions or more")
    return rings


def write_geometry(shape, options, swap: bool = False):
    """Geometry object, or None for NULL and, if asked for, EMPTY.

    Dropping Z or M must be allowed by the options; ``measured`` output is the
    caller's decision through ``keep_m``.
    """
    if shape is None:
        return None
    if W.is_empty(shape) and options["empty_to_null"]:
        return None
    z, m = shape.z, shape.m
    if z and options["drop_z"]:
        z = False
    if m and not options["keep_m"]:
        if not options["drop_m"]:
            raise ValueError("M ordinates cannot be written by this profile")
        m = False
    if m and options["drop_m"]:
        m = False
    keep = [0, 1] + ([2] if z else []) + ([2 + shape.z] if m else [])
    if swap:
        keep[:2] = [1, 0]
    return _object(shape, keep)


def _positions(block, keep):
    block = block[:, keep]
    if not np.isfinite(block).all():
        raise ValueError("Non-finite coordinate")
    return [[number(v) for v in row] for row in block.tolist()]


def _object(shape, keep):
    kind, name = shape.kind, KIND_NAMES[shape.kind]
    if kind == W.POINT:
        found = _positions(shape.parts, keep)
        return {"type": name, "coordinates": found[0] if found else []}
    if kind in (W.LINESTRING, W.CIRCULARSTRING):
        return {"type": name, "coordinates": _positions(shape.parts, keep)}
    if kind == W.POLYGON:
        return {"type": name, "coordinates": [_positions(r, keep) for r in shape.parts]}
    members = [_object(p, keep) for p in shape.parts]
    if kind in (W.MULTIPOINT, W.MULTILINESTRING, W.MULTIPOLYGON):
        return {"type": name, "coordinates": [g["coordinates"] for g in members]}
    return {"type": name, "geometries": members}


def contains_curves(value) -> bool:
    if isinstance(value, dict):
        return value.get("type") in CURVE_NAMES or any(map(contains_curves, value.values()))
    return isinstance(value, list) and any(map(contains_curves, value))


def same_json(a, b) -> bool:
    """Equality with numbers compared by value."""
    if is_number(a) and is_number(b):
        return a == b or (isfinite(float(a)) and parts_of(a) == parts_of(b))
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same_json, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same_json(a[k], b[k]) for k in a)
    return type(a) is type(b) and a == b


def parts_of(text: str):
    """(negative, digits, exponent) of a decimal text, normalised."""
    mantissa, _, power = text.lower().partition("e")
    whole, _, fraction = mantissa.lstrip("-").partition(".")
    digits = (whole + fraction).lstrip("0")
    kept = digits.rstrip("0")
    if not kept:
        return False, "", 0
    return text.startswith("-"), kept, int(power or 0) - len(fraction) + len(digits) - len(kept)


# -- simple feature validity -----------------------------------------------------


def invalidity(shape: W.Shape) -> str | None:
    """Why a geometry is not a valid simple feature, or None."""
    if shape.kind in (W.MULTIPOLYGON, W.COLLECTION, W.MULTILINESTRING, W.MULTIPOINT):
        for part in shape.parts:
            problem = invalidity(part)
            if problem:
                return problem
        if shape.kind == W.MULTIPOLYGON and len(shape.parts) > 1:
            return _crossing([r for p in shape.parts for r in p.parts])
        return None
    if shape.kind == W.LINESTRING:
        block = shape.parts
        if len(block) and (block[:, :2] == block[0, :2]).all():
            return "Too few distinct points in geometry component"
        return None
    if shape.kind != W.POLYGON or not shape.parts:
        return None
    for ring in shape.parts:
        if len(ring) < 4 or (ring[0, :2] != ring[-1, :2]).any():
            return "Ring is not closed or too short"
    problem = _crossing(shape.parts)
    if problem:
        return problem
    if any(_area(ring) == 0 for ring in shape.parts):
        return "Ring has no area"
    shell = np.column_stack([shape.parts[0][:-1, :2], shape.parts[0][1:, :2]])
    for hole in shape.parts[1:]:
        if not _covers(shell, hole[:, :2]):
            return "Hole lies outside shell"
    return None


def _area(ring) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) / 2


def _covers(edges, points) -> bool:
    x1, y1, x2, y2 = edges.T
    for x, y in points:
        turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        on = (turn == 0) & (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))
        crossed = ((y1 <= y) != (y2 <= y)) & ((turn > 0) == (y2 > y1))
        if not on.any() and crossed.sum() % 2 == 0:
            return False
    return True


def _crossing(rings) -> str | None:
    """Segments that cross or overlap; touching end points are allowed."""
    e = np.vstack([np.column_stack([r[:-1, :2], r[1:, :2]]) for r in rings if len(r) > 1])
    e = e[(e[:, :2] != e[:, 2:]).any(axis=1)]
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    order = np.argsort(low[:, 0], kind="stable")
    e, low, high = e[order], low[order], high[order]
    last = np.searchsorted(low[:, 0], high[:, 0], "right")
    for i in range(len(e)):
        j = np.arange(i + 1, last[i])
        j = j[(low[j, 1] <= high[i, 1]) & (high[j, 1] >= low[i, 1])]
        if not len(j):
            continue
        a, b, c, d = e[i]
        x1, y1, x2, y2 = e[j].T
        s1, s2 = np.sign((c - a) * (y1 - b) - (d - b) * (x1 - a)), np.sign((c - a) * (y2 - b) - (d - b) * (x2 - a))
        s3, s4 = np.sign((x2 - x1) * (b - y1) - (y2 - y1) * (a - x1)), np.sign((x2 - x1) * (d - y1) - (y2 - y1) * (c - x1))
        if ((s1 * s2 < 0) & (s3 * s4 < 0)).any():
            return "Self-intersection"
        flat = (s1 == 0) & (s2 == 0)
        if flat.any():
            # Collinear segments overlap when their projections share length.
            axis = 0 if abs(c - a) >= abs(d - b) else 1
            lo = np.maximum(low[i, axis], low[j, axis])
            hi = np.minimum(high[i, axis], high[j, axis])
            if (flat & (hi > lo)).any():
                return "Self-intersection"
        # An end point in the inside of another segment of the same ring.
        inner = ((s1 == 0) & (s3 * s4 < 0)) | ((s2 == 0) & (s3 * s4 < 0))
        inner |= ((s3 == 0) & (s1 * s2 < 0)) | ((s4 == 0) & (s1 * s2 < 0))
        if len(rings) == 1 and inner.any():
            return "Ring Self-intersection"
    return None
