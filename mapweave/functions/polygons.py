"""Rings to polygons: nesting by area and cover."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wkb as W
from .geometry import GEOMETRY, arrow_geometries


def signed_area(ring: np.ndarray) -> float:
    """Positive for counter-clockwise rings."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) / 2


def oriented(ring: np.ndarray, ccw: bool) -> np.ndarray:
    return ring if (signed_area(ring) > 0) == ccw else ring[::-1]


def ring_covers(outer: np.ndarray, inner: np.ndarray) -> bool:
    """All points of ``inner`` lie in ``outer`` or on its boundary."""
    x1, y1, x2, y2 = np.hstack([outer[:-1, :2], outer[1:, :2]]).T
    px, py = inner[:, 0, None], inner[:, 1, None]
    turn = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    in_box = (np.minimum(x1, x2) <= px) & (px <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= py) & (py <= np.maximum(y1, y2))
    on = ((turn == 0) & in_box).any(axis=1)
    crossed = (((y1 <= py) != (y2 <= py)) & ((turn > 0) == (y2 > y1))).sum(axis=1) % 2 == 1
    return bool((on | crossed).all())


def nest_rings(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons (shell first, then holes) from rings in any order.

    The parent of a ring is the smallest larger ring that covers it; even
    depth is a shell, odd depth a hole of its parent.
    """
    for ring in rings:
        if len(ring) < 4 or (ring[0, :2] != ring[-1, :2]).any():
            raise ValueError("Polygon rings must be closed and have four points or more")
    order = sorted(range(len(rings)), key=lambda i: -abs(signed_area(rings[i])))
    depth, holes, result = {}, {}, []
    for position, i in enumerate(order):
        parent = next((j for j in reversed(order[:position]) if ring_covers(rings[j], rings[i])), None)
        depth[i] = 0 if parent is None else depth[parent] + 1
        if depth[i] % 2 == 0:
            holes[i] = [oriented(rings[i], False)]
            result.append(holes[i])
        else:
            holes[parent].append(oriented(rings[i], True))
    return result


@F.arrow_udf(GEOMETRY)
def _assemble(rings: pa.Array, srid: pa.Array) -> pa.Array:
    out = []
    for parts, code in zip(rings.to_pylist(), srid.to_pylist()):
        blocks = [np.array([[p["x"], p["y"]] for p in ring], float).reshape(-1, 2) for ring in parts]
        polygons = [W.Shape(W.POLYGON, False, False, r) for r in nest_rings(blocks)]
        out.append((W.Shape(W.MULTIPOLYGON, False, False, polygons), code))
    return arrow_geometries(out)


def assemble_polygons(df: DataFrame, id: str, ring: str, srid: int = 0) -> DataFrame:
    """One multipolygon per ``id`` from rows with one ring each, an
    ``ARRAY<STRUCT<x, y>>``.  Shells come out clockwise, holes the other way.
    A group is the rings of one feature.
    """
    return df.groupBy(id).agg(F.collect_list(ring).alias("_rings")).select(
        id, _assemble("_rings", F.lit(srid)).alias("geometry", metadata={"srid": srid})
    )
