"""Which cell centres does a polygon cover, its boundary included.

The kernels work on polygon edges, an (n, 4) array of x1, y1, x2, y2.  They
run inside Arrow functions on one tile at a time.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil, floor

import numpy as np

from . import wkb as W

#: rounding bound of the two-product orientation determinant
_FILTER = 3.3306690738754716e-16
_CHUNK = 4096


def edges_of(shape: W.Shape) -> np.ndarray:
    """Edges of all rings of a polygon or multipolygon."""
    if shape.kind in W.CURVES:
        raise ValueError("Curved geometry must be linearised first")
    if shape.kind not in (W.POLYGON, W.MULTIPOLYGON):
        raise ValueError("A polygon or multipolygon is required")
    polygons = [shape] if shape.kind == W.POLYGON else shape.parts
    blocks = []
    for polygon in polygons:
        for ring in polygon.parts:
            if len(ring) < 4 or (ring[0, :2] != ring[-1, :2]).any():
                raise ValueError("Polygon rings must be closed and have four points or more")
            blocks.append(np.column_stack([ring[:-1, :2], ring[1:, :2]]))
    return np.vstack(blocks) if blocks else np.empty((0, 4))


def orientation(x1, y1, x2, y2, px, py) -> np.ndarray:
    """Sign of the turn (x1,y1) -> (x2,y2) -> (px,py), exact."""
    left, right = (x2 - x1) * (py - y1), (y2 - y1) * (px - x1)
    det = left - right
    sign = np.sign(det)
    unsure = (np.abs(det) <= _FILTER * (np.abs(left) + np.abs(right))) & ((left != 0) | (right != 0))
    for i in np.flatnonzero(unsure):
        a, b, c, d, p, q = (Fraction(float(v[i])) for v in (x1, y1, x2, y2, px, py))
        exact = (c - a) * (q - b) - (d - b) * (p - a)
        sign[i] = (exact > 0) - (exact < 0)
    return sign


def covered(edges: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Boolean (len(ys), len(xs)) mask of covered centres.

    ``xs`` ascends; ``ys`` may run either way.  Even-odd rule over all rings,
    centres on an edge count.
    """
    if len(ys) > 1 and ys[0] > ys[-1]:
        return covered(edges, xs, ys[::-1])[::-1]
    rows, cols = len(ys), len(xs)
    crossings = np.zeros(rows * (cols + 1), dtype=np.int64)
    marks = np.zeros(rows * (cols + 1), dtype=np.int64)
    touched = np.zeros(rows * cols, dtype=bool)
    for start in range(0, len(edges), _CHUNK):
        x1, y1, x2, y2 = edges[start : start + _CHUNK].T
        down = y1 > y2
        x1, x2 = np.where(down, x2, x1), np.where(down, x1, x2)
        y1, y2 = np.where(down, y2, y1), np.where(down, y1, y2)
        low = np.searchsorted(ys, y1, "left")
        n = np.searchsorted(ys, y2, "right") - low
        e = np.repeat(np.arange(len(n)), n)
        r = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        flat = y1[e] == y2[e]
        if flat.any():
            he, hr = e[flat], r[flat]
            a = np.searchsorted(xs, np.minimum(x1[he], x2[he]), "left")
            b = np.searchsorted(xs, np.maximum(x1[he], x2[he]), "right")
            np.add.at(marks, hr * (cols + 1) + a, 1)
            np.add.at(marks, hr * (cols + 1) + b, -1)
            e, r = e[~flat], r[~flat]
        ax, ay, bx, by, cy = x1[e], y1[e], x2[e], y2[e], ys[r]
        # k = number of centres left of the crossing; the two centres next to
        # the computed crossing are decided exactly.
        k = np.searchsorted(xs, ax + (cy - ay) * (bx - ax) / (by - ay), "left")
        for shift in (-1, 0):
            c = k + shift
            ok = (c >= 0) & (c < cols)
            side = np.full(len(c), 1 if shift else -1.0)
            side[ok] = orientation(ax[ok], ay[ok], bx[ok], by[ok], xs[c[ok]], cy[ok])
            touched[(r * cols + c)[ok & (side == 0)]] = True
            if shift:
                before = side <= 0
            else:
                after = side > 0
        k = np.where(before, k - 1, np.where(after, k + 1, k))
        half_open = cy < by
        crossings += np.bincount(
            (r * (cols + 1) + k)[half_open], minlength=len(crossings)
        )
    crossings = crossings.reshape(rows, cols + 1)
    inside = (crossings[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:] & 1).astype(bool)
    on_flat = marks.reshape(rows, cols + 1).cumsum(axis=1)[:, :-1] > 0
    return inside | on_flat | touched.reshape(rows, cols)


class Grid:
    """Cell lattice of one raster: centres and tile numbers."""

    def __init__(self, origin_x, origin_y, pixel_x, pixel_y, width, height, tile_size, off_x=0, off_y=0):
        self.ox, self.oy, self.px, self.py = origin_x, origin_y, pixel_x, pixel_y
        self.width, self.height, self.tile = width, height, tile_size
        self.off_x, self.off_y = off_x, off_y

    def xs(self, first, n):
        return self.ox + (np.arange(first, first + n) + 0.5) * self.px

    def ys(self, first, n):
        return self.oy + (np.arange(first, first + n) + 0.5) * self.py

    def cells(self, box):
        """Column and row range that may hold covered centres, or None."""
        xmin, ymin, xmax, ymax = box
        cols = sorted(((xmin - self.ox) / self.px, (xmax - self.ox) / self.px))
        rows = sorted(((ymin - self.oy) / self.py, (ymax - self.oy) / self.py))
        c0, c1 = max(0, floor(cols[0] - 1)), min(self.width - 1, ceil(cols[1] + 1))
        r0, r1 = max(0, floor(rows[0] - 1)), min(self.height - 1, ceil(rows[1] + 1))
        return (c0, r0, c1, r1) if c0 <= c1 and r0 <= r1 else None


    def tiles(self, box):
        """First and last tile numbers (x0, y0, x1, y1) of a box, or None."""
        span = self.cells(box)
        if span is None:
            return None
        c0, r0, c1, r1 = span
        return (c0 + self.off_x) // self.tile, (r0 + self.off_y) // self.tile, (c1 + self.off_x) // self.tile, (r1 + self.off_y) // self.tile

    def centres(self, window):
        """First and last centre of a window of tiles in x, lowest and highest in
        y, and the centre of its first row."""
        tx0, ty0, tx1, ty1 = window
        left, right = max(0, tx0 * self.tile - self.off_x), min(self.width, (tx1 + 1) * self.tile - self.off_x) - 1
        top, bottom = max(0, ty0 * self.tile - self.off_y), min(self.height, (ty1 + 1) * self.tile - self.off_y) - 1
        x0, x1 = (self.ox + (c + 0.5) * self.px for c in (left, right))
        y0, y1 = (self.oy + (r + 0.5) * self.py for r in (top, bottom))
        return x0, x1, min(y0, y1), max(y0, y1), y0


def bounds_of(edges: np.ndarray) -> tuple[float, float, float, float]:
    """Bounds of closed rings, of which the start points are enough."""
    low, high = edges[:, :2].min(axis=0), edges[:, :2].max(axis=0)
    return float(low[0]), float(low[1]), float(high[0]), float(high[1])


def _upright(edges: np.ndarray) -> np.ndarray:
    """Edges to the right of all centres of a window, as few upright ones.

    A ray to the right only counts how often it crosses them, and only odd counts
    matter: where an even number of them share a height, none is left.
    """
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    ends, counts = np.unique(np.concatenate([low, high])[np.tile(low < high, 2)], return_counts=True)
    ends = ends[counts % 2 == 1]
    x = np.full(len(ends) // 2, edges[:, [0, 2]].max() if len(edges) else 0.0)
    return np.column_stack([x, ends[::2], x, ends[1::2]])


def quarters(edges: np.ndarray | None, grid: Grid, window, cut: bool):
    """Yield (edges, window, cut) for the quarters of a window of tiles that may
    hold covered centres.

    ``edges`` None: the window is wholly covered.  Else a quarter gets the edges
    near it, and those to its right in as few upright ones as have the same effect;
    ``cut`` tells that edges to the left were left out.
    """
    tx0, ty0, tx1, ty1 = window
    mx, my = (tx0 + tx1) // 2, (ty0 + ty1) // 2
    for y0, y1 in ((ty0, my), (my + 1, ty1)):
        for x0, x1 in ((tx0, mx), (mx + 1, tx1)):
            if x0 > x1 or y0 > y1:
                continue
            part = x0, y0, x1, y1
            if edges is None:
                yield None, part, cut
                continue
            left, right, low, high, first = grid.centres(part)
            xlo, xhi = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
            band = (np.minimum(edges[:, 1], edges[:, 3]) <= high) & (np.maximum(edges[:, 1], edges[:, 3]) >= low)
            deciding = band & (xhi >= left)
            near = deciding & (xlo <= right)
            beyond = _upright(edges[deciding & ~near])
            if near.any():
                yield np.vstack([edges[near], beyond]), part, cut or bool((band & ~deciding).any())
            elif len(beyond) and covered(beyond, np.array([left]), np.array([first]))[0, 0]:
                yield None, part, cut


def tile_cover(edges: np.ndarray | None, grid: Grid, window=None, cut: bool = False):
    """Yield (tile_x, tile_y, edges or None, cut) for every tile that may hold
    a covered centre.  None means that no edge comes near the tile and all its
    centres are covered.  Otherwise only the edges that decide the tile are
    given: those in its rows and not wholly to its left; ``cut`` tells that
    edges to the left were left out.

    With a ``window`` only its tiles are given; ``edges`` and ``cut`` are then
    those of :func:`quarters`.
    """
    if edges is None:
        yield from ((tx, ty, None, False) for ty in range(window[1], window[3] + 1) for tx in range(window[0], window[2] + 1))
        return
    span = window or grid.tiles(bounds_of(edges))
    if span is None:
        return
    tx0, ty0, tx1, ty1 = span
    size = grid.tile
    if tx0 == tx1 and ty0 == ty1:
        yield tx0, ty0, edges, cut
        return
    xlo, xhi = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
    ylo, yhi = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    for ty in range(ty0, ty1 + 1):
        top = max(0, ty * size - grid.off_y)
        ys = grid.ys(top, min(grid.height, (ty + 1) * size - grid.off_y) - top)
        low, high = min(ys[0], ys[-1]), max(ys[0], ys[-1])
        band = np.flatnonzero((ylo <= high) & (yhi >= low))
        for tx in range(tx0, tx1 + 1):
            left = max(0, tx * size - grid.off_x)
            right = min(grid.width, (tx + 1) * size - grid.off_x) - 1
            x0 = grid.ox + (left + 0.5) * grid.px
            x1 = grid.ox + (right + 0.5) * grid.px
            deciding = band[xhi[band] >= x0]
            if (xlo[deciding] <= x1).any():
                yield tx, ty, edges[deciding], cut or len(deciding) < len(band)
            elif len(deciding) and covered(edges[deciding], np.array([x0]), ys[:1])[0, 0]:
                yield tx, ty, None, False
