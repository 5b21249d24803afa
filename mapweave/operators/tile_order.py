"""Tiles in Morton order, and scans of only the tiles that are asked for.

A written tile carries its Morton number ``tile_z``, the interleaved bits of its
column and row, and tiles lie in that order.  So a block of 2^k x 2^k tiles is one
range of numbers, and any window is a union of ranges, which is pushed into the
scan together with the raster, the level and the window's tile numbers.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits of a tile number
BITS = 31

#: number ranges of one raster in a filter, and rasters that are named in it
MOST_RANGES, MOST_RASTERS = 32, 16

#: blocks per side in which the tiles under many shapes are counted
BLOCKS = 32

# Masks that spread the bits of a number over every second place.
_SPREAD = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def morton(x: Column, y: Column) -> Column:
    """The Morton number of a tile; columns take the even bits."""

    def spread(v: Column) -> Column:
        v = v.cast("long")
        for shift, mask in _SPREAD:
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def morton_number(x: int, y: int) -> int:
    return sum(((x >> b) & 1) << (2 * b) | ((y >> b) & 1) << (2 * b + 1) for b in range(BITS))


def merged(ranges: list[tuple[int, int]], most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Sorted ranges, at most so many: the narrowest gaps are closed."""
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    if not out:
        return []
    gaps = sorted(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1], reverse=True)
    starts = [0, *sorted(gaps[: most - 1])]
    return [(out[a][0], out[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(out)], strict=True)]


def window_ranges(x0: int, y0: int, x1: int, y1: int, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Few ranges of numbers that cover the tiles ``x0 .. x1``, ``y0 .. y1``.

    Quadrants are cut until they are inside the window, level by level; when a
    level would give too many, those on the border are taken whole.
    """
    if x0 > x1 or y0 > y1:
        return []
    inside: list[tuple[int, int]] = []
    border = [(0, 0)]
    for bits in range(BITS, -1, -1):
        cut = []
        for x, y in border:
            left, top, last = x << bits, y << bits, (1 << bits) - 1
            if left > x1 or top > y1 or left + last < x0 or top + last < y0:
                continue
            if x0 <= left and left + last <= x1 and y0 <= top and top + last <= y1:
                inside.append((x, y, bits))
            else:
                cut.append((x, y))
        if bits == 0 or len(inside) + 2 * len(cut) > 8 * most:
            inside += [(x, y, bits) for x, y in cut]
            break
        border = [(2 * x + i, 2 * y + j) for x, y in cut for i in (0, 1) for j in (0, 1)]
    found = [(morton_number(x, y) << (2 * b), ((morton_number(x, y) + 1) << (2 * b)) - 1) for x, y, b in inside]
    return merged(found, most)


def ordered(tiles: DataFrame) -> bool:
    return "tile_z" in tiles.columns


def only(tiles: DataFrame, wanted: dict[str, tuple[tuple[int, int, int, int], list[tuple[int, int]]]], level: int = 0) -> DataFrame:
    """The tiles of a level that lie in the boxes and number ranges of the named
    rasters; every part of the condition can be pushed into the scan."""
    rows = tiles.filter((F.col("level") == level) & F.col("raster_id").isin(sorted(wanted)))

    def one(name, box, ranges) -> Column:
        in_box = F.col("tile_x").between(box[0], box[2]) & F.col("tile_y").between(box[1], box[3])
        in_range = reduce(or_, [F.col("tile_z").between(low, high) for low, high in ranges], F.lit(False))
        return in_box & in_range if len(wanted) == 1 else (F.col("raster_id") == name) & in_box & in_range

    return rows.filter(reduce(or_, [one(name, *found) for name, found in sorted(wanted.items())], F.lit(False)))


def in_windows(tiles: DataFrame, planned: DataFrame) -> DataFrame:
    """The tiles in each raster's pixel ``window`` (NULL: none).

    Up to :data:`MOST_RASTERS` windows are read first and become a filter of the
    scan; tiles without numbers, or of more rasters, are returned as they are.
    """
    if not ordered(tiles):
        return tiles
    w, size = F.col("window"), F.col("tile_size")
    first = [F.floor((F.col(off) + w[c]) / size).cast("long").alias(c) for off, c in (("off_x", "c0"), ("off_y", "r0"))]
    last = [F.floor((F.col(off) + w[c] - 1) / size).cast("long").alias(c) for off, c in (("off_x", "c1"), ("off_y", "r1"))]
    rows = planned.filter(w.isNotNull()).select("raster_id", *first, *last).limit(MOST_RASTERS + 1).collect()
    if len(rows) > MOST_RASTERS:
        return tiles
    wanted = {}
    for r in rows:
        box = r.c0, r.r0, r.c1, r.r1
        wanted[r.raster_id] = box, window_ranges(*box)
    return only(tiles, wanted)


def under_shapes(tiles: DataFrame, spans: DataFrame) -> DataFrame:
    """The tiles under any of many shapes.

    ``spans``: ``raster_id``, the tile numbers ``x0``, ``y0``, ``x1``, ``y1`` that
    a shape's bounds touch, and ``shift``, so that a raster has at most
    :data:`BLOCKS` blocks of 2^shift tiles per side.  One small aggregation finds
    the blocks in use; they become number ranges in the filter of the scan.
    """
    if not ordered(tiles):
        return tiles
    names = spans.select("raster_id").distinct().limit(MOST_RASTERS + 1).collect()
    if len(names) > MOST_RASTERS:
        return tiles
    block = {c: F.expr(f"shiftright({c}, shift)") for c in ("x0", "x1", "y0", "y1")}
    rows = spans.select("raster_id", "shift", "x0", "y0", "x1", "y1", F.sequence(block["x0"], block["x1"]).alias("xs"), F.sequence(block["y0"], block["y1"]).alias("ys"))
    bounds = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    rows = rows.withColumn("bx", F.explode("xs")).withColumn("by", F.explode("ys"))
    wanted: dict = {}
    for r in rows.groupBy("raster_id", "shift", "bx", "by").agg(*bounds).collect():
        box, ranges = wanted.get(r.raster_id, ((r.x0, r.y0, r.x1, r.y1), []))
        box = min(box[0], r.x0), min(box[1], r.y0), max(box[2], r.x1), max(box[3], r.y1)
        number = morton_number(r.bx, r.by)
        wanted[r.raster_id] = box, [*ranges, (number << (2 * r["shift"]), ((number + 1) << (2 * r["shift"])) - 1)]
    return only(tiles, {name: (box, merged(ranges)) for name, (box, ranges) in wanted.items()})
