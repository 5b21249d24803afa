"""Covers of huge zones, cut into quarters and dealt out."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapweave.functions import wkb as W
from mapweave.functions.coverage import Grid, bounds_of, covered, edges_of, quarters, tile_cover
from mapweave.functions.geometry import st_geomfromwkb
from mapweave.operators import clip, rasters, zonal
from mapweave.operators.rasters import raster_meta, tiles_from_pixels


def star(rng, x, y, size, n, hole=True):
    """A ragged ring with a hole, some corners exactly on centres."""
    def ring(factor):
        out = []
        for i in range(n):
            r = size * factor * rng.uniform(0.5, 1)
            p = x + r * math.cos(2 * math.pi * i / n), y + r * math.sin(2 * math.pi * i / n)
            out.append(tuple(math.floor(v) + 0.5 for v in p) if rng.random() < 0.3 else p)
        return np.array([*out, out[0]])

    return W.Shape(W.POLYGON, False, False, [ring(1.0), ring(0.3)] if hole else [ring(1.0)])


def grids():
    return [Grid(0, 0, 1, 1, 90, 70, 4), Grid(-3, 66, 1.5, -1, 60, 70, 5, 2, 3)]


def mask_of(pieces, grid):
    out = np.zeros((grid.height, grid.width), bool)
    for tx, ty, edges, _ in pieces:
        left, top = max(0, tx * grid.tile - grid.off_x), max(0, ty * grid.tile - grid.off_y)
        n = min(grid.width, (tx + 1) * grid.tile - grid.off_x) - left
        m = min(grid.height, (ty + 1) * grid.tile - grid.off_y) - top
        assert not out[top : top + m, left : left + n].any()
        out[top : top + m, left : left + n] = True if edges is None else covered(edges, grid.xs(left, n), grid.ys(top, m))
    return out


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_quarters_cover_the_same(depth):
    rng = random.Random(depth)
    for grid in grids():
        for _ in range(12):
            edges = edges_of(star(rng, rng.uniform(-5, 80), rng.uniform(-5, 70), rng.uniform(5, 60), rng.randrange(4, 40)))
            window = grid.tiles(bounds_of(edges))
            whole = mask_of(tile_cover(edges, grid), grid)
            assert (whole == covered(edges, grid.xs(0, grid.width), grid.ys(0, grid.height))).all()
            parts = [] if window is None else [(edges, window, False)]
            for _ in range(depth):
                parts = [q for e, w, c in parts for q in quarters(e, grid, w, c)]
            found = [piece for e, w, c in parts for piece in tile_cover(e, grid, w, c)]
            assert (mask_of(found, grid) == whole).all()
            assert {p[:2] for p in found if p[2] is None} <= {p[:2] for p in tile_cover(edges, grid) if p[2] is None or p[2] is not None}


def test_edges_are_left_behind():
    """A quarter holds the edges near it and few others."""
    rng = random.Random(1)
    grid = Grid(0, 0, 1, 1, 4096, 4096, 16)
    edges = edges_of(star(rng, 2048, 2048, 2000, 5000))
    parts = [(edges, grid.tiles(bounds_of(edges)), False)]
    for _ in range(4):
        parts = [q for e, w, c in parts for q in quarters(e, grid, w, c)]
    sizes = [len(e) for e, _, _ in parts if e is not None]
    # not the whole outline again for every quarter
    assert sum(sizes) < 6 * len(edges) and max(sizes) < len(edges) / 4


@pytest.fixture(scope="module")
def raster(spark):
    meta = raster_meta(spark, [dict(raster_id="r", path="p", width=200, height=160, origin_x=0, origin_y=0, pixel_x=1, pixel_y=1, crs="LOCAL", tile_size=4, bands=[dict(name="b", nodata=-9.0)])])
    cells = spark.range(200 * 160).select(F.lit("r").alias("raster_id"), F.lit(1).alias("band"), (F.col("id") % 200).alias("x"), F.expr("id div 200").alias("y"), ((F.col("id") * 37) % 1001).cast("double").alias("v"))
    return meta, tiles_from_pixels(cells, meta, "r")


def shapes(spark):
    rng = random.Random(6)
    rows = [(1, star(rng, 100, 80, 95, 60)), (2, star(rng, 20, 20, 6, 9, False)), (3, star(rng, 150, 60, 300, 30)), (4, W.Shape(W.POLYGON, False, False, []))]
    return spark.createDataFrame([(i, bytearray(W.write(s))) for i, s in rows], "id int, wkb binary").select("id", st_geomfromwkb("wkb", 0).alias("g"))


def test_zonal_and_clip_equal(spark, raster, monkeypatch):
    meta, tiles = raster
    run = lambda: sorted(map(tuple, zonal.zonal_stats(shapes(spark), "g", meta, tiles, key="id", raster_id="r", stats="count sum min max").drop("g").collect()))
    some = shapes(spark).filter("id < 4")
    cut = lambda: sorted(map(tuple, rasters.pixels_from_tiles(clip.clip_polygon(meta, tiles, some, "g", out_id="id", raster_id="r")[1]).collect()), key=repr)
    want, pixels = run(), cut()
    monkeypatch.setattr(zonal, "SPLIT_TILES", 20)
    assert run() == want and cut() == pixels and want[0][1] > 10_000


def test_one_zone_uses_many_tasks(spark, monkeypatch):
    """A zone over a million tiles is covered by all tasks."""
    meta = raster_meta(spark, [dict(raster_id="r", path="p", width=4000, height=4000, origin_x=0, origin_y=0, pixel_x=1, pixel_y=1, crs="LOCAL", tile_size=4, bands=[dict(name="b")])])
    shape = star(random.Random(2), 2000, 2000, 1990, 400)
    zone = spark.createDataFrame([(1, bytearray(W.write(shape)))], "id int, wkb binary").select("id", st_geomfromwkb("wkb", 0).alias("g"))
    ready = zonal.zones_on_grid(zone, "g", meta, raster_id="r").select("id", "raster_id", "grid", F.col("_geom"))
    assert zonal.most_tiles(ready) > 900_000
    cover = zonal.cover_tiles(ready.withColumn("wkb", F.col("_geom.wkb")).drop("_geom"), ["id"], zonal.most_tiles(ready))
    per_task = cover.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("tile_no").alias("d")).collect()
    total = sum(r.n for r in per_task)
    assert total == sum(r.d for r in per_task) > 300_000
    assert len(per_task) == 4 and max(r.n for r in per_task) < 0.6 * total
