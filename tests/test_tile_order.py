"""Tiles in Morton order and scans that skip what is not asked for."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mapweave.functions import wkb as W
from mapweave.functions.geometry import geometry_field, st_box, st_geomfromwkb
from mapweave.operators import clip, rasters, zonal
from mapweave.operators import tile_order as order
from mapweave.operators.rasters import raster_meta, tiles_from_pixels
from mapweave.sources.raster_store import read_raster, write_raster

SIDE, TILE = 256, 4


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Two rasters of 64 x 64 tiles on disk, many row groups each."""
    bands = [dict(name="b", nodata=-9.0)]
    meta = raster_meta(spark, [dict(raster_id=n, path="p", width=SIDE, height=SIDE, origin_x=x, origin_y=0, pixel_x=1, pixel_y=1, crs="LOCAL", tile_size=TILE, bands=bands) for n, x in (("a", 0), ("b", 1000))])
    cells = spark.range(SIDE * SIDE).select((F.col("id") % SIDE).alias("x"), F.expr(f"id div {SIDE}").alias("y"))
    pixels = cells.crossJoin(spark.createDataFrame([("a",), ("b",)], "raster_id string")).select("raster_id", F.lit(1).alias("band"), "x", "y", (F.col("x") * 1000 + F.col("y")).cast("double").alias("v"))
    path = str(tmp_path_factory.mktemp("raster") / "out")
    write_raster(meta, tiles_from_pixels(pixels, meta), path, row_group=16_000)
    return path


def scanned(df):
    """Rows that the scan of a plan without shuffles gave, and the plan."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value(), plan.treeString()


def test_numbers(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(2**k), rng.randrange(2**k)) for k in (1, 4, 16, 31) for _ in range(20)]
    rows = spark.createDataFrame(pairs, "x int, y int").select("x", "y", order.morton(F.col("x"), F.col("y")).alias("z")).collect()
    assert all(r.z == order.morton_number(r.x, r.y) == int("".join(f"{b}{a}" for a, b in zip(f"{r.x:031b}", f"{r.y:031b}")), 2) for r in rows)


@pytest.mark.parametrize("most", [1, 4, 32])
def test_ranges_cover_the_window(most):
    rng = random.Random(most)
    for _ in range(40):
        x0, y0 = rng.randrange(60), rng.randrange(60)
        x1, y1 = x0 + rng.randrange(20), y0 + rng.randrange(20)
        ranges = order.window_ranges(x0, y0, x1, y1, most)
        assert 0 < len(ranges) <= most and all(a <= b for a, b in ranges)
        assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))
        assert all(any(a <= order.morton_number(x, y) <= b for a, b in ranges) for x in range(x0, x1 + 1) for y in range(y0, y1 + 1))
        if most == 32:
            # few tiles beside the window: no more than a border of blocks around it
            assert sum(b - a + 1 for a, b in ranges) <= 4 * (x1 - x0 + 2) * (y1 - y0 + 2)
    assert order.window_ranges(3, 3, 2, 4) == []


def test_merged_closes_the_narrowest_gaps():
    assert order.merged([(0, 1), (2, 3), (10, 11), (5, 6), (100, 101)], 3) == [(0, 6), (10, 11), (100, 101)]
    assert order.merged([(7, 9)], 1) == [(7, 9)] and order.merged([], 4) == []


def test_window_reads_its_row_groups(spark, written):
    meta, tiles = read_raster(spark, written)
    planned = meta.filter("raster_id = 'a'").withColumn("window", clip.pixel_window(*[F.lit(float(v)) for v in (100, 40, 118, 52)]))
    rows, plan = scanned(order.in_windows(tiles, planned).drop("pixels"))
    want = {(x, y) for x in range(25, 30) for y in range(10, 13)}
    found = {(r.tile_x, r.tile_y) for r in order.in_windows(tiles, planned).collect()}
    assert found == want
    # PushedFilters hold numbers and tiles, the folders are pruned by name
    assert "GreaterThanOrEqual(tile_z" in plan and "GreaterThanOrEqual(tile_x" in plan
    assert "PartitionFilters: [" in plan and "raster_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    groups = [pq.ParquetFile(f).metadata for f in files(written)]
    sizes = [m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)]
    assert len(sizes) > 20 and rows <= 6 * max(sizes) < SIDE * SIDE // TILE**2 / 4


def files(path):
    return glob.glob(f"{path}/tiles/raster_id=a/level=0/*.parquet")


def pixels_of(parts):
    return sorted(map(tuple, rasters.pixels_from_tiles(parts[1]).collect()), key=repr)


def test_clip_box_equals_unnumbered(spark, written):
    meta, tiles = read_raster(spark, written)
    for ids in ("raster_id = 'a'", "true"):
        some = meta.filter(ids)
        bounds = [F.col("origin_x") + v if i % 2 == 0 else F.lit(float(v)) for i, v in enumerate((3.5, 3, 20.25, 61))]
        some = some.withColumns({f"b{i}": b for i, b in enumerate(bounds)})
        wanted = tiles if ids == "true" else tiles.filter(ids)
        got = clip.clip_box(some, tiles if ids == "true" else wanted, "b0", "b1", "b2", "b3")
        assert pixels_of(got) == pixels_of(clip.clip_box(some, wanted.drop("tile_z"), "b0", "b1", "b2", "b3"))


def zones(spark):
    corners = [(1, 10.0, 10.0, 14.0, 13.0), (2, 200.0, 220.0, 230.0, 231.0), (3, 9.0, 9.0, 11.0, 40.0), (4, 900.0, 900.0, 901.0, 901.0)]
    return spark.createDataFrame(corners, "id int, x0 double, y0 double, x1 double, y1 double").select("id", geometry_field(st_box("x0", "y0", "x1", "y1"), "g", 0))


def test_zones_read_their_tiles(spark, written):
    meta, tiles = read_raster(spark, written)
    ready = zonal.zones_on_grid(zones(spark), "g", meta, raster_id="a")
    needed = zonal.needed_tiles(tiles, ready)
    rows, plan = scanned(needed.drop("pixels"))
    assert "GreaterThanOrEqual(tile_z" in plan and rows < SIDE * SIDE // TILE**2 / 4
    touched = {(r.tile_x, r.tile_y) for r in zonal.touched_tiles(ready).collect()}
    assert touched <= {(r.tile_x, r.tile_y) for r in needed.collect()}
    args = dict(key="id", raster_id="a", stats="mean min max sum count")
    got, want = (sorted(map(tuple, zonal.zonal_stats(zones(spark), "g", meta, t, **args).drop("g").collect())) for t in (tiles, tiles.drop("tile_z")))
    assert got == want and [r[-1] for r in got] == ["OK", "OK", "OK", "NO_VALID_PIXELS"]


def test_clip_polygon_routes_bad_zones(spark, written):
    meta, tiles = read_raster(spark, written)
    nothing = bytearray(W.write(W.Shape(W.POLYGON, False, False, [])))
    empty = spark.createDataFrame([(5, nothing), (6, None)], "id int, wkb binary").select("id", st_geomfromwkb("wkb", 0).alias("g"))
    every = zones(spark).unionByName(empty)
    clipped, out, bad = clip.clip_polygon(meta, tiles, every, "g", out_id="id", raster_id="a", errors="ROUTE_TO_ERROR")
    assert sorted((r.id, r.error.code, r.error.message) for r in bad.collect()) == [
        ("4", "CLIP", "Clip area does not overlap raster a"), ("5", "CLIP", "Clip geometry is empty"), ("6", "CLIP", "Clip geometry is empty"),
    ]
    assert {r.raster_id for r in clipped.collect()} == {"1", "2", "3"}
    good = every.filter("id <= 3")
    assert pixels_of((clipped, out)) == pixels_of(clip.clip_polygon(meta, tiles.drop("tile_z"), good, "g", out_id="id", raster_id="a"))
    with pytest.raises(Exception, match="does not overlap"):
        clip.clip_polygon(meta, tiles, zones(spark), "g", out_id="id", raster_id="a")[0].collect()
    with pytest.raises(ValueError, match="ROUTE_TO_ERROR"):
        clip.clip_polygon(meta, tiles, good, "g", out_id="id", errors="RETURN_NULL")
