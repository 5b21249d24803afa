import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapweave.functions import wkb as W
from mapweave.functions.coverage import Grid, covered, edges_of, tile_cover
from mapweave.functions.crs import transform_xy
from mapweave.functions.geometry import geometry_field, st_box, st_geomfromwkb, st_triangle
from mapweave.operators import clip, overviews, rasters, resample, skew, zonal
from mapweave.sources.raster_store import read_raster, write_raster

WIDTH, HEIGHT = 45, 33
X0, Y1 = 2600000, 1200000 + HEIGHT


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(1)
    byte = rng.integers(0, 200, (HEIGHT, WIDTH)).astype(float)
    byte[rng.random((HEIGHT, WIDTH)) < 0.2] = 255
    return byte, rng.random((HEIGHT, WIDTH)) * 100


@pytest.fixture(scope="module")
def raster(spark, arrays):
    rows = [("r", b + 1, x, y, float(a[y, x])) for b, a in enumerate(arrays) for y in range(HEIGHT) for x in range(WIDTH)]
    pixels = spark.createDataFrame(rows, "raster_id string, band int, x long, y long, v double")
    meta = rasters.raster_meta(
        spark,
        [dict(raster_id="r", width=WIDTH, height=HEIGHT, origin_x=X0, origin_y=Y1, pixel_x=1, pixel_y=-1, srid=2056,
              tile_size=8, bands=[dict(data_type="UINT8", nodata=255.0), dict(data_type="FLOAT64")])],
    )
    return meta, rasters.tiles_from_pixels(pixels, meta).cache()


def dense(meta, tiles, rid, band, level=0):
    m = meta.filter(F.col("raster_id") == rid).first()
    w, h = m["width"], m["height"]
    for _ in range(level):
        w, h = -(-w // 2), -(-h // 2)
    nodata = m["bands"][band - 1]["nodata"]
    out = np.full((h, w), np.nan if nodata is None else nodata)
    rows = tiles.filter((F.col("raster_id") == rid) & (F.col("band") == band) & (F.col("level") == level)).collect()
    for t in rows:
        assert t["tile_x"] == (t["col0"] + m["off_x"] * (level == 0)) // m["tile_size"]
        out[t["row0"] : t["row0"] + t["height"], t["col0"] : t["col0"] + t["width"]] = np.array(t["pixels"]).reshape(t["height"], t["width"])
    return out, m


def brute_cover(edges, xs, ys):
    """Point in polygon, boundary included, in exact arithmetic."""
    from fractions import Fraction

    out = np.zeros((len(ys), len(xs)), bool)
    for i, y in enumerate(map(Fraction, map(float, ys))):
        for j, x in enumerate(map(Fraction, map(float, xs))):
            odd = on = False
            for a, b, c, d in ([Fraction(float(v)) for v in e] for e in edges):
                turn = (c - a) * (y - b) - (d - b) * (x - a)
                on |= turn == 0 and min(a, c) <= x <= max(a, c) and min(b, d) <= y <= max(b, d)
                if (b <= y) != (d <= y):
                    odd ^= a + (y - b) * (c - a) / (d - b) > x
            out[i, j] = on or odd
    return out


def test_cover_equals_brute_force():
    rng = np.random.default_rng(3)
    grid = Grid(0, 8, 1, -1, 9, 8, 3, 1, 2)
    for _ in range(30):
        points = rng.integers(0, 16, (rng.integers(3, 9), 2)) / 2
        edges = edges_of(W.Shape(W.POLYGON, False, False, [np.vstack([points, points[:1]])]))
        want = brute_cover(edges, grid.xs(0, 9), grid.ys(0, 8))
        assert (covered(edges, grid.xs(0, 9), grid.ys(0, 8)) == want).all()
        mask = np.zeros((8, 9), bool)
        for tx, ty, part, _ in tile_cover(edges, grid):
            c0, c1, r0, r1 = max(0, tx * 3 - 1), min(9, tx * 3 + 2), max(0, ty * 3 - 2), min(8, ty * 3 + 1)
            inside = True if part is None else covered(part, grid.xs(c0, c1 - c0), grid.ys(r0, r1 - r0))
            mask[r0:r1, c0:c1] = inside
        assert (mask == want).all()


def test_near_edge_is_exact():
    """Centres one rounding step from a slanted edge."""
    edges = np.array([[0.1, 0.1, 0.7, 0.7], [0.7, 0.7, 0.7, 0.1], [0.7, 0.1, 0.1, 0.1]])
    xs = np.array([0.3, np.nextafter(0.3, 0), np.nextafter(0.3, 1)])
    xs.sort()
    assert (covered(edges, xs, np.array([0.3])) == brute_cover(edges, xs, np.array([0.3]))).all()


def test_pixels_round_trip(raster, arrays):
    for band in (1, 2):
        assert (dense(*raster, "r", band)[0] == arrays[band - 1]).all()


def test_info(raster):
    row = rasters.raster_info(raster[0], "bands width", "m_").first()
    bands = json.loads(row["m_bands"])
    assert row["m_width"] == WIDTH and bands[0]["noData"] == 255.0 and bands[1]["noData"] is None
    with pytest.raises(ValueError, match="Unknown"):
        rasters.raster_info(raster[0], "depth")
    with pytest.raises(ValueError, match="exists"):
        rasters.raster_info(raster[0], "width", "")


def test_info_writes_special_numbers_as_text(spark):
    meta = rasters.raster_meta(spark, [dict(raster_id="r", width=1, height=1, origin_x=0, origin_y=0, pixel_x=1, pixel_y=1, bands=[dict(nodata=math.nan)])])
    assert json.loads(rasters.raster_info(meta).first()["raster_bands"])[0]["noData"] == "NaN"


def test_clip_box_then_overviews(raster, arrays):
    meta, tiles = clip.clip_box(*raster, X0 + 3.5, 1200002, X0 + 30, 1200020.2)
    out, m = dense(meta, tiles, "r", 1)
    assert (out == arrays[0][12:31, 3:30]).all() and (m["off_x"], m["off_y"], m["steps"]) == (3, 4, ["clip box"])
    pyramid = overviews.build_overviews(meta, tiles, "AVERAGE", limit=4)
    nearest = overviews.build_overviews(meta, tiles, "NEAREST", limit=4)
    for band, nodata, integer in ((1, 255.0, True), (2, None, False)):
        level = dense(meta, tiles, "r", band)[0]
        sample = level
        for k in (1, 2, 3):
            h, w = level.shape
            nxt = np.full((-(-h // 2), -(-w // 2)), np.nan if nodata is None else nodata)
            for i, j in np.ndindex(nxt.shape):
                q = level[2 * i : 2 * i + 2, 2 * j : 2 * j + 2].ravel()
                q = q[np.isfinite(q) & (q != nodata)]
                if len(q):
                    nxt[i, j] = np.rint(q.mean()) if integer else q.mean()
            level, sample = nxt, sample[::2, ::2]
            np.testing.assert_allclose(dense(meta, pyramid, "r", band, k)[0], level, rtol=1e-12)
            assert (dense(meta, nearest, "r", band, k)[0] == sample).all()


def test_odd_sizes_round_up():
    assert overviews.overview_levels(777, 665) == 1 and overviews.overview_levels(512, 512) == 0
    assert overviews.halve(np.zeros((665, 777)), None, "AVERAGE", False, math.nan).shape == (333, 389)


def test_disjoint_or_wrong_boxes_fail(raster):
    for box in ((0, 0, 1, 1), (X0 + 5, 1200001, X0 + 4, 1200002)):
        with pytest.raises(Exception, match="overlap|minimum"):
            clip.clip_box(*raster, *box)[0].collect()


def test_clip_polygon(spark, raster, arrays):
    corners = {"a": (2.0, 1.0, 20.0, 30.0), "b": (30.5, 3.0, 44.0, 9.5)}
    rows = [(k, *(float(v + o) for v, o in zip(c, (X0, 1200000, X0, 1200000)))) for k, c in corners.items()]
    zones = spark.createDataFrame(rows, "id string, x0 double, y0 double, x1 double, y1 double").select(
        "id", geometry_field(st_triangle("x0", "y0", "x1", "y0", "x0", "y1", 2056), "g", 2056)
    )
    meta, tiles = clip.clip_polygon(*raster, zones, "g", out_id="id", raster_id="r")
    for rid, (x0, y0, x1, y1) in corners.items():
        edges = np.array([[x0, y0, x1, y0], [x1, y0, x0, y1], [x0, y1, x0, y0]])
        mask = covered(edges, np.arange(WIDTH) + 0.5, HEIGHT - (np.arange(HEIGHT) + 0.5))
        rows_, cols = slice(math.floor(HEIGHT - y1), math.ceil(HEIGHT - y0)), slice(math.floor(x0), math.ceil(x1))
        assert (dense(meta, tiles, rid, 1)[0] == np.where(mask, arrays[0], 255)[rows_, cols]).all()


def test_clip_needs_a_sentinel(spark):
    meta = rasters.raster_meta(spark, [dict(raster_id="r", width=4, height=4, origin_x=0, origin_y=4, pixel_x=1, pixel_y=-1, tile_size=4, bands=[dict(data_type="UINT8")])])
    tiles = rasters.tiles_from_pixels(spark.createDataFrame([("r", 1, 0, 0, 1.0)], "raster_id string, band int, x long, y long, v double"), meta)
    zone = spark.range(1).select("id", st_box(F.lit(0), F.lit(0), F.lit(2), F.lit(2)).alias("g"))
    with pytest.raises(Exception, match="NoData"):
        clip.clip_polygon(meta, tiles, zone, "g", out_id="id", raster_id="r")[0].collect()
    assert clip.clip_polygon(meta, tiles, zone, "g", out_id="id", raster_id="r", nodata=0)[0].count() == 1


def brute_resample(array, nodata, u, v, mode, fill):
    out = np.full(u.shape, fill)
    for i, j in np.ndindex(u.shape):
        a, b = u[i, j], v[i, j]
        if not (0 <= a < WIDTH and 0 <= b < HEIGHT):
            continue
        if mode == "NEAREST":
            if array[int(b), int(a)] != nodata:
                out[i, j] = array[int(b), int(a)]
            continue
        c, r = math.floor(a - 0.5), math.floor(b - 0.5)
        total = weight = 0.0
        for dc, wc in ((0, 1 - (a - 0.5 - c)), (1, a - 0.5 - c)):
            for dr, wr in ((0, 1 - (b - 0.5 - r)), (1, b - 0.5 - r)):
                if 0 <= c + dc < WIDTH and 0 <= r + dr < HEIGHT and array[r + dr, c + dc] != nodata:
                    total, weight = total + wc * wr * array[r + dr, c + dc], weight + wc * wr
        if weight > 0:
            out[i, j] = total / weight
    return out


@pytest.mark.parametrize("mode, fill", [("NEAREST", 250.0), ("BILINEAR", -1.0)])
@pytest.mark.parametrize("crs, size", [(None, 1.7), ("EPSG:21781", 0.6), ("4326", 0.00002)])
def test_reproject(raster, arrays, mode, fill, crs, size):
    meta, tiles = resample.reproject(*raster, crs, size, size, interpolation=mode, output_nodata=fill)
    out, m = dense(meta, tiles, "r", 1)
    cols, rows = np.meshgrid(np.arange(m["width"]), np.arange(m["height"]))
    x, y = m["origin_x"] + (cols + 0.5) * m["pixel_x"], m["origin_y"] + (rows + 0.5) * m["pixel_y"]
    if m["srid"] != 2056:
        x, y = transform_xy(x, y, m["srid"], 2056)
    want = brute_resample(arrays[0], 255, x - X0, Y1 - y, mode, fill)
    np.testing.assert_allclose(out, want, rtol=1e-9, atol=1e-9)
    assert m["bands"][0]["data_type"] == ("UINT8" if mode == "NEAREST" else "FLOAT64")
    assert abs(m["origin_x"] / size - round(m["origin_x"] / size)) < 1e-4


def test_reproject_rules(raster):
    with pytest.raises(Exception, match="fit"):
        resample.reproject(*raster, None, 2, 2, output_nodata=300)[0].collect()
    with pytest.raises(Exception, match="overlap"):
        resample.reproject(*raster, None, 2, 2, extent=(0, 0, 1, 1))[0].collect()
    with pytest.raises(Exception, match="positive"):
        resample.reproject(*raster, None, -1, 2)[0].collect()
    with pytest.raises(ValueError, match="overflows"):
        resample.finish(np.array([300.0]), np.array([1.0]), "UINT8", 255.0)
    with pytest.raises(ValueError, match="equals"):
        resample.finish(np.array([255.0]), np.array([1.0]), "UINT8", 255.0)
    assert list(resample.finish(np.array([0.5, 1.5]), np.array([1.0, 1.0]), "UINT8", 255.0)) == [0, 2]


def test_extent_is_kept_whole(raster):
    meta, _ = resample.reproject(*raster, None, 1, 1, extent=(X0 - 10, 1200000, X0 + 5, 1200010))
    m = meta.first()
    assert (m["width"], m["height"], m["origin_x"]) == (15, 10, X0 - 10)


def test_bands_and_store(raster, arrays, tmp_path):
    meta, tiles = rasters.select_bands(*raster, "2; 1,2")
    assert (dense(meta, tiles, "r", 1)[0] == arrays[1]).all() and (dense(meta, tiles, "r", 2)[0] == arrays[0]).all()
    path = str(tmp_path / "r")
    status = write_raster(meta, tiles, path, overviews="AUTO").first()
    assert (status["raster_status"], status["raster_output_file"]) == ("OK", path)
    back = read_raster(meta.sparkSession, path)
    assert (dense(*back, "r", 1)[0] == arrays[1]).all()
    with pytest.raises(Exception):
        write_raster(meta, tiles, path)


def zone_stats(array, mask):
    v = array[mask]
    return (len(v), v.mean(), v.std(), v.min(), v.max(), v.sum())


def test_zonal_large_hollow_zone(spark, raster, arrays):
    """A multipolygon with a hole over many tiles, its tiles mostly whole."""
    outer = [(1, 1), (44, 1), (44, 32), (1, 32), (1, 1)]
    hole = [(10.5, 10.5), (20.5, 10.5), (20.5, 20.5), (10.5, 20.5), (10.5, 10.5)]
    shape = W.Shape(W.MULTIPOLYGON, False, False, [W.Shape(W.POLYGON, False, False, [np.array(r) + (X0, 1200000) for r in (outer, hole)])])
    rows = [(1, bytearray(W.write(shape))), (2, None), (3, bytearray(W.write(W.Shape(W.POLYGON, False, False, []))))]
    zones = spark.createDataFrame(rows, "id int, wkb binary").select("id", st_geomfromwkb("wkb", 2056).alias("g"))
    out = zonal.zonal_stats(zones, "g", *raster, key="id", raster_id="r", band=2, stats="mean stddev min max sum")
    got = {r["id"]: r for r in out.collect()}
    mask = brute_cover(edges_of(shape), X0 + np.arange(WIDTH) + 0.5, Y1 - (np.arange(HEIGHT) + 0.5))
    n, mean, std, low, high, total = zone_stats(arrays[1], mask)
    r = got[1]
    assert (r["raster_count"], r["raster_min"], r["raster_max"]) == (n, low, high)
    np.testing.assert_allclose([r["raster_mean"], r["raster_stddev"], r["raster_sum"]], [mean, std, total], rtol=1e-12)
    assert got[2]["raster_status"] == got[3]["raster_status"] == "EMPTY_GEOMETRY" and got[2]["raster_count"] == 0


def test_zonal_in_another_crs(spark, raster):
    zones = spark.range(1).select("id", st_box(F.lit(600001.0), F.lit(200001.0), F.lit(600010.0), F.lit(200010.0), 21781).alias("g"))
    same = spark.range(1).select("id", st_box(F.lit(2600001.0), F.lit(1200001.0), F.lit(2600010.0), F.lit(1200010.0), 2056).alias("g"))
    rows = [zonal.zonal_stats(z, "g", *raster, key="id", raster_id="r", band=2).drop("g").first() for z in (zones, same)]
    assert rows[0] == rows[1] and rows[0]["raster_count"] == 81


def test_zonal_with_a_hot_tile(spark, raster, arrays, monkeypatch):
    """One tile holds almost all zones: packs are split and the result stays."""
    monkeypatch.setattr(zonal, "ZONES_PER_PACK", 5)
    zones = spark.range(200).select("id", st_box(F.lit(X0 + 1.0), F.lit(1200001.0), X0 + 2.0 + F.col("id") % 5, F.lit(1200006.0), 2056).alias("g"))
    out = zonal.zonal_stats(zones, "g", *raster, key="id", raster_id="r", band=2)
    got = {r["id"]: r["raster_count"] for r in out.collect()}
    assert got == {i: 5 * (1 + i % 5) for i in range(200)}


def test_zonal_many_rasters(spark, raster):
    meta, tiles = raster
    both = meta.unionByName(meta.withColumn("raster_id", F.lit("s")).withColumn("origin_x", F.lit(0.0)))
    copies = tiles.unionByName(tiles.withColumn("raster_id", F.lit("s")))
    rows = [(1, "r", float(X0)), (2, "s", 0.0), (3, "s", float(X0))]
    zones = spark.createDataFrame(rows, "id int, raster_id string, x double").select(
        "id", "raster_id", st_box("x", F.lit(1200000.0), F.col("x") + 10, F.lit(1200010.0), 2056).alias("g")
    )
    got = {r["id"]: r for r in zonal.zonal_stats(zones, "g", both, copies, key="id", band=2).collect()}
    assert got[1]["raster_mean"] == got[2]["raster_mean"] and got[3]["raster_status"] == "NO_VALID_PIXELS"
    with pytest.raises(Exception, match="Missing raster"):
        zonal.zonal_stats(zones.withColumn("raster_id", F.lit("x")), "g", both, copies, key="id").collect()


def test_zonal_settings(spark, raster):
    zones = spark.range(1).select("id", st_box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0), 2056).alias("g"), F.lit(1).alias("raster_count"))
    with pytest.raises(ValueError, match="exists"):
        zonal.zonal_stats(zones, "g", *raster, key="id", raster_id="r")
    with pytest.raises(ValueError, match="Unknown"):
        zonal.zonal_stats(zones, "g", *raster, key="id", raster_id="r", stats="median")
    with pytest.raises(Exception, match="Band 3"):
        zonal.zonal_stats(zones.drop("raster_count"), "g", *raster, key="id", raster_id="r", band=3).collect()
    names = zonal.zonal_stats(zones, "g", *raster, key="id", raster_id="r", stats="max,mean", prefix="h_").columns
    assert names[3:] == ["h_max", "h_mean", "h_count", "h_status"]


def test_merge_in_buckets(spark):
    """Zones of more than 1024 tiles are merged through square-root buckets."""
    rng = np.random.default_rng(0)
    parts = [rng.random(int(rng.integers(1, 4))) * 1e6 + 1e9 for _ in range(3000)]
    rows = [(1, i, *zonal.moments(p)) for i, p in enumerate(parts)]
    df = spark.createDataFrame(rows, "id int, tile_no long, n long, mean double, m2 double, sum double, min double, max double")
    r = zonal.merge_partials(df, ["id"]).first()
    values = np.concatenate(parts)
    np.testing.assert_allclose([r["mean"], math.sqrt(r["m2"] / r["n"])], [values.mean(), values.std()], rtol=1e-12)
    assert r["n"] == len(values) and r["max"] == values.max()


def test_hot_keys_beyond_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_KEYS", 1)
    rows = spark.range(100).select((F.col("id") % 4).alias("k"), "id")
    hot = skew.HotKeys(rows, ["k"], 10)
    left, right = hot.spread(rows, "id"), hot.replicate(spark.range(4).withColumnRenamed("id", "k"))
    assert left.join(right, ["k", "_part"]).count() == 100 and left.select("_part").distinct().count() == 3


def test_zonal_plan_reads_few_columns(raster):
    meta, _ = raster
    plan = rasters.raster_info(meta, "width")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_alpha_weighted_colours(spark):
    """A transparent black pixel beside an opaque one leaves no dark fringe."""
    meta = rasters.raster_meta(spark, [dict(raster_id="r", width=2, height=1, origin_x=0, origin_y=1, pixel_x=1, pixel_y=-1, tile_size=2,
                                            color="RGB", bands=[dict(data_type="UINT8"), dict(data_type="UINT8", alpha=True)])])
    rows = [("r", 1, 0, 0, 200.0), ("r", 1, 1, 0, 0.0), ("r", 2, 0, 0, 255.0), ("r", 2, 1, 0, 0.0)]
    tiles = rasters.tiles_from_pixels(spark.createDataFrame(rows, "raster_id string, band int, x long, y long, v double"), meta)
    out_meta, out = resample.reproject(meta, tiles, None, 2, 1, interpolation="BILINEAR", output_nodata=-1)
    # colours keep their type: 127.5 is rounded to even
    assert dense(out_meta, out, "r", 1)[0].tolist() == [[200.0]] and dense(out_meta, out, "r", 2)[0].tolist() == [[128.0]]
    palette = meta.withColumn("color", F.lit("PALETTE"))
    with pytest.raises(Exception, match="colour table"):
        resample.reproject(palette, tiles, None, 2, 1, interpolation="BILINEAR")[0].collect()
