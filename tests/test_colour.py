"""Pixel tests of colour rasters, against sums over the neighbours of each cell."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapweave.operators import colour, rasters, resample
from mapweave.session import configure
from mapweave.sources.raster_store import read_raster, write_raster

W, H = 13, 9


def build(spark, arrays, bands, **more):
    meta = rasters.raster_meta(spark, [dict(raster_id="r", width=W, height=H, origin_x=0, origin_y=H, pixel_x=1, pixel_y=-1, tile_size=4, bands=bands, **more)])
    rows = [("r", b + 1, x, y, float(a[y, x])) for b, a in enumerate(arrays) for y in range(H) for x in range(W)]
    return meta, rasters.tiles_from_pixels(spark.createDataFrame(rows, "raster_id string, band int, x long, y long, v double"), meta)


def planes(meta, tiles):
    """Arrays by band; a missing tile is 0, as for a transparent one."""
    m = meta.first()
    out = np.zeros((len(m["bands"]), m["height"], m["width"]))
    for t in tiles.filter("level = 0").collect():
        block = np.array(t["pixels"]).reshape(t["height"], t["width"])
        out[t["band"] - 1, t["row0"] : t["row0"] + t["height"], t["col0"] : t["col0"] + t["width"]] = block
    return m, out


def halves(colours, opacity, good, full):
    """Cells of 2 x 2 pixels: four equal weights, opacity beside them."""
    h, w = -(-H // 2), -(-W // 2)
    want = np.zeros((len(colours) + 1, h, w))
    # rows count from the top, and the lattice from the bottom
    for r in range(h):
        for c in range(w):
            bottom, left = 2 * (h - 1 - r), 2 * c
            # a centre on the right edge is outside, one on the top edge inside
            if left + 1 >= W:
                continue
            at = [(H - 1 - y, x) for y in (bottom, bottom + 1) if y < H for x in (left, left + 1)]
            weight = [opacity[p] / full * good[p] for p in at]
            for b, a in enumerate(colours):
                if sum(weight) > 0:
                    want[b, r, c] = sum(k * a[p] for k, p in zip(weight, at)) / sum(weight)
            valid = [p for p in at if good[p]]
            if valid:
                want[-1, r, c] = sum(opacity[p] for p in valid) / len(valid)
    return want


@pytest.fixture(scope="module")
def rgb():
    rng = np.random.default_rng(3)
    arrays = rng.integers(0, 3, (3, H, W)).astype(float) * 100
    arrays[:, 2:4, 3:6] = 0
    return arrays


def test_rgb_nodata_needs_all_channels(spark, rgb):
    """One channel at the sentinel is a valid 0; all three are no pixel.  The
    result has an alpha band, keeps its type and has no sentinel."""
    meta, tiles = build(spark, rgb, [dict(data_type="UINT8", nodata=0.0)] * 3, color="RGB")
    m, got = planes(*resample.reproject(meta, tiles, None, 2, 2, interpolation="BILINEAR", output_type="FLOAT64"))
    good = ~(rgb == 0).all(axis=0)
    assert (~good).any() and ((rgb == 0).any(axis=0) & good).any()
    want = halves(rgb, np.full((H, W), 255.0), good, 255.0)
    assert [b["data_type"] for b in m["bands"]] == ["UINT8"] * 4 and [b["alpha"] for b in m["bands"]] == [False] * 3 + [True]
    assert all(b["nodata"] is None for b in m["bands"])
    assert np.array_equal(got[3], want[3])
    assert np.abs(got - want).max() <= 0.5
    none = want[3] == 0
    assert none.any() and (got[:, none] == 0).all()


@pytest.mark.parametrize("nodata", [None, 100.0])
def test_override_of_the_sentinel(spark, rgb, nodata):
    meta, tiles = build(spark, rgb, [dict(data_type="UINT8")] * 3, color="RGB")
    _, got = planes(*resample.reproject(meta, tiles, None, 1, 1, source_nodata=nodata))
    good = np.ones((H, W), bool) if nodata is None else ~(rgb == nodata).all(axis=0)
    assert np.array_equal(got[3] == 255, good) and np.array_equal(got[:3], np.where(good, rgb, 0))


@pytest.mark.parametrize("pre", [False, True])
def test_opacity(spark, rgb, pre):
    """Colours weigh by opacity; premultiplied ones are divided first."""
    rng = np.random.default_rng(4)
    opacity = rng.integers(0, 5, (H, W)) / 4
    stored = rgb / 255 * opacity if pre else rgb / 255
    kinds = [dict(data_type="FLOAT64")] * 3 + [dict(data_type="FLOAT64", alpha=True)]
    meta, tiles = build(spark, [*stored, opacity], kinds, color="RGB", premultiplied=pre)
    m, got = planes(*resample.reproject(meta, tiles, None, 2, 2, interpolation="BILINEAR"))
    want = halves(rgb / 255, opacity, np.ones((H, W), bool), 1.0)
    assert np.allclose(got, want, atol=1e-12) and m["premultiplied"] is False


def test_grey_with_alpha_keeps_two_bands(spark, rgb):
    opacity = np.where(rgb[1] > 0, 65535.0, 0.0)
    kinds = [dict(data_type="UINT16"), dict(data_type="UINT16", alpha=True)]
    m, got = planes(*resample.reproject(*build(spark, [rgb[0], opacity], kinds), None, 1, 1, output_type="FLOAT64"))
    assert [b["data_type"] for b in m["bands"]] == ["UINT16", "UINT16"]
    assert np.array_equal(got[0], np.where(opacity > 0, rgb[0], 0)) and np.array_equal(got[1], opacity)


def test_three_bands_alone_are_measurements(spark, rgb):
    meta, tiles = build(spark, rgb, [dict(data_type="UINT8", nodata=0.0)] * 3)
    m, got = planes(*resample.reproject(meta, tiles, None, 1, 1))
    assert len(m["bands"]) == 3 and [b["nodata"] for b in m["bands"]] == [0.0] * 3 and np.array_equal(got, rgb)


def test_channels_are_checked(spark, rgb):
    meta, tiles = build(spark, rgb[:2], [dict(data_type="UINT8")] * 2, color="RGB")
    with pytest.raises(Exception, match="channels"):
        resample.reproject(meta, tiles, None, 1, 1)[0].collect()


TABLE = [dict(red=i * 257, green=65535 - i * 1000, blue=(i * i * 321) % 65536) for i in range(40)]


@pytest.fixture(scope="module")
def indexes():
    rng = np.random.default_rng(5)
    found = rng.integers(0, 40, (H, W)).astype(float)
    found[rng.random((H, W)) < 0.3] = 255
    return found


def palette_raster(spark, indexes):
    return build(spark, [indexes], [dict(data_type="UINT8", nodata=255.0)], color="PALETTE", palette=TABLE)


def test_palette_expands_for_bilinear(spark, indexes):
    meta, tiles = palette_raster(spark, indexes)
    m, got = planes(*resample.reproject(meta, tiles, None, 2, 2, interpolation="BILINEAR"))
    good = indexes != 255
    at = np.where(good, indexes, 0).astype(int)
    colours = [np.where(good, np.array([c[n] for c in TABLE])[at], 0) for n in ("red", "green", "blue")]
    want = halves(colours, np.where(good, 65535.0, 0.0), np.ones((H, W), bool), 65535.0)
    assert [b["data_type"] for b in m["bands"]] == ["UINT16"] * 4 and m["color"] == "RGB" and m["palette"] is None
    assert np.array_equal(got, np.rint(want))


def test_palette_stays_for_nearest_and_in_the_store(spark, indexes, tmp_path):
    meta, tiles = palette_raster(spark, indexes)
    write_raster(meta, tiles, str(tmp_path / "p"))
    m, got = planes(*resample.reproject(*read_raster(spark, str(tmp_path / "p")), None, 1, 1))
    assert [c.asDict() for c in m["palette"]] == TABLE and m["color"] == "PALETTE"
    assert np.array_equal(got[0], indexes)


def test_palette_errors(spark, indexes):
    meta, tiles = palette_raster(spark, indexes)
    for table, text in ((F.expr("slice(palette, 1, 5)"), "beyond"), (F.lit(None).cast(rasters.PALETTE), "without a colour table")):
        with pytest.raises(Exception, match=text):
            colour.expand_palettes(meta.withColumn("palette", table), tiles)[1].collect()


def test_expansion_stays_in_the_plan(spark, indexes):
    """Lookups are Catalyst expressions; other rasters pass unchanged."""
    meta, tiles = palette_raster(spark, indexes)
    held = spark.createDataFrame(tiles.collect(), rasters.TILE)
    plan = colour.expand_palettes(meta, held)[1]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    plain = meta.withColumn("color", F.lit("NUMERIC"))
    assert sorted(colour.expand_palettes(plain, held)[1].select(*held.columns).collect()) == sorted(held.collect())


def test_many_colours_are_not_broadcast(spark, indexes, monkeypatch):
    monkeypatch.setattr(rasters, "BROADCAST_COLOURS", 39)
    monkeypatch.setattr(rasters, "BROADCAST_RASTERS", 10)
    meta, tiles = palette_raster(spark, indexes)
    held = spark.createDataFrame(tiles.collect(), rasters.TILE)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = colour.expand_palettes(meta, held)[1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan


def test_worker_memory_does_not_follow_the_partition(spark, tmp_path, monkeypatch):
    """Tiles come to a worker in batches of a few MiB, however many a partition holds."""
    kernel, log = resample._share_kernel, str(tmp_path / "sizes")

    def watched(interpolation):
        share = kernel(interpolation)

        def run(batches):
            for batch in batches:
                with open(log, "a") as out:
                    out.write(f"{batch.nbytes}\n")
                yield from share([batch])

        return run

    monkeypatch.setattr(resample, "_share_kernel", watched)
    configure(spark)  # the text operators of other tests set their own limits
    many, size = 400, 32
    grid = dict(width=many * size, height=size, origin_x=0, origin_y=size, pixel_x=1, pixel_y=-1, tile_size=size)
    meta = rasters.raster_meta(spark, [dict(raster_id="r", **grid, bands=[dict(data_type="UINT8", nodata=255.0)], color="PALETTE", palette=TABLE)])
    tiles = spark.range(0, many, 1, 1).selectExpr(
        "'r' AS raster_id", "0 AS level", "1 AS band", "int(id) AS tile_x", "0 AS tile_y", f"id * {size} AS col0", "0L AS row0",
        f"{size} AS width", f"{size} AS height", f"array_repeat(3D, {size * size}) AS pixels",
    )
    out = rasters.pixels_from_tiles(resample.reproject(meta, tiles, None, 2, 2, interpolation="BILINEAR")[1])
    found = out.groupBy("band").agg(F.min("v"), F.max("v"), F.count("v")).sort("band").collect()
    colour3 = [float(TABLE[3][n]) for n in ("red", "green", "blue")]
    assert [tuple(r) for r in found] == [(b + 1, v, v, many * size * size // 4) for b, v in enumerate([*colour3, 65535.0])]
    sizes = [int(n) for n in open(log).read().split()]
    assert sum(sizes) > 25e6 and max(sizes) < 6e6
