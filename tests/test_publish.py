"""Writers publish whole results: a failing overwrite leaves the old data."""

import os

import pytest
from pyspark.sql import functions as F

from mapweave.functions.geometry import st_point
from mapweave.operators.rasters import raster_meta, tiles_from_pixels
from mapweave.operators.vector import GeometrySchema
from mapweave.sources import generate, geojson
from mapweave.sources.raster_store import read_raster, write_raster
from mapweave.sources.spatial_parquet import read_spatial_parquet, write_spatial_parquet


def layer(spark, n):
    return spark.range(n).select(F.col("id"), st_point(F.col("id"), F.lit(1), 4326).alias("geometry"))


def broken(spark):
    stop = F.when(F.col("id") == 7, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id"))
    return spark.range(9).select(stop.alias("id"), st_point(stop, F.lit(1), 4326).alias("geometry"))


def raster(spark, n, df=None):
    meta = raster_meta(spark, [dict(raster_id="r", path="p", width=40, height=n, origin_x=0, origin_y=0, pixel_x=1, pixel_y=1, crs="LOCAL", tile_size=8, bands=[dict(name="b", nodata=-9.0)])])
    cells = spark.range(40 * n) if df is None else df
    pixels = cells.select(F.lit("r").alias("raster_id"), F.lit(1).alias("band"), (F.col("id") % 40).alias("x"), F.expr("id div 40").alias("y"), F.col("id").cast("double").alias("v"))
    return meta, tiles_from_pixels(pixels, meta, "r")


def text_rows(spark, path):
    return spark.read.text(path).filter("value LIKE '%1%'").count()


WRITERS = {
    "text": (
        lambda spark, df, path, again: generate.write_generate(df, path, "geometry", generate.GenerateOptions(), again, id_field="id"),
        text_rows,
    ),
    "lines": (lambda spark, df, path, again: geojson.write_geojson(df.select("geometry"), path, overwrite=again, layout="LINES"), text_rows),
    "collection": (lambda spark, df, path, again: geojson.write_geojson(df.select("geometry"), path, overwrite=again), text_rows),
    "parquet": (
        lambda spark, df, path, again: write_spatial_parquet(df, path, "geometry", GeometrySchema("POINT", srid=4326), overwrite=again),
        lambda spark, path: read_spatial_parquet(spark, path, "geometry").count(),
    ),
}


@pytest.mark.parametrize("name", sorted(WRITERS))
def test_failed_overwrite(spark, tmp_path, name):
    write, count = WRITERS[name]
    path = str(tmp_path / "out")
    write(spark, layer(spark, 5), path, False)
    assert count(spark, path) == 5
    with pytest.raises(Exception, match="broken row"):
        write(spark, broken(spark), path, True)
    with pytest.raises(FileExistsError):
        write(spark, layer(spark, 3), path, False)
    assert count(spark, path) == 5
    write(spark, layer(spark, 3), path, True)
    assert count(spark, path) == 3
    assert [p for p in os.listdir(tmp_path) if not p.endswith(".crc")] == ["out"]


def test_failed_first_write_can_be_repeated(spark, tmp_path):
    write, count = WRITERS["parquet"]
    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="broken row"):
        write(spark, broken(spark), path, False)
    assert os.listdir(tmp_path) == []
    write(spark, layer(spark, 4), path, False)
    assert count(spark, path) == 4


def test_raster_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    write_raster(*raster(spark, 20), path, overviews="AUTO")
    old = [sorted(map(repr, df.collect())) for df in read_raster(spark, path)]
    stop = spark.range(40 * 30).select(F.when(F.col("id") == 900, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken row"):
        write_raster(*raster(spark, 30, stop), path, overwrite=True)
    assert [sorted(map(repr, df.collect())) for df in read_raster(spark, path)] == old
    write_raster(*raster(spark, 30), path, overwrite=True)
    meta, tiles = read_raster(spark, path)
    assert meta.first()["height"] == 30 and tiles.filter("level = 0").count() == 20
    # tiles lie in the order of their numbers
    files = spark.read.parquet(f"{path}/tiles").select(F.input_file_name().alias("f"), "tile_y").groupBy("f").agg(F.min("tile_y").alias("a"), F.max("tile_y").alias("b")).orderBy("a").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(files, files[1:]))
