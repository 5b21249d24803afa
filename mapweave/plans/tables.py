"""Inputs of the registered queries, derived by Spark from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import geometry_field, st_box, st_point, st_triangle
from ..operators.rasters import raster_meta, tiles_from_pixels

RASTER = "orders"
TILE = 32
NODATA = -9999.0


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan with too few splits for the cores, spread over them.

    For inputs of Python kernels: a table of one small file would leave all
    but one core idle.  A scan with enough splits is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def pixels(spark, folder) -> DataFrame:
    """One pixel per order: x, y, v; a pending order is NoData."""
    return table(spark, folder, "orders").select(
        F.lit(RASTER).alias("raster_id"),
        F.lit(1).alias("band"),
        (F.col("o_orderkey") % 100).alias("x"),
        F.expr("o_orderkey div 100").alias("y"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v"),
    )


def raster(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Raster tables of the order pixels, y upward, 32 x 32 tiles."""
    (last,) = table(spark, folder, "orders").agg(F.max("o_orderkey")).first()
    meta = raster_meta(
        spark,
        [
            dict(
                raster_id=RASTER, path="orders.parquet", width=100, height=last // 100 + 1,
                origin_x=0, origin_y=0, pixel_x=1, pixel_y=1, crs="LOCAL", tile_size=TILE,
                bands=[dict(name="price", nodata=NODATA)],
            )
        ],
    )
    return meta, tiles_from_pixels(pixels(spark, folder), meta, RASTER)


def palette(spark, folder) -> tuple[DataFrame, DataFrame]:
    """The same pixels as indexes of a palette of 16 colours."""
    (last,) = table(spark, folder, "orders").agg(F.max("o_orderkey")).first()
    colours = [dict(red=i * 4000, green=60000 - i * 3000, blue=i * i * 250) for i in range(16)]
    grid = dict(width=100, height=last // 100 + 1, origin_x=0, origin_y=0, pixel_x=1, pixel_y=1, crs="LOCAL", tile_size=TILE)
    meta = raster_meta(spark, [dict(raster_id=RASTER, **grid, color="PALETTE", palette=colours, bands=[dict(data_type="UINT8", nodata=255.0)])])
    index = F.when(F.col("v").isNotNull(), (F.floor("v") % 16).cast("double")).alias("v")
    return meta, tiles_from_pixels(pixels(spark, folder).select("raster_id", "band", "x", "y", index), meta, RASTER)


def zone_corners(spark, folder, shift: float = 0.0) -> DataFrame:
    """id, x0, y0, x1, y1: one rectangle per customer, some far outside."""
    k = F.col("c_custkey")
    return (
        spread(table(spark, folder, "customer").select("c_custkey"))
        .select(
            k.alias("id"),
            ((k * 7) % 100 + F.lit(shift)).cast("double").alias("x0"),
            F.expr("c_custkey div 10 + if(c_custkey % 50 = 0, 1000000, 0)").cast("double").alias("y0"),
        )
        .select(
            "id", "x0", "y0",
            (F.col("x0") + 1 + F.col("id") % 9).alias("x1"),
            (F.col("y0") + 1 + F.col("id") % 6).alias("y1"),
        )
    )


def zones(spark, folder, shift: float = 0.0) -> DataFrame:
    return zone_corners(spark, folder, shift).select(
        "id", geometry_field(st_box("x0", "y0", "x1", "y1"), "geometry", 0)
    )


def triangles(spark, folder) -> DataFrame:
    return zone_corners(spark, folder).select(
        "id", geometry_field(st_triangle("x0", "y0", "x1", "y0", "x0", "y1"), "geometry", 0)
    )


def points(spark, folder) -> DataFrame:
    """id, x, y, c_mktsegment, c_acctbal and a geometry in 2056."""
    return (
        table(spark, folder, "customer")
        .select(
            F.col("c_custkey").alias("id"),
            (2600000 + F.col("c_custkey") % 1000).cast("double").alias("x"),
            (1200000 + (F.col("c_custkey") * 37) % 1000).cast("double").alias("y"),
            "c_mktsegment",
            "c_acctbal",
        )
        .select("*", geometry_field(st_point("x", "y", 2056), "geometry", 2056))
    )
