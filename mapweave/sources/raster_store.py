"""Raster tables on disk: metadata and tiles as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.overviews import build_overviews
from ..operators.rasters import META, TILE
from ..operators.tile_order import morton
from .publish import published


#: bytes of a row group: some tiles of 512 x 512 doubles
ROW_GROUP = 16 * 1024 * 1024


def write_raster(
    meta: DataFrame,
    tiles: DataFrame,
    path: str,
    overwrite: bool = False,
    overviews: str = "NONE",
    resampling: str = "AVERAGE",
    compression: str = "zstd",
    prefix: str = "raster_",
    row_group: int = ROW_GROUP,
) -> DataFrame:
    """Write derived rasters and return one status row per raster.

    Tiles are partitioned by raster and level and lie in Morton order, in row
    groups of about ``row_group`` bytes, so that a reader of a window skips all
    but the row groups around it.  ``overviews`` is NONE or AUTO.  Tiles, overviews and metadata are published together; without
    ``overwrite`` an existing target fails.
    """
    if overviews not in ("NONE", "AUTO"):
        raise ValueError("Overviews must be AUTO or NONE")
    spark = meta.sparkSession

    def write(rows: DataFrame, folder: str) -> None:
        order = ("raster_id", "level", "tile_z", "band")
        numbered = rows.select(*[f.name for f in TILE], morton(F.col("tile_x"), F.col("tile_y")).alias("tile_z"))
        dealt = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
        # tiles are large rows: the size of a row group is checked at every few
        groups = {"compression": compression, "parquet.block.size": row_group, "parquet.block.size.row.check.min": 4}
        dealt.write.mode("append").options(**groups).partitionBy("raster_id", "level").parquet(f"{folder}/tiles")

    with published(spark, path, overwrite) as folder:
        write(tiles.filter(F.col("level") == 0), folder)
        if overviews == "AUTO":
            # The pyramid reads the written tiles, not the operations before them.
            written = spark.read.schema(TILE).parquet(f"{folder}/tiles")
            write(build_overviews(meta, written, resampling), folder)
        meta.select(*[f.name for f in META]).write.parquet(f"{folder}/meta")
    status = {prefix + "output_file": F.lit(path), prefix + "status": F.lit("OK")}
    written_meta = meta.sparkSession.read.schema(META).parquet(f"{path}/meta")
    return written_meta.select("raster_id", *[c.alias(n) for n, c in status.items()])


def read_raster(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(metadata, tiles) of a written raster table.

    Tiles have their Morton number ``tile_z`` in a further column, by which
    clips, zonal statistics and resampling read only the tiles they need; tables
    written without it are read whole.
    """
    meta = spark.read.schema(META).parquet(f"{path}/meta")
    numbered = "tile_z" in spark.read.parquet(f"{path}/tiles").columns
    tiles = spark.read.schema(T.StructType([*TILE, T.StructField("tile_z", T.LongType())]) if numbered else TILE).parquet(f"{path}/tiles")
    return meta, tiles
