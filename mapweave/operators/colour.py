"""Colour rasters: palettes, opacity and NoData over all channels.

A raster is colour if its interpretation is RGB, or if it is one grey band with
an alpha band.  Three bands alone are measurements.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rasters import BAND, INTEGER_RANGES, PALETTE, TILE, arrow_type, join_meta, pixel_blocks, pixel_lists, valid

#: the highest value of a 16-bit channel
FULL16 = 65535

#: a tile with the weight of each pixel
WEIGHTED = T.StructType([*TILE, T.StructField("alpha", T.ArrayType(T.DoubleType()))])

CHANNELS = ("red", "green", "blue", "alpha")


def alpha_number() -> Column:
    """The 1-based number of the alpha band, NULL without one."""
    return F.get(F.filter(F.sequence(F.lit(1), F.size("bands")), lambda i: F.coalesce(F.element_at("bands", i)["alpha"], F.lit(False))), F.lit(0))


def is_colour() -> Column:
    return (F.col("color") == "RGB") | (alpha_number().isNotNull() & (F.coalesce("color", F.lit("")) != "PALETTE"))


def has_colour(meta: DataFrame) -> bool:
    return meta.filter(is_colour()).limit(1).count() > 0


def has_palettes(meta: DataFrame) -> bool:
    return meta.filter(F.col("color") == "PALETTE").limit(1).count() > 0


def _band(name: str, data_type, alpha: bool) -> Column:
    fields = dict(name=F.lit(name), data_type=data_type, nodata=F.lit(None).cast("double"), scale=F.lit(1.0), offset=F.lit(0.0), alpha=F.lit(alpha))
    return F.struct(*[fields[f.name].cast(f.dataType).alias(f.name) for f in BAND])


def expand_palettes(meta: DataFrame, tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Palette rasters as RGBA with 16 bits a channel; the others unchanged.

    An index that is NoData becomes a transparent pixel.  An index beyond the
    table, a palette raster without a table or with several bands is an error.
    Stays in Catalyst: one lookup per pixel and channel.
    """
    palette = F.col("color") == "PALETTE"
    wrong = F.when(F.coalesce(F.size("palette"), F.lit(0)) <= 0, "Palette raster without a colour table").when(F.size("bands") != 1, "Palette raster with several bands")
    rgba = F.array(*[_band(name, F.lit("UINT16"), name == "alpha") for name in CHANNELS])
    bands = F.when(palette & wrong.isNotNull(), F.raise_error(wrong).cast(T.ArrayType(BAND))).when(palette, rgba).otherwise(F.col("bands"))
    new_meta = meta.withColumns(
        {
            "bands": bands,
            "palette": F.when(~palette, F.col("palette")).cast(PALETTE),
            "premultiplied": ~palette & F.coalesce("premultiplied", F.lit(False)),
            "color": F.when(palette, "RGB").otherwise(F.col("color")),
        }
    )
    table = F.when(palette & wrong.isNotNull(), F.raise_error(wrong).cast(PALETTE)).when(palette, F.col("palette"))
    rows = join_meta(tiles, meta, {"palette": table, "_nodata": F.element_at("bands", 1)["nodata"]})
    rows = rows.withColumn("_to", F.explode(F.when(F.col("palette").isNotNull(), F.array(*[F.lit(i) for i in (1, 2, 3, 4)])).otherwise(F.array("band"))))
    channel = F.when(F.col("_to") == 1, F.transform("palette", lambda c: c["red"])).when(F.col("_to") == 2, F.transform("palette", lambda c: c["green"])).otherwise(F.transform("palette", lambda c: c["blue"]))
    rows = rows.withColumn("_channel", F.when(F.col("palette").isNotNull() & (F.col("_to") < 4), channel))

    def looked_up(p: Column) -> Column:
        found = F.when((p >= 0) & (p == F.floor(p)), F.get("_channel", p.cast("int")))
        beyond = F.raise_error(F.concat(F.lit("Index beyond the colour table: "), p.cast("string"))).cast("double")
        return F.when(~valid(p, F.col("_nodata")), 0.0).otherwise(F.coalesce(found.cast("double"), beyond))

    opaque = F.transform("pixels", lambda p: F.when(valid(p, F.col("_nodata")), float(FULL16)).otherwise(0.0))
    pixels = F.when(F.col("palette").isNull(), F.col("pixels")).when(F.col("_to") == 4, opaque).otherwise(F.transform("pixels", looked_up))
    return new_meta, rows.withColumn("band", F.col("_to")).withColumn("pixels", pixels).drop("palette", "_nodata", "_to", "_channel")


def with_alpha_band(meta: DataFrame) -> DataFrame:
    """``meta`` of the result: RGB gets an alpha band if it has none, colour
    bands have no sentinel (opacity tells what is valid), and the alpha is not
    multiplied into the colours.  Other numbers of channels are an error."""
    colours = F.size("bands") - F.when(alpha_number().isNotNull(), 1).otherwise(0)
    good = (colours == 3) & (F.col("color") == "RGB") | (colours == 1) & alpha_number().isNotNull()
    plain = F.transform("bands", lambda b: b.withField("nodata", F.lit(None).cast("double")))
    full = F.when(alpha_number().isNull(), F.concat(plain, F.array(_band("alpha", F.element_at("bands", 1)["data_type"], True)))).otherwise(plain)
    checked = F.when(~good, F.raise_error(F.lit("Unsupported colour channels")).cast(T.ArrayType(BAND))).otherwise(full)
    colour = is_colour()
    return meta.withColumns(
        {
            "bands": F.when(colour, checked).otherwise(F.col("bands")),
            "premultiplied": ~colour & F.coalesce("premultiplied", F.lit(False)),
        }
    )


def weighted_tiles(meta: DataFrame, tiles: DataFrame, source_nodata: float | None = None) -> DataFrame:
    """Base tiles with ``alpha``, the weight of each pixel (NULL: no colour).

    The bands of a colour tile meet once (four rows at most) and leave as one
    row per band: colours weigh by their opacity, so a transparent pixel gives
    nothing to its neighbours; the alpha samples weigh alike.  A pixel whose
    colour channels all equal their sentinel, or with a channel that is not
    finite, weighs nothing in any band; one channel at the sentinel is valid.
    Premultiplied colours are divided by their opacity.
    """
    key = ["raster_id", "level", "tile_x", "tile_y", "col0", "row0", "width", "height"]
    sentinel = F.transform("bands", lambda b: b["nodata"] if source_nodata is None else F.lit(float(source_nodata)))
    context = {
        "_type": F.element_at("bands", 1)["data_type"], "_number": F.coalesce(alpha_number(), F.lit(0)), "_bands": F.size("bands"),
        "_sentinel": sentinel, "_pre": F.coalesce("premultiplied", F.lit(False)),
    }
    rows = join_meta(tiles.filter("level = 0").select(*[f.name for f in TILE]), meta, {"_colour": F.coalesce(is_colour(), F.lit(False)), **context})
    stacked = rows.filter("_colour").groupBy(*key).agg(F.collect_list(F.struct("band", "pixels")).alias("planes"), *[F.first(c).alias(c) for c in context])
    schema, names = arrow_type(WEIGHTED), key + list(context)

    def run(batches):
        for batch in batches:
            infos = batch.select(names).to_pylist()
            for info, planes in zip(infos, batch.column("planes"), strict=True):
                blocks = pixel_blocks(pa.RecordBatch.from_arrays([planes.values.field("pixels")], names=["pixels"]))
                found = _weighted(info, dict(zip(planes.values.field("band").to_pylist(), blocks, strict=True)))
                columns = [pa.array([info[k] if k != "band" else b for b, _, _ in found], schema.field(k).type) for k in schema.names[:-2]]
                data = [pixel_lists([part[i] for part in found]).cast(schema.field(k).type) for i, k in ((1, "pixels"), (2, "alpha"))]
                yield pa.RecordBatch.from_arrays([*columns, *data], schema=schema)

    result = stacked.mapInArrow(run, WEIGHTED)
    if meta.filter(~F.coalesce(is_colour(), F.lit(False))).limit(1).count():
        others = rows.filter("NOT _colour").select(*[f.name for f in TILE], F.lit(None).cast("array<double>").alias("alpha"))
        result = result.unionByName(others)
    return result


def _weighted(info: dict, planes: dict[int, np.ndarray]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(band, pixels, weights) of a tile; a band without pixels is invalid."""
    area, number, count = info["width"] * info["height"], info["_number"], info["_bands"]
    full = float(INTEGER_RANGES.get(info["_type"], (0, 1))[1])
    colours = [b for b in range(1, count + 1) if b != number]
    values = [planes.get(b, np.full(area, np.nan)) for b in colours]
    good, blank = np.ones(area, bool), np.ones(area, bool)
    for b, v in zip(colours, values, strict=True):
        sentinel = info["_sentinel"][b - 1]
        good &= np.isfinite(v)
        blank &= v == sentinel if sentinel is not None and not math.isnan(sentinel) else False
    good &= ~blank
    opacity = np.clip(np.nan_to_num(planes.get(number, np.zeros(area))), 0, full) if number else np.full(area, full)
    opacity = np.where(good, opacity, 0.0)
    if info["_pre"]:
        divisor = np.where(opacity > 0, opacity, 1.0)
        values = [np.minimum(np.where(opacity > 0, v * full / divisor, 0.0), full) for v in values]
    found = [(b, np.where(good, v, 0.0), opacity / full) for b, v in zip(colours, values, strict=True)]
    return [*found, (number or count + 1, opacity, good.astype(float))]
