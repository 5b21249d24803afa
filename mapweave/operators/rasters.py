"""Raster tables: one metadata row per raster, one row per tile and band.

A tile holds the pixels of ``col0 .. col0 + width - 1`` and
``row0 .. row0 + height - 1``.  The tile number of a column is
``floor((col + off_x) / tile_size)``, so that a clipped raster keeps the tiles
of its source and needs no shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


TILE_SIZE = 512
#: metadata rows (about 200 bytes each) that may be sent to all executors
BROADCAST_RASTERS = 50_000
#: entries of all their colour tables together
BROADCAST_COLOURS = 2_000_000

BAND = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("nodata", T.DoubleType()),
        T.StructField("scale", T.DoubleType()),
        T.StructField("offset", T.DoubleType()),
        T.StructField("alpha", T.BooleanType()),
    ]
)
#: the colour table of a palette, 16 bits a channel
PALETTE = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("red", "green", "blue")]))
META = T.StructType(
    [
        T.StructField("raster_id", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("width", T.LongType()),
        T.StructField("height", T.LongType()),
        T.StructField("origin_x", T.DoubleType()),
        T.StructField("origin_y", T.DoubleType()),
        T.StructField("pixel_x", T.DoubleType()),
        T.StructField("pixel_y", T.DoubleType()),
        T.StructField("srid", T.IntegerType()),
        T.StructField("crs", T.StringType()),
        T.StructField("tile_size", T.IntegerType()),
        T.StructField("off_x", T.IntegerType()),
        T.StructField("off_y", T.IntegerType()),
        T.StructField("color", T.StringType()),
        T.StructField("bands", T.ArrayType(BAND)),
        T.StructField("steps", T.ArrayType(T.StringType())),
        T.StructField("palette", PALETTE),
        T.StructField("premultiplied", T.BooleanType()),
    ]
)
TILE = T.StructType(
    [
        T.StructField("raster_id", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("band", T.IntegerType()),
        T.StructField("tile_x", T.IntegerType()),
        T.StructField("tile_y", T.IntegerType()),
        T.StructField("col0", T.LongType()),
        T.StructField("row0", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("pixels", T.ArrayType(T.DoubleType())),
    ]
)
GRID_FIELDS = [
    "origin_x", "origin_y", "pixel_x", "pixel_y", "width", "height", "tile_size", "off_x", "off_y",
]

# Integer sample types and their ranges.
INTEGER_RANGES = {
    "UINT8": (0, 255),
    "INT8": (-128, 127),
    "UINT16": (0, 65535),
    "INT16": (-32768, 32767),
    "UINT32": (0, 4294967295),
    "INT32": (-2147483648, 2147483647),
}


def raster_meta(spark: SparkSession, rasters: list[dict]) -> DataFrame:
    """Metadata table from plain dictionaries; missing settings get defaults."""
    rows = []
    for raster in rasters:
        row = dict(
            path=None, srid=0, crs="", tile_size=TILE_SIZE, off_x=0, off_y=0, color="NUMERIC", steps=[],
            palette=None, premultiplied=False,
        )
        row.update(raster)
        row["bands"] = [
            {**dict(name=f"band_{i + 1}", data_type="FLOAT64", nodata=None, scale=1.0, offset=0.0, alpha=False), **b}
            for i, b in enumerate(raster.get("bands") or [{}])
        ]
        for name in ("origin_x", "origin_y", "pixel_x", "pixel_y"):
            row[name] = float(row[name])
        rows.append(tuple(row[f.name] for f in META.fields))
    return spark.createDataFrame(rows, META)


def valid(pixel: Column, nodata: Column) -> Column:
    """A pixel counts when it is finite and not the sentinel; zero is valid."""
    finite = pixel.isNotNull() & ~F.isnan(pixel) & (F.abs(pixel) != float("inf"))
    return finite & ~pixel.eqNullSafe(nodata)


def physical(pixel: Column, scale: Column, offset: Column) -> Column:
    return pixel * F.coalesce(scale, F.lit(1.0)) + F.coalesce(offset, F.lit(0.0))


def valid_mask(values: np.ndarray, nodata) -> np.ndarray:
    """The same rule for a pixel block; a NaN sentinel adds nothing."""
    mask = np.isfinite(values)
    if nodata is not None and not math.isnan(nodata):
        mask &= values != nodata
    return mask


def arrow_type(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def pixel_blocks(batch: pa.RecordBatch, name: str = "pixels"):
    """Pixel arrays of a batch as numpy views, without copying the batch."""
    lists = batch.column(name)
    values = lists.values.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    for i in range(len(lists)):
        yield values[offsets[i] : offsets[i + 1]]


def pixel_lists(blocks: list[np.ndarray]) -> pa.Array:
    """ListArray of doubles from pixel blocks."""
    offsets = np.concatenate([[0], np.cumsum([b.size for b in blocks])]).astype(np.int32)
    flat = np.concatenate([b.ravel() for b in blocks]) if blocks else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.float64()))


def literal(value, kind: T.DataType) -> Column:
    """A Python value as a constant column of a Spark type."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    if isinstance(kind, T.ArrayType):
        return F.array(*[literal(v, kind.elementType) for v in value]).cast(kind)
    return F.lit(value).cast(kind)


def raster_row(meta: DataFrame, raster_id: str):
    """The one metadata row of a raster."""
    rows = meta.filter(F.col("raster_id") == raster_id).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"Expected one raster {raster_id}, found {len(rows)}")
    return rows[0]


def with_row(df: DataFrame, like: DataFrame, row) -> DataFrame:
    """Add the values of one metadata row as constants of the types in ``like``."""
    found = {f.name: literal(row[f.name], f.dataType) for f in like.schema}
    return df.withColumns({"raster_id": F.lit(row["raster_id"]), **found})


def join_meta(df: DataFrame, meta: DataFrame, columns: dict, raster_id: str | None = None) -> DataFrame:
    """Add metadata columns to rows; a raster without metadata fails.

    With a literal ``raster_id`` its one metadata row is read first and becomes
    constants, so there is no join.  Otherwise the rows are joined by their own
    ``raster_id``: metadata of up to BROADCAST_RASTERS rasters, with up to
    BROADCAST_COLOURS colours, is broadcast, so that pixels are not shuffled;
    more of it is joined by a shuffle.
    """
    side = meta.select(F.col("raster_id").alias("_rid"), *[c.alias(n) for n, c in columns.items()])
    if raster_id is not None:
        return with_row(df, side.drop("_rid"), raster_row(meta.select("raster_id", *[c.alias(n) for n, c in columns.items()]), raster_id))
    entries = F.sum(F.greatest(F.size("palette"), F.lit(0))) if "palette" in columns else F.lit(0)
    rasters, entries = side.limit(BROADCAST_RASTERS + 1).agg(F.count(F.lit(1)), entries).first()
    if rasters <= BROADCAST_RASTERS and (entries or 0) <= BROADCAST_COLOURS:
        side = F.broadcast(side)
    joined = df.join(side, F.col("raster_id") == F.col("_rid"), "left")
    missing = F.raise_error(F.concat(F.lit("Missing raster: "), F.coalesce("raster_id", F.lit("NULL"))))
    checked = F.when(F.col("_rid").isNull(), missing.cast("string")).otherwise(F.col("raster_id"))
    return joined.withColumn("raster_id", checked).drop("_rid")


def tile_rows(rows: list[dict], blocks: list[np.ndarray]) -> pa.RecordBatch:
    """Batch of tile rows from key dictionaries and pixel blocks."""
    schema = arrow_type(TILE)
    columns = [pa.array([r[f.name] for r in rows], f.type) for f in list(schema)[:-1]]
    return pa.RecordBatch.from_arrays(columns + [pixel_lists(blocks).cast(schema[-1].type)], schema=schema)


def add_step(text: str) -> Column:
    return F.concat("steps", F.array(F.lit(text)))


def tiles_from_pixels(pixels: DataFrame, meta: DataFrame, raster_id: str | None = None) -> DataFrame:
    """Tiles from one row per pixel: ``raster_id, band, x, y, v``.

    A NULL value and a missing row become the band's NoData (NaN without one).
    Repeated pixels are merged before the tile is collected, so a group never
    exceeds the pixels of one tile.
    """
    cells = join_meta(
        pixels,
        meta,
        {
            "_t": F.struct("tile_size", "off_x", "off_y", "width", "height"),
            "_bands": F.col("bands"),
        },
        raster_id,
    )
    size = F.col("_t.tile_size")
    keys = ["raster_id", "band", "tile_x", "tile_y"]
    cells = (
        cells.withColumn("tile_x", F.floor((F.col("x") + F.col("_t.off_x")) / size).cast("int"))
        .withColumn("tile_y", F.floor((F.col("y") + F.col("_t.off_y")) / size).cast("int"))
        .withColumn("col0", F.greatest(F.lit(0), F.col("tile_x") * size - F.col("_t.off_x")).cast("long"))
        .withColumn("row0", F.greatest(F.lit(0), F.col("tile_y") * size - F.col("_t.off_y")).cast("long"))
    )
    right = F.least(F.col("_t.width"), ((F.col("tile_x") + 1) * size - F.col("_t.off_x")).cast("long"))
    bottom = F.least(F.col("_t.height"), ((F.col("tile_y") + 1) * size - F.col("_t.off_y")).cast("long"))
    cells = (
        cells.withColumn("width", (right - F.col("col0")).cast("int"))
        .withColumn("height", (bottom - F.col("row0")).cast("int"))
        .withColumn("pos", ((F.col("y") - F.col("row0")) * F.col("width") + F.col("x") - F.col("col0")).cast("int"))
        .withColumn("nodata", F.element_at("_bands", F.col("band")).getField("nodata"))
    )
    shape = ["col0", "row0", "width", "height", "nodata"]
    packed = (
        cells.groupBy(*keys, "pos", *shape)
        .agg(F.max("v").alias("v"))
        .groupBy(*keys, *shape)
        .agg(F.collect_list(F.struct("pos", "v")).alias("cells"))
        .select(
            *keys, *shape, F.col("cells.pos").alias("pos"), F.col("cells.v").alias("v")
        )
    )
    schema = arrow_type(TILE)

    def scatter(batches):
        for batch in batches:
            rows = batch.select(keys + shape).to_pylist()
            blocks = []
            spots = pixel_blocks(batch, "pos")
            for row, pos, v in zip(rows, spots, pixel_blocks(batch, "v")):
                fill = np.nan if row["nodata"] is None else row["nodata"]
                block = np.full(row["width"] * row["height"], fill)
                block[pos.astype(int)] = np.where(np.isnan(v), fill, v)
                blocks.append(block)
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["level"] = pa.array(np.zeros(batch.num_rows, np.int32))
            columns["pixels"] = pixel_lists(blocks)
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)

    return packed.mapInArrow(scatter, TILE)


def pixels_from_tiles(tiles: DataFrame) -> DataFrame:
    """One row per pixel: ``raster_id, level, band, x, y, v``."""
    at = F.col("pos")
    # Tiles are never empty; the outer form only keeps the planner from copying
    # the pixel expression into a filter.
    return tiles.select(
        "raster_id", "level", "band", "col0", "row0", "width", F.posexplode_outer("pixels").alias("pos", "v")
    ).select(
        "raster_id",
        "level",
        "band",
        (F.col("col0") + at % F.col("width")).alias("x"),
        (F.col("row0") + F.floor(at / F.col("width"))).alias("y"),
        "v",
    )


def raster_info(meta: DataFrame, fields="width height crs bands", prefix: str = "raster_") -> DataFrame:
    """Add the selected metadata columns; no pixels are read."""
    names = tokens(fields)
    known = {
        "width": F.col("width"),
        "height": F.col("height"),
        "crs": F.col("crs"),
        "bands": _bands_json(),
    }
    for name in names:
        if name not in known:
            raise ValueError(f"Unknown info field: {name}")
    return add_columns(meta, {prefix + name: known[name] for name in names})


def _bands_json() -> Column:
    def number(value):
        # Numbers stay JSON numbers, NaN and infinities become text.
        finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
        return (
            F.when(value.isNull(), "null")
            .when(finite, value.cast("string"))
            .otherwise(F.concat(F.lit('"'), value.cast("string"), F.lit('"')))
        )

    def text(value):
        return F.when(value.isNull(), "null").otherwise(
            F.concat(F.lit('"'), F.regexp_replace(value, r'(["\\])', r"\\$1"), F.lit('"'))
        )

    def item(band, i):
        return F.concat(
            F.lit('{"band":'), (i + 1).cast("string"),
            F.lit(',"name":'), text(band["name"]),
            F.lit(',"dataType":'), text(band["data_type"]),
            F.lit(',"noData":'), number(band["nodata"]),
            F.lit(',"scale":'), number(band["scale"]),
            F.lit(',"offset":'), number(band["offset"]),
            F.lit(',"color":'), text(F.col("color")),
            F.lit(',"alpha":'), band["alpha"].cast("string"),
            F.lit("}"),
        )

    return F.concat(F.lit("["), F.array_join(F.transform("bands", item), ","), F.lit("]"))


def tokens(text) -> list[str]:
    """Names from a list or a text with comma, semicolon or blank separators;
    repeated names count once."""
    parts = text if isinstance(text, (list, tuple)) else (
        str(text).replace(",", " ").replace(";", " ").split()
    )
    return list(dict.fromkeys(str(p) for p in parts))


def add_columns(df: DataFrame, new: dict) -> DataFrame:
    """Append columns; an existing name (in any case) is an error."""
    taken = {name.lower() for name in df.columns}
    for name in new:
        if name.lower() in taken:
            raise ValueError(f"Output field already exists: {name}")
        taken.add(name.lower())
    return df.select("*", *[c.alias(n) for n, c in new.items()])


def select_bands(meta: DataFrame, tiles: DataFrame, bands) -> tuple[DataFrame, DataFrame]:
    """``ALL`` or an ordered list of 1-based bands."""
    if isinstance(bands, str) and bands.strip().upper() == "ALL":
        return meta, tiles
    chosen = [int(b) for b in tokens(bands)]
    if not chosen or min(chosen) < 1:
        raise ValueError("Bands are numbered from 1")
    numbers = F.array(*[F.lit(b) for b in chosen])
    checked = F.when(
        F.size("bands") < max(chosen), F.raise_error(F.lit("Band does not exist")).cast(T.ArrayType(BAND))
    ).otherwise(F.transform(numbers, lambda b: F.element_at("bands", b)))
    step = add_step("bands " + " ".join(map(str, chosen)))
    position = F.array_position(numbers, F.col("band")).cast("int")
    return (
        meta.withColumn("bands", checked).withColumn("steps", step),
        tiles.filter(F.col("band").isin(chosen)).withColumn("band", position),
    )
