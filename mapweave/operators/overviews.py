"""Regular tile lattices and overview pyramids.

Both cut tiles into pieces and put the pieces of a target tile together.  A
target tile never collects more pixels than it has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .rasters import INTEGER_RANGES, META, TILE, arrow_type, join_meta, pixel_blocks, pixel_lists, tile_rows, valid_mask

#: overview levels made by one shuffle; a parent then has at most 4^4 pieces
LEVELS_PER_PASS = 4
#: AUTO stops when both sides fit
OVERVIEW_LIMIT = 512

PIECE = T.StructType(
    TILE.fields
    + [
        T.StructField("full_width", T.LongType()),
        T.StructField("full_height", T.LongType()),
        T.StructField("tile_size", T.IntegerType()),
        T.StructField("fill", T.DoubleType()),
    ]
)
PIECE_KEY = ["raster_id", "level", "band", "tile_x", "tile_y"]


def piece_batch(rows: list[dict], blocks: list[np.ndarray]) -> pa.RecordBatch:
    schema = arrow_type(PIECE)
    columns = [
        pixel_lists(blocks).cast(f.type) if f.name == "pixels" else pa.array([r[f.name] for r in rows], f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def assemble(pieces: DataFrame) -> DataFrame:
    """Tiles of an aligned lattice from their pieces; gaps become NoData."""
    piece = F.struct("row0", "col0", "width", "height", "pixels")
    grouped = pieces.groupBy(*PIECE_KEY).agg(
        F.collect_list(piece).alias("pieces"),
        *[F.first(n).alias(n) for n in ("full_width", "full_height", "tile_size", "fill")],
    )

    def build(batches):
        names = PIECE_KEY + ["full_width", "full_height", "tile_size", "fill"]
        for batch in batches:
            rows, blocks = [], []
            lists = batch.column("pieces")
            for i, row in enumerate(batch.select(names).to_pylist()):
                size = row["tile_size"]
                col0, row0 = row["tile_x"] * size, row["tile_y"] * size
                n, m = min(size, row["full_width"] - col0), min(size, row["full_height"] - row0)
                block = np.full((m, n), row["fill"])
                parts = lists[i].values
                values = pixel_blocks(pa.RecordBatch.from_arrays([parts.field("pixels")], names=["pixels"]))
                spots = zip(*(parts.field(k).to_pylist() for k in ("row0", "col0", "height", "width")))
                for (r, c, h, w), pixels in zip(spots, values):
                    block[r - row0 : r - row0 + h, c - col0 : c - col0 + w] = pixels.reshape(h, w)
                rows.append({**row, "col0": col0, "row0": row0, "width": n, "height": m})
                blocks.append(block)
            if rows:
                yield tile_rows(rows, blocks)

    return grouped.mapInArrow(build, TILE)


def _base(meta: DataFrame, tiles: DataFrame) -> DataFrame:
    info = {
        "off_x": F.col("off_x"),
        "off_y": F.col("off_y"),
        "tile_size": F.col("tile_size"),
        "full_width": F.col("width"),
        "full_height": F.col("height"),
        "color": F.col("color"),
        "_bands": F.col("bands"),
    }
    joined = join_meta(tiles.filter(F.col("level") == 0), meta, info)
    band = F.element_at("_bands", F.col("band"))
    return (
        joined.withColumn("nodata", band["nodata"])
        .withColumn("fill", F.coalesce(band["nodata"], F.lit(float("nan"))))
        .withColumn("integer", band["data_type"].isin(sorted(INTEGER_RANGES)))
        .drop("_bands")
    )


def retile(meta: DataFrame, tiles: DataFrame, tile_size: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Move rasters to a lattice that starts at their first pixel.

    Rasters that already have it (and the wanted tile size) are passed through.
    """
    size = F.col("tile_size") if tile_size is None else F.lit(tile_size)
    aligned = (F.col("off_x") == 0) & (F.col("off_y") == 0) & (F.col("tile_size") == size)
    base = _base(meta, tiles).withColumn("_target", size).withColumn("_same", aligned)

    def cut(batches):
        for batch in batches:
            rows, blocks = [], []
            names = [n for n in batch.schema.names if n != "pixels"]
            for row, pixels in zip(batch.select(names).to_pylist(), pixel_blocks(batch)):
                block = pixels.reshape(row["height"], row["width"])
                step = row["tile_size"] = row["_target"]
                for ty in range(row["row0"] // step, (row["row0"] + row["height"] - 1) // step + 1):
                    for tx in range(row["col0"] // step, (row["col0"] + row["width"] - 1) // step + 1):
                        c0, r0 = max(tx * step, row["col0"]), max(ty * step, row["row0"])
                        c1 = min((tx + 1) * step, row["col0"] + row["width"])
                        r1 = min((ty + 1) * step, row["row0"] + row["height"])
                        rows.append({**row, "tile_x": tx, "tile_y": ty, "col0": c0, "row0": r0, "width": c1 - c0, "height": r1 - r0})
                        blocks.append(block[r0 - row["row0"] : r1 - row["row0"], c0 - row["col0"] : c1 - row["col0"]])
            if rows:
                yield piece_batch(rows, blocks)

    moved = assemble(base.filter(~F.col("_same")).mapInArrow(cut, PIECE))
    kept = base.filter("_same").select(*[f.name for f in TILE])
    new = meta.withColumns({"off_x": F.lit(0), "off_y": F.lit(0), "tile_size": size.cast("int")})
    return new.select(*[f.name for f in META]), kept.unionByName(moved)


def overview_levels(width: int, height: int, limit: int = OVERVIEW_LIMIT) -> int:
    """Number of halvings until both sides are at most ``limit``."""
    levels = 0
    while max(width, height) > limit:
        width, height, levels = -(-width // 2), -(-height // 2), levels + 1
    return levels


def halve(block: np.ndarray, nodata, resampling: str, integer: bool, fill: float) -> np.ndarray:
    """Next overview level of a block that starts at an even column and row."""
    if resampling == "NEAREST":
        return block[::2, ::2]
    h, w = block.shape
    padded = np.full((h + h % 2, w + w % 2), np.nan)
    padded[:h, :w] = np.where(valid_mask(block, nodata), block, np.nan)
    quads = [padded[0::2, 0::2], padded[0::2, 1::2], padded[1::2, 0::2], padded[1::2, 1::2]]
    ok = [~np.isnan(q) for q in quads]
    n = sum(o.astype(int) for o in ok)
    total = sum(np.where(o, q, 0.0) for o, q in zip(ok, quads))
    mean = np.where(n > 0, total / np.maximum(n, 1), np.nan)
    if integer:
        mean = np.rint(mean)
    return np.where(n > 0, mean, fill)


def build_overviews(
    meta: DataFrame, tiles: DataFrame, resampling: str = "AVERAGE", limit: int = OVERVIEW_LIMIT
) -> DataFrame:
    """Overview tiles (level 1 and up) of every raster.

    Each level halves the previous one and rounds odd sizes up.  AVERAGE
    ignores NoData; palettes always use NEAREST.  A tile yields its share of
    four levels at once, so a pyramid of L levels costs L / 4 shuffles.
    """
    resampling = resampling.upper()
    if resampling not in ("AVERAGE", "NEAREST"):
        raise ValueError("Overview resampling must be AVERAGE or NEAREST")
    sizes = meta.agg(F.max("width"), F.max("height"), F.min("tile_size")).first()
    if sizes[0] is None:
        return tiles.filter(F.lit(False))
    levels = overview_levels(sizes[0], sizes[1], limit)
    per_pass = min(LEVELS_PER_PASS, (sizes[2] & -sizes[2]).bit_length() - 1)
    if per_pass < 1:
        raise ValueError("Overviews need an even tile size")
    meta, current = retile(meta, tiles)
    result = None
    done = 0
    while done < levels:
        count = min(per_pass, levels - done)
        pieces = _shares(_base(meta, current.withColumn("level", F.lit(0))), resampling, done, count, limit)
        made = assemble(pieces)
        if done + count < levels:
            # Read by the result and by the next pass, but computed once.
            made = cut_lineage(made)
        result = made if result is None else result.unionByName(made)
        done += count
        current = made.filter(F.col("level") == done)
    return result if result is not None else tiles.filter(F.lit(False))


def _shares(base: DataFrame, resampling: str, done: int, count: int, limit: int) -> DataFrame:
    def reduce(batches):
        for batch in batches:
            rows, blocks = [], []
            names = [n for n in batch.schema.names if n != "pixels"]
            for row, pixels in zip(batch.select(names).to_pylist(), pixel_blocks(batch)):
                method = "NEAREST" if row["color"] == "PALETTE" else resampling
                block = pixels.reshape(row["height"], row["width"])
                most = overview_levels(row["full_width"], row["full_height"], limit)
                for k in range(1, count + 1):
                    level = done + k
                    if level > most:
                        break
                    block = halve(block, row["nodata"], method, row["integer"], row["fill"])
                    rows.append(
                        {
                            **row,
                            "level": level,
                            "tile_x": row["tile_x"] >> k,
                            "tile_y": row["tile_y"] >> k,
                            "col0": row["col0"] >> k,
                            "row0": row["row0"] >> k,
                            "width": block.shape[1],
                            "height": block.shape[0],
                            "full_width": -(-row["full_width"] // 2**level),
                            "full_height": -(-row["full_height"] // 2**level),
                        }
                    )
                    blocks.append(block)
            if rows:
                yield piece_batch(rows, blocks)

    return base.mapInArrow(reduce, PIECE)
