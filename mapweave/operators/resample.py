"""Target grids and resampling to another grid or reference system.

Every source tile works out its own share of the target tiles it reaches and
sends only those pixels.  A target tile therefore collects at most its own
pixels (NEAREST) or four contributions per pixel (BILINEAR), whatever the
ratio of the two resolutions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.crs import known, transform_xy
from ..functions.geometry import BOUNDS, parse_crs
from .colour import expand_palettes, has_colour, has_palettes, is_colour, weighted_tiles, with_alpha_band
from .rasters import (
    INTEGER_RANGES, META, TILE, add_step, arrow_type, join_meta, pixel_blocks, tile_rows, valid_mask,
)

#: segments per outline edge of a raster, and per edge of a tile
OUTLINE_SEGMENTS, TILE_SEGMENTS = 256, 64
#: cell edges closer than this to a multiple of the pixel size are on it
SNAP = 1e-6


def _outline(x0, y0, x1, y1, n):
    t = np.linspace(0, 1, n + 1)
    xs, ys = x0 + (x1 - x0) * t, y0 + (y1 - y0) * t
    return (
        np.concatenate([xs, xs, np.full(n + 1, x0), np.full(n + 1, x1)]),
        np.concatenate([np.full(n + 1, y0), np.full(n + 1, y1), ys, ys]),
    )


@F.arrow_udf(BOUNDS)
def _raster_bounds(
    ox: pa.Array, oy: pa.Array, px: pa.Array, py: pa.Array, w: pa.Array, h: pa.Array,
    source: pa.Array, target: pa.Array,
) -> pa.Array:
    rows = []
    for a, b, dx, dy, n, m, src, dst in zip(*(v.to_pylist() for v in (ox, oy, px, py, w, h, source, target))):
        xs, ys = _outline(a, b, a + dx * n, b + dy * m, OUTLINE_SEGMENTS)
        if src != dst:
            xs, ys = transform_xy(xs, ys, src, dst)
        if not (np.isfinite(xs).all() and np.isfinite(ys).all()):
            raise ValueError("Raster outline cannot be transformed")
        rows.append(dict(xmin=xs.min(), ymin=ys.min(), xmax=xs.max(), ymax=ys.max()))
    return pa.array(rows, pa.struct([(n, pa.float64()) for n in ("xmin", "ymin", "xmax", "ymax")]))


def _number(v) -> Column:
    return F.col(v).cast("double") if isinstance(v, str) else F.lit(float(v))


def target_grid(meta: DataFrame, crs, rx, ry, extent="AUTO", crs_field: str | None = None) -> DataFrame:
    """Add ``target``: the north-up grid that each raster is resampled to.

    Cell edges lie on multiples of the pixel size and the extent is rounded
    outward.  ``extent`` is AUTO (the transformed outline) or four bounds in
    the target CRS, kept whole when they overlap partly.  Pixel sizes and
    bounds are numbers or column names; ``crs_field`` names an SRID column.
    """
    if crs_field is not None:
        srid = F.col(crs_field).cast("int")
    elif crs in (None, ""):
        srid = F.col("srid")
    else:
        code = parse_crs(crs)
        if not known(code):
            raise ValueError(f"Unsupported coordinate reference system: {crs}")
        srid = F.lit(code)
    rx, ry = _number(rx), _number(ry)
    checked = lambda r: F.when(
        (r > 0) & (r < float("inf")), r
    ).otherwise(F.raise_error(F.lit("Pixel size must be positive and finite")).cast("double"))
    rx, ry = checked(rx), checked(ry)
    grid = [F.col(n) for n in ("origin_x", "origin_y", "pixel_x", "pixel_y", "width", "height")]
    meta = meta.withColumn("_o", _raster_bounds(*grid, F.col("srid"), srid))
    outline = [F.col(f"_o.{n}") for n in ("xmin", "ymin", "xmax", "ymax")]
    if extent == "AUTO":
        box = outline
    else:
        box = [_number(v) for v in extent]
        apart = (
            (box[0] >= outline[2]) | (box[2] <= outline[0]) | (box[1] >= outline[3]) | (box[3] <= outline[1])
        )
        wrong = (box[0] >= box[2]) | (box[1] >= box[3])
        box[0] = (
            F.when(wrong, F.raise_error(F.lit("Bounding box minimum must be below maximum")).cast("double"))
            .when(apart, F.raise_error(F.lit("Target extent does not overlap the raster")).cast("double"))
            .otherwise(box[0])
        )
    c0, c1 = F.floor(box[0] / rx + SNAP), F.ceil(box[2] / rx - SNAP)
    r0, r1 = F.floor(box[1] / ry + SNAP), F.ceil(box[3] / ry - SNAP)
    return meta.withColumn(
        "target",
        F.struct(
            (c0 * rx).alias("origin_x"),
            (r1 * ry).alias("origin_y"),
            rx.alias("pixel_x"),
            (-ry).alias("pixel_y"),
            (c1 - c0).cast("long").alias("width"),
            (r1 - r0).cast("long").alias("height"),
            srid.alias("srid"),
        ),
    ).drop("_o")


def reproject(
    meta: DataFrame,
    tiles: DataFrame,
    crs=None,
    rx=None,
    ry=None,
    extent="AUTO",
    interpolation: str = "NEAREST",
    output_type: str = "AUTO",
    source_nodata: float | None = None,
    output_nodata: float | None = None,
    crs_field: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Resample raw values of all bands to the target grid.

    NEAREST takes the value of the source pixel under the target centre.
    BILINEAR weighs up to four neighbours, leaves invalid ones out and
    renormalises.  Cells without a valid contribution are NoData; target tiles
    without any are left out.

    Colour rasters keep their type whatever ``output_type`` says and get no
    sentinel: RGB leaves with an alpha band, cells without a contribution are 0
    and transparent, and so is a target tile that is left out.  Colours weigh by
    their opacity.  NEAREST keeps the indexes and the table of a palette; BILINEAR
    expands it to RGBA with 16 bits a channel.
    """
    interpolation, output_type = interpolation.upper(), output_type.upper()
    if interpolation not in ("NEAREST", "BILINEAR"):
        raise ValueError("Interpolation must be NEAREST or BILINEAR")
    if output_type not in ("AUTO", "SOURCE", "FLOAT32", "FLOAT64"):
        raise ValueError("Output type must be AUTO, SOURCE, FLOAT32 or FLOAT64")
    for value in (source_nodata, output_nodata):
        if value is not None and np.isinf(value):
            raise ValueError("Infinite NoData")
    if interpolation == "BILINEAR" and has_palettes(meta):
        meta, tiles = expand_palettes(meta, tiles)
    weighed = has_colour(meta)
    if weighed:
        tiles, meta = weighted_tiles(meta, tiles, source_nodata), with_alpha_band(meta)
    colour = F.coalesce(is_colour(), F.lit(False))
    planned = target_grid(meta, crs, rx, ry, extent, crs_field)
    numeric = F.transform("bands", lambda b: _output_band(b, interpolation, output_type, output_nodata))
    bands = F.when(colour, F.col("bands")).otherwise(numeric) if weighed else numeric
    t = F.col("target")
    changed = {n: t[n] for n in ("origin_x", "origin_y", "pixel_x", "pixel_y", "width", "height", "srid")}
    changed.update(
        crs=F.when(t["srid"] == F.col("srid"), F.col("crs")).otherwise(F.concat(F.lit("EPSG:"), t["srid"])),
        off_x=F.lit(0), off_y=F.lit(0), bands=bands, steps=add_step(f"reproject {interpolation}"),
    )
    new_meta = planned.select(*[changed.get(f.name, F.col(f.name)).alias(f.name) for f in META])

    source = F.struct("origin_x", "origin_y", "pixel_x", "pixel_y", "width", "height", "srid")
    base = join_meta(
        tiles.filter(F.col("level") == 0),
        planned.withColumn("out", bands),
        {
            "source": source, "target": F.col("target"), "tile_size": F.col("tile_size"),
            "_in": F.col("bands"), "_out": F.col("out"), "colour": colour,
        },
    )
    declared = F.element_at("_in", F.col("band"))["nodata"] if source_nodata is None else F.lit(float(source_nodata))
    base = base.withColumn("nodata", F.when(~F.col("colour"), declared))
    base = base.withColumn("out", F.element_at("_out", F.col("band")))
    base = base.drop("_in", "_out", "level")
    shares = base.mapInArrow(_share_kernel(interpolation), SHARE)
    return new_meta, _collect(shares)


def _output_band(band: Column, interpolation, output_type, nodata) -> Column:
    if output_type in ("FLOAT32", "FLOAT64"):
        kind = F.lit(output_type)
    elif output_type == "AUTO" and interpolation == "BILINEAR":
        kind = F.lit("FLOAT64")
    else:
        kind = band["data_type"]
    sentinel = band["nodata"] if nodata is None else F.lit(float(nodata))
    integer = kind.isin(sorted(INTEGER_RANGES))
    fits = F.lit(False)
    for name, (low, high) in INTEGER_RANGES.items():
        inside = sentinel.between(float(low), float(high)) & (sentinel == F.floor(sentinel))
        fits = F.when(kind == name, inside).otherwise(fits)
    exact32 = F.isnan(sentinel) | (sentinel.cast("float").cast("double") == sentinel)
    message = (
        F.when(integer & sentinel.isNull(), "Integer output needs a NoData value")
        .when(integer & ~fits, "NoData value does not fit the output type")
        .when((kind == "FLOAT32") & ~exact32, "NoData value does not fit the output type")
    )
    checked = F.when(message.isNotNull(), F.raise_error(message).cast("double")).otherwise(sentinel)
    return band.withField("data_type", kind).withField("nodata", checked)


SHARE = T.StructType(
    [
        T.StructField("raster_id", T.StringType()),
        T.StructField("band", T.IntegerType()),
        T.StructField("tile_x", T.IntegerType()),
        T.StructField("tile_y", T.IntegerType()),
        T.StructField("from_y", T.LongType()),
        T.StructField("from_x", T.LongType()),
        T.StructField("pos", T.ArrayType(T.IntegerType())),
        T.StructField("total", T.ArrayType(T.DoubleType())),
        T.StructField("weight", T.ArrayType(T.DoubleType())),
        T.StructField("tile_size", T.IntegerType()),
        T.StructField("full_width", T.LongType()),
        T.StructField("full_height", T.LongType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("nodata", T.DoubleType()),
        T.StructField("colour", T.BooleanType()),
    ]
)


def _share_kernel(interpolation: str):
    schema = arrow_type(SHARE)

    def run(batches):
        for batch in batches:
            names = [n for n in batch.schema.names if n not in ("pixels", "alpha")]
            alphas = pixel_blocks(batch, "alpha") if "alpha" in batch.schema.names else None
            for row, pixels in zip(batch.select(names).to_pylist(), pixel_blocks(batch)):
                row["alpha"] = next(alphas) if alphas else ()
                for share in _tile_shares(row, pixels, interpolation):
                    yield pa.RecordBatch.from_pylist([share], schema=schema)

    return run


def _tile_shares(row, pixels, interpolation):
    """The contributions of one source tile to each target tile it reaches."""
    s, t, size = row["source"], row["target"], row["tile_size"]
    block = pixels.reshape(row["height"], row["width"])
    usable = valid_mask(block, row["nodata"])
    if not usable.any():
        return
    # The tile's area, half a pixel wider for interpolation, in target cells.
    grow = 0.5 if interpolation == "BILINEAR" else 0.0
    x0 = s["origin_x"] + (row["col0"] - grow) * s["pixel_x"]
    x1 = s["origin_x"] + (row["col0"] + row["width"] + grow) * s["pixel_x"]
    y0 = s["origin_y"] + (row["row0"] - grow) * s["pixel_y"]
    y1 = s["origin_y"] + (row["row0"] + row["height"] + grow) * s["pixel_y"]
    xs, ys = _outline(x0, y0, x1, y1, TILE_SEGMENTS)
    same = s["srid"] == t["srid"]
    if not same:
        xs, ys = transform_xy(xs, ys, s["srid"], t["srid"])
    cols = (xs - t["origin_x"]) / t["pixel_x"]
    rows = (ys - t["origin_y"]) / t["pixel_y"]
    c0, c1 = max(0, int(np.floor(cols.min())) - 1), min(t["width"], int(np.ceil(cols.max())) + 1)
    r0, r1 = max(0, int(np.floor(rows.min())) - 1), min(t["height"], int(np.ceil(rows.max())) + 1)
    for ty in range(r0 // size, -(-r1 // size)):
        for tx in range(c0 // size, -(-c1 // size)):
            left, right = tx * size, min((tx + 1) * size, t["width"])
            top, bottom = ty * size, min((ty + 1) * size, t["height"])
            a, b, c, d = max(left, c0), min(right, c1), max(top, r0), min(bottom, r1)
            if a >= b or c >= d:
                continue
            gx = t["origin_x"] + (np.arange(a, b) + 0.5) * t["pixel_x"]
            gy = t["origin_y"] + (np.arange(c, d) + 0.5) * t["pixel_y"]
            gx, gy = (v.ravel() for v in np.meshgrid(gx, gy))
            if not same:
                gx, gy = transform_xy(gx, gy, t["srid"], s["srid"])
            u = (gx - s["origin_x"]) / s["pixel_x"]
            v = (gy - s["origin_y"]) / s["pixel_y"]
            inside = (u >= 0) & (u < s["width"]) & (v >= 0) & (v < s["height"])
            jj, ii = np.meshgrid(np.arange(a, b) - left, np.arange(c, d) - top)
            pos = (ii * (right - left) + jj).ravel()[inside]
            total, weight = _contributions(row, block, usable, u[inside], v[inside], interpolation)
            hit = weight > 0
            if hit.any():
                yield dict(
                    raster_id=row["raster_id"], band=row["band"], tile_x=tx, tile_y=ty,
                    from_y=row["row0"], from_x=row["col0"],
                    pos=pos[hit].astype(np.int32), total=total[hit], weight=weight[hit],
                    tile_size=size, full_width=t["width"], full_height=t["height"],
                    data_type=row["out"]["data_type"], nodata=row["out"]["nodata"],
                    colour=row["colour"],
                )


def _contributions(row, block, usable, u, v, interpolation):
    """Weighted sum and weight that this tile's pixels give each position."""

    # Colours count by their alpha, so transparent pixels leave no fringe.
    alpha = np.asarray(row["alpha"]).reshape(block.shape) if len(row["alpha"]) else None

    def pick(c, r):
        c, r = c - row["col0"], r - row["row0"]
        mine = (c >= 0) & (c < row["width"]) & (r >= 0) & (r < row["height"])
        c, r = np.where(mine, c, 0), np.where(mine, r, 0)
        ok = mine & usable[r, c]
        return np.where(ok, block[r, c], 0.0), ok if alpha is None else np.where(ok, alpha[r, c], 0.0)

    if interpolation == "NEAREST":
        value, ok = pick(np.floor(u).astype(np.int64), np.floor(v).astype(np.int64))
        return value, (ok > 0).astype(float)
    cu, cv = np.floor(u - 0.5), np.floor(v - 0.5)
    fu, fv = u - 0.5 - cu, v - 0.5 - cv
    total, weight = np.zeros(len(u)), np.zeros(len(u))
    for dc, wc in ((0, 1 - fu), (1, fu)):
        for dr, wr in ((0, 1 - fv), (1, fv)):
            value, share = pick(cu.astype(np.int64) + dc, cv.astype(np.int64) + dr)
            w = wc * wr * share
            total += w * value
            weight += w
    return total, weight


def _collect(shares: DataFrame) -> DataFrame:
    keys = ["raster_id", "band", "tile_x", "tile_y"]
    context = ["tile_size", "full_width", "full_height", "data_type", "nodata", "colour"]
    grouped = shares.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("from_y", "from_x", "pos", "total", "weight"))).alias("shares"),
        *[F.first(c).alias(c) for c in context],
    )

    def build(batches):
        for batch in batches:
            rows, blocks = [], []
            lists = batch.column("shares")
            for i, row in enumerate(batch.select(keys + context).to_pylist()):
                size = row["tile_size"]
                col0, row0 = row["tile_x"] * size, row["tile_y"] * size
                n, m = min(size, row["full_width"] - col0), min(size, row["full_height"] - row0)
                total, weight = np.zeros(n * m), np.zeros(n * m)
                parts = lists[i].values
                for at, t, w in zip(*(_lists(parts.field(k)) for k in ("pos", "total", "weight"))):
                    at = at.astype(np.int64)
                    total[at] += t
                    weight[at] += w
                block = finish(total, weight, row["data_type"], row["nodata"])
                if row["colour"]:
                    block = np.where(weight > 0, block, 0.0)
                rows.append({**row, "level": 0, "col0": col0, "row0": row0, "width": n, "height": m})
                blocks.append(block)
            if rows:
                yield tile_rows(rows, blocks)

    return grouped.mapInArrow(build, TILE)


def _lists(column):
    return pixel_blocks(pa.RecordBatch.from_arrays([column], names=["pixels"]))


def finish(total, weight, data_type, nodata):
    """Values of the output type; collisions with the sentinel fail."""
    hit = weight > 0
    value = np.where(hit, total / np.where(hit, weight, 1.0), 0.0)
    if data_type in INTEGER_RANGES:
        value = np.rint(value)
        low, high = INTEGER_RANGES[data_type]
        if ((value < low) | (value > high))[hit].any():
            raise ValueError("Resampled value overflows the output type")
    elif data_type == "FLOAT32":
        value = value.astype(np.float32).astype(float)
    if nodata is not None and (value[hit] == nodata).any():
        raise ValueError("A valid value equals the output NoData")
    return np.where(hit, value, np.nan if nodata is None else nodata)
