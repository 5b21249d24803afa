"""Cutting rasters: by a box and by polygons."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coverage import Grid, covered
from ..functions.crs import known, transform_xy
from ..functions.geometry import BOUNDS, parse_crs
from .errors import error
from .rasters import (
    GRID_FIELDS, INTEGER_RANGES, META, TILE, add_step, join_meta, pixel_blocks, select_bands, tile_rows,
)
from .skew import HotKeys
from .tile_order import in_windows
from .zonal import TILE_KEY, cover_tiles, most_tiles, needed_tiles, touched_tiles, zones_on_grid

#: zones that share one copy of a tile before it is replicated
CLIPS_PER_TILE = 256

WINDOW = T.StructType([T.StructField(n, T.LongType()) for n in ("c0", "r0", "c1", "r1")])


def pixel_window(xmin, ymin, xmax, ymax, strict: bool = True) -> Column:
    """Column and row range (end exclusive) of the pixels that overlap a box; a
    box beyond the raster fails, or gives NULL if not ``strict``."""

    def span(low, high, origin, step, cells):
        a, b = (low - origin) / step, (high - origin) / step
        first = F.greatest(F.floor(F.least(a, b)), F.lit(0))
        last = F.least(F.ceil(F.greatest(a, b)), cells)
        return first.cast("long"), last.cast("long")

    c0, c1 = span(xmin, xmax, F.col("origin_x"), F.col("pixel_x"), F.col("width"))
    r0, r1 = span(ymin, ymax, F.col("origin_y"), F.col("pixel_y"), F.col("height"))
    window = F.struct(c0.alias("c0"), r0.alias("r0"), c1.alias("c1"), r1.alias("r1"))
    if not strict:
        return F.when((c0 < c1) & (r0 < r1), window)
    return F.when((c0 >= c1) | (r0 >= r1), F.raise_error(_disjoint()).cast(WINDOW)).otherwise(window)


def _disjoint() -> Column:
    return F.concat(F.lit("Clip area does not overlap raster "), F.col("raster_id"))


def cut_meta(meta: DataFrame, step: str) -> DataFrame:
    """Metadata of the part given by the ``window`` column."""
    w, size = F.col("window"), F.col("tile_size")
    changed = {
        "width": w["c1"] - w["c0"],
        "height": w["r1"] - w["r0"],
        "origin_x": F.col("origin_x") + w["c0"] * F.col("pixel_x"),
        "origin_y": F.col("origin_y") + w["r0"] * F.col("pixel_y"),
        "off_x": F.pmod(F.col("off_x") + w["c0"], size).cast("int"),
        "off_y": F.pmod(F.col("off_y") + w["r0"], size).cast("int"),
        "steps": add_step(step),
    }
    return meta.select(*[changed.get(f.name, F.col(f.name)).alias(f.name) for f in META])


def _value(v) -> Column:
    return F.col(v).cast("double") if isinstance(v, str) else F.lit(float(v))


def clip_box(meta, tiles, xmin, ymin, xmax, ymax, crs=None) -> tuple[DataFrame, DataFrame]:
    """Cut rasters to the pixels that overlap a box; nothing is resampled.

    Bounds are numbers or names of metadata columns.  A box in another CRS is
    densified to a hundredth of its longer side before it is transformed.
    """
    bounds = [_value(v) for v in (xmin, ymin, xmax, ymax)]
    order = F.when(
        (bounds[0] >= bounds[2]) | (bounds[1] >= bounds[3]),
        F.raise_error(F.lit("Bounding box minimum must be below maximum")).cast("double"),
    ).otherwise(bounds[0])
    bounds[0] = order
    if crs not in (None, ""):
        code = parse_crs(crs)
        if not known(code):
            raise ValueError(f"Unsupported coordinate reference system: {crs}")
        box = _box_bounds(*bounds, F.lit(code), F.col("srid"))
        bounds = [box[n] for n in ("xmin", "ymin", "xmax", "ymax")]
    planned = meta.withColumn("window", pixel_window(*bounds))
    return cut_meta(planned, "clip box"), cut_tiles(in_windows(tiles, planned), planned)


@F.arrow_udf(BOUNDS)
def _box_bounds(
    xmin: pa.Array, ymin: pa.Array, xmax: pa.Array, ymax: pa.Array, source: pa.Array, target: pa.Array
) -> pa.Array:
    rows = []
    for a, b, c, d, src, dst in zip(*(v.to_pylist() for v in (xmin, ymin, xmax, ymax, source, target))):
        if src == dst:
            rows.append(dict(xmin=a, ymin=b, xmax=c, ymax=d))
            continue
        step = max(c - a, d - b) / 100
        xs = np.linspace(a, c, int(np.ceil((c - a) / step)) + 1)
        ys = np.linspace(b, d, int(np.ceil((d - b) / step)) + 1)
        px = np.concatenate([xs, xs, np.full(len(ys), a), np.full(len(ys), c)])
        py = np.concatenate([np.full(len(xs), b), np.full(len(xs), d), ys, ys])
        tx, ty = transform_xy(px, py, src, dst)
        rows.append(dict(xmin=tx.min(), ymin=ty.min(), xmax=tx.max(), ymax=ty.max()))
    return pa.array(rows, pa.struct([(n, pa.float64()) for n in ("xmin", "ymin", "xmax", "ymax")]))


def cut_tiles(tiles: DataFrame, planned: DataFrame) -> DataFrame:
    """Tiles inside each raster's window; border tiles are sliced."""
    info = {
        "_w": F.col("window"),
        "_sx": F.floor((F.col("off_x") + F.col("window.c0")) / F.col("tile_size")).cast("int"),
        "_sy": F.floor((F.col("off_y") + F.col("window.r0")) / F.col("tile_size")).cast("int"),
    }
    base = join_meta(tiles.filter(F.col("level") == 0), planned, info)
    w = F.col("_w")
    right, bottom = F.col("col0") + F.col("width"), F.col("row0") + F.col("height")
    base = base.filter(
        (F.col("col0") < w["c1"]) & (right > w["c0"]) & (F.col("row0") < w["r1"]) & (bottom > w["r0"])
    )
    left = F.greatest(F.col("col0"), w["c0"])
    top = F.greatest(F.col("row0"), w["r0"])
    base = (
        base.withColumn("_x", (left - F.col("col0")).cast("int"))
        .withColumn("_y", (top - F.col("row0")).cast("int"))
        .withColumn("_n", F.greatest(F.least(right, w["c1"]) - left, F.lit(0)).cast("int"))
        .withColumn("_m", F.greatest(F.least(bottom, w["r1"]) - top, F.lit(0)).cast("int"))
    )
    whole = (F.col("_n") == F.col("width")) & (F.col("_m") == F.col("height"))
    rows = F.transform(
        F.sequence(F.col("_y"), F.col("_y") + F.col("_m") - 1),
        lambda r: F.slice("pixels", r * F.col("width") + F.col("_x") + 1, F.col("_n")),
    )
    # Kept apart from the projection below, whose aliases reuse these names.
    base = base.withColumn("_p", F.when(whole, F.col("pixels")).when(F.col("_m") > 0, F.flatten(rows)))
    return base.select(
        "raster_id",
        "level",
        "band",
        (F.col("tile_x") - F.col("_sx")).alias("tile_x"),
        (F.col("tile_y") - F.col("_sy")).alias("tile_y"),
        (F.col("col0") + F.col("_x") - w["c0"]).alias("col0"),
        (F.col("row0") + F.col("_y") - w["r0"]).alias("row0"),
        F.col("_n").alias("width"),
        F.col("_m").alias("height"),
        F.col("_p").alias("pixels"),
    )


def clip_polygon(
    meta: DataFrame,
    tiles: DataFrame,
    zones: DataFrame,
    geom: str,
    *,
    out_id: str,
    raster_id: str | None = None,
    crs=None,
    nodata: float | None = None,
    bands="ALL",
    errors: str = "FAIL",
) -> tuple[DataFrame, ...]:
    """One clipped raster per zone, named by the ``out_id`` column.

    Pixels whose centre the polygon covers are kept, the boundary included;
    the others become NoData.  Tiles without a covered centre are left out,
    which means NoData.  Integer bands need a sentinel.

    An empty zone, or one beyond its raster, stops the job.  With ``errors`` =
    ROUTE_TO_ERROR it gives no raster but a row (``out_id``, ``error``) of a
    third DataFrame.
    """
    if errors not in ("FAIL", "ROUTE_TO_ERROR"):
        raise ValueError("Clip errors are FAIL or ROUTE_TO_ERROR")
    if nodata is not None and np.isinf(nodata):
        raise ValueError("Infinite NoData")
    strict = errors == "FAIL"
    meta, tiles = select_bands(meta, tiles, bands)
    columns = [F.col(out_id).cast("string").alias("_out"), F.col(geom)]
    zones = zones.select(*columns, *([] if raster_id else ["raster_id"]))
    empty = F.col(geom).isNull() | F.col(f"{geom}.xmin").isNull()
    without = zones.filter(empty).select(F.col("_out").alias(out_id), error("CLIP", geom, "Clip geometry is empty").alias("error"))
    if strict:
        failing = F.raise_error(F.lit("Clip geometry is empty")).cast("string")
        zones = zones.withColumn("_out", F.when(empty, failing).otherwise(F.col("_out")))
    ready = zones_on_grid(zones, geom, _with_sentinel(meta, nodata), raster_id=raster_id, crs=crs)

    info = join_meta(
        ready.select("_out", "raster_id", "_geom"), _with_sentinel(meta, nodata),
        {f.name: F.col(f.name) for f in META if f.name != "raster_id"}, raster_id,
    )
    box = [F.col(f"_geom.{n}") for n in ("xmin", "ymin", "xmax", "ymax")]
    planned = info.withColumn("window", pixel_window(*box, strict))
    beyond = planned.filter("window IS NULL").select(F.col("_out").alias(out_id), error("CLIP", geom, _disjoint()).alias("error"))
    if not strict:
        planned = planned.filter("window IS NOT NULL")
    clipped = cut_meta(planned.withColumn("raster_id", F.col("_out")), "clip polygon")

    spans = join_meta(
        ready, _with_sentinel(meta, nodata),
        {"_bands": F.col("bands"), **{n: F.col(n) for n in GRID_FIELDS}}, raster_id,
    ).withColumn("window", pixel_window(*box, strict))
    if not strict:
        spans = spans.filter("window IS NOT NULL")
    sentinel = F.transform("_bands", lambda b: F.coalesce(b["nodata"], F.lit(float("nan"))))
    wanted = spans.select(
        "_out", "raster_id", "grid", "window", sentinel.alias("fills"), F.col("_geom.wkb").alias("wkb")
    )
    hot = HotKeys(touched_tiles(ready), TILE_KEY, CLIPS_PER_TILE)
    cover = hot.spread(cover_tiles(wanted, ["_out"], most_tiles(ready)), "_out")
    base = hot.replicate(needed_tiles(tiles, ready).filter(F.col("level") == 0))
    # never broadcast: the planner does not know how many rows a cover makes
    joined = base.join(cover.hint("shuffle_hash"), [*TILE_KEY, "_part"]).select(
        "_out", "band", "tile_x", "tile_y", "col0", "row0", "width", "height", "pixels", "edges", "grid", "window", "fills"
    )
    masked = joined.mapInArrow(_mask_batches, TILE)
    return (clipped, masked) if strict else (clipped, masked, without.unionByName(beyond))


def _with_sentinel(meta: DataFrame, nodata) -> DataFrame:
    integer = sorted(INTEGER_RANGES)

    def band(b):
        b = b if nodata is None else b.withField("nodata", F.lit(float(nodata)))
        lacking = b["nodata"].isNull() & b["data_type"].isin(integer)
        message = F.raise_error(F.lit("Integer raster needs a NoData value for clipping"))
        return b.withField("nodata", F.when(lacking, message.cast("double")).otherwise(b["nodata"]))

    return meta.withColumn("bands", F.transform("bands", band))


def _mask_batches(batches):
    for batch in batches:
        names = [n for n in batch.schema.names if n not in ("pixels", "edges")]
        rows, blocks = [], []
        edge_lists = batch.column("edges")
        whole = edge_lists.is_null().to_numpy(zero_copy_only=False)
        edges = list(pixel_blocks(batch, "edges"))
        for i, (row, pixels) in enumerate(zip(batch.select(names).to_pylist(), pixel_blocks(batch))):
            grid, w = Grid(*[row["grid"][n] for n in GRID_FIELDS]), row["window"]
            left, top = max(row["col0"], w["c0"]), max(row["row0"], w["r0"])
            n = min(row["col0"] + row["width"], w["c1"]) - left
            m = min(row["row0"] + row["height"], w["r1"]) - top
            if n <= 0 or m <= 0:
                continue
            x, y = left - row["col0"], top - row["row0"]
            block = pixels.reshape(row["height"], row["width"])[y : y + m, x : x + n]
            if not whole[i]:
                inside = covered(edges[i].reshape(-1, 4), grid.xs(left, n), grid.ys(top, m))
                block = np.where(inside, block, row["fills"][row["band"] - 1])
            rows.append(
                dict(
                    raster_id=row["_out"], level=0, band=row["band"],
                    tile_x=row["tile_x"] - (grid.off_x + w["c0"]) // grid.tile,
                    tile_y=row["tile_y"] - (grid.off_y + w["r0"]) // grid.tile,
                    col0=left - w["c0"], row0=top - w["r0"], width=n, height=m,
                )
            )
            blocks.append(block)
        if rows:
            yield tile_rows(rows, blocks)
