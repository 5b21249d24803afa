"""Zonal statistics: aggregate raster pixels by polygon.

Plan: every zone is turned into the tiles it touches, with only the edges that
decide each tile.  Zones are packed per tile into bounded lists, so a tile's
pixels travel to the kernel once per pack and not once per zone.  The kernel
returns one small partial row per zone and tile, and two grouped merges of
square-root fan-in combine them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import wkb as W
from ..functions.coverage import Grid, bounds_of, covered, edges_of, quarters, tile_cover
from ..functions.crs import in_raster_crs
from ..functions.geometry import col
from .rasters import (
    GRID_FIELDS,
    add_columns,
    arrow_type,
    join_meta,
    pixel_blocks,
    raster_row,
    tokens,
    valid_mask,
    with_row,
)
from .skew import HotKeys
from .tile_order import BLOCKS, ordered, under_shapes

STATISTICS = ("mean", "min", "max", "sum", "stddev", "count")
#: zones that share one copy of a tile's pixels
ZONES_PER_PACK = 512
#: tiles in the bounds of a zone from which on its cover is dealt out, and the
#: quarters of each round
SPLIT_TILES = 16_384
#: cover rows buffered before a batch is sent back to the JVM
COVER_ROWS = 4096

TILE_KEY = ["raster_id", "tile_x", "tile_y"]


def zonal_stats(
    zones: DataFrame,
    geom: str,
    meta: DataFrame,
    tiles: DataFrame,
    *,
    key,
    raster_id: str | None = None,
    stats="mean min max",
    band: int = 1,
    nodata: float | None = None,
    prefix: str = "raster_",
    crs=None,
) -> DataFrame:
    """Statistics of the valid pixels whose centre each polygon covers.

    ``key`` names the columns that identify a zone.  The raster is the literal
    ``raster_id`` or, without it, the zones' own ``raster_id`` column.  All
    attributes are kept; the statistics follow in the order given, then
    ``count`` if it was not among them, then ``status``.
    """
    key = [key] if isinstance(key, str) else list(key)
    names = _statistics(stats)
    cover = cover_zones(
        zones.select(*key, geom, *([] if raster_id else ["raster_id"])),
        geom, meta, key=key, raster_id=raster_id, crs=crs, band=band, nodata=nodata,
    )
    partials = tile_partials(cover, needed_tiles(tiles, cover.zones), key, band)
    totals = merge_partials(partials, key)
    return attach(zones, geom, totals, key, names, prefix)


def _statistics(stats) -> list[str]:
    names = tokens(stats)
    for name in names:
        if name not in STATISTICS:
            raise ValueError(f"Unknown statistic: {name}")
    return names if "count" in names else names + ["count"]


class ZoneCover:
    """Zones of one call, ready to be joined with tiles."""

    def __init__(self, zones: DataFrame, hot: HotKeys, cover: DataFrame):
        self.zones, self.hot, self.cover = zones, hot, cover


def zones_on_grid(zones, geom, meta, *, raster_id=None, crs=None, band=None, nodata=None) -> DataFrame:
    """Non-empty zones with the grid of their raster and their geometry in its
    CRS."""
    columns = {"grid": F.struct(*GRID_FIELDS), "_srid": F.col("srid")}
    if band is not None:
        columns["_bands"] = F.col("bands")
    fixed = None
    zones = zones.filter(F.col(geom)["xmin"].isNotNull())
    if raster_id is not None:
        wanted = meta.select(*[c.alias(n) for n, c in columns.items()])
        row = raster_row(meta.select("raster_id", *[c.alias(n) for n, c in columns.items()]), raster_id)
        fixed = row["_srid"]
        zones = with_row(zones, wanted, row)
    else:
        zones = join_meta(zones, meta, columns)
    zones = zones.withColumn("_geom", in_raster_crs(zones, geom, crs, F.col("_srid"), fixed))
    if band is not None:
        if nodata is not None and np.isinf(nodata):
            raise ValueError("Infinite NoData")
        if band < 1:
            raise ValueError("Bands are numbered from 1")
        declared = F.when(
            F.size("_bands") < band, F.raise_error(F.lit(f"Band {band} does not exist"))
        ).otherwise(F.element_at("_bands", band))
        zones = zones.withColumn("_band", declared).withColumn(
            "sample",
            F.struct(
                (F.col("_band.nodata") if nodata is None else F.lit(float(nodata))).alias("nodata"),
                F.coalesce("_band.scale", F.lit(1.0)).alias("scale"),
                F.coalesce("_band.offset", F.lit(0.0)).alias("offset"),
            ),
        ).drop("_band", "_bands")
    return zones.drop("_srid")


def tile_range(low, high, origin, step, cells, size, off):
    """First and last tile that may hold a centre between two coordinates."""
    a, b = (low - origin) / step, (high - origin) / step
    first = F.greatest(F.floor(F.least(a, b) - 1), F.lit(0))
    last = F.least(F.ceil(F.greatest(a, b) + 1), cells - 1)
    return F.floor((first + off) / size).cast("int"), F.floor((last + off) / size).cast("int"), first <= last


def tile_spans(zones: DataFrame) -> DataFrame:
    """``raster_id`` and the tile numbers ``x0``, ``x1``, ``y0``, ``y1`` in the
    bounds of each zone, known without reading a shape; NULL beyond the raster."""
    # Bounds first, each used once: what builds the shape is pruned away.
    zones = zones.select("raster_id", "grid", *[F.col(f"_geom.{n}").alias(f"_{n}") for n in ("xmin", "ymin", "xmax", "ymax")])
    g = F.col("grid")
    x0, x1, in_x = tile_range(
        F.col("_xmin"), F.col("_xmax"), g["origin_x"], g["pixel_x"], g["width"], g["tile_size"], g["off_x"]
    )
    y0, y1, in_y = tile_range(
        F.col("_ymin"), F.col("_ymax"), g["origin_y"], g["pixel_y"], g["height"], g["tile_size"], g["off_y"]
    )
    inside = in_x & in_y
    spans = {"x0": x0, "x1": x1, "y0": y0, "y1": y1}
    return zones.select("raster_id", "grid", *[F.when(inside, c).alias(n) for n, c in spans.items()])


def touched_tiles(zones: DataFrame) -> DataFrame:
    """Tile keys in the bounds of each zone: the load per tile."""
    spans = tile_spans(zones).select("raster_id", F.sequence("x0", "x1").alias("xs"), F.sequence("y0", "y1").alias("ys"))
    # The outer form keeps the planner from copying the range expressions into
    # a filter on the scan.
    return (
        spans.select("raster_id", "xs", F.explode_outer("ys").alias("tile_y"))
        .select("raster_id", F.explode_outer("xs").alias("tile_x"), "tile_y")
        .filter(F.col("tile_x").isNotNull())
    )


def needed_tiles(tiles: DataFrame, zones: DataFrame) -> DataFrame:
    """The tiles that lie under the zones (as :func:`zones_on_grid` gives them),
    if the tiles are numbered so that a scan can skip the others."""
    if not ordered(tiles):
        return tiles
    g = F.col("grid")
    side = F.greatest((g["width"] + g["off_x"]) / g["tile_size"], (g["height"] + g["off_y"]) / g["tile_size"])
    shift = F.greatest(F.ceil(F.log2(F.ceil(side + 1) / BLOCKS)), F.lit(0)).cast("int")
    spans = tile_spans(zones).filter("x0 IS NOT NULL").select("raster_id", "x0", "x1", "y0", "y1", shift.alias("shift"))
    return under_shapes(tiles, spans)


def cover_zones(zones, geom, meta, *, key, raster_id=None, crs=None, band=1, nodata=None) -> ZoneCover:
    ready = zones_on_grid(zones, geom, meta, raster_id=raster_id, crs=crs, band=band, nodata=nodata)
    ready = ready.select(*key, "raster_id", "grid", "sample", "_geom")
    hot = HotKeys(touched_tiles(ready), TILE_KEY, ZONES_PER_PACK)
    return ZoneCover(ready, hot, cover_tiles(ready.withColumn("wkb", F.col("_geom.wkb")).drop("_geom"), key, most_tiles(ready)))


def cover_tiles(zones: DataFrame, key: list[str], biggest: int | None = None) -> DataFrame:
    """One row per zone and touched tile: the deciding edges (NULL when the
    tile is wholly covered), the position in the zone's tiles and their number.

    Zones over more than :data:`SPLIT_TILES` tiles are cut into quarters first, a
    round at a time, and the quarters are dealt out again, each with the edges
    near it.  ``biggest``: the tiles in the bounds of the largest zone.
    """
    rounds = 0
    while biggest is not None and biggest > SPLIT_TILES * 4**rounds:
        rounds += 1
    carried = [f for f in zones.schema.fields if f.name != "wkb"]
    schema = T.StructType(
        carried
        + [
            T.StructField("tile_x", T.IntegerType()),
            T.StructField("tile_y", T.IntegerType()),
            T.StructField("tile_no", T.LongType()),
            T.StructField("edges", T.ArrayType(T.DoubleType())),
            T.StructField("cut", T.BooleanType()),
        ]
    )
    target = arrow_type(schema)
    names = [f.name for f in carried]
    zones = _quartered(zones, rounds) if rounds else zones

    def pieces(batch, i, lattice, data):
        """(number, tile_x, tile_y, edges, cut) of a zone or a part of it."""
        if data is not None:
            yield from ((no, *found) for no, found in enumerate(tile_cover(edges_of(W.read(data)), lattice)))
            return
        window, whole, cut = batch.column("_window")[i].as_py(), batch.column("_whole")[i].as_py(), batch.column("_cut")[i].as_py()
        edges = None if whole else batch.column("_edges")[i].values.to_numpy().reshape(-1, 4)
        x0, y0, across = batch.column("_zone")[i].as_py()
        for tx, ty, *found in tile_cover(edges, lattice, tuple(window), cut):
            yield ((ty - y0) * across + tx - x0, tx, ty, *found)

    def expand(batches):
        for batch in batches:
            grids = _grids(batch.column("grid"))
            rows, out = [], []
            for i, (lattice, data) in enumerate(zip(grids, batch.column("wkb").to_pylist())):
                for found in pieces(batch, i, lattice, data):
                    rows.append(i)
                    out.append(found)
                    if len(out) >= COVER_ROWS:
                        yield _cover_batch(batch, names, rows, out, target)
                        rows, out = [], []
            if out:
                yield _cover_batch(batch, names, rows, out, target)

    return zones.mapInArrow(expand, schema)


# Parts of a zone: a window of tiles (x0, y0, x1, y1), the edges near it (or
# ``_whole``), and the first tile and the tiles across of the zone itself.
_PART = "_window array<int>, _whole boolean, _cut boolean, _zone array<long>, _edges array<double>"


def _quartered(zones: DataFrame, rounds: int) -> DataFrame:
    """Zones in parts of few tiles; a zone that needs no cutting keeps its
    ``wkb``.  Every round deals the parts out anew."""
    fields = [f for f in zones.schema.fields if f.name != "wkb"]
    part = T.StructType.fromDDL(_PART)
    schema = T.StructType([*fields, T.StructField("wkb", T.BinaryType()), *part])
    target = arrow_type(schema)
    names = [f.name for f in fields]
    tasks = int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def small(window) -> bool:
        return (window[2] - window[0] + 1) * (window[3] - window[1] + 1) <= SPLIT_TILES

    def cut_in_four(batches):
        for batch in batches:
            shapes, grids = batch.column("wkb").to_pylist(), list(_grids(batch.column("grid")))
            for i, data in enumerate(shapes):
                keep = batch.select(names).slice(i, 1)
                for row in _quarter_rows(batch, i, data, grids[i], small):
                    columns = [*keep.columns, *(pa.array([v], f.type) for v, f in zip(row, list(target)[len(names) :]))]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)

    parts = zones.select(*names, "wkb", *[F.lit(None).cast(f.dataType).alias(f.name) for f in part])
    for _ in range(rounds):
        parts = parts.mapInArrow(cut_in_four, schema)
        # a part goes by its place, so that the parts of one zone are spread
        parts = parts.repartition(tasks, "_window", "_zone")
    return parts


def _quarter_rows(batch, i, data, grid, small):
    if data is not None:
        edges = edges_of(W.read(data))
        window = grid.tiles(bounds_of(edges)) if len(edges) else None
        if window is None or small(window):
            yield data, None, None, None, None, None
            return
        zone, cut = [window[0], window[1], window[2] - window[0] + 1], False
    else:
        window, zone, cut = tuple(batch.column("_window")[i].as_py()), batch.column("_zone")[i].as_py(), batch.column("_cut")[i].as_py()
        edges = None if batch.column("_whole")[i].as_py() else batch.column("_edges")[i].values.to_numpy().reshape(-1, 4)
        if small(window):
            yield None, list(window), edges is None, cut, zone, None if edges is None else edges.ravel()
            return
    for near, place, left_out in quarters(edges, grid, window, cut):
        yield None, list(place), near is None, left_out, zone, None if near is None else near.ravel()


def most_tiles(zones: DataFrame) -> int:
    """Tiles in the bounds of the largest zone, known without reading a shape."""
    tiles = (F.col("x1") - F.col("x0") + 1).cast("long") * (F.col("y1") - F.col("y0") + 1)
    return tile_spans(zones).agg(F.max(tiles)).first()[0] or 0


def _grids(column):
    """One Grid per row; equal rows share it."""
    cache = {}
    fields = [column.field(n).to_pylist() for n in GRID_FIELDS]
    for row in zip(*fields):
        lattice = cache.get(row)
        if lattice is None:
            lattice = cache[row] = Grid(*row)
        yield lattice


def _cover_batch(batch, names, rows, out, schema):
    index = pa.array(rows, pa.int64())
    no, tx, ty, edges, cut = zip(*out)
    columns = [batch.column(n).take(index) for n in names]
    columns += [pa.array(tx, pa.int32()), pa.array(ty, pa.int32()), pa.array(no, pa.int64())]
    columns += [nullable_lists(edges), pa.array(cut, pa.bool_())]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def nullable_lists(blocks) -> pa.Array:
    """ListArray of doubles with NULL for None."""
    sizes = [0 if b is None else b.size for b in blocks]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    filled = [b.ravel() for b in blocks if b is not None]
    flat = np.concatenate(filled) if filled else np.empty(0)
    mask = pa.array([b is None for b in blocks])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.float64()), mask=mask)


def pack_zones(cover: ZoneCover, key: list[str], context: list[str]) -> DataFrame:
    """Per tile lists of zones, of bounded length."""
    spread = cover.hot.spread(cover.cover, *key)
    zone = F.struct(*[F.col(k) for k in key], "tile_no", "edges", "cut")
    return spread.groupBy(*TILE_KEY, "_part").agg(
        F.collect_list(zone).alias("zones"), *[F.first(c).alias(c) for c in context]
    )


def join_packs(hot: HotKeys, packs: DataFrame, tiles: DataFrame, band: int | None) -> DataFrame:
    """Tiles with the packs that need them.  A tile with many packs is copied
    once per part, so that its packs go to different tasks.  The packs are never
    broadcast: the planner does not know how many rows a cover makes."""
    base = tiles.filter(F.col("level") == 0)
    if band is not None:
        base = base.filter(F.col("band") == band)
    return hot.replicate(base).join(packs.hint("shuffle_hash"), [*TILE_KEY, "_part"]).drop("_part")


def tile_partials(cover: ZoneCover, tiles: DataFrame, key: list[str], band: int) -> DataFrame:
    packs = pack_zones(cover, key, ["grid", "sample"])
    joined = join_packs(cover.hot, packs, tiles, band).select(
        "col0", "row0", "width", "height", "pixels", "grid", "sample", "zones"
    )
    key_fields = [cover.cover.schema[k] for k in key]
    schema = T.StructType(
        key_fields
        + [T.StructField("tile_no", T.LongType()), T.StructField("n", T.LongType())]
        + [T.StructField(n, T.DoubleType()) for n in ("mean", "m2", "sum", "min", "max")]
    )
    target = arrow_type(schema)

    def measure(batches):
        for batch in batches:
            rows = batch.select(["col0", "row0", "width", "height", "grid", "sample"]).to_pylist()
            packed = batch.column("zones")
            for i, (row, pixels) in enumerate(zip(rows, pixel_blocks(batch))):
                zones = packed[i].values
                grid = Grid(*[row["grid"][n] for n in GRID_FIELDS])
                found = list(_zone_moments(row, pixels, zones, grid))
                if not found:
                    continue
                index = pa.array([f[0] for f in found], pa.int64())
                columns = [zones.field(k).take(index) for k in key] + [zones.field("tile_no").take(index)]
                columns += [pa.array([f[1 + j] for f in found]) for j in range(6)]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, target)], schema=target
                )

    return joined.mapInArrow(measure, schema)


def _zone_moments(row, pixels, zones, grid):
    """(index, n, mean, m2, sum, min, max) of each zone with valid pixels."""
    sample = row["sample"]
    block = pixels.reshape(row["height"], row["width"])
    usable = valid_mask(block, sample["nodata"])
    values = block * sample["scale"] + sample["offset"]
    xs, ys = grid.xs(row["col0"], row["width"]), grid.ys(row["row0"], row["height"])
    whole = None
    lists = zones.field("edges")
    flat = lists.values.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    absent = lists.is_null().to_numpy(zero_copy_only=False)
    cut = zones.field("cut").to_numpy(zero_copy_only=False)
    for i in range(len(lists)):
        if absent[i]:
            if whole is None:
                whole = moments(values[usable])
            found = whole
        else:
            edges = flat[offsets[i] : offsets[i + 1]].reshape(-1, 4)
            found = moments(_inside(edges, cut[i], xs, ys, values, usable))
        if found:
            yield (i, *found)


def _inside(edges, cut, xs, ys, values, usable):
    """Valid pixels under the polygon, looking only at its rows and columns."""
    low, high = edges[:, [1, 3]].min(), edges[:, [1, 3]].max()
    rows = np.flatnonzero((ys >= low) & (ys <= high))
    left, right = edges[:, [0, 2]].min(), edges[:, [0, 2]].max()
    near = xs <= right
    if not cut:
        near &= xs >= left
    cols = np.flatnonzero(near)
    if not len(rows) or not len(cols):
        return values[:0, 0]
    window = slice(rows[0], rows[-1] + 1), slice(cols[0], cols[-1] + 1)
    mask = covered(edges, xs[window[1]], ys[window[0]]) & usable[window]
    return values[window][mask]


def moments(values: np.ndarray):
    if not len(values):
        return None
    mean = float(values.mean())
    return (
        len(values), mean, float(((values - mean) ** 2).sum()), float(values.sum()),
        float(values.min()), float(values.max()),
    )


def _merge(parts):
    """Chan's merge of (n, mean, m2) partials in a fixed order."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(a, b):
        n = a["n"] + b["n"]
        delta = b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + delta * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / n).alias("m2"),
        )

    return F.aggregate(F.array_sort(parts), zero, step)


def _grouped(partials: DataFrame, keys: list[str], order: str) -> DataFrame:
    parts = F.collect_list(F.struct(order, "n", "mean", "m2", "sum"))
    merged = partials.groupBy(*keys).agg(
        parts.alias("_parts"), F.min("min").alias("min"), F.max("max").alias("max")
    )
    total = F.aggregate(F.array_sort("_parts"), F.lit(0.0), lambda a, b: a + b["sum"])
    merged = merged.withColumn("_m", _merge(F.col("_parts"))).withColumn("sum", total)
    return merged.select(
        *keys, F.col("_m.n").alias("n"), F.col("_m.mean").alias("mean"), F.col("_m.m2").alias("m2"),
        "sum", "min", "max",
    )


def merge_partials(partials: DataFrame, key: list[str]) -> DataFrame:
    """Merge in two steps, so that no group collects all tiles of a zone.

    Up to 1024 tiles form one bucket; beyond that a bucket holds the tile
    numbers with the same integer square root.  With n tiles no bucket has more
    than 2 * sqrt(n) rows and there are at most sqrt(n) buckets.
    """
    no = F.col("tile_no")
    bucket = F.when(no < 1024, F.lit(0)).otherwise(F.floor(F.sqrt(no.cast("double")))).cast("long")
    first = _grouped(partials.withColumn("_bucket", bucket), [*key, "_bucket"], "tile_no")
    return _grouped(first, key, "_bucket")


def attach(zones, geom, totals, key, names, prefix) -> DataFrame:
    g = col(geom)
    side = totals.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.struct("n", "mean", "m2", "sum", "min", "max").alias("_s"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key])
    joined = zones.join(side, same, "left").drop(*[f"_k_{k}" for k in key])
    s = F.col("_s")
    found = {
        "mean": s["mean"],
        "min": s["min"],
        "max": s["max"],
        "sum": s["sum"],
        "stddev": F.sqrt(s["m2"] / s["n"]),
        "count": F.coalesce(s["n"], F.lit(0).cast("long")),
    }
    status = (
        F.when(g.isNull() | g["xmin"].isNull(), "EMPTY_GEOMETRY")
        .when(s["n"].isNull(), "NO_VALID_PIXELS")
        .otherwise("OK")
    )
    new = {prefix + n: found[n] for n in names}
    new[prefix + "status"] = status
    return add_columns(joined, new).drop("_s")
