"""Relationship checks and the point-in-polygon join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import wkb as W
from ..functions.coverage import edges_of
from .rasters import arrow_type
from .skew import HotKeys
from .zonal import COVER_ROWS, nullable_lists

#: points of one cell that share a copy of the cell's polygons
POINTS_PER_CELL = 100_000


def join_relationship(origin: DataFrame, destination: DataFrame, origin_key: str, foreign_key: str, how="inner") -> DataFrame:
    """Origin rows with their destination rows."""
    return origin.join(destination, origin[origin_key] == destination[foreign_key], how)


def check_relationship(
    origin: DataFrame, destination: DataFrame, origin_key: str, foreign_key: str, cardinality: str = "ONE_TO_MANY"
) -> DataFrame:
    """Findings per kind with their number of keys and rows: ``DUPLICATE_KEY``
    (an origin key that is not unique), ``ORPHAN`` (a destination key without
    origin) and, for 1:1, ``DUPLICATE_REFERENCE``.

    Keys are counted before they are compared, so a frequent key is one row.
    """
    origins = origin.filter(F.col(origin_key).isNotNull()).groupBy(F.col(origin_key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    refs = destination.filter(F.col(foreign_key).isNotNull()).groupBy(F.col(foreign_key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    findings = [
        origins.filter("n > 1").select(F.lit("DUPLICATE_KEY").alias("finding"), "n"),
        refs.join(origins.select("k"), "k", "left_anti").select(F.lit("ORPHAN").alias("finding"), "n"),
    ]
    if cardinality == "ONE_TO_ONE":
        findings.append(refs.filter("n > 1").select(F.lit("DUPLICATE_REFERENCE").alias("finding"), "n"))
    rows = findings[0]
    for more in findings[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("finding").agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def spatial_join(
    points: DataFrame, point_geom: str, polygons: DataFrame, polygon_geom: str, cell: float, polygon_columns=()
) -> DataFrame:
    """Point rows with the columns of every polygon that covers them, the
    boundary included.

    Polygons are cut into square cells; a point meets only the polygons of its
    cell.  Cells wholly inside a polygon match without a test; elsewhere the
    exact test is a Catalyst expression over the few deciding edges.
    """
    columns = list(polygon_columns)
    cover = _cell_cover(
        polygons.filter(F.col(f"{polygon_geom}.xmin").isNotNull()).select(
            *columns,
            F.col(f"{polygon_geom}.wkb").alias("_wkb"),
            F.struct(*[F.col(f"{polygon_geom}.{n}").alias(n) for n in ("xmin", "ymin", "xmax", "ymax")]).alias("_box"),
        ),
        columns, float(cell),
    )
    p = points.filter(F.col(f"{point_geom}.xmin").isNotNull()).withColumns(
        {
            "_cx": F.floor(F.col(f"{point_geom}.xmin") / cell),
            "_cy": F.floor(F.col(f"{point_geom}.ymin") / cell),
        }
    )
    hot = HotKeys(p.select("_cx", "_cy"), ["_cx", "_cy"], POINTS_PER_CELL)
    left = hot.spread(p, F.col(point_geom)["xmin"], F.col(point_geom)["ymin"], *points.columns[:1])
    # never broadcast: the planner does not know how many rows a cover makes; the
    # merge spills where a cell has many polygons
    joined = left.join(hot.replicate(cover).hint("merge"), ["_cx", "_cy", "_part"])
    x, y = F.col(f"{point_geom}.xmin"), F.col(f"{point_geom}.ymin")
    inside = F.col("_edges").isNull() | (
        (x >= F.col("_box.xmin")) & (x <= F.col("_box.xmax")) & (y >= F.col("_box.ymin")) & (y <= F.col("_box.ymax"))
        & covers_point("_edges", x, y)
    )
    return joined.filter(inside).select(*points.columns, *columns)


def covers_point(edges: str, x, y):
    """Even-odd test with boundary over ``ARRAY<STRUCT<x1, y1, x2, y2>>``."""
    e = F.col(edges)

    def turn(s):
        return (s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"])

    on_edge = F.exists(
        e,
        lambda s: (turn(s) == 0)
        & x.between(F.least(s["x1"], s["x2"]), F.greatest(s["x1"], s["x2"]))
        & y.between(F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"])),
    )
    crossed = F.size(
        F.filter(
            e,
            lambda s: ((s["y1"] <= y) != (s["y2"] <= y)) & ((turn(s) > 0) == (s["y2"] > s["y1"])),
        )
    )
    return on_edge | (crossed % 2 == 1)


EDGE = T.StructType([T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")])


def _cell_cover(polygons: DataFrame, columns: list[str], cell: float) -> DataFrame:
    """Cells of each polygon with their deciding edges (NULL: all inside)."""
    kept = [polygons.schema[c] for c in columns] + [polygons.schema["_box"]]
    schema = T.StructType(
        kept
        + [T.StructField(n, T.LongType()) for n in ("_first", "_last", "_cy")]
        + [T.StructField("_flat", T.ArrayType(T.DoubleType()))]
    )
    target = arrow_type(schema)
    names = [f.name for f in kept]

    def flush(batch, rows, out):
        index = pa.array(rows, pa.int64())
        *cells, edges = zip(*out)
        data = [batch.column(n).take(index) for n in names]
        data += [*(pa.array(c, pa.int64()) for c in cells), nullable_lists(edges)]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(data, target)], schema=target)

    def expand(batches):
        for batch in batches:
            rows, out = [], []
            for i, data in enumerate(batch.column("_wkb").to_pylist()):
                for found in _cells(edges_of(W.read(data)), cell):
                    rows.append(i)
                    out.append(found)
                    if len(out) >= COVER_ROWS:
                        yield flush(batch, rows, out)
                        rows, out = [], []
            if out:
                yield flush(batch, rows, out)

    flat = polygons.mapInArrow(expand, schema)
    at = lambda i, k: F.element_at("_flat", i * 4 + k)
    edges = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("_flat") / 4).cast("int") - 1),
        lambda i: F.struct(
            at(i, 1).alias("x1"), at(i, 2).alias("y1"), at(i, 3).alias("x2"), at(i, 4).alias("y2")
        ),
    )
    with_edges = flat.withColumn("_edges", F.when(F.size("_flat") > 0, edges)).drop("_flat")
    # runs of inner cells are single rows until here
    return with_edges.withColumn("_cx", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")


def _cells(edges: np.ndarray, cell: float):
    """Cover of a polygon on the endless lattice of ``cell``: first and last
    column, row, and the deciding edges (None: all inside).

    A cell spans [i * cell, (i + 1) * cell).  Cells that an edge may meet come
    one by one; between them the cells of a row are all inside or all outside,
    so one test settles a run of any length.
    """
    low, high = edges[:, :2].min(axis=0), edges[:, :2].max(axis=0)
    first, last = np.floor(low / cell).astype(np.int64), np.floor(high / cell).astype(np.int64)
    xlo, xhi = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
    ylo, yhi = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    if (first == last).all():
        yield int(first[0]), int(first[0]), int(first[1]), edges
        return
    width = int(last[0] - first[0]) + 1
    # the columns each edge may meet, with room for rounding
    begin = np.clip(np.ceil(xlo / cell - 1e-9).astype(np.int64) - 1 - first[0], 0, width)
    end = np.clip(np.floor(xhi / cell + 1e-9).astype(np.int64) + 1 - first[0], 0, width)
    for cy in range(int(first[1]), int(last[1]) + 1):
        band = np.flatnonzero((ylo <= (cy + 1) * cell) & (yhi >= cy * cell))
        turns = np.zeros(width + 1, np.int64)
        np.add.at(turns, begin[band], 1)
        np.add.at(turns, end[band], -1)
        met = np.cumsum(turns[:-1]) > 0
        change = np.flatnonzero(np.diff(met)) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), width]):
            for cx in range(a, b) if met[a] else (a,):
                deciding = edges[band[xhi[band] >= (first[0] + cx) * cell - 1e-9 * cell]]
                x = int(first[0]) + cx
                if met[a]:
                    yield x, x, cy, deciding
                elif len(deciding) and _inside(deciding, (x + 0.5) * cell, (cy + 0.5) * cell):
                    yield x, int(first[0]) + b - 1, cy, None


def _inside(edges, x, y) -> bool:
    x1, y1, x2, y2 = edges.T
    turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    return bool((((y1 <= y) != (y2 <= y)) & ((turn > 0) == (y2 > y1))).sum() % 2)
