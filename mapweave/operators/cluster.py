"""Spatial clustering along a Hilbert curve and the packed R-tree.

Rows are range-partitioned by (Hilbert key, input order) and sorted inside the
partitions; a rank is the number of rows in earlier partitions plus the local
row number, so no window runs over the whole table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .vector import require_geometry

GRID_MAX = 65535
FAN_OUT = 16


def total_extent(df: DataFrame, geom: str):
    """(xmin, ymin, xmax, ymax) of a table, None when nothing has bounds."""
    g = F.col(geom)
    row = df.agg(F.min(g["xmin"]), F.min(g["ymin"]), F.max(g["xmax"]), F.max(g["ymax"])).first()
    return None if row[0] is None else tuple(row)


def grid_position(geom, extent) -> tuple[Column, Column]:
    """Envelope centre on the 16-bit grid of the extent."""
    g = F.col(geom) if isinstance(geom, str) else geom
    xmin, ymin, xmax, ymax = extent

    def scaled(low, high, start, size):
        if size == 0:
            return F.lit(0).cast("int")
        return F.floor(F.lit(float(GRID_MAX)) * ((low + high) / 2 - start) / size).cast("int")

    return scaled(g["xmin"], g["xmax"], xmin, xmax - xmin), scaled(g["ymin"], g["ymax"], ymin, ymax - ymin)


def hilbert_key(x: Column, y: Column) -> Column:
    """Key of a 16-bit position on the order-16 Hilbert curve.

    Each step takes one bit pair of the position and turns the frame.
    """
    full = F.lit(GRID_MAX)

    def step(state, bit):
        x, y = state["x"], state["y"]
        rx, ry = x.bitwiseAND(bit) > 0, y.bitwiseAND(bit) > 0
        quadrant = F.when(rx, F.when(ry, 2).otherwise(3)).otherwise(F.when(ry, 1).otherwise(0))
        # In the lower half the frame is transposed, and turned around on the
        # right.
        return F.struct(
            F.when(ry, x).when(rx, full - y).otherwise(y).alias("x"),
            F.when(ry, y).when(rx, full - x).otherwise(x).alias("y"),
            (state["d"] * 4 + quadrant).alias("d"),
        )

    start = F.struct(x.alias("x"), y.alias("y"), F.lit(0).cast("long").alias("d"))
    bits = F.array(*[F.lit(1 << b) for b in reversed(range(16))])
    return F.aggregate(bits, start, step, lambda state: state["d"])


def with_hilbert_key(df: DataFrame, geom: str, extent, name: str = "hilbert") -> DataFrame:
    return df.withColumn(name, hilbert_key(*grid_position(geom, extent)))


def ranked(df: DataFrame, order: list[str], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add the 0-based rank in the order of ``order``, whose values are unique.

    The sorted rows are checkpointed, so that partition sizes and row numbers
    stay the same if an executor is lost.
    """
    split = [partitions] if partitions else []
    rows = df.repartitionByRange(*split, *order).sortWithinPartitions(*order)
    # The id is the partition number in the upper bits and the row number below.
    rows = cut_lineage(rows.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_id"), 33)
    # One row per partition: as small as the number of shuffle partitions.
    sizes = rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, total = [], 0
    for row in sorted(sizes, key=lambda r: r["p"]):
        starts.append((row["p"], total))
        total += row["n"]
    prefix = df.sparkSession.createDataFrame(starts, "_p long, _start long")
    local = F.col("_id") - F.shiftleft(part, 33)
    return (
        rows.join(F.broadcast(prefix), part == F.col("_p"), "left")
        .withColumn(name, F.col("_start") + local)
        .drop("_id", "_p", "_start")
    )


def cluster_by_hilbert(
    df: DataFrame, geom: str, order_by: str, *, empty: str = "ERROR", partitions: int | None = None
) -> DataFrame:
    """Rows with ``hilbert`` and ``rank``, sorted along the curve.

    ``order_by`` is a unique column that stands for the input order and breaks
    ties.  NULL and EMPTY geometries are an error or, with ``SKIP``, left out.
    """
    require_geometry(df, geom)
    if empty not in ("ERROR", "SKIP"):
        raise ValueError("empty must be ERROR or SKIP")
    has = F.coalesce(F.col(geom)["xmin"].isNotNull(), F.lit(False))
    if empty == "SKIP":
        df = df.filter(has)
    else:
        stop = F.raise_error(F.lit("An index requires nonempty geometry; skip empty rows or do without index"))
        df = df.filter(F.when(has, F.lit(True)).otherwise(stop.cast("boolean")))
    extent = total_extent(df, geom)
    if extent is None:
        return df.withColumns({"hilbert": F.lit(None).cast("long"), "rank": F.lit(None).cast("long")})
    return ranked(with_hilbert_key(df, geom, extent), ["hilbert", order_by], "rank", partitions)


def prepare_unindexed(df: DataFrame, geom: str) -> DataFrame:
    """Without index EMPTY becomes NULL, with a warning."""
    g = F.col(geom)
    empty = g.isNotNull() & g["xmin"].isNull()
    note = F.array(F.struct(F.lit(geom).alias("field"), F.lit("empty_to_null").alias("cause")))
    return df.withColumns(
        {
            geom: F.when(~empty, g),
            "warnings": F.when(empty, note).otherwise(F.array().cast("array<struct<field:string,cause:string>>")),
        }
    )


def level_sizes(n: int) -> list[int]:
    """Nodes per level, leaves first; even one feature has a parent."""
    if n == 0:
        return []
    sizes = [n]
    while True:
        n = math.ceil(n / FAN_OUT)
        if n <= 1:
            return sizes + [1]
        sizes.append(n)


def packed_rtree(clustered: DataFrame, geom: str) -> DataFrame:
    """Nodes of the packed tree: ``level, node, xmin, ymin, xmax, ymax,
    children``.  Level 0 is one node per row in rank order; a node of level k
    is the envelope of the sixteen nodes below it.
    """
    g = F.col(geom)
    level = clustered.select(
        F.lit(0).alias("level"), F.col("rank").alias("node"), g["xmin"].alias("xmin"), g["ymin"].alias("ymin"),
        g["xmax"].alias("xmax"), g["ymax"].alias("ymax"), F.lit(0).cast("long").alias("children"),
    ).filter(F.col("node").isNotNull())
    (count,) = level.agg(F.count(F.lit(1))).first()
    tree = level
    for k in range(1, len(level_sizes(count))):
        level = level.groupBy(F.floor(F.col("node") / FAN_OUT).alias("node")).agg(
            F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"),
            F.max("ymax").alias("ymax"), F.count(F.lit(1)).alias("children"),
        ).withColumn("level", F.lit(k))
        if k == 1:
            # A sixteenth of the leaves; the levels above are read from here.
            level = cut_lineage(level)
        tree = tree.unionByName(level)
    return tree


#: inner nodes read by the driver, and rank ranges put into the leaf scan
SEARCH_NODES, SEARCH_RANGES = 4096, 64


def search_rtree(tree: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Ranks of the rows whose envelope meets the box.

    The hits of one upper level (a bounded number of nodes) give the ranges of
    ranks that can hold results.  The leaves are then read with these ranges
    and the box as predicates, so a table in rank order skips the rest.
    """
    meets = (F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin)
    sizes = {r["level"]: r["n"] for r in tree.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    leaves = tree.filter((F.col("level") == 0) & meets)
    small = [k for k, n in sizes.items() if k > 0 and n <= SEARCH_NODES]
    if small:
        level = min(small)
        hits = tree.filter((F.col("level") == level) & meets).select("node").collect()
        leaves = leaves.filter(_in_ranges([r["node"] for r in hits], FAN_OUT**level))
    return leaves.select(F.col("node").alias("rank"))


def _in_ranges(nodes: list[int], span: int) -> Column:
    """Predicate for the ranks below some nodes.  Beyond SEARCH_RANGES the
    smallest gaps are closed: more is read, but nothing is lost."""
    ranges: list[list[int]] = []
    for node in sorted(nodes):
        if ranges and ranges[-1][1] == node - 1:
            ranges[-1][1] = node
        else:
            ranges.append([node, node])
    if len(ranges) > SEARCH_RANGES:
        gaps = sorted(b[0] - a[1] for a, b in zip(ranges, ranges[1:]))
        limit = gaps[len(ranges) - SEARCH_RANGES - 1]
        merged = [ranges[0]]
        for low, high in ranges[1:]:
            if low - merged[-1][1] <= limit:
                merged[-1][1] = high
            else:
                merged.append([low, high])
        ranges = merged
    found = F.lit(False)
    for low, high in ranges:
        found = found | F.col("node").between(low * span, (high + 1) * span - 1)
    return found
