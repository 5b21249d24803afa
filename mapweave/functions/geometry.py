"""The geometry column and its column functions.

A geometry is ``STRUCT<wkb, srid, xmin, ymin, xmax, ymax>``.  The bounds are
plain doubles, so envelope predicates stay in Catalyst and reach the Parquet
statistics.  NULL is a null struct; EMPTY has a ``wkb`` and null bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wkb as W

GEOMETRY = T.StructType(
    [T.StructField("wkb", T.BinaryType()), T.StructField("srid", T.IntegerType())]
    + [T.StructField(name, T.DoubleType()) for name in ("xmin", "ymin", "xmax", "ymax")]
)
BOUNDS = T.StructType(GEOMETRY.fields[2:])
ARROW_GEOMETRY = pa.struct(
    [("wkb", pa.binary()), ("srid", pa.int32())] + [(n, pa.float64()) for n in BOUNDS.names]
)


NO_BOX = (None,) * 4


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c if isinstance(c, Column) else F.lit(c)).cast("double")


def geometry_field(geom: Column, name: str, srid: int, **schema) -> Column:
    """Geometry column that declares its schema (SRID, type, z, m) in the
    field metadata, so that plans can rely on it."""
    return geom.alias(name, metadata={"srid": srid, **schema})


def declared_srid(df, name: str) -> int | None:
    """SRID declared by a geometry column, None when it is not declared."""
    return df.schema[name].metadata.get("srid")


def arrow_geometries(rows) -> pa.Array:
    """Struct array from (Shape, srid) pairs; None gives NULL."""
    data, srids, boxes = [], [], []
    for row in rows:
        if row is None:
            data.append(None)
            srids.append(None)
            boxes.append(NO_BOX)
        else:
            data.append(W.write(row[0]))
            srids.append(row[1])
            boxes.append(W.envelope(row[0]) or NO_BOX)
    columns = list(zip(*boxes)) if boxes else [()] * 4
    arrays = [pa.array(data, pa.binary()), pa.array(srids, pa.int32())]
    arrays += [pa.array(c, pa.float64()) for c in columns]
    return pa.StructArray.from_arrays(
        arrays, fields=list(ARROW_GEOMETRY), mask=pa.array([d is None for d in data], pa.bool_())
    )


def shapes(array: pa.Array):
    """Iterate a geometry struct array as (Shape, srid) or None."""
    for data, srid, valid in zip(
        array.field("wkb").to_pylist(), array.field("srid").to_pylist(), array.is_valid().to_pylist()
    ):
        yield (W.read(data), srid or 0) if valid and data is not None else None


def _floats(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False).astype(float)


def _null_mask(*arrays) -> np.ndarray:
    mask = np.zeros(len(arrays[0]), dtype=bool)
    for a in arrays:
        mask |= a.is_null().to_numpy(zero_copy_only=False)
    return mask


@F.arrow_udf(T.BinaryType())
def _point_wkb(x: pa.Array, y: pa.Array) -> pa.Array:
    return W.points(_floats(x), _floats(y), _null_mask(x, y))


@F.arrow_udf(T.BinaryType())
def _box_wkb(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    return W.boxes(*map(_floats, (x0, y0, x1, y1)), _null_mask(x0, y0, x1, y1))


@F.arrow_udf(T.BinaryType())
def _triangle_wkb(
    x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array
) -> pa.Array:
    args = (x0, y0, x1, y1, x2, y2)
    return W.triangles(*map(_floats, args), _null_mask(*args))


def _struct(data, srid, xmin, ymin, xmax, ymax) -> Column:
    srid = srid if isinstance(srid, Column) else F.lit(srid)
    return F.struct(
        data.alias("wkb"),
        srid.cast("int").alias("srid"),
        xmin.alias("xmin"),
        ymin.alias("ymin"),
        xmax.alias("xmax"),
        ymax.alias("ymax"),
    )


def st_point(x, y, srid=0) -> Column:
    """Point from two numeric columns; NULL when a coordinate is NULL."""
    x, y = _number(x), _number(y)
    return F.when((x + y).isNotNull(), _struct(_point_wkb(x, y), srid, x, y, x, y))


def st_box(x0, y0, x1, y1, srid=0) -> Column:
    """Rectangle from its corners; the corners must be ordered."""
    c = [_number(v) for v in (x0, y0, x1, y1)]
    return F.when((c[0] + c[1] + c[2] + c[3]).isNotNull(), _struct(_box_wkb(*c), srid, *c))


def st_triangle(x0, y0, x1, y1, x2, y2, srid=0) -> Column:
    c = [_number(v) for v in (x0, y0, x1, y1, x2, y2)]
    xs, ys = c[0::2], c[1::2]
    return _struct(
        _triangle_wkb(*c), srid, F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)
    )


@F.arrow_udf(T.StructType([T.StructField("error", T.StringType())] + BOUNDS.fields))
def _inspect(data: pa.Array) -> pa.Array:
    rows = []
    for item in data.to_pylist():
        if item is None:
            rows.append(None)
            continue
        try:
            box = W.envelope(W.read(item)) or (None,) * 4
            rows.append({"error": None, **dict(zip(BOUNDS.names, box))})
        except W.WkbError as e:
            rows.append({"error": str(e)})
    return pa.array(rows, pa.struct([("error", pa.string())] + [(n, pa.float64()) for n in BOUNDS.names]))


def st_geomfromwkb(data, srid=0) -> Column:
    """Geometry from ISO WKB of either byte order; invalid bytes stop the job."""
    data = col(data)
    found = _inspect(data)
    checked = F.when(found["error"].isNotNull(), F.raise_error(found["error"]).cast("binary")).otherwise(data)
    return F.when(data.isNotNull(), _struct(checked, srid, *[found[n] for n in BOUNDS.names]))


def validate_wkb(data) -> Column:
    """Error text of an ISO WKB value, NULL when it is valid or NULL."""
    return _inspect(col(data))["error"]


def st_isempty(geom) -> Column:
    g = col(geom)
    return F.when(g.isNotNull(), g["xmin"].isNull())


def st_envelope(geom) -> Column:
    """Bounds struct; NULL for NULL and EMPTY."""
    g = col(geom)
    return F.when(g["xmin"].isNotNull(), F.struct(*[g[n].alias(n) for n in BOUNDS.names]))


def _type_code(geom) -> Column:
    head = F.hex(F.substring(col(geom)["wkb"], 1, 5))
    little = F.concat(*[F.substring(head, i, 2) for i in (9, 7, 5, 3)])
    return F.conv(F.when(head.startswith("00"), F.substring(head, 3, 8)).otherwise(little), 16, 10).cast("int")


def st_type(geom) -> Column:
    """Upper-case geometry type name, read from the WKB header only."""
    names = F.array(*[F.lit(W.NAMES[i]) for i in sorted(W.NAMES)])
    return F.get(names, _type_code(geom) % 1000 - 1)


def st_hasz(geom) -> Column:
    return F.floor(_type_code(geom) / 1000).isin(1, 3)


def st_hasm(geom) -> Column:
    return F.floor(_type_code(geom) / 1000).isin(2, 3)


def assign_crs(geom, crs) -> Column:
    """Declare the CRS; coordinates never move."""
    code = parse_crs(crs)
    g = col(geom)
    return F.when(g.isNotNull(), g.withField("srid", F.lit(code)))


def parse_crs(crs) -> int:
    """SRID of blank, ``EPSG:n`` or ``n``.  WKT has no number and gives 0."""
    text = str(crs if crs is not None else "").strip()
    if text.upper().startswith("EPSG:"):
        text = text[5:].strip()
        if not text.isdigit():
            raise ValueError(f"Invalid CRS: {crs}")
    return int(text) if text.isdigit() else 0


@F.arrow_udf(GEOMETRY)
def _linearize(geom: pa.Array, tolerance: pa.Array) -> pa.Array:
    steps = tolerance.to_pylist()
    return arrow_geometries(
        item and (W.linearize(item[0], step), item[1]) for item, step in zip(shapes(geom), steps)
    )


def linearize(geom, tolerance: float) -> Column:
    """Replace arcs by chords within ``tolerance``; other shapes stay equal."""
    return _linearize(col(geom), F.lit(float(tolerance)))


@F.arrow_udf(GEOMETRY)
def _snap(geom: pa.Array, x0: pa.Array, y0: pa.Array, step: pa.Array) -> pa.Array:
    def one(item, ox, oy, r):
        def move(block):
            block = block.copy()
            block[:, 0] = np.round((block[:, 0] - ox) / r) * r + ox
            block[:, 1] = np.round((block[:, 1] - oy) / r) * r + oy
            return block

        return item and (W.map_coords(item[0], move), item[1])

    return arrow_geometries(
        one(*row) for row in zip(shapes(geom), x0.to_pylist(), y0.to_pylist(), step.to_pylist())
    )


def snap_to_grid(geom, precision) -> Column:
    """Move X and Y to the grid of an ``XYPrecision``."""
    return _snap(
        col(geom),
        F.lit(float(precision.x_origin)),
        F.lit(float(precision.y_origin)),
        F.lit(float(precision.resolution)),
    )


def densify_box(xmin, ymin, xmax, ymax) -> Column:
    """Vertices of a box whose edges are cut into pieces of at most a
    hundredth of the longer side, as ``ARRAY<STRUCT<x, y>>``."""
    x0, y0, x1, y1 = (_number(v) for v in (xmin, ymin, xmax, ymax))
    step = F.greatest(x1 - x0, y1 - y0) / 100

    def edge(ax, ay, bx, by):
        n = F.greatest(F.ceil((F.abs(bx - ax) + F.abs(by - ay)) / step), F.lit(1)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct((ax + (bx - ax) * i / n).alias("x"), (ay + (by - ay) * i / n).alias("y")),
        )

    return F.concat(
        edge(x0, y0, x1, y0), edge(x1, y0, x1, y1), edge(x1, y1, x0, y1), edge(x0, y1, x0, y0),
        F.array(F.struct(x0.alias("x"), y0.alias("y"))),
    )


def to_iso_wkb(geom, z: bool | None = None, m: bool | None = None) -> Column:
    """Big-endian ISO WKB.  ``z`` / ``m`` force an ordinate on (NaN where it
    is missing) or off; None keeps what the geometry has."""

    @F.arrow_udf(T.BinaryType())
    def encode(array: pa.Array) -> pa.Array:
        return pa.array(
            [item and W.write(with_dimension(item[0], z, m)) for item in shapes(array)], pa.binary()
        )

    return encode(col(geom))


def with_dimension(shape: W.Shape, z, m) -> W.Shape:
    """Copy with the wanted ordinates; added ones are NaN."""
    z, m = shape.z if z is None else z, shape.m if m is None else m
    if (z, m) == (shape.z, shape.m):
        return shape

    def convert(block):
        pad = np.full(len(block), np.nan)
        columns = [block[:, 0], block[:, 1]]
        if z:
            columns.append(block[:, 2] if shape.z else pad)
        if m:
            columns.append(block[:, 2 + shape.z] if shape.m else pad)
        return np.column_stack(columns)

    def walk(s):
        if s.kind != W.POLYGON and isinstance(s.parts, list):
            return W.Shape(s.kind, z, m, [walk(p) for p in s.parts])
        if s.kind == W.POLYGON:
            return W.Shape(s.kind, z, m, [convert(r) for r in s.parts])
        return W.Shape(s.kind, z, m, convert(s.parts))

    return walk(shape)


def register(spark: SparkSession) -> None:
    """Make the bounds functions visible to SQL.  They are SQL functions, so
    Catalyst inlines them."""
    kind = GEOMETRY.simpleString()
    for name, result, body in (
        ("st_isempty", "BOOLEAN", "IF(g IS NULL, NULL, g.xmin IS NULL)"),
        ("st_minx", "DOUBLE", "g.xmin"),
        ("st_miny", "DOUBLE", "g.ymin"),
        ("st_maxx", "DOUBLE", "g.xmax"),
        ("st_maxy", "DOUBLE", "g.ymax"),
    ):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(g {kind}) RETURNS {result} RETURN {body}"
        )
