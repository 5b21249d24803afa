"""Envelope filter, geometry schema, conforming, extent and precision."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import wkb as W
from ..functions.geometry import (
    ARROW_GEOMETRY, GEOMETRY, arrow_geometries, col, parse_crs, shapes, st_hasm, st_hasz, st_type,
    with_dimension,
)
from .errors import ERROR


def has_geometry(df: DataFrame, name: str) -> bool:
    if name not in df.columns:
        return False
    kind = df.schema[name].dataType
    return isinstance(kind, T.StructType) and kind.names == GEOMETRY.names


def require_geometry(df: DataFrame, name: str) -> None:
    if not has_geometry(df, name):
        raise ValueError(f"Geometry column required: {name}")


def filter_bbox(df: DataFrame, geom: str, xmin=None, ymin=None, xmax=None, ymax=None) -> DataFrame:
    """Rows whose envelope meets the box, all bounds inclusive.

    All four bounds or none must be given.  The predicate uses the stored
    bounds, so a Parquet scan skips row groups by their statistics.
    """
    given = [xmin, ymin, xmax, ymax]
    if all(v is None for v in given):
        return df
    if any(v is None for v in given):
        raise ValueError("Specify all four bounds")
    require_geometry(df, geom)
    x0, y0, x1, y1 = (float(v) for v in given)
    if not all(math.isfinite(v) for v in (x0, y0, x1, y1)) or x0 > x1 or y0 > y1:
        raise ValueError("Invalid query bounds")
    g = F.col(geom)
    return df.filter((g["xmin"] <= x1) & (g["xmax"] >= x0) & (g["ymin"] <= y1) & (g["ymax"] >= y0))


@dataclass(frozen=True)
class GeometrySchema:
    """Declared geometry of a layer; Z and M are ABSENT, REQUIRED or OPTIONAL."""

    type: str
    z: str = "ABSENT"
    m: str = "ABSENT"
    srid: int = 0

    @property
    def dimension(self) -> str:
        return "XY" + ("Z" if self.z != "ABSENT" else "") + ("M" if self.m != "ABSENT" else "")

    @staticmethod
    def explicit(kind: str, dimension: str, crs=0) -> "GeometrySchema":
        if dimension not in ("XY", "XYZ", "XYM", "XYZM"):
            raise ValueError(f"Invalid coordinate dimension: {dimension}")
        kind = {"LINE": "LINESTRING", "POLYLINE": "LINESTRING"}.get(kind.upper(), kind.upper())
        if kind not in W.CODES:
            raise ValueError(f"Explicit geometry type not supported: {kind}")
        return GeometrySchema(
            kind, "REQUIRED" if "Z" in dimension else "ABSENT",
            "OPTIONAL" if "M" in dimension else "ABSENT", parse_crs(crs),
        )


@F.arrow_udf(T.BooleanType())
def _finite_z(data: pa.Array) -> pa.Array:
    out = []
    for item in data.to_pylist():
        blocks = [] if item is None else [b for _, b in W.leaves(W.read(item))]
        out.append(any((~np.isnan(b[:, 2])).any() for b in blocks))
    return pa.array(out, pa.bool_())


def geometry_profile(df: DataFrame, geom: str) -> DataFrame:
    """Features per type, ordinates and SRID; NULL and EMPTY are counted apart.

    Only shapes whose header announces Z are read to see whether any Z is set.
    """
    require_geometry(df, geom)
    g = F.col(geom)
    data = df.select(
        F.when(g.isNull(), "NULL").when(g["xmin"].isNull(), "EMPTY").otherwise("VALUE").alias("content"),
        st_type(g).alias("type"),
        F.when(st_hasz(g), _finite_z(F.when(st_hasz(g), g["wkb"]))).otherwise(F.lit(False)).alias("z"),
        F.coalesce(st_hasm(g), F.lit(False)).alias("m"),
        g["srid"].alias("srid"),
    )
    return data.groupBy("content", "type", "z", "m", "srid").agg(F.count(F.lit(1)).alias("n"))


def infer_geometry_schema(df, geom: str, type=None, dimension=None, crs=None) -> GeometrySchema | None:
    """Schema from one aggregate over all features.

    An explicit type needs an explicit dimension.  No features without an
    explicit type give None; only NULL or EMPTY ones are an error.  A single
    type and its multi type together infer the multi type; other mixtures and
    different known SRIDs are errors.
    """
    if type not in (None, "", "AUTO"):
        if dimension in (None, "", "AUTO"):
            raise ValueError("Explicit geometry type requires explicit dimension")
        return GeometrySchema.explicit(type, dimension, crs or 0)
    value = F.col("content") == "VALUE"
    known = F.when(value & (F.col("srid") != 0), F.col("srid"))
    # one row, whatever the number of combinations; there are few types
    found = geometry_profile(df, geom).agg(
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(F.when(value, F.col("type"))).alias("types"),
        F.max(F.when(value, F.col("z"))).alias("z"),
        F.max(F.when(value, F.col("m"))).alias("m"),
        F.min(known).alias("low"),
        F.max(known).alias("high"),
    ).first()
    if not found["rows"]:
        return None
    if not found["types"]:
        raise ValueError("Every geometry is null or empty, so the type is unknown")
    kinds = set(found["types"])
    kind = kinds.pop() if len(kinds) == 1 else _common_type(kinds)
    if crs not in (None, ""):
        srid = parse_crs(crs)
    elif found["low"] != found["high"]:
        raise ValueError(f"Different SRIDs in one layer, from {found['low']} to {found['high']}")
    else:
        srid = found["low"] or 0
    if dimension not in (None, "", "AUTO"):
        return GeometrySchema.explicit(kind, dimension, srid)
    return GeometrySchema(kind, "REQUIRED" if found["z"] else "ABSENT", "OPTIONAL" if found["m"] else "ABSENT", srid)


def _common_type(kinds: set[str]) -> str:
    for single in ("POINT", "LINESTRING", "POLYGON"):
        if kinds == {single, f"MULTI{single}"}:
            return f"MULTI{single}"
    raise ValueError(f"Mixed geometry types: {sorted(kinds)}")


CONFORMED = T.StructType(
    [
        T.StructField("geometry", GEOMETRY),
        T.StructField("error", T.StringType()),
        T.StructField("curve", T.BooleanType()),
    ]
)


def conform(shape: W.Shape, srid: int, schema: GeometrySchema, tolerance: float) -> W.Shape:
    """Shape that fits the schema; raises when it cannot."""
    if srid and schema.srid and srid != schema.srid:
        raise ValueError("Conflicting geometry SRID")
    wanted = W.CODES[schema.type]
    if shape.kind in W.CURVES and wanted not in W.CURVES:
        shape = W.linearize(shape, tolerance)
    if shape.kind != wanted:
        promoted = {W.POINT: W.MULTIPOINT, W.LINESTRING: W.MULTILINESTRING, W.POLYGON: W.MULTIPOLYGON}
        if promoted.get(shape.kind) != wanted:
            raise ValueError(f"Geometry does not match output type {schema.type}")
        empty = W.is_empty(shape)
        shape = W.Shape(wanted, shape.z, shape.m, [] if empty else [shape])
    for _, block in W.leaves(shape):
        if not np.isfinite(block[:, :2]).all():
            raise ValueError("Non-finite XY coordinate")
        z = block[:, 2] if shape.z else None
        m = block[:, 2 + shape.z] if shape.m else None
        if schema.z == "ABSENT" and z is not None and not np.isnan(z).all():
            raise ValueError("Extra Z ordinate")
        if schema.m == "ABSENT" and m is not None:
            raise ValueError("Extra M ordinate")
        if schema.z == "REQUIRED" and (z is None or not np.isfinite(z).all()):
            raise ValueError("Required Z ordinate missing")
        if m is not None and np.isinf(m).any():
            raise ValueError("Infinite M ordinate")
    return with_dimension(shape, schema.z != "ABSENT", schema.m != "ABSENT")


def conform_geometry(geom, schema: GeometrySchema, tolerance: float = 0.001) -> Column:
    """``STRUCT<geometry, error, curve>``; the input stays as it is.

    ``curve`` tells that arcs were linearised, a warning for the caller.
    """

    @F.arrow_udf(CONFORMED)
    def run(array: pa.Array) -> pa.Array:
        values, errors, curves = [], [], []
        for item in shapes(array):
            value, message, curve = None, None, False
            if item is not None:
                curve = item[0].kind in W.CURVES
                try:
                    value = conform(*item, schema, tolerance), schema.srid or item[1]
                except ValueError as e:
                    message = str(e)
            values.append(value)
            errors.append(message)
            curves.append(curve)
        return pa.StructArray.from_arrays(
            [arrow_geometries(values), pa.array(errors, pa.string()), pa.array(curves, pa.bool_())],
            fields=[
                pa.field("geometry", ARROW_GEOMETRY), pa.field("error", pa.string()), pa.field("curve", pa.bool_()),
            ],
        )

    return run.asNondeterministic()(col(geom))


def conform_layer(df: DataFrame, geom: str, schema: GeometrySchema, tolerance: float = 0.001) -> DataFrame:
    """Replace the geometry column by its conformed copy and add ``error`` and
    ``warnings`` for the row policies."""
    require_geometry(df, geom)
    done = df.withColumn("_c", conform_geometry(geom, schema, tolerance))
    message = F.col("_c.error")
    problem = F.when(
        message.isNotNull(),
        F.struct(F.lit("GEOMETRY").alias("code"), F.lit(geom).alias("field"), message.alias("message")),
    ).cast(ERROR)
    warned = F.when(
        F.col("_c.curve"), F.array(F.struct(F.lit(geom).alias("field"), F.lit("curve").alias("cause")))
    ).otherwise(F.array().cast("array<struct<field:string,cause:string>>"))
    kept = F.col("_c.geometry").alias(
        geom, metadata={"srid": schema.srid, "type": schema.type, "z": schema.z, "m": schema.m}
    )
    others = [F.col(c) for c in df.columns if c != geom]
    return done.select(*others, kept, problem.alias("error"), warned.alias("warnings"))


def layer_extent(df: DataFrame, geom: str, by=()) -> DataFrame:
    """Envelope of all features, optionally per group; NULL and EMPTY do not
    count, a group without any has NULL bounds."""
    require_geometry(df, geom)
    g = F.col(geom)
    return df.groupBy(*by).agg(
        F.min(g["xmin"]).alias("xmin"),
        F.min(g["ymin"]).alias("ymin"),
        F.max(g["xmax"]).alias("xmax"),
        F.max(g["ymax"]).alias("ymax"),
        F.count(g["xmin"]).alias("n"),
    )


def merge_extent(old, new):
    """Union of two bounds rows or tuples, NULL bounds ignored."""
    pick = lambda fn, a, b: b if a is None else a if b is None else fn(a, b)
    return tuple(pick(fn, old[i], new[i]) for i, fn in enumerate((min, min, max, max)))


@dataclass(frozen=True)
class XYPrecision:
    resolution: float
    tolerance: float
    x_origin: float
    y_origin: float


def xy_precision(
    geographic: bool, unit_metres: float = 1.0, resolution=None, tolerance=None, x_origin=None, y_origin=None
) -> XYPrecision:
    """Grid of a layer: AUTO defaults, overridden by explicit values.

    Geographic layers use 1e-9 degrees, a tolerance of 8.983153e-9 and origin
    -400; projected ones 0.1 mm and 1 mm in CRS units.  An explicit resolution
    sets the tolerance to ten times as much; origins come in pairs.
    """
    for value in (resolution, tolerance):
        if value is not None and not (math.isfinite(value) and value > 0):
            raise ValueError("XY resolution and tolerance must be positive and finite")
    if (x_origin is None) != (y_origin is None):
        raise ValueError("Specify both XY origins")
    if x_origin is not None and not (math.isfinite(x_origin) and math.isfinite(y_origin)):
        raise ValueError("XY origins must be finite")
    if not geographic and not (unit_metres and math.isfinite(unit_metres) and unit_metres > 0):
        raise ValueError("Unknown CRS units")
    # Default resolutions, tolerances and origins.
    if geographic:
        auto = (1e-9, 8.983153e-9, -400.0)
    else:
        auto = (0.0001 / unit_metres, 0.001 / unit_metres, 0.0)
    step = auto[0] if resolution is None else resolution
    if tolerance is None:
        tolerance = auto[1] if resolution is None else resolution * 10
    return XYPrecision(
        step, tolerance, auto[2] if x_origin is None else x_origin, auto[2] if y_origin is None else y_origin
    )
