"""Spatial Parquet: attributes plus ISO WKB, with the CRS in the metadata."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.crs import is_geographic
from ..functions.geometry import st_geomfromwkb
from ..operators.vector import GeometrySchema, conform_geometry, require_geometry
from .publish import published

# Labels of the edge interpolation algorithms.
ALGORITHMS = ("SPHERICAL", "VINCENTY", "THOMAS", "ANDOYER", "KARNEY")
ROW_GROUP_BYTES = 128 * 1024 * 1024
#: bounds columns written beside the WKB, so that envelope filters prune
BOUNDS = "bbox"


def crs_text(srid: int, authority: str = "", wkt: str = "") -> str:
    """``AUTH:code``, else WKT, else ``srid:n``, else ``srid:0``."""
    if authority and srid:
        return f"{authority}:{srid}"
    if wkt.strip() and wkt.strip().lower() != "undefined":
        return wkt
    return f"srid:{srid}" if srid else "srid:0"


def _checked(f: T.StructField) -> Column:
    value = F.col(f"`{f.name}`")
    kind = f.dataType
    simple = (
        T.StringType, T.BooleanType, T.IntegralType, T.FractionalType, T.DateType, T.TimestampType,
        T.TimestampNTZType, T.BinaryType,
    )
    if not isinstance(kind, simple):
        raise ValueError(f"Convert unsupported attribute '{f.name}' before exporting")
    if isinstance(kind, T.IntegralType):
        return value.cast("long")
    return value.cast("double") if isinstance(kind, T.FloatType) else value


def write_spatial_parquet(
    df: DataFrame,
    path: str,
    geom: str,
    schema: GeometrySchema,
    *,
    logical: str = "GEOMETRY",
    algorithm: str = "SPHERICAL",
    compression: str = "gzip",
    row_group_bytes: int = ROW_GROUP_BYTES,
    overwrite: bool = False,
    authority: str = "EPSG",
) -> None:
    """Write a layer; every field is optional and the geometry is ISO WKB.

    The geometry has no statistics and no dictionary; envelope filters use the
    ``bbox`` struct next to it.  GEOGRAPHY needs a geographic CRS and
    coordinates within longitude and latitude limits.  Rows that do not fit
    the schema stop the job, and nothing is published.
    """
    require_geometry(df, geom)
    if logical not in ("GEOMETRY", "GEOGRAPHY") or algorithm not in ALGORITHMS:
        raise ValueError("Unknown logical type or edge algorithm")
    if compression not in ("gzip", "none"):
        raise ValueError("Compression must be gzip or none")
    if logical == "GEOGRAPHY" and not is_geographic(schema.srid):
        raise ValueError("GEOGRAPHY requires a geographic CRS")
    names = [n.lower() for n in df.columns]
    if len(set(names)) != len(names) or any(not n.strip() for n in names) or BOUNDS in names:
        raise ValueError("Empty, reserved or duplicate field name")
    done = df.withColumn("_c", conform_geometry(geom, schema))
    shape = F.col("_c.geometry")
    problem = F.col("_c.error")
    if logical == "GEOGRAPHY":
        outside = (shape["xmin"] < -180) | (shape["xmax"] > 180) | (shape["ymin"] < -90) | (shape["ymax"] > 90)
        problem = F.coalesce(problem, F.when(outside, "GEOGRAPHY coordinates outside longitude/latitude bounds"))
    label = {"crs": crs_text(schema.srid, authority), "type": schema.type, "dimension": schema.dimension, "logical": logical}
    if logical == "GEOGRAPHY":
        label["algorithm"] = algorithm
    checked = F.when(problem.isNotNull(), F.raise_error(problem).cast("binary")).otherwise(shape["wkb"])
    box = F.struct(*[shape[n].alias(n) for n in ("xmin", "ymin", "xmax", "ymax")])
    columns = [
        checked.alias(geom, metadata={"geometry": json.dumps(label), "srid": schema.srid})
        if f.name == geom
        else _checked(f).alias(f.name)
        for f in df.schema
    ]
    settings = {
        "compression": compression,
        "parquet.block.size": str(row_group_bytes),
        f"parquet.enable.dictionary#{geom}": "false",
        f"parquet.column.statistics.enabled#{geom}": "false",
    }
    rows = done.select(*columns, F.when(shape["xmin"].isNotNull(), box).alias(BOUNDS))
    with published(df.sparkSession, path, overwrite) as folder:
        rows.write.options(**settings).parquet(folder)


def read_spatial_parquet(spark: SparkSession, path: str, geom: str, bbox=None) -> DataFrame:
    """A written layer with its geometry column.

    ``bbox`` (xmin, ymin, xmax, ymax) keeps the features whose envelope meets
    it; the predicate is on the file's own bounds and reaches the scan.
    """
    df = spark.read.parquet(path)
    if bbox is not None:
        xmin, ymin, xmax, ymax = (float(v) for v in bbox)
        b = F.col(BOUNDS)
        df = df.filter((b["xmin"] <= xmax) & (b["xmax"] >= xmin) & (b["ymin"] <= ymax) & (b["ymax"] >= ymin))
    declared = df.schema[geom].metadata
    if BOUNDS in df.columns:
        box = F.col(BOUNDS)
        shape = F.struct(
            F.col(geom).alias("wkb"), F.lit(declared.get("srid", 0)).cast("int").alias("srid"),
            *[box[n].alias(n) for n in ("xmin", "ymin", "xmax", "ymax")],
        )
        shape = F.when(F.col(geom).isNotNull(), shape)
    else:
        shape = st_geomfromwkb(F.col(geom), declared.get("srid", 0))
    return df.select(
        *[shape.alias(geom, metadata=declared) if c == geom else F.col(c) for c in df.columns if c != BOUNDS]
    )
