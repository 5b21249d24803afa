"""Format choice and one entry point for reading vector data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.geometry import assign_crs as declare
from ..functions.geometry import geometry_field, parse_crs
from ..operators.features import FeatureOptions
from . import geojson, geopackage, shapefile
from .store import Store, resolve_layer

# Formats by file extension and what can be read.
EXTENSIONS = {
    ".shp": "SHAPEFILE",
    ".gpkg": "GEOPACKAGE",
    ".gdb": "FILEGEODATABASE",
    ".fgb": "FLATGEOBUF",
    ".parquet": "PARQUET",
    ".gen": "ARCINFO_GENERATE",
    ".geojson": "GEOJSON",
    ".json": "GEOJSON",
}
READABLE = ("SHAPEFILE", "GEOPACKAGE", "FILEGEODATABASE", "GEOJSON")


def resolve_format(path: str, format: str | None = "AUTO") -> str:
    """An explicit format wins, else the extension; unknown is an error."""
    if format not in (None, "", "AUTO"):
        if format not in EXTENSIONS.values():
            raise ValueError(f"Unknown format: {format}")
        return format
    name = path.lower().rstrip("/")
    for extension, found in EXTENSIONS.items():
        if name.endswith(extension):
            return found
    raise ValueError("Select a vector format or use a known file extension")


def read_vector(
    spark: SparkSession, path: str, format: str = "AUTO", layer: str | None = None, geometry_field_name: str | None = None,
    assign_crs=None, **options,
) -> DataFrame:
    """Read a layer; a directory store stands in for the database format."""
    kind = resolve_format(path, format)
    if kind not in READABLE:
        raise ValueError(f"{kind} supports writing only")
    srid = None if assign_crs in (None, "") else parse_crs(assign_crs)
    if kind == "SHAPEFILE":
        stem = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        if layer:
            resolve_layer([stem], layer)
        return shapefile.read_shapefile(
            spark, path, geometry_field_name=geometry_field_name or "the_geom", assign_crs=srid, **options
        )
    if kind == "GEOPACKAGE":
        return geopackage.read_geopackage(
            spark, path, layer, geometry_field_name=geometry_field_name, assign_crs=srid, **options
        )
    if kind == "GEOJSON":
        if layer:
            resolve_layer(["features"], layer)
        settings = FeatureOptions(geometry=geometry_field_name) if geometry_field_name else FeatureOptions()
        df, name = geojson.read_geojson(spark, path, options.pop("options", settings), **options), settings.geometry
    else:
        store = Store(spark, path)
        df = store.table(layer)
        name = next((f.name for f in df.schema if "srid" in f.metadata), None)
    if srid is None or name is None:
        return df
    return df.select(*[geometry_field(declare(name, srid), name, srid) if c == name else c for c in df.columns])


def list_layers(spark: SparkSession, path: str, format: str = "AUTO") -> DataFrame:
    """Layers and their fields, without reading rows."""
    kind = resolve_format(path, format)
    if kind == "FILEGEODATABASE":
        return Store(spark, path).layers()
    if kind == "GEOPACKAGE":
        rows = [
            (d["name"], d["geometry"], d["type"], "XY" + "Z" * bool(d["z"]) + "M" * bool(d["m"]), d["srid"], name, declared)
            for d in geopackage.layers(path)
            for name, declared in d["fields"]
        ]
    else:
        df = read_vector(spark, path, kind)
        stem = "features" if kind == "GEOJSON" else path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        shape = next((f for f in df.schema if "srid" in f.metadata), None)
        name, meta = (shape.name, shape.metadata) if shape else ("geometry", {})
        rows = [
            (stem, name, meta.get("type"), None, meta.get("srid"), f.name, f.dataType.simpleString())
            for f in df.schema
            if f.name != name
        ]
    return spark.createDataFrame(
        rows, "layer string, geometry string, type string, dimension string, srid int, field string, field_type string"
    )
