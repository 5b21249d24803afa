"""GeoPackage feature layers, read only, split by row id."""

from __future__ import annotations

import re
import sqlite3

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import wkb as W
from ..functions.geometry import ARROW_GEOMETRY, GEOMETRY, arrow_geometries, col, geometry_field, shapes
from .store import resolve_layer

ROWS_PER_PARTITION = 200_000


def _connect(path: str):
    """Read-only connection; the file must be on a mounted file system."""
    plain = path[7:] if path.startswith("file://") else path.removeprefix("file:")
    db = sqlite3.connect(f"file:{plain}?mode=ro", uri=True)
    (found,) = db.execute("PRAGMA application_id").fetchone()
    if found != 0x47504B47:
        raise ValueError(f"Not a GeoPackage database: {path}")
    return db


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def layers(path: str) -> list[dict]:
    """Feature layers with their geometry and fields, by table name."""
    db = _connect(path)
    try:
        found = db.execute(
            "SELECT g.table_name, g.column_name, g.geometry_type_name, g.srs_id, g.z, g.m"
            " FROM gpkg_geometry_columns g JOIN gpkg_contents c ON c.table_name = g.table_name"
            " WHERE c.data_type = 'features' ORDER BY g.table_name"
        ).fetchall()
        out = []
        for table, geom, kind, srid, z, m in found:
            info = db.execute(f"PRAGMA table_info({_quote(table)})").fetchall()
            names = [row[1] for row in info]
            if geom.lower() not in [n.lower() for n in names]:
                raise ValueError(f"Geometry column missing: {table}.{geom}")
            fields = [(row[1], row[2] or "") for row in info if not row[5] and row[1].lower() != geom.lower()]
            out.append(dict(name=table, geometry=geom, type=kind.upper(), srid=srid, z=z, m=m, fields=fields))
        return out
    finally:
        db.close()


def field_type(declared: str) -> T.DataType:
    """Column type of a declared SQL type."""
    text = declared.upper()
    # Parts of type names, in order of precedence.
    for parts, kind in (
        (("BOOL",), T.BooleanType()),
        (("INT",), T.LongType()),
        (("REAL", "FLOA", "DOUB", "NUMERIC", "DECIMAL"), T.DoubleType()),
        (("DATE", "TIME"), T.TimestampType()),
        (("BLOB",), T.BinaryType()),
    ):
        if any(p in text for p in parts):
            return kind
    return T.StringType()


def declared_size(declared: str) -> dict:
    """Length and precision metadata of ``TYPE(n)`` or ``TYPE(n, m)``."""
    found = re.fullmatch(r"[^()]*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)\s*", declared)
    if not found:
        return {}
    sizes = {"length": int(found.group(1))}
    if found.group(2):
        sizes["precision"] = int(found.group(2))
    return sizes


class GeoPackageSource(DataSource):
    """Attribute columns as stored and the geometry blob as ``_blob``."""

    @classmethod
    def name(cls):
        return "geopackage_rows"

    def _layer(self):
        found = layers(self.options["path"])
        name = resolve_layer([d["name"] for d in found], self.options.get("layer"))
        return next(d for d in found if d["name"] == name)

    def schema(self):
        layer = self._layer()
        fields = []
        for name, declared in layer["fields"]:
            kind = field_type(declared)
            # Times travel as text and are parsed by the engine.
            kind = T.StringType() if isinstance(kind, T.TimestampType) else kind
            fields.append(T.StructField(name, kind, True, declared_size(declared)))
        return T.StructType(fields + [T.StructField("_blob", T.BinaryType())])

    def reader(self, schema):
        return GeoPackageReader(self.options["path"], self._layer(), int(self.options.get("rows", ROWS_PER_PARTITION)))


class GeoPackageReader(DataSourceReader):
    def __init__(self, path, layer, step):
        self.path, self.layer, self.step = path, layer, step

    def partitions(self):
        db = _connect(self.path)
        try:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quote(self.layer['name'])}").fetchone()
        finally:
            db.close()
        if low is None:
            return [InputPartition((0, 0))]
        return [InputPartition((a, a + self.step)) for a in range(low, high + 1, self.step)]

    def read(self, partition):
        low, high = partition.value
        kinds = [field_type(d) for _, d in self.layer["fields"]]
        names = [n for n, _ in self.layer["fields"]] + [self.layer["geometry"]]
        # Python types of the declared column types.
        convert = {T.BooleanType: bool, T.LongType: int, T.DoubleType: float, T.BinaryType: bytes}
        casts = [convert.get(type(k), str) for k in kinds] + [bytes]
        db = _connect(self.path)
        try:
            rows = db.execute(
                f"SELECT {', '.join(map(_quote, names))} FROM {_quote(self.layer['name'])} WHERE rowid >= ? AND rowid < ?",
                (low, high),
            )
            for row in rows:
                yield tuple(None if v is None else cast(v) for v, cast in zip(row, casts))
        finally:
            db.close()


DECODED = T.StructType([T.StructField("geometry", GEOMETRY), T.StructField("error", T.StringType())])


def decode_blob(data: bytes, srid: int) -> W.Shape:
    """Shape of a GeoPackage geometry blob."""
    if len(data) < 13 or data[:3] != b"GP\0":
        raise ValueError("Invalid GeoPackage binary header")
    flags = data[3]
    envelope = flags >> 1 & 7
    if flags & 0xE0 or envelope > 4:
        raise ValueError("Unsupported GeoPackage binary flags")
    if envelope > 1:
        raise ValueError("Only XY envelopes are supported")
    empty = bool(flags & 16)
    if empty and envelope:
        raise ValueError("Empty geometry must not have an envelope")
    if int.from_bytes(data[4:8], "little" if flags & 1 else "big", signed=True) != srid:
        raise ValueError("Geometry SRID differs from layer SRID")
    shape = W.read(data[8 + 32 * envelope :])
    if shape.z or shape.m:
        raise ValueError("Only XY geometries are supported")
    if W.is_empty(shape) != empty:
        raise ValueError("GeoPackage empty flag disagrees with WKB")
    return shape


def decode_gpkg(blob, srid: int) -> Column:
    """``STRUCT<geometry, error>`` of a blob column; NULL stays NULL and EMPTY
    stays EMPTY."""

    @F.arrow_udf(DECODED)
    def run(array: pa.Array) -> pa.Array:
        values, errors = [], []
        for item in array.to_pylist():
            value, message = None, None
            if item is not None:
                try:
                    value = decode_blob(item, srid), srid
                except ValueError as e:
                    message = str(e)
            values.append(value)
            errors.append(message)
        return pa.StructArray.from_arrays(
            [arrow_geometries(values), pa.array(errors, pa.string())],
            fields=[pa.field("geometry", ARROW_GEOMETRY), pa.field("error", pa.string())],
        )

    return run(col(blob))


@F.arrow_udf(T.BinaryType())
def _encode(array: pa.Array) -> pa.Array:
    out = []
    for item in shapes(array):
        if item is None:
            out.append(None)
            continue
        shape, srid = item
        if shape.z or shape.m:
            raise ValueError("Z/M cannot be discarded: only XY geometries are supported")
        flags = 1 | (16 if W.is_empty(shape) else 0)
        out.append(b"GP\0" + bytes([flags]) + srid.to_bytes(4, "little", signed=True) + W.write(shape))
    return pa.array(out, pa.binary())


def encode_gpkg(geom) -> Column:
    """GeoPackage geometry blob without envelope."""
    return _encode(col(geom))


def read_geopackage(
    spark: SparkSession, path: str, layer: str | None = None, *, geometry_field_name: str | None = None,
    assign_crs: int | None = None, rows_per_partition: int = ROWS_PER_PARTITION,
) -> DataFrame:
    """A feature layer, the primary key hidden and the geometry last."""
    found = layers(path)
    chosen = resolve_layer([d["name"] for d in found], layer)
    info = next(d for d in found if d["name"] == chosen)
    if info["z"] or info["m"]:
        raise ValueError(f"Layer {chosen} declares Z/M; only XY is supported")
    if info["type"] != "GEOMETRY" and info["type"] not in W.CODES:
        raise ValueError(f"Unsupported GeoPackage geometry type: {info['type']}")
    name = geometry_field_name or info["geometry"]
    if name.lower() in [n.lower() for n, _ in info["fields"]]:
        raise ValueError("Geometry output name collides with an attribute")
    spark.dataSource.register(GeoPackageSource)
    rows = spark.read.format("geopackage_rows").options(path=path, layer=chosen, rows=str(rows_per_partition)).load()
    columns = []
    for field, declared in info["fields"]:
        value = F.col(f"`{field}`")
        if isinstance(field_type(declared), T.TimestampType):
            value = value.cast("timestamp")
        columns.append(value.alias(field, metadata=declared_size(declared)))
    decoded = decode_gpkg("_blob", info["srid"])
    bad = F.raise_error(decoded["error"]).cast(GEOMETRY)
    shape = F.when(decoded["error"].isNotNull(), bad).otherwise(decoded["geometry"])
    srid = info["srid"] if assign_crs is None else assign_crs
    if assign_crs is not None:
        shape = F.when(shape.isNotNull(), shape.withField("srid", F.lit(srid)))
    return rows.select(*columns, geometry_field(shape, name, srid, type=info["type"]))
