"""Shapefile bundles: one per partition, published when all are complete."""

from __future__ import annotations

import json
import struct
import uuid
from dataclasses import dataclass

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions import wkb as W
from ..functions.polygons import oriented
from ..operators.errors import with_errors
from ..operators.vector import GeometrySchema, conform_layer, require_geometry
from .dbf import DbfField, DbfOverride, conform_dbf, dbf_schema
from .files import _locate

# Shape families, the marker for a missing M and the size limit.
FAMILY = {W.POINT: 1, W.MULTIPOINT: 8, W.LINESTRING: 3, W.MULTILINESTRING: 3, W.POLYGON: 5, W.MULTIPOLYGON: 5}
NO_M = -1e39
LIMIT = 2**31 - 1


def shape_type(schema: GeometrySchema) -> int:
    """Type code of a layer: family, +10 with Z, +20 with M only."""
    family = FAMILY.get(W.CODES[schema.type])
    if family is None:
        raise ValueError(f"Unsupported Shapefile geometry: {schema.type}")
    return family + (10 if schema.z != "ABSENT" else 20 if schema.m != "ABSENT" else 0)


def encode_shape(shape: W.Shape | None, code: int, with_m: bool) -> bytes:
    """Record content; NULL and EMPTY become a Null Shape."""
    if shape is None or W.is_empty(shape):
        return struct.pack("<i", 0)
    family, has_z = code % 10, code // 10 == 1
    if FAMILY.get(shape.kind) != family:
        raise ValueError(f"Geometry family differs from output layer: {W.NAMES[shape.kind]}")
    parts = _parts(shape)
    block = np.vstack(parts)
    with_m = with_m or (family == 1 and has_z)
    z = block[:, 2] if has_z else None
    m = None
    if with_m:
        m = block[:, 2 + shape.z] if shape.m else np.full(len(block), np.nan)
        m = np.where(np.isnan(m), NO_M, m)
    out = [struct.pack("<i", code)]
    if family != 1:
        low, high = block[:, :2].min(axis=0), block[:, :2].max(axis=0)
        out.append(struct.pack("<4d", *low, *high))
        starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
        out.append(struct.pack("<i", len(block)) if family == 8 else struct.pack(f"<ii{len(parts)}i", len(parts), len(block), *starts))
    out.append(block[:, :2].astype("<f8").tobytes())
    for values in (z, m):
        if values is None:
            continue
        if family != 1:
            known = values[values > -1e38]
            out.append(struct.pack("<2d", *((known.min(), known.max()) if len(known) else (NO_M, NO_M))))
        out.append(values.astype("<f8").tobytes())
    return b"".join(out)


def _parts(shape):
    if shape.kind in (W.POINT, W.LINESTRING):
        return [shape.parts]
    if shape.kind == W.MULTIPOINT:
        return [p.parts for p in shape.parts]
    if shape.kind == W.MULTILINESTRING:
        return [p.parts for p in shape.parts]
    polygons = [shape] if shape.kind == W.POLYGON else shape.parts
    return [oriented(r, i > 0) for p in polygons for i, r in enumerate(p.parts)]


def encode_value(value, f: DbfField, charset: str) -> bytes:
    """Fixed-width bytes of one attribute; NULL is blank or ``?``."""
    if value is None:
        return (b"?" if f.type == "L" else b"").ljust(f.width)
    if f.type == "C":
        return value.encode(charset).ljust(f.width)
    if f.type == "L":
        return b"T" if value else b"F"
    if f.type == "D":
        return value.strftime("%Y%m%d").encode()
    text = format(value, "f").encode()
    if len(text) > f.width:
        raise ValueError(f"Number exceeds field width: {f.name}")
    return text.rjust(f.width)


def dbf_head(fields: list[DbfField], records: int, year=126, month=1, day=1) -> bytes:
    length = 1 + sum(f.width for f in fields)
    top = struct.pack("<4BIHH20x", 3, year, month, day, records, 33 + 32 * len(fields), length)
    rows = [f.name.encode("ascii").ljust(11, b"\0") + f.type.encode() + bytes(4) + bytes([f.width, f.scale]) + bytes(14) for f in fields]
    return top + b"".join(rows) + b"\r"


def shp_head(code: int, size: int, box, z, m) -> bytes:
    return struct.pack(">i20xi", 9994, size // 2) + struct.pack("<ii8d", 1000, code, *box, *z, *m)


@dataclass
class Bundle(WriterCommitMessage):
    """Staged files of one partition."""

    stem: str
    files: list


class BundleSource(DataSource):
    @classmethod
    def name(cls):
        return "shapefile_bundles"

    def schema(self):
        return "wkb binary"

    def writer(self, schema, overwrite):
        return BundleWriter(dict(self.options))


class BundleWriter(DataSourceArrowWriter):
    """Streams SHP, SHX and DBF of a partition to a staging folder."""

    def __init__(self, options):
        self.path, self.code = options["path"], int(options["code"])
        self.with_m, self.charset, self.prj = options["with_m"] == "1", options["charset"], options["prj"]
        self.fields = [DbfField(*f) for f in json.loads(options["fields"])]
        self.job = options["job"]

    def write(self, iterator):
        system, root = _locate(f"{self.path}/_staging-{self.job}")
        system.create_dir(root)
        stem = f"part-{uuid.uuid4().hex}"
        # Bodies first, headers with the final counts afterwards.
        body = {e: f"{root}/{stem}.{e}.body" for e in ("shp", "shx", "dbf")}
        streams = {e: system.open_output_stream(p) for e, p in body.items()}
        at, count = 100, 0
        box, z, m = [np.inf, np.inf, -np.inf, -np.inf], [np.inf, -np.inf], [np.inf, -np.inf]
        for batch in iterator:
            data = batch.column("_wkb").to_pylist()
            values = [batch.column(f.name).to_pylist() for f in self.fields]
            for i, item in enumerate(data):
                shape = None if item is None else W.read(item)
                record = encode_shape(shape, self.code, self.with_m)
                count += 1
                if at + 8 + len(record) > LIMIT:
                    raise ValueError("Shapefile exceeds 2 GiB; use more partitions")
                streams["shp"].write(struct.pack(">ii", count, len(record) // 2) + record)
                streams["shx"].write(struct.pack(">ii", at // 2, len(record) // 2))
                at += 8 + len(record)
                row = [encode_value(v[i], f, self.charset) for v, f in zip(values, self.fields)]
                streams["dbf"].write(b" " + b"".join(row))
                if shape is not None and not W.is_empty(shape):
                    self._extend(shape, box, z, m)
        for s in streams.values():
            s.close()
        clean = lambda r: [0.0 if not np.isfinite(v) else v for v in r]
        box, z, m = clean(box), clean(z), clean(m)
        heads = {
            "shp": shp_head(self.code, at, box, z, m),
            "shx": shp_head(self.code, 100 + 8 * count, box, z, m),
            "dbf": dbf_head(self.fields, count),
        }
        files = []
        if count:
            for e, head in heads.items():
                name = f"{root}/{stem}.{e}"
                with system.open_output_stream(name) as out, system.open_input_stream(body[e]) as source:
                    out.write(head)
                    while chunk := source.read(1 << 20):
                        out.write(chunk)
                    if e == "dbf":
                        out.write(b"\x1a")
                files.append(name)
            for e, text in (("cpg", self.charset.upper()), ("prj", self.prj)):
                if text:
                    with system.open_output_stream(f"{root}/{stem}.{e}") as out:
                        out.write(text.encode())
                    files.append(f"{root}/{stem}.{e}")
        return Bundle(stem, files)

    def _extend(self, shape, box, z, m):
        for _, block in W.leaves(shape):
            low, high = block[:, :2].min(axis=0), block[:, :2].max(axis=0)
            box[:] = [min(box[0], low[0]), min(box[1], low[1]), max(box[2], high[0]), max(box[3], high[1])]
            for target, present, index in ((z, shape.z, 2), (m, shape.m, 2 + shape.z)):
                if present and not np.isnan(block[:, index]).all():
                    target[:] = [min(target[0], np.nanmin(block[:, index])), max(target[1], np.nanmax(block[:, index]))]

    def commit(self, messages):
        system, root = _locate(self.path)
        staged = _locate(f"{self.path}/_staging-{self.job}")[1]
        for message in messages:
            for name in message.files if message else ():
                system.move(name, f"{root}/{name.rsplit('/', 1)[-1]}")
        system.delete_dir(staged)

    def abort(self, messages):
        system, staged = _locate(f"{self.path}/_staging-{self.job}")
        if system.get_file_info(staged).type == fs.FileType.Directory:
            system.delete_dir(staged)


def write_shapefile(
    df: DataFrame, path: str, geom: str, schema: GeometrySchema, *, by=(), overrides: dict[str, DbfOverride] | None = None,
    charset: str = "UTF-8", tz: str = "UTC", prj: str = "",
) -> DataFrame:
    """Write one bundle per partition and return the attribute warnings.

    ``by`` first brings equal values into one partition.  Rows that do not fit
    stop the job, and nothing is published.
    """
    require_geometry(df, geom)
    fields, _ = dbf_schema(df, overrides, skip=(geom,))
    if not fields:
        raise ValueError("A shapefile needs at least one attribute")
    if by:
        df = df.repartition(*by)
    shaped, _ = with_errors(conform_layer(df, geom, schema).drop("warnings"), "FAIL")
    rows, _ = with_errors(conform_dbf(shaped, fields, charset, tz), "FAIL")
    names = [f.name for f in fields.values()]
    spark = df.sparkSession
    spark.dataSource.register(BundleSource)
    system, root = _locate(path)
    if system.get_file_info(root).type != fs.FileType.NotFound:
        raise ValueError(f"Output already exists: {path}")
    out = rows.select(F.col(f"{geom}.wkb").alias("_wkb"), *names)
    out.write.format("shapefile_bundles").mode("append").options(
        path=path, code=str(shape_type(schema)), with_m="1" if schema.m != "ABSENT" else "0", charset=charset.lower(),
        prj=prj, job=uuid.uuid4().hex,
        fields=json.dumps([[f.name, f.type, f.width, f.scale] for f in fields.values()]),
    ).save()
    return rows.select("warnings")
