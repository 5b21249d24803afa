"""Shapefile reading as a data source split by record ranges."""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import wkb as W
from ..functions.geometry import BOUNDS, geometry_field
from ..functions.polygons import nest_rings
from .dbf import DbfField, dbf_value, input_charset
from .files import exists, open_file, read_bytes, read_text, sibling, size

# Shape type codes by family and the marker for a missing M.
FAMILIES = {1: "POINT", 3: "MULTILINESTRING", 5: "MULTIPOLYGON", 8: "MULTIPOINT"}
NO_M = -1e38
#: records of one partition
RECORDS_PER_PARTITION = 100_000


def shape_header(path: str) -> int:
    """Shape type after the checks of a 100-byte header."""
    head = read_bytes(path, 0, 100)
    code, words = struct.unpack(">i20xi", head[:28])
    version, kind = struct.unpack("<ii", head[28:36])
    if code != 9994 or version != 1000 or words * 2 != size(path):
        raise ValueError(f"Invalid shapefile header: {path}")
    if kind % 10 not in FAMILIES or kind > 28:
        raise ValueError(f"Unsupported shape type: {kind}")
    return kind


def dbf_header(path: str):
    """(records, header bytes, record bytes, language id, raw field rows)."""
    head = read_bytes(path, 0, 32)
    records, start, length = struct.unpack("<IHH", head[4:12])
    fields, at = [], 32
    block = read_bytes(path, 0, start)
    while at + 32 <= start and block[at] != 0x0D:
        entry = block[at : at + 32]
        name = entry[:11].split(b"\0")[0].decode("latin-1").strip()
        fields.append((name, chr(entry[11]), entry[16], entry[17]))
        at += 32
    if 1 + sum(f[2] for f in fields) != length:
        raise ValueError(f"Inconsistent DBF header: {path}")
    if size(path) < start + records * length:
        raise ValueError(f"Truncated DBF file: {path}")
    return records, start, length, head[29], fields


def decode_shape(body: bytes, expected: int) -> W.Shape | None:
    """Shape of one record; lines and polygons come as multi types."""
    try:
        return _decode(body, expected)
    except (struct.error, IndexError) as e:
        raise ValueError("Truncated shape record") from e


def _decode(body, expected):
    (kind,) = struct.unpack_from("<i", body, 0)
    if kind == 0:
        if len(body) != 4:
            raise ValueError("Invalid Null Shape length")
        return None
    if kind != expected:
        raise ValueError("Record shape type differs from header")
    family, has_z, has_m = kind % 10, kind // 10 == 1, kind // 10 == 2
    at, starts, n = 4, [0], 1
    if family != 1:
        at += 32
        if family == 8:
            (n,) = struct.unpack_from("<i", body, at)
            at += 4
        else:
            parts, n = struct.unpack_from("<ii", body, at)
            at += 8
            if not 0 <= parts <= n:
                raise ValueError("Invalid shape counts")
            starts = list(struct.unpack_from(f"<{parts}i", body, at))
            at += 4 * parts
            if any(b <= a for a, b in zip(starts, starts[1:])) or (starts and (starts[0] != 0 or starts[-1] >= n)):
                raise ValueError("Invalid part index")

    def doubles(count):
        nonlocal at
        if count < 0 or at + 8 * count > len(body):
            raise ValueError("Truncated shape record")
        values = np.frombuffer(body, "<f8", count, at)
        at += 8 * count
        return values

    columns = [doubles(2 * n).reshape(n, 2)]
    skip = 0 if family == 1 else 16
    if has_z:
        at += skip
        columns.append(doubles(n).reshape(n, 1))
    with_m = has_m or (has_z and at < len(body))
    if with_m:
        if at < len(body):
            at += skip
            m = doubles(n).reshape(n, 1)
        else:
            m = np.full((n, 1), NO_M * 10)
    if not all(np.isfinite(c).all() for c in columns) or (with_m and not np.isfinite(m).all()):
        raise ValueError("Non-finite coordinate")
    if with_m:
        columns.append(np.where(m < NO_M, np.nan, m))
    if at != len(body):
        raise ValueError("Unexpected shape record bytes")
    block = np.hstack(columns)
    if family == 1:
        return W.Shape(W.POINT, has_z, with_m, block)
    if family == 8:
        return W.Shape(W.MULTIPOINT, has_z, with_m, [W.Shape(W.POINT, has_z, with_m, row[None, :]) for row in block])
    pieces = [block[a:b] for a, b in zip(starts, starts[1:] + [n])]
    if family == 3:
        return W.Shape(W.MULTILINESTRING, has_z, with_m, [W.Shape(W.LINESTRING, has_z, with_m, p) for p in pieces])
    return W.Shape(W.MULTIPOLYGON, has_z, with_m, [W.Shape(W.POLYGON, has_z, with_m, rings) for rings in nest_rings(pieces)])


class ShapefileSource(DataSource):
    """Raw records: deleted mark, WKB with bounds, and the DBF texts."""

    @classmethod
    def name(cls):
        return "shapefile_records"

    def _dbf(self):
        found = sibling(self.options["path"], ".dbf")
        if found is None:
            raise ValueError("Missing DBF file")
        return found

    def schema(self):
        fields = dbf_header(self._dbf())[4]
        base = [T.StructField("_deleted", T.BooleanType()), T.StructField("_wkb", T.BinaryType())]
        return T.StructType(base + BOUNDS.fields + [T.StructField(f"_f{i}", T.StringType()) for i in range(len(fields))])

    def reader(self, schema):
        return ShapefileReader(
            self.options["path"], self._dbf(), self.options["charset"],
            int(self.options.get("records", RECORDS_PER_PARTITION)),
        )


class ShapefileReader(DataSourceReader):
    def __init__(self, path, dbf, charset, step):
        self.path, self.dbf, self.charset, self.step = path, dbf, charset, step

    def partitions(self):
        kind, records = shape_header(self.path), dbf_header(self.dbf)[0]
        index = sibling(self.path, ".shx")
        if index is None:
            # Without an index record positions are only known from the start.
            return [InputPartition((0, records, None, kind))]
        if shape_header(index) != kind or size(index) != 100 + 8 * records:
            raise ValueError("Inconsistent SHX header/count")
        bounds = range(0, records, self.step)
        return [InputPartition((a, min(a + self.step, records), index, kind)) for a in bounds]

    def read(self, partition):
        first, last, index, kind = partition.value
        records, start, length, _, fields = dbf_header(self.dbf)
        table = read_bytes(self.dbf, start + first * length, (last - first) * length)
        entries, at = None, 100
        if index is not None:
            entries = np.frombuffer(read_bytes(index, 100 + 8 * first, 8 * (last - first)), ">i4").reshape(-1, 2)
            at = int(entries[0, 0]) * 2 if len(entries) else 100
        total = size(self.path)
        with open_file(self.path) as shp:
            shp.seek(at)
            for i in range(last - first):
                head = shp.read(8)
                if len(head) < 8:
                    raise ValueError("SHP/DBF record counts differ")
                number, words = struct.unpack(">ii", head)
                if number != first + i + 1 or words < 2 or at + 8 + 2 * words > total:
                    raise ValueError(f"Invalid SHP record header at {at}")
                if entries is not None and (int(entries[i, 0]) * 2 != at or entries[i, 1] != words):
                    raise ValueError("SHX entry differs from SHP record")
                shape = decode_shape(shp.read(2 * words), kind)
                at += 8 + 2 * words
                row = table[i * length : (i + 1) * length]
                texts, pos = [], 1
                for _, _, width, _ in fields:
                    texts.append(row[pos : pos + width].decode(self.charset, "replace"))
                    pos += width
                box = (W.envelope(shape) if shape is not None else None) or (None,) * 4
                yield (row[0:1] == b"*", None if shape is None else W.write(shape), *box, *texts)
        if last == records and at != total:
            raise ValueError("SHP/DBF record counts differ")


def read_shapefile(
    spark: SparkSession, path: str, *, charset: str | None = None, tz: str = "UTC", geometry_field_name: str = "the_geom",
    assign_crs: int | None = None, records_per_partition: int = RECORDS_PER_PARTITION,
) -> DataFrame:
    """A shapefile as a DataFrame, the geometry last.

    Deleted DBF rows are left out.  Without a PRJ the CRS is unknown (0).  The
    attribute rules run as Column expressions on the raw texts.
    """
    dbf = sibling(path, ".dbf")
    if dbf is None:
        raise ValueError("Missing DBF file")
    _, _, _, ldid, raw = dbf_header(dbf)
    cpg = sibling(path, ".cpg")
    encoding, _ = input_charset(charset, read_text(cpg) if cpg else None, ldid)
    names = [name.lower() for name, *_ in raw]
    if len(set(names)) != len(names):
        raise ValueError("Duplicate DBF field")
    if geometry_field_name.lower() in names:
        raise ValueError(f"Geometry field collides with attribute: {geometry_field_name}")
    srid = assign_crs if assign_crs is not None else prj_srid(path)
    spark.dataSource.register(ShapefileSource)
    rows = (
        spark.read.format("shapefile_records")
        .options(path=path, charset=encoding, records=str(records_per_partition)).load()
        .filter(~F.col("_deleted"))
    )
    columns = []
    for i, (name, kind, width, scale) in enumerate(raw):
        if kind not in "CNFDL":
            raise ValueError(f"Unsupported DBF field type: {kind}")
        f = DbfField(name, kind, width, scale)
        columns.append(dbf_value(f"_f{i}", f, tz).alias(name, metadata={"length": width, "precision": scale}))
    shape = F.when(
        F.col("_wkb").isNotNull(),
        F.struct(F.col("_wkb").alias("wkb"), F.lit(srid).cast("int").alias("srid"), *[F.col(n) for n in BOUNDS.names]),
    )
    header = shape_header(path)
    return rows.select(*columns, geometry_field(shape, geometry_field_name, srid, type=FAMILIES[header % 10]))


def prj_srid(path: str) -> int:
    """SRID of the outermost EPSG authority of a PRJ file; 0 when unknown."""
    import re

    prj = sibling(path, ".prj")
    if prj is None or not exists(prj):
        return 0
    found = re.findall(r'AUTHORITY\s*\[\s*"EPSG"\s*,\s*"?(\d+)"?\s*\]', read_text(prj))
    return int(found[-1]) if found else 0
