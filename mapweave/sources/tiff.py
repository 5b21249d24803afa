"""Raster ingest from TIFF files (no compression or Deflate).

One job reads the headers and gives metadata and a table of blocks; a second
one reads the blocks, spread over all tasks, and cuts them into tiles.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.overviews import PIECE, assemble, piece_batch
from ..operators.rasters import META, TILE_SIZE, arrow_type
from .files import open_file

# TIFF field sizes and struct codes by field type.
FIELD = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}
# Sample types by (sample format, bits).
SAMPLES = {
    (1, 8): "UINT8", (1, 16): "UINT16", (1, 32): "UINT32", (2, 8): "INT8", (2, 16): "INT16", (2, 32): "INT32",
    (3, 32): "FLOAT32", (3, 64): "FLOAT64",
}
NUMPY = {
    "UINT8": "u1", "UINT16": "u2", "UINT32": "u4", "INT8": "i1", "INT16": "i2", "INT32": "i4", "FLOAT32": "f4",
    "FLOAT64": "f8",
}

BLOCK = T.StructType(
    [
        T.StructField("raster_id", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("band", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("col0", T.LongType()),
        T.StructField("row0", T.LongType()),
        T.StructField("block_width", T.IntegerType()),
        T.StructField("block_height", T.IntegerType()),
        T.StructField("samples", T.IntegerType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("order", T.StringType()),
        T.StructField("compression", T.IntegerType()),
        T.StructField("predictor", T.IntegerType()),
        T.StructField("full_width", T.LongType()),
        T.StructField("full_height", T.LongType()),
        T.StructField("tile_size", T.IntegerType()),
        T.StructField("fill", T.DoubleType()),
    ]
)
HEADER = T.StructType([T.StructField("meta", META), T.StructField("blocks", T.ArrayType(BLOCK))])


def read_tags(f) -> tuple[str, dict]:
    """Byte order mark and the tags of the first image directory."""
    head = f.read(8)
    if head[:4] not in (b"II*\0", b"MM\0*"):
        raise ValueError("Not a classic TIFF file")
    mark = "<" if head[:2] == b"II" else ">"
    (at,) = struct.unpack(mark + "I", head[4:8])
    f.seek(at)
    (count,) = struct.unpack(mark + "H", f.read(2))
    entries = f.read(12 * count)
    tags = {}
    for i in range(count):
        tag, kind, n = struct.unpack_from(mark + "HHI", entries, 12 * i)
        code = FIELD.get(kind)
        if code is None:
            continue
        size = struct.calcsize("=" + code) * n
        if size <= 4:
            data = entries[12 * i + 8 : 12 * i + 8 + size]
        else:
            f.seek(struct.unpack_from(mark + "I", entries, 12 * i + 8)[0])
            data = f.read(size)
        if code == "s":
            tags[tag] = data.split(b"\0")[0].decode("latin-1")
        else:
            tags[tag] = struct.unpack(mark + code * n, data)
    return mark, tags


def describe(path: str, raster_id: str, tile_size: int) -> dict:
    """Metadata and blocks of one file."""
    with open_file(path) as f:
        mark, tags = read_tags(f)
    one = lambda tag, default=None: tags[tag][0] if tag in tags else default
    width, height, count = one(256), one(257), one(277, 1)
    bits, formats = tags.get(258, (1,)), tags.get(339, (1,) * count)
    kinds = {SAMPLES.get((formats[min(i, len(formats) - 1)], bits[min(i, len(bits) - 1)])) for i in range(count)}
    if None in kinds or len(kinds) != 1:
        raise ValueError(f"Unsupported sample type: {path}")
    compression = one(259, 1)
    if compression not in (1, 8, 32946):
        raise ValueError(f"Unsupported TIFF compression {compression}: {path}")
    predictor = one(317, 1)
    if predictor not in (1, 2) or (predictor == 2 and next(iter(kinds)).startswith("FLOAT")):
        raise ValueError(f"Unsupported TIFF predictor {predictor}: {path}")
    scale = tags.get(33550)
    tie = tags.get(33922)
    if scale is None or tie is None:
        raise ValueError(f"Missing georeference: {path}")
    text = str(tags.get(42113, "")).strip()
    nodata = float(text) if text else None
    srid = _srid(tags.get(34735, ()))
    color = {2: "RGB", 3: "PALETTE"}.get(one(262, 1), "NUMERIC")
    extra = tags.get(338, ())
    data_type = kinds.pop()
    scales, offsets = _scaling(str(tags.get(42112, "")))
    bands = [
        dict(
            name=f"band_{b + 1}", data_type=data_type, nodata=nodata, scale=scales.get(b, 1.0),
            offset=offsets.get(b, 0.0), alpha=bool(extra) and b == count - len(extra) and extra[0] in (1, 2),
        )
        for b in range(count)
    ]
    origin_x = tie[3] - tie[0] * scale[0]
    origin_y = tie[4] + tie[1] * scale[1]
    meta = dict(
        raster_id=raster_id, path=path, width=width, height=height, origin_x=origin_x, origin_y=origin_y,
        pixel_x=scale[0], pixel_y=-scale[1], srid=srid, crs=f"EPSG:{srid}" if srid else "", tile_size=tile_size,
        off_x=0, off_y=0, color=color, bands=bands, steps=[],
        palette=_palette(tags.get(320)) if color == "PALETTE" else None, premultiplied=bool(extra) and extra[0] == 1,
    )
    tiled = 322 in tags
    bw, bh = (one(322), one(323)) if tiled else (width, min(one(278, height), height))
    offsets_, lengths = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
    across, down = -(-width // bw), -(-height // bh)
    planar = one(284, 1) == 2 and count > 1
    blocks = []
    for i, (at, size) in enumerate(zip(offsets_, lengths)):
        plane, rest = divmod(i, across * down)
        row, column = divmod(rest, across)
        blocks.append(
            dict(
                raster_id=raster_id, path=path, band=plane + 1 if planar else 0, offset=at, length=size,
                col0=column * bw, row0=row * bh, block_width=bw,
                block_height=bh if tiled else min(bh, height - row * bh), samples=1 if planar else count,
                data_type=data_type, order=mark, compression=compression, predictor=predictor, full_width=width,
                full_height=height, tile_size=tile_size, fill=float("nan") if nodata is None else nodata,
            )
        )
    return {"meta": meta, "blocks": blocks}


def _srid(keys) -> int:
    """EPSG code of the GeoKey directory; 0 when user defined."""
    found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    code = found.get(3072) or found.get(2048) or 0
    return 0 if code == 32767 else code


def _palette(table) -> list[dict] | None:
    """Colours of a colour map: all reds, then all greens, then all blues."""
    if not table:
        return None
    n = len(table) // 3
    return [dict(red=table[i], green=table[n + i], blue=table[2 * n + i]) for i in range(n)]


def _scaling(xml: str) -> tuple[dict, dict]:
    """Scale and offset per band of the metadata items."""
    out = {"scale": {}, "offset": {}}
    for item in re.findall(r"<Item\b([^>]*)>([^<]*)</Item>", xml):
        role = re.search(r'role="(scale|offset)"', item[0])
        sample = re.search(r'sample="(\d+)"', item[0])
        if role and sample:
            out[role.group(1)][int(sample.group(1))] = float(item[1])
    return out["scale"], out["offset"]


def read_block(f, row) -> np.ndarray:
    """Samples of one block, (height, width, samples)."""
    f.seek(row["offset"])
    data = f.read(row["length"])
    if row["compression"] != 1:
        data = zlib.decompress(data)
    shape = (row["block_height"], row["block_width"], row["samples"])
    values = np.frombuffer(data, row["order"] + NUMPY[row["data_type"]], int(np.prod(shape))).reshape(shape)
    if row["predictor"] == 2:
        values = np.cumsum(values, axis=1, dtype=values.dtype.newbyteorder("="))
    return values


def _cut(row, values):
    """Tile pieces of one block; padding beyond the raster is left out."""
    n = min(row["block_width"], row["full_width"] - row["col0"])
    m = min(row["block_height"], row["full_height"] - row["row0"])
    size = row["tile_size"]
    for ty in range(row["row0"] // size, (row["row0"] + m - 1) // size + 1):
        for tx in range(row["col0"] // size, (row["col0"] + n - 1) // size + 1):
            c0, r0 = max(tx * size, row["col0"]), max(ty * size, row["row0"])
            c1, r1 = min((tx + 1) * size, row["col0"] + n), min((ty + 1) * size, row["row0"] + m)
            part = values[r0 - row["row0"] : r1 - row["row0"], c0 - row["col0"] : c1 - row["col0"]]
            for s in range(row["samples"]):
                yield (
                    dict(
                        raster_id=row["raster_id"], level=0, band=row["band"] or s + 1, tile_x=tx, tile_y=ty, col0=c0,
                        row0=r0, width=c1 - c0, height=r1 - r0, full_width=row["full_width"],
                        full_height=row["full_height"], tile_size=size, fill=row["fill"],
                    ),
                    part[:, :, s].astype(float),
                )


def read_tiff(spark: SparkSession, paths, tile_size: int = TILE_SIZE) -> tuple[DataFrame, DataFrame]:
    """(metadata, tiles) of TIFF files; the path names the raster.

    ``paths`` is a list or a DataFrame with a ``path`` column (and optionally
    ``raster_id``).
    """
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in ([paths] if isinstance(paths, str) else paths)], "path string")
    if "raster_id" not in paths.columns:
        paths = paths.withColumn("raster_id", F.col("path"))
    header_type = arrow_type(HEADER)

    def headers(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pylist([describe(r["path"], r["raster_id"], tile_size) for r in rows], schema=header_type)

    found = paths.select("path", "raster_id").mapInArrow(headers, HEADER)
    meta = found.select("meta.*")
    # Blocks are spread by place, so one large file uses all tasks.
    blocks = found.select(F.explode("blocks").alias("b")).select("b.*").repartition("raster_id", "row0", "col0", "band")

    def pieces(batches):
        path, handle = None, None
        for batch in batches:
            rows, parts = [], []
            for row in batch.to_pylist():
                if row["path"] != path:
                    if handle is not None:
                        handle.close()
                    path, handle = row["path"], open_file(row["path"])
                for piece, block in _cut(row, read_block(handle, row)):
                    rows.append(piece)
                    parts.append(block)
                if sum(p.size for p in parts) > 1 << 22:
                    yield piece_batch(rows, parts)
                    rows, parts = [], []
            if rows:
                yield piece_batch(rows, parts)

    return meta, assemble(blocks.mapInArrow(pieces, PIECE))
