import json
import sqlite3
import struct
import zlib
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapweave.functions import wkb as W
from mapweave.functions.geometry import st_box, st_geomfromwkb, st_isempty, st_point, st_type
from mapweave.functions.polygons import assemble_polygons
from mapweave.operators.errors import summarize_warnings, with_errors
from mapweave.operators.features import FeatureOptions
from mapweave.operators.colour import expand_palettes
from mapweave.operators.rasters import pixels_from_tiles, raster_meta, tiles_from_pixels
from mapweave.operators.zonal import zonal_stats
from mapweave.sources import dbf, generate, geojson, geopackage
from mapweave.sources.dispatch import list_layers, read_vector, resolve_format
from mapweave.sources.tiff import read_tiff


def shapes_df(spark, rows):
    """(id, Shape or None) rows with a geometry column."""
    data = [(i, None if s is None else bytearray(W.write(s))) for i, s in rows]
    df = spark.createDataFrame(data, "id long, wkb binary")
    return df.select("id", st_geomfromwkb("wkb", 2056).alias("geometry"))


def ring(*points):
    return np.array([*points, points[0]], float)


# -- format choice --------------------------------------------------------------------


def test_format_by_extension():
    assert resolve_format("a/B.SHP") == "SHAPEFILE"
    assert resolve_format("x.json") == "GEOJSON"
    assert resolve_format("x.bin", "PARQUET") == "PARQUET"
    with pytest.raises(ValueError):
        resolve_format("x.bin")


def test_write_only_formats(spark):
    for name in ("a.fgb", "a.parquet", "a.gen"):
        with pytest.raises(ValueError, match="writing only"):
            read_vector(spark, name)


# -- GeoJSON documents -----------------------------------------------------------------


DOCUMENT = """{"source": "a,b [x] \\"}", "features": [
 {"type":"Feature","id":123456789012345678901234567890,"geometry":{"type":"Point","coordinates":[7.438632495,46.951082877]},
  "properties":{"name":"Bern \\\\","precise":0.1234567890123456789,"nested":{"tags":["a","b"],"nullable":null}}},
 {"type":"Feature","geometry":null,"properties":null}],
 "type": "FeatureCollection", "extra": {"features": [1, 2]}}"""


def test_collection_is_read_exactly(spark, tmp_path, monkeypatch):
    path = tmp_path / "a.geojson"
    path.write_text(DOCUMENT)
    for chunk in (7, 1 << 20):
        monkeypatch.setattr(geojson, "CHUNK", chunk)
        root, collection = geojson.read_root(str(path))
        assert collection and set(root) == {"source", "type", "extra"}
        pieces = list(geojson.split_document(geojson._chunks(str(path)), True))
        assert [json.loads(p)["type"] for p in pieces] == ["Feature", "Feature"]
    rows = read_vector(spark, str(path)).collect()
    assert len(rows) == 2
    first = next(r for r in rows if r["geometry"] is not None)
    assert first["feature_id_json"] == "123456789012345678901234567890"
    assert '"precise":0.1234567890123456789' in first["properties_json"]
    context = json.loads(first["geojson_context_json"])
    assert context["root"]["source"] == 'a,b [x] "}' and context["root"]["extra"] == {"features": [1, 2]}
    assert "crs" not in context["root"]


@pytest.mark.parametrize(
    "text", ['{"type":"Point","coordinates":[1,2]}', "[]", '{"type":"FeatureCollection"}', '{"type":"FeatureCollection","features":[1]}',
             '{"type":"FeatureCollection","features":[]} x', '{"type":"FeatureCollection","features":['],
)
def test_bad_documents_fail(spark, tmp_path, text):
    path = tmp_path / "bad.json"
    path.write_text(text)
    with pytest.raises(Exception):
        read_vector(spark, str(path)).collect()


def test_empty_collection_warns(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"type":"FeatureCollection","features":[],"title":"x"}')
    (tmp_path / "f.json").write_text('{"type":"FeatureCollection","features":[]}')
    paths = [str(tmp_path / "e.json"), str(tmp_path / "f.json")]
    assert geojson.read_geojson(spark, paths).count() == 0
    assert [r["path"] for r in geojson.empty_collections(spark, paths).collect()] == paths[:1]


def test_lines_and_routes(spark, tmp_path):
    good = '{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]},"properties":{}}'
    (tmp_path / "l.txt").write_text(good + "\n\nbroken\n" + good + "\n")
    ok, bad = geojson.read_geojson(spark, str(tmp_path / "l.txt"), layout="LINES", errors="ROUTE_TO_ERROR")
    assert ok.count() == 2 and [r["error_code"] for r in bad.collect()] == ["FEATURE"]


def test_collection_round_trip(spark, tmp_path):
    path = tmp_path / "a.geojson"
    path.write_text(DOCUMENT)
    df = read_vector(spark, str(path))
    geojson.write_geojson(df, str(tmp_path / "out"))
    parts = [json.loads(p.read_text()) for p in (tmp_path / "out").glob("part-*")]
    assert all(p["type"] == "FeatureCollection" and p["source"] == 'a,b [x] "}' for p in parts)
    assert sum(len(p["features"]) for p in parts) == 2
    with pytest.raises(Exception):
        geojson.write_geojson(df, str(tmp_path / "out"))


def test_root_metadata_is_merged(spark):
    rows = spark.createDataFrame(
        [('{"a":1,"conformsTo":["x","y"]}',), ('{"a":1,"conformsTo":["z"]}',), ('{"b":{"c":2}}',)], "root string"
    )
    found = {r["key"]: (r["value"], r["conflict"]) for r in geojson.merge_root_metadata(rows, "root").collect()}
    assert found == {"a": ("1", False), "b": ('{"c":2}', False), "conformsTo": ('["x","y","z"]', False)}
    clash = rows.unionAll(spark.createDataFrame([('{"a":2}',)], "root string"))
    merged = geojson.merge_root_metadata(clash, "root").collect()
    with pytest.raises(ValueError, match="partition the rows"):
        geojson.root_text(merged, "AUTO")


def test_root_metadata_is_exact(spark):
    long = "0.1234567890123456789012345678901234567890123456"
    rows = spark.createDataFrame([('{"a":%s,"b":1.10,"s":"x\\"{","n":123456789012345678901234567890123456789012345}' % long,), ('{"b":11e-1}',), ('{"a" : %s }' % long,)], "root string")
    found = {r["key"]: (r["value"], r["conflict"]) for r in geojson.merge_root_metadata(rows, "root").collect()}
    assert found == {"a": (long, False), "b": ("1.10", False), "s": ('"x\\"{"', False), "n": ("123456789012345678901234567890123456789012345", False)}
    near = rows.unionAll(spark.createDataFrame([('{"a":%s1}' % long,)], "root string"))
    assert {r["key"]: r["conflict"] for r in geojson.merge_root_metadata(near, "root").collect()}["a"]
    wrong = spark.createDataFrame([('{"conformsTo":"x"}',)], "root string")
    with pytest.raises(Exception, match="conformsTo"):
        geojson.merge_root_metadata(wrong, "root").collect()


def test_many_root_members(spark):
    rows = spark.range(12_000).select(F.concat(F.lit('{"k'), F.col("id"), F.lit('":1}')).alias("root"))
    assert len(geojson.collected_root(geojson.merge_root_metadata(rows, "root"))) == 12_000
    clash = rows.unionAll(spark.createDataFrame([('{"k11999":2}',)], "root string"))
    with pytest.raises(ValueError, match="partition the rows"):
        geojson.collected_root(geojson.merge_root_metadata(clash, "root"))


# -- shapefile and DBF -----------------------------------------------------------------------


def write_shapefile(base, kind, bodies, fields, records):
    """A small shapefile by hand: bodies are record bytes, records DBF texts."""
    at, shp, shx = 50, b"", b""
    for i, body in enumerate(bodies):
        shp += struct.pack(">ii", i + 1, len(body) // 2) + body
        shx += struct.pack(">ii", at, len(body) // 2)
        at += 4 + len(body) // 2

    def header(size):
        return struct.pack(">i20xi", 9994, (100 + size) // 2) + struct.pack("<ii", 1000, kind) + bytes(64)

    base.with_suffix(".shp").write_bytes(header(len(shp)) + shp)
    base.with_suffix(".shx").write_bytes(header(len(shx)) + shx)
    head = b"".join(
        n.encode().ljust(11, b"\0") + t.encode() + bytes(4) + bytes([w, s]) + bytes(14) for n, t, w, s in fields
    )
    length = 1 + sum(f[2] for f in fields)
    data = b"".join(mark + b"".join(t.encode("cp1252").ljust(f[2]) for t, f in zip(texts, fields)) for mark, texts in records)
    top = struct.pack("<4BIHH", 3, 100, 1, 1, len(records), 33 + 32 * len(fields), length) + bytes(17) + bytes([3]) + bytes(2)
    base.with_suffix(".dbf").write_bytes(top + head + b"\r" + data + b"\x1a")


def polygon_body(rings):
    points = [p for r in rings for p in r]
    starts = np.cumsum([0] + [len(r) for r in rings[:-1]])
    return (
        struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), len(points))
        + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
    )


def test_shapefile_polygons(spark, tmp_path):
    shell, hole = [(0, 0), (0, 9), (9, 9), (9, 0), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
    island = [(20, 0), (20, 1), (21, 1), (21, 0), (20, 0)]
    fields = [("NAME", "C", 6, 0), ("N", "N", 5, 0), ("D", "N", 8, 2), ("OK", "L", 1, 0), ("DAY", "D", 8, 0)]
    records = [
        (b" ", [" Zürc", "12", "1.50", "T", "20240229"]),
        (b"*", ["gone", "1", "1", "F", "20240101"]),
        (b" ", ["\0" * 6, "*****", "?", "?", "00000000"]),
    ]
    bodies = [polygon_body([hole, shell, island]), polygon_body([shell]), struct.pack("<i", 0)]
    write_shapefile(tmp_path / "z", 5, bodies, fields, records)
    df = read_vector(spark, str(tmp_path / "z.shp"), assign_crs=2056, records_per_partition=2)
    assert df.columns == ["NAME", "N", "D", "OK", "DAY", "the_geom"]
    rows = df.collect()
    assert len(rows) == 2
    a = rows[0]
    assert (a["NAME"], a["N"], float(a["D"]), a["OK"], a["DAY"]) == (" Zürc", 12, 1.5, True, datetime(2024, 2, 29))
    shape = W.read(bytes(a["the_geom"]["wkb"]))
    assert [len(p.parts) for p in shape.parts] == [2, 1] and a["the_geom"]["srid"] == 2056
    assert tuple(rows[1]) == (None,) * 6
    assert list_layers(spark, str(tmp_path / "z.shp")).first()["type"] == "MULTIPOLYGON"


def test_broken_shapefile_fails(spark, tmp_path):
    body = struct.pack("<i2d", 1, 1.0, 2.0)
    write_shapefile(tmp_path / "p", 1, [body, body], [("A", "C", 1, 0)], [(b" ", ["a"]), (b" ", ["b"])])
    assert read_vector(spark, str(tmp_path / "p.shp")).count() == 2
    data = bytearray((tmp_path / "p.shp").read_bytes())
    data[100 + 28 + 3] = 9  # second record number
    (tmp_path / "p.shp").write_bytes(data)
    with pytest.raises(Exception, match="record header"):
        read_vector(spark, str(tmp_path / "p.shp")).collect()


def test_point_with_z_and_m():
    body = struct.pack("<i4d", 11, 1, 2, 3, -2e38)
    from mapweave.sources.shapefile import decode_shape

    shape = decode_shape(body, 11)
    assert shape.z and shape.m and np.isnan(shape.parts[0, 3])
    with pytest.raises(ValueError):
        decode_shape(body[:-3], 11)
    with pytest.raises(ValueError, match="differs"):
        decode_shape(body, 1)


def test_dbf_names_and_widths(spark):
    df = spark.createDataFrame([("x", 1, 1.0, True)], "`Zürich-Länge` string, `1a` long, `Zuerich_La` double, `zuerich_la2` boolean")
    fields, notes = dbf.dbf_schema(df)
    assert [f.name for f in fields.values()] == ["Zurich_Lan", "_1a", "Zuerich_La", "zuerich__1"]
    assert [(f.type, f.width, f.scale) for f in fields.values()] == [("C", 254, 0), ("N", 20, 0), ("N", 33, 15), ("L", 1, 0)]
    assert ("1a", "field-name") in notes
    with pytest.raises(ValueError):
        dbf.dbf_schema(df, {"1a": dbf.DbfOverride(width=300)})


def test_dbf_conform_warnings(spark):
    df = spark.createDataFrame(
        [("aäb€", 1.005, datetime(2024, 1, 1, 5)), (None, 2.5, datetime(2024, 1, 2)), ("abcdef", 123456.0, None)],
        "s string, n double, t timestamp",
    )
    fields, _ = dbf.dbf_schema(df, {"s": dbf.DbfOverride(width=4), "n": dbf.DbfOverride(width=6, scale=2)})
    out = dbf.conform_dbf(df, fields)
    rows = out.collect()
    assert [r["s"] for r in rows] == ["aäb", None, "abcd"]
    assert [None if r["n"] is None else float(r["n"]) for r in rows] == [1.01, 2.5, None]
    assert rows[2]["error"]["message"] == "Number exceeds field width"
    found = {(r["field"], r["cause"]): r["n"] for r in summarize_warnings(out).collect()}
    assert found[("s", "text-truncation")] == 2 and found[("n", "rounding")] == 1
    assert found[("t", "date-time-loss")] == 1 and found[("t", "null-attribute")] == 1
    latin = dbf.conform_dbf(df, fields, "ISO-8859-1").select("s").collect()
    assert [r["s"] for r in latin] == ["aäb?", None, "abcd"]


def test_input_charset():
    assert dbf.input_charset("UTF-8", "cp1252", 1) == ("utf-8", False)
    assert dbf.input_charset(None, "﻿UTF-8\n", 1) == ("utf-8", False)
    assert dbf.input_charset(None, None, 0x57) == ("cp1252", False)
    assert dbf.input_charset("", "", 0) == ("iso-8859-1", True)


# -- GeoPackage ----------------------------------------------------------------------------------


def blob(wkb, srid=2056, flags=1):
    return b"GP\0" + bytes([flags]) + struct.pack("<i", srid) + wkb


def write_geopackage(path, rows):
    db = sqlite3.connect(path)
    db.executescript(
        """PRAGMA application_id = 1196444487;
        CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT);
        CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INT, z INT, m INT);
        CREATE TABLE Places (fid INTEGER PRIMARY KEY, label TEXT(20), seen DATETIME, size DOUBLE, shape BLOB);
        INSERT INTO gpkg_contents VALUES ('Places', 'features');
        INSERT INTO gpkg_geometry_columns VALUES ('Places', 'shape', 'POINT', 2056, 0, 0);"""
    )
    db.executemany("INSERT INTO Places (label, seen, size, shape) VALUES (?, ?, ?, ?)", rows)
    db.commit()
    db.close()


def test_geopackage_layer(spark, tmp_path):
    path = str(tmp_path / "a.gpkg")
    point = W.write(W.Shape(W.POINT, False, False, np.array([[1.0, 2.0]])))
    empty = W.write(W.Shape(W.POINT, False, False, np.empty((0, 2))))
    write_geopackage(path, [("a", "2024-01-01T00:00:00Z", 1, blob(point)), ("b", None, None, None), ("c", "2024-01-02", 2.5, blob(empty, flags=17))])
    df = read_vector(spark, path, layer="places", rows_per_partition=1)
    assert df.columns == ["label", "seen", "size", "shape"] and df.schema["label"].metadata == {"length": 20}
    rows = {r["label"]: r for r in df.select("*", st_isempty("shape").alias("empty")).collect()}
    assert (rows["a"]["shape"]["xmin"], rows["a"]["seen"]) == (1.0, datetime(2024, 1, 1))
    assert rows["b"]["shape"] is None and rows["b"]["empty"] is None
    assert rows["c"]["empty"] is True
    assert [r["field"] for r in list_layers(spark, path).collect()] == ["label", "seen", "size"]
    with pytest.raises(ValueError, match="not found"):
        read_vector(spark, path, layer="other")


def test_blob_rules():
    point = W.write(W.Shape(W.POINT, False, False, np.array([[1.0, 2.0]])))
    assert geopackage.decode_blob(blob(point), 2056).kind == W.POINT
    for bad in (b"XX" + blob(point)[2:], blob(point, flags=0x21), blob(point, 21781), blob(point, flags=17), blob(point + b"x"), blob(point)[:9]):
        with pytest.raises(ValueError):
            geopackage.decode_blob(bad, 2056)


def test_blob_round_trip(spark):
    df = spark.range(3).select("id", st_point(F.col("id"), F.col("id") + 1, 2056).alias("g"))
    back = df.select("id", geopackage.decode_gpkg(geopackage.encode_gpkg("g"), 2056).alias("d"))
    rows = back.select("id", "d.geometry.xmin", "d.geometry.ymax", "d.error").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(i, float(i), i + 1.0, None) for i in range(3)]


# -- GENERATE --------------------------------------------------------------------------------------


LINE = W.Shape(W.LINESTRING, True, False, np.array([[2600000, 1200000, 400], [2600010.5, 1200000, 401.25]]))
SQUARE = W.Shape(W.POLYGON, False, False, [ring((0, 0), (10, 0), (10, 10), (0, 10))])


@pytest.mark.parametrize(
    "shape, options, text",
    [
        (W.Shape(W.POINT, False, False, np.array([[2600000.0, -0.0]])), generate.GenerateOptions(), "7,2600000,0"),
        (W.Shape(W.POINT, True, False, np.array([[1.005, 2, 3]])), generate.GenerateOptions("POINT", "XYZ", decimals=2), "7,1.01,2.00,3.00"),
        (LINE, generate.GenerateOptions("LINE", "XY", discard_extra=True, comma=False), "7\n2600000 1200000\n2600010.5 1200000\nEND"),
        (LINE, generate.GenerateOptions("LINE", "XYZ"), "7\n2600000,1200000,400\n2600010.5,1200000,401.25\nEND"),
        (SQUARE, generate.GenerateOptions("POLYGON"), "7,AUTO\n0,0\n0,10\n10,10\n10,0\n0,0\nEND"),
    ],
)
def test_generate_text(spark, shape, options, text):
    assert generated(spark, [(7, shape)], options) == [(text, None)]


def generated(spark, rows, options):
    out = generate.encode_generate(shapes_df(spark, rows).coalesce(1), "id", "geometry", options, "e")
    return [(r["e"]["text"], r["e"]["error"]) for r in out.collect()]


def test_generate_numbers(spark):
    values = [0.1, -0.0, 1e-7, 123456789.125, 1e21, -2.5e-5, 100.0, 1 / 3, 1e-300, 1.7976931348623157e308]
    rows = [(i, W.Shape(W.POINT, False, False, np.array([[v, 1.0]]))) for i, v in enumerate(values)]
    want = [f"{i},{np.format_float_positional(v + 0.0, trim='-')},1" for i, v in enumerate(values)]
    assert [t for t, _ in generated(spark, rows, generate.GenerateOptions())] == want


def test_generate_rejections(spark):
    polygon, flat = generate.GenerateOptions("POLYGON"), generate.GenerateOptions("POLYGON", decimals=0)
    short = W.Shape(W.LINESTRING, False, False, np.array([[0, 0], [0.1, 0]]))
    tiny = W.Shape(W.POLYGON, False, False, [ring((0, 0), (0.1, 0), (0, 0.1))])
    hole = SQUARE._replace(parts=SQUARE.parts * 2)
    tilted = W.Shape(W.POLYGON, True, False, [np.array([[0, 0, 1], [9, 0, 1], [0, 9, 1], [0, 0, 2.0]])])
    for rows, options, words in (
        ([(-99999, SQUARE)], polygon, "reserved"),
        ([(1, hole)], polygon, "holes"),
        ([(None, SQUARE)], polygon, "id is missing"),
        ([(1, None)], polygon, "no geometry"),
        ([(1, LINE)], polygon, "no single polygon"),
        ([(1, LINE)], generate.GenerateOptions("LINE"), "extra"),
        ([(1, short)], generate.GenerateOptions("LINE", decimals=0), "collapses"),
        ([(1, tiny)], flat, "rounding"),
        ([(1, SQUARE)], generate.GenerateOptions("POLYGON", "XYZ"), "finite"),
        ([(1, tilted)], generate.GenerateOptions("POLYGON", "XYZ"), "height"),
    ):
        ((text, error),) = generated(spark, rows, options)
        assert text is None and words in error


def test_generate_files(spark, tmp_path):
    df = spark.range(10).select(F.col("id"), st_point(F.col("id"), F.lit(1), 0).alias("g"))
    generate.write_generate(df, str(tmp_path / "out"), "g", generate.GenerateOptions(), order_by="id", start_id=100)
    lines = [line for p in (tmp_path / "out").glob("part-*") for line in p.read_text().splitlines()]
    points = sorted(line for line in lines if line != "END")
    assert points == sorted(f"{100 + i},{i},1" for i in range(10)) and "END" in lines
    with pytest.raises(Exception, match="overflow"):
        generate.generate_rows(df, "g", generate.GenerateOptions(), order_by="id", start_id=2**63 - 5).collect()


# -- rings ---------------------------------------------------------------------------------------------


def test_ring_assembly(spark):
    def square(x, y, s):
        return [(float(a), float(b)) for a, b in ((x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y))]

    rows = [(1, square(1, 1, 8)), (1, square(0, 0, 10)), (1, square(2, 2, 2)), (2, square(0, 0, 1))]
    df = spark.createDataFrame(rows, "id int, ring array<struct<x:double,y:double>>")
    out = assemble_polygons(df, "id", "ring", 2056)
    shapes = {r["id"]: W.read(bytes(r["geometry"]["wkb"])) for r in out.collect()}
    # The hole's inner ring is an island, a polygon of its own.
    assert sorted(len(p.parts) for p in shapes[1].parts) == [1, 2] and len(shapes[2].parts) == 1
    assert out.select(st_type("geometry")).distinct().count() == 1


# -- TIFF -------------------------------------------------------------------------------------------------


def write_tiff(path, array, *, nodata=None, deflate=False, tiled=0, scale=(1.0, 1.0), origin=(0.0, 0.0), epsg=2056, metadata="", palette=None):
    """Little-endian TIFF of one band, strips of two rows or square tiles."""
    h, w = array.shape
    kind = {"u1": (1, 8), "f4": (3, 32), "f8": (3, 64), "i2": (2, 16)}[array.dtype.str[1:]]
    blocks = []
    if tiled:
        for r in range(0, h, tiled):
            for c in range(0, w, tiled):
                block = np.zeros((tiled, tiled), array.dtype)
                part = array[r : r + tiled, c : c + tiled]
                block[: part.shape[0], : part.shape[1]] = part
                blocks.append(block.tobytes())
    else:
        blocks = [array[r : r + 2].tobytes() for r in range(0, h, 2)]
    if deflate:
        blocks = [zlib.compress(b) for b in blocks]
    body, offsets = b"", []
    for b in blocks:
        offsets.append(8 + len(body))
        body += b
    tags = {256: ("I", [w]), 257: ("I", [h]), 258: ("H", [kind[1]]), 259: ("H", [8 if deflate else 1]), 262: ("H", [1]), 277: ("H", [1]), 339: ("H", [kind[0]]),
            33550: ("d", [*scale, 0.0]), 33922: ("d", [0, 0, 0, origin[0], origin[1], 0]),
            34735: ("H", [1, 1, 0, 1, 3072, 0, 1, epsg])}
    if tiled:
        tags.update({322: ("I", [tiled]), 323: ("I", [tiled]), 324: ("I", offsets), 325: ("I", [len(b) for b in blocks])})
    else:
        tags.update({273: ("I", offsets), 278: ("I", [2]), 279: ("I", [len(b) for b in blocks])})
    if nodata is not None:
        tags[42113] = ("s", str(nodata).encode() + b"\0")
    if palette is not None:
        tags.update({262: ("H", [3]), 320: ("H", palette.T.ravel().tolist())})
    if metadata:
        tags[42112] = ("s", metadata.encode() + b"\0")
    entries, at = b"", 8 + len(body)
    data = b""
    start = at + 2 + 12 * len(tags) + 4
    for tag in sorted(tags):
        code, values = tags[tag]
        raw = values if code == "s" else struct.pack("<" + code * len(values), *values)
        field = {"s": 2, "H": 3, "I": 4, "d": 12}[code]
        value = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", start + len(data))
        if len(raw) > 4:
            data += raw
        entries += struct.pack("<HHI", tag, field, len(values)) + value
    path.write_bytes(b"II*\0" + struct.pack("<I", at) + body + struct.pack("<H", len(tags)) + entries + bytes(4) + data)


def test_byte_raster_statistics(spark, tmp_path):
    """4 x 3 pixels, value = x + 4 y: the polygon over all of them."""
    array = np.arange(12, dtype="u1").reshape(3, 4)
    write_tiff(tmp_path / "b.tif", array, nodata=255, origin=(2600000.0, 1200003.0))
    meta, tiles = read_tiff(spark, str(tmp_path / "b.tif"), tile_size=2)
    m = meta.first()
    assert (m["width"], m["height"], m["srid"], m["bands"][0]["nodata"]) == (4, 3, 2056, 255.0)
    zones = spark.range(1).select("id", st_box(F.lit(2600000.0), F.lit(1200000.0), F.lit(2600004.0), F.lit(1200003.0), 2056).alias("geometry"))
    r = zonal_stats(zones, "geometry", meta, tiles, key="id", raster_id=m["raster_id"], stats="mean min max").first()
    assert (r["raster_mean"], r["raster_min"], r["raster_max"], r["raster_count"], r["raster_status"]) == (5.5, 0.0, 11.0, 12, "OK")


@pytest.mark.parametrize("deflate, tiled", [(False, 0), (True, 0), (True, 16)])
def test_tiff_layouts(spark, tmp_path, deflate, tiled):
    array = (np.arange(37 * 29).reshape(29, 37) / 7).astype("f4")
    items = '<GDALMetadata><Item name="SCALE" sample="0" role="scale">0.5</Item><Item name="OFFSET" sample="0" role="offset">100</Item></GDALMetadata>'
    write_tiff(tmp_path / "f.tif", array, deflate=deflate, tiled=tiled, metadata=items)
    meta, tiles = read_tiff(spark, [str(tmp_path / "f.tif")], tile_size=10)
    rows = pixels_from_tiles(tiles).collect()
    out = np.zeros(array.shape, "f4")
    for r in rows:
        out[r["y"], r["x"]] = r["v"]
    assert len(rows) == array.size and (out == array).all()
    band = meta.first()["bands"][0]
    assert (band["scale"], band["offset"], band["data_type"]) == (0.5, 100.0, "FLOAT32")


def test_tiff_palette(spark, tmp_path):
    """The colour map lists all reds, then all greens, then all blues."""
    palette = np.random.default_rng(2).integers(0, 65536, (256, 3))
    array = np.arange(256, dtype="u1").reshape(16, 16)
    write_tiff(tmp_path / "p.tif", array, nodata=9, palette=palette, origin=(0.0, 16.0))
    meta, tiles = read_tiff(spark, str(tmp_path / "p.tif"), tile_size=8)
    assert meta.first()["color"] == "PALETTE" and [tuple(c) for c in meta.first()["palette"]] == [tuple(c) for c in palette.tolist()]
    rgba = np.zeros((256, 4))
    for r in pixels_from_tiles(expand_palettes(meta, tiles)[1]).collect():
        rgba[r["y"] * 16 + r["x"], r["band"] - 1] = r["v"]
    want = np.column_stack([palette, np.full(256, 65535)])
    want[9] = 0
    assert np.array_equal(rgba, want)


def test_unsupported_tiff(spark, tmp_path):
    (tmp_path / "x.tif").write_bytes(b"II+\0" + bytes(20))
    with pytest.raises(Exception, match="classic TIFF"):
        read_tiff(spark, str(tmp_path / "x.tif"))[0].collect()


def test_scale_and_offset_apply_after_nodata(spark):
    meta = raster_meta(spark, [dict(raster_id="r", width=2, height=1, origin_x=0, origin_y=1, pixel_x=1, pixel_y=-1, tile_size=4, bands=[dict(nodata=0.0, scale=0.5, offset=100.0)])])
    pixels = spark.createDataFrame([("r", 1, 0, 0, 8.0), ("r", 1, 1, 0, 0.0)], "raster_id string, band int, x long, y long, v double")
    zones = spark.range(1).select("id", st_box(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(1.0)).alias("g"))
    r = zonal_stats(zones, "g", meta, tiles_from_pixels(pixels, meta), key="id", raster_id="r").first()
    assert (r["raster_mean"], r["raster_count"]) == (104.0, 1)


def test_feature_options_pass_through(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]},"properties":{"k":5}}')
    df = read_vector(spark, str(tmp_path / "a.json"), geometry_field_name="shape", assign_crs="EPSG:3857")
    assert df.first()["shape"]["srid"] == 3857 and isinstance(FeatureOptions().geometry, str)
    ok, bad = with_errors(df.withColumn("error", F.lit(None).cast("struct<code:string,field:string,message:string>")), "FAIL")
    assert ok.count() == 1 and bad is None
