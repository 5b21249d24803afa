import math
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.functions import crs, exact
from mapweave.functions import wkb as W
from mapweave.functions.geometry import (
    densify_box, linearize, parse_crs, register, st_geomfromwkb, st_hasm, st_hasz, st_isempty, st_point, st_type, to_iso_wkb, validate_wkb,
)
from mapweave.operators import append, cluster, export, joins, vector
from mapweave.operators.errors import with_errors
from mapweave.plans import tables as P
from mapweave.sources.spatial_parquet import crs_text, read_spatial_parquet, write_spatial_parquet
from mapweave.sources.store import open_store, resolve_layer


def frame(spark, shapes, srid=2056):
    rows = [(i, None if s is None else bytearray(W.write(s))) for i, s in enumerate(shapes)]
    return spark.createDataFrame(rows, "id int, wkb binary").select("id", "wkb", st_geomfromwkb("wkb", srid).alias("g"))


def point(*c, z=False, m=False):
    return W.Shape(W.POINT, z, m, np.array([c], float) if c else np.empty((0, 2 + z + m)))


def line(*points, z=False, m=False):
    return W.Shape(W.LINESTRING, z, m, np.array(points, float))


ARC = W.Shape(W.CIRCULARSTRING, False, False, np.array([[0, 0], [1, 1], [2, 0.0]]))
CIRCLE = W.Shape(W.CIRCULARSTRING, False, False, np.array([[0, 0], [2, 0], [0, 0.0]]))


# -- geometry --------------------------------------------------------------------------


@pytest.mark.parametrize("z, m", [(False, False), (True, False), (False, True), (True, True)])
def test_wkb_round_trip_and_type_codes(z, m):
    dims = 2 + z + m
    rows = np.arange(5 * dims, dtype=float).reshape(5, dims)
    rows[4] = rows[0]
    poly = W.Shape(W.POLYGON, z, m, [rows])
    for shape in (W.Shape(W.POINT, z, m, rows[:1]), W.Shape(W.LINESTRING, z, m, rows), poly, W.Shape(W.MULTIPOLYGON, z, m, [poly]),
                  W.Shape(W.COMPOUNDCURVE, z, m, [W.Shape(W.CIRCULARSTRING, z, m, rows[:3]), W.Shape(W.LINESTRING, z, m, rows[2:4])])):
        data = W.write(shape)
        assert int.from_bytes(data[1:5], "big") == shape.kind + 1000 * z + 2000 * m
        assert W.write(W.read(data)) == data


def test_wkb_rejects_bad_bytes(spark):
    good = W.write(line((0, 0), (1, 1)))
    bad = [good + b"x", good[:-1], b"\2" + good[1:], good[:1] + b"\0\0\0\x63" + good[5:], good[:5] + b"\xff\xff\xff\xff" + good[9:]]
    nested = W.write(point(1, 2))
    for _ in range(70):
        nested = b"\0\0\0\0\7\0\0\0\1" + nested
    bad.append(nested)
    df = spark.createDataFrame([(bytearray(b),) for b in [good, *bad]], "w binary")
    errors = [r[0] for r in df.select(validate_wkb("w")).collect()]
    assert errors[0] is None and all(errors[1:])
    with pytest.raises(Exception):
        df.select(st_geomfromwkb("w")).collect()


def test_arc_envelopes():
    assert W.envelope(ARC) == pytest.approx((0, 0, 2, 1))
    assert W.envelope(CIRCLE) == pytest.approx((0, -1, 2, 1))
    assert W.envelope(point()) is None
    with pytest.raises(W.WkbError):
        W.envelope(line((0, 0), (math.inf, 1)))


def test_linearize_stays_within_tolerance(spark):
    df = frame(spark, [ARC, CIRCLE, line((0, 0), (1, 1))])
    for row in df.select(linearize("g", 0.01).alias("l")).collect()[:2]:
        shape = W.read(bytes(row["l"]["wkb"]))
        assert shape.kind == W.LINESTRING
        middle = (shape.parts[1:] + shape.parts[:-1]) / 2
        assert np.abs(np.hypot(middle[:, 0] - 1, middle[:, 1]) - 1).max() <= 0.0101


def test_null_and_empty_differ(spark):
    df = frame(spark, [None, point(), point(1, 2)])
    rows = df.select(st_isempty("g"), st_type("g"), F.col("g").isNull()).collect()
    assert [tuple(r) for r in rows] == [(None, None, True), (True, "POINT", False), (False, "POINT", False)]
    register(spark)
    df.createOrReplaceTempView("shapes")
    assert spark.sql("SELECT st_maxx(g) FROM shapes WHERE NOT st_isempty(g)").collect()[0][0] == 1.0


def test_iso_wkb_dimensions(spark):
    df = frame(spark, [point(1, 2, 3, z=True), point(1, 2)])
    assert [r[0] for r in df.select(st_hasz("g")).collect()] == [True, False]
    out = df.select(to_iso_wkb("g", z=True, m=False).alias("w")).collect()
    assert all(W.read(bytes(r["w"])).z for r in out)
    assert not any(r[0] for r in df.select(st_hasm("g")).collect())


def test_crs(spark):
    assert [parse_crs(c) for c in ("", None, "EPSG:2056", " 21781 ", "GEOGCS[...]")] == [0, 0, 2056, 21781, 0]
    lon, lat = crs.transform_xy(np.array([2600000.0]), np.array([1200000.0]), 2056, 4326)
    assert abs(lon[0] - 7.438632495) < 2e-7 and abs(lat[0] - 46.951082877) < 2e-7
    for code in (3857, 2056, 21781, 32632, 32731):
        x, y = crs.transform_xy(np.array([8.1]), np.array([46.9]), 4326, code)
        back = crs.transform_xy(x, y, code, 4326)
        assert abs(back[0][0] - 8.1) < 2e-8 and abs(back[1][0] - 46.9) < 2e-8
    # Published UTM value: 9 E, 48 N lies on the central meridian of zone 32.
    x, y = crs.transform_xy(np.array([9.0]), np.array([48.0]), 4326, 32632)
    assert x[0] == pytest.approx(500000) and y[0] == pytest.approx(5316300.5, abs=1)
    with pytest.raises(ValueError, match="Unsupported"):
        crs.transform_points("x", "y", 4326, 9999)
    df = spark.createDataFrame([(7.5, 46.9)], "x double, y double")
    r = df.select(crs.transform_points("x", "y", 4326, 2056).alias("p")).first()["p"]
    assert 2604000 < r["x"] < 2605000
    with pytest.raises(Exception, match="required"):
        frame(spark, [point(1, 2)], 0).select(crs.transform("g", 2056)).collect()


def test_densified_box(spark):
    p = spark.range(1).select(densify_box(0, 0, 10, 5).alias("p")).first()["p"]
    assert len(p) == 301 and (p[0]["x"], p[0]["y"]) == (p[-1]["x"], p[-1]["y"]) == (0, 0)
    assert max(abs(a["x"] - b["x"]) + abs(a["y"] - b["y"]) for a, b in zip(p, p[1:])) <= 0.1 + 1e-12


# -- schema, filter, conform ----------------------------------------------------------------


def test_filter_bounds(spark, folder):
    df = P.points(spark, folder)
    assert vector.filter_bbox(df, "geometry").count() == 150
    for bad in ((1, 2, 3, None), (1, 2, 0, 3), (0, 0, math.inf, 1)):
        with pytest.raises(ValueError):
            vector.filter_bbox(df, "geometry", *bad)
    with pytest.raises(ValueError, match="Geometry column"):
        vector.filter_bbox(df.select("id"), "id", 0, 0, 1, 1)


def test_filter_reaches_the_scan(spark, folder, tmp_path):
    P.points(spark, folder).write.parquet(str(tmp_path / "p"))
    out = vector.filter_bbox(spark.read.parquet(str(tmp_path / "p")), "geometry", 0, 0, 1, 1).select("id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(geometry.xmin,1.0)" in plan.replace(" ", "") or "geometry.xmin" in plan.split("PushedFilters")[1]


def test_infer_schema(spark):
    infer = vector.infer_geometry_schema
    assert infer(frame(spark, [None, point(), point(1, 2)]), "g") == vector.GeometrySchema("POINT", srid=2056)
    z = W.Shape(W.POINT, True, False, np.array([[1, 2, np.nan]]))
    assert infer(frame(spark, [z]), "g").z == "ABSENT"
    assert infer(frame(spark, [point(1, 2, 3, 4, z=True, m=True)]), "g").dimension == "XYZM"
    multi = W.Shape(W.MULTIPOINT, False, False, [point(1, 2)])
    assert infer(frame(spark, [multi, point(1, 2)]), "g").type == "MULTIPOINT"
    with pytest.raises(ValueError, match="Mixed"):
        infer(frame(spark, [point(1, 2), line((0, 0), (1, 1))]), "g")
    with pytest.raises(ValueError, match="null"):
        infer(frame(spark, [None, point()]), "g")
    with pytest.raises(ValueError, match="dimension"):
        infer(frame(spark, [point(1, 2)]), "g", type="POINT")
    assert infer(frame(spark, []), "g") is None


def test_conform(spark):
    schema = vector.GeometrySchema("MULTILINESTRING", srid=2056)
    df = frame(spark, [line((0, 0), (1, 1)), ARC, point(1, 2), line((0, 0, 1), (1, 1, 2), z=True), None])
    rows = vector.conform_layer(df, "g", schema).select(st_type("g").alias("t"), "error.message", "warnings").collect()
    assert [r["t"] for r in rows] == ["MULTILINESTRING", "MULTILINESTRING", None, None, None]
    assert [r["message"] for r in rows] == [None, None, "Geometry does not match output type MULTILINESTRING", "Extra Z ordinate", None]
    assert [len(r["warnings"]) for r in rows] == [0, 1, 0, 0, 0]
    other = vector.conform_layer(frame(spark, [point(1, 2)], 21781), "g", vector.GeometrySchema("POINT", srid=2056))
    assert other.first()["error"]["message"] == "Conflicting geometry SRID"
    need = vector.GeometrySchema("POINT", "REQUIRED", srid=2056)
    assert "Required Z" in vector.conform_layer(frame(spark, [point(1, 2)]), "g", need).first()["error"]["message"]


def test_extent_and_precision(spark):
    df = frame(spark, [None, point(), point(1, 2), point(5, -1)])
    assert tuple(vector.layer_extent(df, "g").first()) == (1, -1, 5, 2, 2)
    assert vector.merge_extent((None,) * 4, (1, 2, 3, 4)) == (1, 2, 3, 4)
    assert vector.xy_precision(True).x_origin == -400
    p = vector.xy_precision(False, unit_metres=0.3048)
    assert p.resolution == pytest.approx(0.0001 / 0.3048) and p.tolerance == pytest.approx(0.001 / 0.3048)
    assert vector.xy_precision(False, resolution=0.5).tolerance == 5
    for bad in (dict(resolution=0), dict(x_origin=1.0), dict(unit_metres=None)):
        with pytest.raises(ValueError):
            vector.xy_precision(False, **bad)


# -- clustering -----------------------------------------------------------------------------------


def test_index_equals_scan(spark):
    """2000 points, the box query through the tree and by brute force."""
    df = spark.range(2000).select("id", st_point(F.col("id"), F.col("id") % 17).alias("g"))
    out = cluster.cluster_by_hilbert(df, "g", "id", partitions=5)
    tree = cluster.packed_rtree(out, "g")
    sizes = {r["level"]: r["n"] for r in tree.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert [sizes[k] for k in sorted(sizes)] == cluster.level_sizes(2000) == [2000, 125, 8, 1]
    hits = out.join(cluster.search_rtree(tree, 123, 2, 345, 8), "rank", "left_semi")
    want = {i for i in range(123, 346) if 2 <= i % 17 <= 8}
    assert {r["id"] for r in hits.select("id").collect()} == want
    ranks = out.select("rank", "hilbert", "id").orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(2000))
    assert [(r["hilbert"], r["id"]) for r in ranks] == sorted((r["hilbert"], r["id"]) for r in ranks)


def test_cluster_of_equal_points(spark):
    df = spark.range(50).select("id", st_point(F.lit(1.0), F.lit(1.0)).alias("g"))
    out = cluster.cluster_by_hilbert(df, "g", "id")
    assert [r["id"] for r in out.orderBy("rank").collect()] == list(range(50))
    assert cluster.level_sizes(1) == [1, 1] and cluster.level_sizes(0) == []


def test_empty_geometries_and_the_index(spark):
    df = frame(spark, [point(1, 2), None, point()])
    with pytest.raises(Exception, match="nonempty"):
        cluster.cluster_by_hilbert(df, "g", "id").collect()
    assert cluster.cluster_by_hilbert(df, "g", "id", empty="SKIP").count() == 1
    rows = cluster.prepare_unindexed(df, "g").collect()
    assert [r["g"] is None for r in rows] == [False, True, True] and [len(r["warnings"]) for r in rows] == [0, 0, 1]


# -- joins -------------------------------------------------------------------------------------------


def test_join_on_boundaries_and_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(joins, "POINTS_PER_CELL", 20)
    pts = spark.range(400).select("id", st_point(F.floor(F.col("id") / 20) % 20 / 2, F.col("id") % 20 / 2).alias("p"))
    tri = W.Shape(W.POLYGON, False, False, [np.array([[1, 1], [8, 1], [1, 8], [1, 1.0]]), np.array([[2, 2], [4, 2], [2, 4], [2, 2.0]])])
    polygons = frame(spark, [tri]).select(F.col("id").alias("z"), "g")
    got = {r["id"] for r in joins.spatial_join(pts, "p", polygons, "g", 1.5, ["z"]).collect()}

    def inside(x, y):
        outer = x >= 1 and y >= 1 and x + y <= 9
        hole = x > 2 and y > 2 and x + y < 6
        return outer and not hole

    assert got == {i for i in range(400) if inside(i // 20 / 2, i % 20 / 2)}


def test_spatial_join_sends_no_cover_whole(spark):
    """A cover has an unknown number of rows, so it is shuffled, however small."""
    pts = spark.range(10).select("id", st_point(F.col("id") / 10, 1 + F.col("id") / 10).alias("p"))
    tri = W.Shape(W.POLYGON, False, False, [np.array([[0, 0], [4, 0], [0, 4], [0, 0.0]])])
    joined = joins.spatial_join(pts, "p", frame(spark, [tri]).select(F.col("id").alias("z"), "g"), "g", 1.5, ["z"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and joined.count() == 10


def test_relationship_findings(spark):
    origin = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dest = spark.createDataFrame([(1,), (1,), (3,), (3,), (None,)], "f int")
    rows = {r["finding"]: (r["keys"], r["rows"]) for r in joins.check_relationship(origin, dest, "k", "f", "ONE_TO_ONE").collect()}
    assert rows == {"DUPLICATE_KEY": (1, 2), "ORPHAN": (1, 2), "DUPLICATE_REFERENCE": (2, 4)}


# -- append and export ----------------------------------------------------------------------------------


TARGET = append.TargetSchema(
    "l",
    (append.TargetColumn("fid", "INTEGER", primary=True), append.TargetColumn("Name", "TEXT(3)", required=True, default="'d'"),
     append.TargetColumn("n", "SMALLINT"), append.TargetColumn("geom", "POINT")),
    "geom", "POINT", 2056,
)


def test_append_plan_and_rows(spark):
    df = frame(spark, [point(1, 2), line((0, 0), (1, 1)), None], 0).select(
        F.expr("CASE id WHEN 0 THEN 'abc' WHEN 1 THEN 'abcd' END").alias("NAME"), F.lit(70000).alias("N"), F.col("g").alias("incoming")
    )
    plan = append.plan_append(df, TARGET, "incoming")
    out = append.append_rows(df, plan, "incoming")
    assert out.columns == ["Name", "n", "geom", "error"]
    rows = out.collect()
    assert [r["error"]["field"] for r in rows] == ["n", "Name", "Name"]
    assert rows[2]["error"]["message"] == "NULL in required field Name" and rows[0]["geom"]["srid"] == 2056
    shape = append.append_rows(df.drop("NAME", "N"), append.plan_append(df.drop("NAME", "N"), TARGET, "incoming"), "incoming")
    assert [(r["Name"], r["error"] and r["error"]["message"]) for r in shape.collect()] == [
        ("d", None), ("d", "Geometry type LINESTRING differs from target POINT"), ("d", None)
    ]
    assert "fid : INTEGER (generated primary key)" in plan.preview()


@pytest.mark.parametrize("column, match", [("fid", "generated"), ("other", "Unknown"), ("geom", "Incompatible")])
def test_append_rejections(spark, column, match):
    df = frame(spark, [point(1, 2)]).select(F.col("id").alias(column), "g")
    with pytest.raises(ValueError, match=match):
        append.plan_append(df, TARGET, "g")


def test_append_subtypes():
    assert "CIRCULARSTRING" in append.SUBTYPES["CURVE"] and "MULTIPOINT" in append.SUBTYPES["GEOMETRYCOLLECTION"]
    assert append.generated_key_name(["FID", "_fid"]) == "__fid"
    with pytest.raises(ValueError):
        append.check_layer_name("gpkg_x")


SCHEMA = """{"schemaVersion": 1,
 "domains": [{"name":"usage","type":"CODED","fieldType":"INT32","values":[{"code":"1","label":"farm"},{"code":"2","label":"mill"}],"splitPolicy":"DUPLICATE"},
             {"name":"depth","type":"RANGE","fieldType":"FLOAT64","minValue":"0","maxValue":"1000"}],
 "datasets": [
  {"name":"buildings","kind":"FEATURE_CLASS","geometry":{"source":"g","name":"shape","type":"Point","dimension":"XY","crs":"EPSG:2056","precisionMode":"AUTO","spatialIndex":true},
   "fields":[{"name":"id","type":"INT32"},{"name":"status","type":"INT32","domain":"usage"},{"name":"height","type":"FLOAT64","nullable":true,"domain":"depth"}]},
  {"name":"entrances","kind":"TABLE","fields":[{"name":"id","type":"INT32"},{"name":"building_id","type":"INT32"},{"name":"label","type":"STRING","length":80}]}],
 "relationships": [{"name":"has","origin":"buildings","destination":"entrances","originKey":"id","foreignKey":"building_id","cardinality":"ONE_TO_MANY","forwardLabel":"doors"}]}"""


def test_export_schema_checks():
    schema = export.load_export_schema(SCHEMA)
    assert schema.dataset("entrances").fields[2].width == 80
    assert schema.domain("depth").high == "1000" and schema.dataset("buildings").geometry.options == {"precisionMode": "AUTO", "spatialIndex": True}
    for old, new in (
        ('"schemaVersion": 1', '"schemaVersion": 2'),
        ('"schemaVersion": 1', '"schemaVersion": true'),
        ('"kind":"TABLE"', '"kind":"FEATURE_CLASS"'),
        ('"originKey":"id"', '"originKey":"OBJECTID"'),
        ('"originKey":"id"', '"originKey":"height"'),
        ('"ONE_TO_MANY"', '"MANY_TO_MANY"'),
        ('"name":"has"', '"name":"GDB_has"'),
        ('"length":80', '"length":80,"width":1'),
        ('"length":80', '"length":80,"length":81'),
        ('"name":"label"', '"name":"ID"'),
        ('"domain":"depth"', '"domain":"usage"'),
        ('"minValue":"0",', ""),
        ('"type":"CODED"', '"kind":"CODED"'),
    ):
        with pytest.raises(ValueError):
            export.load_export_schema(SCHEMA.replace(old, new))
    with pytest.raises(ValueError, match="no member.*is missing"):
        export.load_export_schema(SCHEMA.replace('"type":"RANGE"', '"sort":"RANGE"'))
    assert export.load_export_schema(SCHEMA, schema).domains == ()
    with pytest.raises(ValueError, match="another domain"):
        export.load_export_schema(SCHEMA.replace('"1000"', '"1001"'), schema)


def test_range_domains_are_exact(spark):
    rows = [("1.0000000000000000001",), ("1",), ("0",), ("-0.0",), ("-1e-30",), ("0.99999999999999999999999999",), ("1e0",), ("10e-1",), ("x",), (None,)]
    df = spark.createDataFrame(rows, "v string")

    def outside(low, high, kind="string"):
        domain = export.Domain("d", "FLOAT64", low=low, high=high)
        data = df.select(F.col("v").try_cast(kind).alias("v"))
        return [r["v"] for r in export.validate_domains(data, {"v": domain}).filter("error IS NOT NULL").collect()]

    assert outside("0", "1") == ["1.0000000000000000001", "-1e-30", "x"]
    assert outside("-5", "1e22") == ["x"] and outside("0", "1e22", "double") == [-1e-30]
    assert outside("-1e-30", "0.5") == ["1.0000000000000000001", "1", "0.99999999999999999999999999", "1e0", "10e-1", "x"]
    exact = df.select(F.lit("1.0000000000000000001").cast("decimal(38,19)").alias("v"))
    assert export.validate_domains(exact, {"v": export.Domain("d", "FLOAT64", low="0", high="1")}).filter("error IS NULL").count() == 0


def test_infer_many_srids(spark):
    df = spark.range(3000).select(st_point(F.col("id"), F.col("id"), F.col("id").cast("int") + 1).alias("g"))
    assert vector.infer_geometry_schema(df, "g", crs=2056).srid == 2056
    with pytest.raises(ValueError, match="Different SRIDs"):
        vector.infer_geometry_schema(df, "g")


def buildings(spark, start, height="5.5"):
    return spark.range(start, start + 100).select(
        F.col("id").cast("int").alias("id"), (F.col("id") % 2 + 1).alias("status"),
        F.lit(height).cast("double").alias("height"), st_point(F.col("id"), F.col("id"), 2056).alias("g"),
    )


def entrances(spark, start):
    return spark.range(start, start + 100).select("id", F.col("id").alias("building_id"), F.lit("e").alias("label"))


def test_multi_dataset_export(spark, tmp_path):
    store = open_store(spark, str(tmp_path / "s.gdb"))
    schema = export.load_export_schema(SCHEMA)
    with pytest.raises(Exception, match="domain"):
        store.export_datasets({"buildings": buildings(spark, 0, "5000"), "entrances": entrances(spark, 0)}, schema)
    assert store.catalog()["version"] == 0
    store.export_datasets({"buildings": buildings(spark, 0), "entrances": entrances(spark, 0)}, schema)
    with pytest.raises(ValueError, match="exists"):
        store.export_datasets({"buildings": buildings(spark, 0), "entrances": entrances(spark, 0)}, schema)
    store.export_datasets({"buildings": buildings(spark, 100), "entrances": entrances(spark, 100)}, None, existing=True)
    assert (store.table("buildings").count(), store.table("ENTRANCES").count()) == (200, 200)
    assert store.extent("buildings") == [0, 0, 199, 199]
    assert store.read_catalog("DOMAINS").count() == 2 and store.read_catalog("DOMAIN_VALUES", "usage").count() == 2
    assert store.read_catalog("DOMAINS", "USAGE").count() == 0
    assert [r["field"] for r in store.read_catalog("RELATIONSHIP_KEYS").collect()] == ["id", "building_id"]
    assert store.read_catalog("RELATIONSHIPS").first()["composite"] == "false"
    with pytest.raises(Exception, match="domain"):
        store.export_datasets({"buildings": buildings(spark, 300, "-1")}, None, existing=True)
    assert store.table("buildings").count() == 200


def test_field_conversion(spark):
    df = spark.createDataFrame(
        [(1, 0.1, "{0f8fad5b-d9cb-469f-a165-70867728950e}", datetime(2024, 1, 1, 5, 6, 7, 500), True, "2024-01-01T00:00:00+01:00")],
        "OBJECTID int, f double, g string, t timestamp, b boolean, o string",
    )
    def data(*fields):
        return export.Dataset("d", "TABLE", tuple(fields))

    F_ = export.Field
    r = export.convert_fields(df, data(F_("SOURCE_OBJECTID", "INT64"), F_("g", "GUID"), F_("b", "INT16"), F_("o", "DATETIME_WITH_OFFSET"), F_("d", "DATE", source="t")), {}).first()
    assert (r["SOURCE_OBJECTID"], r["g"], r["b"], r["d"], r["error"]) == (1, "0f8fad5b-d9cb-469f-a165-70867728950e", 1, date(2024, 1, 1), None)
    assert "loss" in export.convert_fields(df, data(F_("f", "FLOAT32")), {}).first()["error"]["message"]
    late = export.convert_fields(df, data(F_("t", "DATETIME")), {}, whole_seconds=True).first()
    assert "fractional" in late["error"]["message"]
    assert "length" in export.convert_fields(df, data(F_("g", "STRING", length=5)), {}).first()["error"]["message"]
    with pytest.raises(ValueError, match="OBJECTID"):
        export.convert_fields(df, data(F_("f", "FLOAT64")), {}, append=True)
    with pytest.raises(ValueError, match="Incompatible"):
        export.convert_fields(df, data(F_("g", "INT16")), {})


def test_long_code_lists_are_joined(spark):
    domain = export.Domain("d", "INT32", codes=tuple((str(i), "") for i in range(600)))
    df = spark.createDataFrame([(5,), (700,), (None,)], "v int")
    out = export.validate_domains(df, {"v": domain}, required=("v",))
    assert {r["v"]: r["error"] and r["error"]["message"] for r in out.collect()} == {
        5: None, 700: "Value outside domain d", None: "NULL is not allowed"
    }


# -- exact numbers -----------------------------------------------------------------------------------------


def test_exact_numbers(spark):
    texts = ["1", "-0", "1.0", "1e2", "100e-2", "1.5", "9223372036854775807", "9223372036854775808", "0.1", "0.10", "1e400",
             "0.10000000000000000000000000001", "x", None, "1e-1", "12345678901234567890.5"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("t", exact.exact_long(F.col("t")).alias("l"), exact.exact_double(F.col("t")).alias("d"), exact.exact_decimal(F.col("t"), 30, 5).alias("m")).orderBy("i").collect()
    assert [r["l"] for r in rows] == [1, 0, 1, 100, 1, None, 2**63 - 1, None] + [None] * 8
    assert [r["d"] for r in rows][:6] == [1.0, -0.0, 1.0, 100.0, 1.0, 1.5] and rows[8]["d"] == rows[9]["d"] == rows[14]["d"] == 0.1
    assert rows[6]["d"] is None and rows[10]["d"] is None and rows[11]["d"] is None
    assert str(rows[15]["m"]) == "12345678901234567890.50000" and rows[11]["m"] is None


# -- spatial Parquet and store ----------------------------------------------------------------------------------


def test_spatial_parquet(spark, tmp_path):
    df = frame(spark, [point(7, 46), None, point()], 4326).drop("wkb").withColumn("d", F.lit("1.50").cast("decimal(10,2)"))
    path = str(tmp_path / "p")
    write_spatial_parquet(df, path, "g", vector.GeometrySchema("POINT", srid=4326), logical="GEOGRAPHY", algorithm="VINCENTY")
    raw = spark.read.parquet(path)
    assert isinstance(raw.schema["g"].dataType, T.BinaryType) and '"algorithm": "VINCENTY"' in raw.schema["g"].metadata["geometry"]
    back = read_spatial_parquet(spark, path, "g").orderBy("id").collect()
    assert (back[0]["g"]["xmin"], back[0]["g"]["srid"], back[1]["g"]) == (7.0, 4326, None) and back[2]["g"]["xmin"] is None
    assert read_spatial_parquet(spark, path, "g", bbox=(0, 0, 10, 50)).count() == 1
    with pytest.raises(Exception):
        write_spatial_parquet(df, path, "g", vector.GeometrySchema("POINT", srid=4326))
    far = frame(spark, [point(181, 0)], 4326).drop("wkb")
    with pytest.raises(Exception, match="bounds"):
        write_spatial_parquet(far, str(tmp_path / "q"), "g", vector.GeometrySchema("POINT", srid=4326), logical="GEOGRAPHY")
    with pytest.raises(ValueError, match="geographic"):
        write_spatial_parquet(far, str(tmp_path / "q"), "g", vector.GeometrySchema("POINT", srid=2056), logical="GEOGRAPHY")
    assert [crs_text(2056, "EPSG"), crs_text(0, "", "PROJCS[]"), crs_text(5), crs_text(0, "", "undefined")] == ["EPSG:2056", "PROJCS[]", "srid:5", "srid:0"]


def test_store_modes(spark, tmp_path):
    store = open_store(spark, str(tmp_path / "s.gdb"))
    layer = frame(spark, [point(1, 2), None]).select("id", "g")
    with pytest.raises(ValueError, match="does not exist"):
        store.write(layer, "a", "ADD_LAYER", "g")
    store.write(layer, "a", "CREATE", "g")
    with pytest.raises(ValueError, match="already exists"):
        store.write(layer, "b", "CREATE", "g")
    store.write(layer.drop("g"), "plain", "ADD_LAYER")
    version = store.catalog()["version"]
    store.write(layer.limit(0), "a", "APPEND", "g")
    assert store.catalog()["version"] == version
    store.write(layer.select(F.col("id").alias("ID"), F.col("g").alias("other")), "A", "APPEND", "other")
    assert store.table("a").count() == 4 and store.table().count() == 4 and store.table("PLAIN").count() == 2
    with pytest.raises(ValueError):
        store.write(layer, "sqlite_x", "ADD_LAYER", "g")
    assert resolve_layer(["B", "b"], "b") == "b" and resolve_layer(["B"], "b") == "B"
    with pytest.raises(ValueError):
        resolve_layer([], "x")


def test_error_modes(spark):
    df = spark.createDataFrame([(1, None), (2, ("C", "f", "m"))], "id int, error struct<code:string,field:string,message:string>")
    df = df.withColumn("new", F.col("id"))
    assert {(r["id"], r["new"]) for r in with_errors(df, "RETURN_NULL", ["new"])[0].collect()} == {(1, 1), (2, None)}
    ok, bad = with_errors(df, "ROUTE_TO_ERROR", ["new"])
    assert ok.count() == 1 and bad.columns == ["id", "error_code", "error_field", "error_message"]
    with pytest.raises(Exception, match="C: f: m"):
        with_errors(df, "FAIL")[0].count()
    with pytest.raises(ValueError):
        with_errors(df, "IGNORE")
