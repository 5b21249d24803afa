"""One query per operator, on the whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import crs
from ..functions.geometry import (
    assign_crs, densify_box, geometry_field, snap_to_grid, st_envelope, st_geomfromwkb, st_isempty, st_point,
    st_type, to_iso_wkb, validate_wkb,
)
from ..operators import append, clip, cluster, errors, export, features, joins, overviews, rasters, resample, vector, zonal
from ..functions.polygons import assemble_polygons
from ..sources import dbf, generate, geojson, geopackage
from ..streaming.cells import features_per_cell
from . import tables as P

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _rounded(value):
    """Four places; the small shift keeps means of cents off a half."""
    return F.round((F.col(value) if isinstance(value, str) else value) + 1e-7, 4)


# -- rasters ---------------------------------------------------------------------------

ALL_STATS = "mean min max sum stddev"


def _stats(zones, meta, tiles, names=ALL_STATS) -> DataFrame:
    out = zonal.zonal_stats(zones, "geometry", meta, tiles, key="id", raster_id=P.RASTER, stats=names)
    rounded = {f"raster_{n}": F.round(f"raster_{n}", 4) for n in ("min", "max", "sum", "stddev") if f"raster_{n}" in out.columns}
    if "raster_mean" in out.columns:
        rounded["raster_mean"] = _rounded("raster_mean")
    return out.drop("geometry").withColumns(rounded)


@query
def zonal_stats(spark, folder):
    return _stats(P.zones(spark, folder), *P.raster(spark, folder))


@query
def zonal_half_cells(spark, folder):
    return _stats(P.zones(spark, folder, 0.5), *P.raster(spark, folder))


@query
def zonal_triangles(spark, folder):
    return _stats(P.triangles(spark, folder), *P.raster(spark, folder), names="count sum min max")


@query
def zonal_empty(spark, folder):
    out = _stats(P.zones(spark, folder), *P.raster(spark, folder), names="mean")
    return out.groupBy("raster_status").agg(F.count(F.lit(1)).alias("zones"), F.sum("raster_count").alias("pixels"))


@query
def raster_info(spark, folder):
    meta, _ = P.raster(spark, folder)
    return rasters.raster_info(meta).select("raster_id", "raster_width", "raster_height", "raster_crs", "raster_bands")


@query
def raster_pixels(spark, folder):
    _, tiles = P.raster(spark, folder)
    return rasters.pixels_from_tiles(tiles).select("x", "y", "v")


@query
def clip_box(spark, folder):
    meta, tiles = clip.clip_box(*P.raster(spark, folder), 10.5, 3, 77, 60.25)
    out = rasters.pixels_from_tiles(tiles)
    grid = meta.select("raster_id", "origin_x", "origin_y")
    return rasters.join_meta(out, grid, {"ox": F.col("origin_x"), "oy": F.col("origin_y")}, P.RASTER).select(
        (F.col("x") + F.col("ox")).alias("wx"), (F.col("y") + F.col("oy")).alias("wy"), "v"
    )


@query
def clip_polygon(spark, folder):
    meta, tiles = P.raster(spark, folder)
    zones = P.triangles(spark, folder)
    clipped, out, beyond = clip.clip_polygon(meta, tiles, zones, "geometry", out_id="id", raster_id=P.RASTER, errors="ROUTE_TO_ERROR")
    found = rasters.pixels_from_tiles(out).filter(F.col("v") != P.NODATA)
    per_zone = found.groupBy("raster_id").agg(
        F.count(F.lit(1)).alias("pixels"), F.round(F.sum("v"), 4).alias("total")
    )
    sizes = clipped.select("raster_id", "width", "height")
    done = sizes.join(per_zone, "raster_id", "left").select(
        F.col("raster_id").cast("long").alias("id"), "width", "height",
        F.coalesce("pixels", F.lit(0)).alias("pixels"), "total", F.lit(None).cast("string").alias("error"),
    )
    failed = beyond.select(F.col("id").cast("long").alias("id"), F.col("error.message").alias("error"))
    return done.unionByName(failed, allowMissingColumns=True)


@query
def select_bands(spark, folder):
    meta, tiles = rasters.select_bands(*P.raster(spark, folder), "1")
    out = rasters.pixels_from_tiles(tiles)
    return out.select("band", "x", "y", F.when(F.col("v") != P.NODATA, F.col("v")).alias("v"))


@query
def target_grid(spark, folder):
    meta, _ = P.raster(spark, folder)
    t = resample.target_grid(meta, None, 3, 7).select("raster_id", "target.*")
    return t.select("raster_id", "origin_x", "origin_y", "pixel_x", "pixel_y", "width", "height")


def _world(meta, tiles) -> DataFrame:
    """Every target cell by column and row; NoData and missing tiles are NULL."""
    rows = F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y")
    grid = meta.select("width", rows).select(F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("x"), "y")
    value = F.when(F.col("v") != P.NODATA, F.round("v", 6)).alias("v")
    return grid.join(rasters.pixels_from_tiles(tiles).select("x", "y", value), ["x", "y"], "left")


@query
def resample_nearest(spark, folder):
    return _world(*resample.reproject(*P.raster(spark, folder), None, 3, 3))


@query
def resample_bilinear(spark, folder):
    return _world(*resample.reproject(*P.raster(spark, folder), None, 2, 2, interpolation="BILINEAR"))


@query
def resample_palette(spark, folder):
    """A palette between its pixels: 16-bit colours and opacity of every cell."""
    meta, tiles = resample.reproject(*P.palette(spark, folder), None, 2, 2, interpolation="BILINEAR")
    rows = F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y")
    grid = meta.select("width", rows).select(F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("x"), "y")
    found = rasters.pixels_from_tiles(tiles).groupBy("x", "y").pivot("band", [1, 2, 3, 4]).agg(F.max("v"))
    named = [F.coalesce(F.col(str(i + 1)), F.lit(0.0)).cast("long").alias(n) for i, n in enumerate(("red", "green", "blue", "alpha"))]
    return grid.join(found, ["x", "y"], "left").select("x", "y", *named)


@query
def resample_palette_nearest(spark, folder):
    """A palette by its nearest indexes; the colours come from the kept table."""
    meta, tiles = resample.reproject(*P.palette(spark, folder), None, 3, 3)
    cells = rasters.join_meta(rasters.pixels_from_tiles(tiles), meta, {"palette": F.col("palette")})
    colour = F.get("palette", F.col("v").cast("int"))
    return cells.filter("v <> 255").select("x", "y", F.col("v").cast("long").alias("v"), colour["green"].cast("long").alias("green"))


@query
def resample_finer(spark, folder):
    return _world(*resample.reproject(*P.raster(spark, folder), None, 0.5, 0.5))


def _overview(spark, folder, method) -> DataFrame:
    meta, tiles = P.raster(spark, folder)
    out = rasters.pixels_from_tiles(overviews.build_overviews(meta, tiles, method, limit=16))
    return out.select("level", "x", "y", F.when(F.col("v") != P.NODATA, _rounded("v")).alias("v"))


@query
def overview_average(spark, folder):
    return _overview(spark, folder, "AVERAGE")


@query
def overview_nearest(spark, folder):
    return _overview(spark, folder, "NEAREST")


@query
def overview_sizes(spark, folder):
    out = _overview(spark, folder, "AVERAGE")
    return out.groupBy("level").agg(
        (F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"), F.count(F.lit(1)).alias("pixels")
    )


# -- vectors ---------------------------------------------------------------------------

BBOX = (2600123, 1200002, 2600345, 1200600)


@query
def bbox_filter(spark, folder):
    return vector.filter_bbox(P.points(spark, folder), "geometry", *BBOX).select("id", "x", "y")


@query
def layer_extent(spark, folder):
    return vector.layer_extent(P.points(spark, folder), "geometry", ["c_mktsegment"])


@query
def infer_schema(spark, folder):
    shapes = P.points(spark, folder).select("geometry").unionByName(P.zones(spark, folder).select("geometry"))
    return vector.geometry_profile(shapes, "geometry").select("content", "type", "z", "m", "srid", "n")


@query
def geometry_bounds(spark, folder):
    """Bounds read back from the WKB bytes."""
    wkb = P.zones(spark, folder).select("id", to_iso_wkb("geometry").alias("wkb"))
    back = wkb.select("id", "wkb", st_geomfromwkb("wkb", 2056).alias("g"), validate_wkb("wkb").alias("problem"))
    return back.select(
        "id", st_type("g").alias("type"), st_isempty("g").alias("is_empty"), F.length("wkb").alias("bytes"),
        "problem", F.col("g.srid").alias("srid"), *[st_envelope("g")[n].alias(n) for n in ("xmin", "ymin", "xmax", "ymax")],
    )


@query
def conform_geometry(spark, folder):
    """Points and rectangles onto a multi-point layer: the rectangles fail."""
    p = P.points(spark, folder).select("id", "geometry")
    z = P.zones(spark, folder).select("id", "geometry")
    done = vector.conform_layer(p.unionByName(z), "geometry", vector.GeometrySchema("MULTIPOINT", srid=2056))
    return done.groupBy(st_type("geometry").alias("type"), F.col("error.message").alias("message")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def assign_crs_rows(spark, folder):
    g = P.points(spark, folder).select("id", assign_crs("geometry", "EPSG:21781").alias("g"))
    return g.select("id", F.col("g.srid").alias("srid"), F.col("g.xmin").alias("x"), F.col("g.ymin").alias("y"))


@query
def to_web_mercator(spark, folder):
    k = F.col("c_custkey")
    p = P.table(spark, folder, "customer").select(
        k.alias("id"), (k % 360 - 180).cast("double").alias("lon"), (k % 160 - 80).cast("double").alias("lat")
    )
    p = p.withColumn("m", crs.transform_points("lon", "lat", 4326, 3857))
    return p.select("id", F.round("m.x", 3).alias("x"), F.round("m.y", 3).alias("y"))


@query
def swiss_shift(spark, folder):
    """Shapes from one Swiss grid to the other."""
    z = P.points(spark, folder).select("id", crs.transform("geometry", 21781).alias("g"))
    return z.select("id", F.col("g.srid").alias("srid"), F.col("g.xmin").alias("x"), F.col("g.ymin").alias("y"))


@query
def snap_grid(spark, folder):
    grid = vector.xy_precision(False, resolution=0.25, x_origin=0.0, y_origin=0.0)
    p = P.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), st_point(F.col("c_acctbal"), F.col("c_custkey") / 8.0, 2056).alias("g")
    )
    s = p.select("id", snap_to_grid("g", grid).alias("g"))
    return s.select("id", F.round("g.xmin", 4).alias("x"), F.round("g.ymin", 4).alias("y"))


@query
def densified_box(spark, folder):
    c = P.zone_corners(spark, folder)
    return c.select("id", densify_box("x0", "y0", "x1", "y1").alias("p")).select(
        "id", F.size("p").alias("vertices"),
        F.round(F.aggregate("p", F.lit(0.0), lambda a, q: a + q["x"]), 6).alias("sum_x"),
        F.round(F.aggregate("p", F.lit(0.0), lambda a, q: a + q["y"]), 6).alias("sum_y"),
    )


@query
def hilbert_cluster(spark, folder):
    out = cluster.cluster_by_hilbert(P.points(spark, folder), "geometry", "id")
    return out.select("id", "hilbert", "rank")


@query
def rtree_levels(spark, folder):
    out = cluster.cluster_by_hilbert(P.points(spark, folder), "geometry", "id")
    tree = cluster.packed_rtree(out, "geometry")
    return tree.groupBy("level").agg(
        F.count(F.lit(1)).alias("nodes"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    )


@query
def rtree_search(spark, folder):
    out = cluster.cluster_by_hilbert(P.points(spark, folder), "geometry", "id")
    hits = cluster.search_rtree(cluster.packed_rtree(out, "geometry"), *BBOX)
    return out.join(hits, "rank", "left_semi").select("id", "x", "y")


def _local_points(spark, folder) -> DataFrame:
    """Customer points moved onto the zones' area."""
    p = P.points(spark, folder)
    return p.select(
        "id", geometry_field(st_point((F.col("x") - 2600000) % 100, F.col("y") - 1200000), "p", 0)
    )


@query
def spatial_join(spark, folder):
    z = P.zones(spark, folder).withColumnRenamed("id", "zone")
    return joins.spatial_join(_local_points(spark, folder), "p", z, "geometry", 8.0, ["zone"]).select("id", "zone")


@query
def spatial_join_triangles(spark, folder):
    z = P.triangles(spark, folder).withColumnRenamed("id", "zone")
    return joins.spatial_join(_local_points(spark, folder), "p", z, "geometry", 4.0, ["zone"]).select("id", "zone")


# -- tables ------------------------------------------------------------------------------

PART_TARGET = append.TargetSchema(
    "parts",
    (
        append.TargetColumn("fid", "INTEGER", primary=True),
        append.TargetColumn("P_PARTKEY", "INTEGER", required=True),
        append.TargetColumn("P_Name", "TEXT(9)"),
        append.TargetColumn("p_size", "TINYINT"),
        append.TargetColumn("p_retailprice", "FLOAT"),
        append.TargetColumn("state", "TEXT", required=True, default="'new'"),
        append.TargetColumn("note", "TEXT"),
    ),
)


@query
def append_plan(spark, folder):
    rows = P.table(spark, folder, "part").select("p_size", "p_partkey", "p_name", "p_retailprice")
    out = append.append_rows(rows, append.plan_append(rows, PART_TARGET))
    return out.select(
        F.col("P_PARTKEY").alias("partkey"), F.col("P_Name").alias("name"), F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"), "state", "note", F.col("error.field").alias("error_field"),
        F.col("error.message").alias("error_message"),
    )


STATUS = export.Domain("status", "STRING", codes=(("F", "final"), ("O", "open")))
DISCOUNT = export.Domain("discount", "FLOAT64", low="0", high="0.05")


@query
def validate_domains(spark, folder):
    o = export.validate_domains(P.table(spark, folder, "orders"), {"o_orderstatus": STATUS})
    li = export.validate_domains(P.table(spark, folder, "lineitem"), {"l_discount": DISCOUNT})
    both = o.select(F.col("error.field").alias("field")).unionAll(li.select(F.col("error.field").alias("field")))
    return both.groupBy("field").agg(F.count(F.lit(1)).alias("n"))


EXPORT = export.Dataset(
    "orders", "TABLE",
    (
        export.Field("KEY", "INT16", source="o_orderkey"),
        export.Field("STATUS", "STRING", length=1, domain="status", source="o_orderstatus"),
        export.Field("PRICE", "FLOAT32", source="o_totalprice"),
        export.Field("DAY", "DATE", source="o_orderdate"),
    ),
)


@query
def convert_fields(spark, folder):
    out = export.convert_fields(P.table(spark, folder, "orders"), EXPORT, {"status": STATUS})
    return out.groupBy(F.col("error.field").alias("field"), F.col("error.message").alias("message")).agg(
        F.count(F.lit(1)).alias("n"), F.min("DAY").cast("string").alias("first_day"),
        F.sum(F.col("KEY").cast("long")).alias("keys"),
    )


@query
def relationship_check(spark, folder):
    origin = P.table(spark, folder, "customer").filter("c_custkey % 10 <> 0")
    return joins.check_relationship(origin, P.table(spark, folder, "orders"), "c_custkey", "o_custkey")


@query
def relationship_join(spark, folder):
    origin = P.table(spark, folder, "customer")
    both = joins.join_relationship(origin, P.table(spark, folder, "orders"), "c_custkey", "o_custkey", "left")
    return both.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows"), F.count("o_orderkey").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("price")
    )


@query
def duplicate_keys(spark, folder):
    return joins.duplicate_keys(P.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- features --------------------------------------------------------------------------------


def feature_text(spark, folder, broken: bool = False) -> DataFrame:
    """One Feature text per event; every seventh cut short if asked for."""
    e = P.spread(P.table(spark, folder, "events"))
    text = F.concat(
        F.lit('{"type":"Feature","id":'), F.col("event_id"),
        F.lit(',"geometry":{"type":"Point","coordinates":['), F.col("user_id"), F.lit(","), F.col("value"),
        F.lit(']},"properties":'), F.col("props"), F.lit("}"),
    )
    if broken:
        text = F.when(F.col("event_id") % 7 == 0, F.substring(text, 1, 20)).otherwise(text)
    return e.select("event_id", "ts", text.alias("feature_json"))


@query
def feature_decode(spark, folder):
    out = features.decode_features(feature_text(spark, folder), "feature_json")
    rows, _ = errors.with_errors(out, "FAIL")
    return rows.select(
        "event_id", F.col("geometry.xmin").alias("x"), F.col("geometry.ymin").alias("y"),
        F.col("geometry.srid").alias("srid"), F.col("feature_id_json").alias("id_json"),
        F.get_json_object("properties_json", "$.k").cast("long").alias("k"),
    )


@query
def feature_project(spark, folder):
    e = P.spread(P.table(spark, folder, "events").select("event_id", "props"))
    mapping = features.Mapping("/k", "k", "INTEGER"), features.Mapping("/missing", "missing", "STRING")
    out = features.project_properties(e, mapping, "props")
    return out.select("event_id", "k", "missing", F.col("error.message").alias("message"))


@query
def feature_overlay(spark, folder):
    e = P.spread(P.table(spark, folder, "events").select("event_id", "props", "event_type"))
    mapping = features.Mapping("/kind/name", "event_type", "STRING"), features.Mapping("/id", "event_id", "INTEGER")
    out = features.overlay_properties(e, mapping, "props")
    return out.select(
        "event_id", F.get_json_object("props", "$.kind.name").alias("kind"),
        F.get_json_object("props", "$.id").cast("long").alias("id"), F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


@query
def feature_encode(spark, folder):
    e = P.spread(P.table(spark, folder, "events")).select(
        "event_id", F.col("event_id").cast("string").alias("feature_id_json"), F.col("props").alias("properties_json"),
        st_point("user_id", "value", 4326).alias("geometry"),
    )
    out = features.encode_features(e, features.FeatureOptions())
    text = F.col("feature_json")
    return out.select(
        "event_id", F.get_json_object(text, "$.type").alias("type"), F.get_json_object(text, "$.id").cast("long").alias("id"),
        F.get_json_object(text, "$.geometry.type").alias("shape"),
        F.get_json_object(text, "$.geometry.coordinates[0]").cast("double").alias("x"),
        F.get_json_object(text, "$.geometry.coordinates[1]").cast("double").alias("y"),
        F.get_json_object(text, "$.properties.k").cast("long").alias("k"),
    )


@query
def feature_profile(spark, folder):
    e = P.table(spark, folder, "events")
    text = (
        F.when(F.col("event_id") % 3 == 0, F.lit('{"type":"Feature","crs":null}'))
        .when(F.col("event_id") % 3 == 1, F.lit('{"type":"Feature","place":null}'))
        .otherwise(F.lit('{"type":"Feature"}'))
    )
    return e.select(features.geojson_profile(text).alias("profile")).groupBy("profile").agg(F.count(F.lit(1)).alias("n"))


@query
def feature_time(spark, folder):
    """Event times inside an interval that ends at 12:00 of their day."""
    e = P.table(spark, folder, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    text = F.concat(
        F.lit('{"date":"'), day, F.lit('","timestamp":"'), stamp, F.lit('","interval":["..","'), day, F.lit('T12:00:00Z"]}')
    )
    return e.select(features.validate_time(text).alias("message")).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


@query
def error_route(spark, folder):
    out = features.decode_features(feature_text(spark, folder, broken=True), "feature_json")
    good, bad = errors.with_errors(out, "ROUTE_TO_ERROR", features.FeatureOptions().payload_fields)
    routed = good.select(F.lit("ok").alias("route"), "event_id").unionAll(bad.select(F.col("error_code").alias("route"), "event_id"))
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query
def features_per_hour_cell(spark, folder):
    e = P.table(spark, folder, "events")
    return features_per_cell(e, "ts", F.col("user_id") % 16, "value", 1, 10)


# -- formats -----------------------------------------------------------------------------------


@query
def warning_summary(spark, folder):
    """Names cut to ten bytes and prices rounded to two places."""
    names = P.table(spark, folder, "part").select("p_name")
    prices = P.table(spark, folder, "orders").select((F.col("o_totalprice") / 7).alias("price"))
    cut, _ = dbf.dbf_schema(names, {"p_name": dbf.DbfOverride(width=10)})
    rounded, _ = dbf.dbf_schema(prices, {"price": dbf.DbfOverride(width=20, scale=2)})
    rows = dbf.conform_dbf(names, cut).select("warnings").unionAll(dbf.conform_dbf(prices, rounded).select("warnings"))
    return errors.summarize_warnings(rows)


@query
def dbf_conform(spark, folder):
    rows = P.table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    fields, _ = dbf.dbf_schema(
        rows.select("p_name", "p_retailprice"),
        {"p_name": dbf.DbfOverride(width=10), "p_retailprice": dbf.DbfOverride(target="preis-größe", width=12, scale=0)},
    )
    out = dbf.conform_dbf(rows, fields)
    return out.select("p_partkey", F.col("p_name").alias("name"), F.col("preis_gro_").cast("long").alias("price"))


@query
def dbf_values(spark, folder):
    """Raw field texts as they stand in a file, back to values."""
    o = P.table(spark, folder, "orders")
    number = F.when(F.col("o_orderkey") % 10 == 0, F.lit("********")).otherwise(F.lpad(F.col("o_orderkey").cast("string"), 8, " "))
    day = F.when(F.col("o_orderkey") % 7 == 0, F.lit("00000000")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    flag = F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "n").otherwise("?")
    text = F.rpad(F.concat(F.lit(" "), F.col("o_orderpriority")), 20, " ")
    raw = o.select("o_orderkey", number.alias("n"), day.alias("d"), flag.alias("l"), text.alias("c"))
    return raw.select(
        "o_orderkey",
        dbf.dbf_value("n", dbf.DbfField("N", "N", 8)).alias("number"),
        F.date_format(dbf.dbf_value("d", dbf.DbfField("D", "D", 8)), "yyyy-MM-dd").alias("day"),
        dbf.dbf_value("l", dbf.DbfField("L", "L", 1)).alias("flag"),
        dbf.dbf_value("c", dbf.DbfField("C", "C", 20)).alias("text"),
    )


@query
def generate_text(spark, folder):
    out = generate.generate_rows(P.points(spark, folder), "geometry", generate.GenerateOptions(), id_field="id")
    rows, _ = errors.with_errors(out, "FAIL")
    return rows


@query
def generate_polygons(spark, folder):
    options = generate.GenerateOptions("POLYGON", decimals=1, comma=False)
    out = generate.generate_rows(P.zones(spark, folder), "geometry", options, order_by="id", start_id=1000)
    rows, _ = errors.with_errors(out, "FAIL")
    return rows


@query
def geopackage_blobs(spark, folder):
    p = P.points(spark, folder).select("id", geopackage.encode_gpkg("geometry").alias("blob"))
    d = p.select("id", F.length("blob").alias("bytes"), geopackage.decode_gpkg("blob", 2056).alias("d"))
    return d.select(
        "id", "bytes", F.col("d.error").alias("problem"), F.col("d.geometry.srid").alias("srid"),
        F.col("d.geometry.xmin").alias("x"), F.col("d.geometry.ymin").alias("y"),
    )


@query
def ring_assembly(spark, folder):
    """A shell and a hole per customer, from one row per ring."""
    c = P.zone_corners(spark, folder)

    def ring(d):
        x0, y0, x1, y1 = F.col("x0") + d, F.col("y0") + d, F.col("x1") - d, F.col("y1") - d
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])

    rings = c.select("id", ring(0.25).alias("ring")).unionAll(c.select("id", ring(0.0).alias("ring")))
    out = assemble_polygons(rings, "id", "ring", 2056)
    return out.select(
        "id", st_type("geometry").alias("type"), F.length("geometry.wkb").alias("bytes"),
        *[F.col(f"geometry.{n}").alias(n) for n in ("xmin", "ymin", "xmax", "ymax")],
    )


@query
def root_metadata(spark, folder):
    """Document members of the events of each type."""
    e = P.table(spark, folder, "events")
    root = F.concat(
        F.lit('{"source":"'), F.col("event_type"), F.lit('","k":'), F.get_json_object("props", "$.k"),
        F.lit(',"conformsTo":["c'), F.col("event_id") % 3, F.lit('","c0"]}'),
    )
    return geojson.merge_root_metadata(e.select("event_type", root.alias("root")), "root", ["event_type"])


@query
def jsonfg_validation(spark, folder):
    """Points in the Swiss grid; every third document lacks its core class."""
    e = P.spread(P.table(spark, folder, "events"))
    core = F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.lit('"http://www.opengis.net/spec/json-fg-1/1.0/conf/core"'))
    text = F.concat(
        F.lit('{"type":"Feature","conformsTo":['), core,
        F.lit('],"coordRefSys":"http://www.opengis.net/def/crs/EPSG/0/2056","place":{"type":"Point","coordinates":['),
        F.col("user_id"), F.lit(","), F.col("value"), F.lit(']},"geometry":null,"properties":null,"time":{"interval":["2024-01-02",'),
        F.when(F.col("event_id") % 5 == 0, '"2024-01-01"').otherwise('".."'), F.lit("]}}"),
    )
    out = features.validate_jsonfg(e.select("event_id", text.alias("t")), "t")
    return out.select(F.explode_outer("errors").alias("message")).groupBy("message").agg(F.count(F.lit(1)).alias("n"))
