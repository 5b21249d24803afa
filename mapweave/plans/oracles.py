"""The same results in DuckDB SQL."""

from __future__ import annotations

PIXELS = """pixels AS (
  SELECT o_orderkey % 100 AS x, o_orderkey // 100 AS y,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS v FROM orders)"""


def zones(shift: str = "0.0") -> str:
    return f"""zones AS (
  SELECT id, x0, y0, x0 + 1.0 + id % 9 AS x1, y0 + 1.0 + id % 6 AS y1 FROM (
    SELECT c_custkey AS id, ((c_custkey * 7) % 100 + {shift})::DOUBLE AS x0,
           (c_custkey // 10 + CASE WHEN c_custkey % 50 = 0 THEN 1000000 ELSE 0 END)::DOUBLE AS y0
    FROM customer))"""


RECTANGLE = "x + 0.5 BETWEEN x0 AND x1 AND y + 0.5 BETWEEN y0 AND y1"
# Integer corners and half-unit centres keep the products exact.
TRIANGLE = """x + 0.5 >= x0 AND y + 0.5 >= y0
  AND (x1 - x0) * (y + 0.5 - y0) + (y1 - y0) * (x + 0.5 - x0) <= (x1 - x0) * (y1 - y0)"""
STATUS = "CASE WHEN count(v) = 0 THEN 'NO_VALID_PIXELS' ELSE 'OK' END AS raster_status"

POINTS = """points AS (
  SELECT c_custkey AS id, (2600000 + c_custkey % 1000)::DOUBLE AS x,
         (1200000 + (c_custkey * 37) % 1000)::DOUBLE AS y, c_mktsegment FROM customer)"""
LOCAL = "(c_custkey % 1000 % 100)::DOUBLE AS x, ((c_custkey * 37) % 1000)::DOUBLE AS y"


def _zonal(shift: str) -> str:
    return f"""WITH {PIXELS}, {zones(shift)}
SELECT id, round(avg(v) + 1e-7, 4) AS raster_mean, round(min(v), 4) AS raster_min, round(max(v), 4) AS raster_max,
       round(sum(v), 4) AS raster_sum, round(stddev_pop(v), 4) AS raster_stddev, count(v) AS raster_count, {STATUS}
FROM zones LEFT JOIN pixels ON {RECTANGLE} GROUP BY id"""


def _average(level: int) -> str:
    source = "(SELECT x, y, v FROM pixels)"
    for _ in range(level):
        source = f"(SELECT x // 2 AS x, y // 2 AS y, avg(v) AS v FROM {source} GROUP BY 1, 2)"
    return f"SELECT {level} AS level, x, y, round(v + 1e-7, 4) AS v FROM {source}"


def _nearest(level: int) -> str:
    step = 2**level
    return f"SELECT {level} AS level, x // {step} AS x, y // {step} AS y, round(v + 1e-7, 4) AS v FROM pixels WHERE x % {step} = 0 AND y % {step} = 0"


# Overviews are made until neither side is longer than 16.
LEVELS = """n AS (
  SELECT 0 AS level, 100::BIGINT AS width, max(o_orderkey) // 100 + 1 AS height FROM orders
  UNION ALL SELECT level + 1, (width + 1) // 2, (height + 1) // 2 FROM n WHERE greatest(width, height) > 16)"""


def _levels(sql) -> str:
    """All levels of a pyramid; enough for 16 * 2^10 rows of pixels."""
    every = " UNION ALL ".join(sql(k) for k in range(1, 11))
    return f"SELECT * FROM ({every}) WHERE level IN (SELECT level FROM n)"


def _grid(width: int) -> str:
    """All cells of a target grid of ``rows`` rows."""
    return f"g AS (SELECT unnest(range({width})) AS x, y FROM (SELECT unnest(range(rows)) AS y FROM s))"


# The bit steps of the Hilbert curve as a recursive query.
HILBERT = f"""grid AS (
  SELECT id, x, y,
    floor(65535.0 * (x - (SELECT min(x) FROM points)) / (SELECT max(x) - min(x) FROM points))::BIGINT AS gx,
    floor(65535.0 * (y - (SELECT min(y) FROM points)) / (SELECT max(y) - min(y) FROM points))::BIGINT AS gy
  FROM points),
steps AS (
  SELECT id, x, y, gx, gy, 0::BIGINT AS d, 32768::BIGINT AS bit FROM grid
  UNION ALL
  SELECT id, x, y,
    CASE WHEN gy & bit > 0 THEN gx WHEN gx & bit > 0 THEN 65535 - gy ELSE gy END,
    CASE WHEN gy & bit > 0 THEN gy WHEN gx & bit > 0 THEN 65535 - gx ELSE gx END,
    d * 4 + CASE WHEN gx & bit > 0 THEN CASE WHEN gy & bit > 0 THEN 2 ELSE 3 END
                 ELSE CASE WHEN gy & bit > 0 THEN 1 ELSE 0 END END,
    bit // 2
  FROM steps WHERE bit > 0),
ranked AS (
  SELECT id, x, y, d AS hilbert, row_number() OVER (ORDER BY d, id) - 1 AS rank FROM steps WHERE bit = 0)"""

IN_BOX = "x BETWEEN 2600123 AND 2600345 AND y BETWEEN 1200002 AND 1200600"

ORACLES = {
    "zonal_stats": _zonal("0.0"),
    "zonal_half_cells": _zonal("0.5"),
    "zonal_triangles": f"""WITH {PIXELS}, {zones()}
SELECT id, count(v) AS raster_count, round(sum(v), 4) AS raster_sum, round(min(v), 4) AS raster_min,
       round(max(v), 4) AS raster_max, {STATUS}
FROM zones LEFT JOIN pixels ON {TRIANGLE} GROUP BY id""",
    "zonal_empty": f"""WITH {PIXELS}, {zones()}, per AS (
  SELECT id, count(v) AS raster_count, {STATUS} FROM zones LEFT JOIN pixels ON {RECTANGLE} GROUP BY id)
SELECT raster_status, count(*) AS zones, sum(raster_count)::BIGINT AS pixels FROM per GROUP BY 1""",
    "raster_info": """SELECT 'orders' AS raster_id, 100::BIGINT AS raster_width, max(o_orderkey) // 100 + 1 AS raster_height,
  'LOCAL' AS raster_crs,
  '[{"band":1,"name":"price","dataType":"FLOAT64","noData":-9999.0,"scale":1.0,"offset":0.0,"color":"NUMERIC","alpha":false}]' AS raster_bands
FROM orders""",
    "raster_pixels": f"WITH {PIXELS} SELECT x, y, coalesce(v, -9999.0) AS v FROM pixels",
    "clip_box": f"""WITH {PIXELS} SELECT x::DOUBLE AS wx, y::DOUBLE AS wy, coalesce(v, -9999.0) AS v FROM pixels
WHERE x >= 10 AND x < 77 AND y >= 3 AND y < 61""",
    "clip_polygon": f"""WITH {PIXELS}, {zones()}, size AS (SELECT max(y) + 1 AS h FROM pixels),
inside AS (SELECT zones.* FROM zones, size WHERE y0 < h AND x0 < 100)
SELECT id, (least(100, any_value(x1)) - any_value(x0))::BIGINT AS width,
  (least((SELECT h FROM size), any_value(y1)) - any_value(y0))::BIGINT AS height,
  count(v) AS pixels, round(sum(v), 4) AS total, NULL::VARCHAR AS error
FROM inside LEFT JOIN pixels ON {TRIANGLE} GROUP BY id
UNION ALL SELECT id, NULL, NULL, NULL, NULL, 'Clip area does not overlap raster orders' FROM zones WHERE id NOT IN (SELECT id FROM inside)""",
    "select_bands": f"WITH {PIXELS} SELECT 1 AS band, x, y, v FROM pixels",
    "target_grid": """WITH s AS (SELECT max(o_orderkey) // 100 + 1 AS h FROM orders)
SELECT 'orders' AS raster_id, 0.0::DOUBLE AS origin_x, (ceil(h / 7.0) * 7)::DOUBLE AS origin_y, 3.0::DOUBLE AS pixel_x,
  -7.0::DOUBLE AS pixel_y, 34::BIGINT AS width, ceil(h / 7.0)::BIGINT AS height FROM s""",
    # Target cells of 3 x 3 source cells: the centre is the middle cell; rows count from the top.
    "resample_nearest": f"""WITH {PIXELS}, s AS (SELECT ceil((max(y) + 1) / 3.0)::BIGINT AS rows FROM pixels), {_grid(34)}
SELECT g.x, g.y, round(v, 6) AS v FROM g, s LEFT JOIN pixels p ON p.x = g.x * 3 + 1 AND p.y = (rows - 1 - g.y) * 3 + 1""",
    # Target cells of 2 x 2 source cells: the centre is the shared corner, all weights are a quarter.
    "resample_bilinear": f"""WITH {PIXELS}, s AS (SELECT ceil((max(y) + 1) / 2.0)::BIGINT AS rows, max(y) + 1 AS h FROM pixels), {_grid(50)},
a AS (SELECT x // 2 AS x, y // 2 AS y, avg(v) AS v FROM pixels, s WHERE y // 2 * 2 + 1 < h GROUP BY 1, 2)
SELECT g.x, g.y, round(v, 6) AS v FROM g, s LEFT JOIN a ON a.x = g.x AND a.y = rows - 1 - g.y""",
    "resample_palette": f"""WITH {PIXELS}, s AS (SELECT ceil((max(y) + 1) / 2.0)::BIGINT AS rows, max(y) + 1 AS h FROM pixels), {_grid(50)},
p AS (SELECT x, y, floor(v)::BIGINT % 16 AS i FROM pixels),
a AS (SELECT x // 2 AS x, y // 2 AS y, avg(i * 4000) AS red, avg(60000 - i * 3000) AS green, avg(i * i * 250) AS blue,
  65535 * count(i) / 4.0 AS alpha FROM p, s WHERE y // 2 * 2 + 1 < h GROUP BY 1, 2)
SELECT g.x, g.y, coalesce(round_even(red, 0), 0)::BIGINT AS red, coalesce(round_even(green, 0), 0)::BIGINT AS green,
  coalesce(round_even(blue, 0), 0)::BIGINT AS blue, coalesce(round_even(alpha::DOUBLE, 0), 0)::BIGINT AS alpha
FROM g, s LEFT JOIN a ON a.x = g.x AND a.y = rows - 1 - g.y""",
    "resample_palette_nearest": f"""WITH {PIXELS}, s AS (SELECT ceil((max(y) + 1) / 3.0)::BIGINT AS rows FROM pixels), {_grid(34)},
p AS (SELECT x, y, floor(v)::BIGINT % 16 AS i FROM pixels WHERE v IS NOT NULL)
SELECT g.x, g.y, i AS v, 60000 - i * 3000 AS green FROM g, s JOIN p ON p.x = g.x * 3 + 1 AND p.y = (rows - 1 - g.y) * 3 + 1""",
    "resample_finer": f"""WITH {PIXELS}, s AS (SELECT (max(y) + 1) * 2 AS rows FROM pixels), {_grid(200)}
SELECT g.x, g.y, round(v, 6) AS v FROM g, s LEFT JOIN pixels p ON p.x = g.x // 2 AND p.y = (rows - 1 - g.y) // 2""",
    "overview_average": f"WITH RECURSIVE {LEVELS}, {PIXELS} " + _levels(_average),
    "overview_nearest": f"WITH RECURSIVE {LEVELS}, {PIXELS} " + _levels(_nearest),
    "overview_sizes": f"""WITH RECURSIVE {LEVELS}
SELECT level, width, height, width * height AS pixels FROM n WHERE level > 0""",
    "bbox_filter": f"WITH {POINTS} SELECT id, x, y FROM points WHERE {IN_BOX}",
    "layer_extent": f"""WITH {POINTS} SELECT c_mktsegment, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax,
  count(*) AS n FROM points GROUP BY 1""",
    "infer_schema": """SELECT 'VALUE' AS content, 'POINT' AS type, false AS z, false AS m, 2056 AS srid, count(*) AS n FROM customer
UNION ALL SELECT 'VALUE', 'POLYGON', false, false, 0, count(*) FROM customer""",
    "geometry_bounds": f"""WITH {zones()} SELECT id, 'POLYGON' AS type, false AS is_empty, 93 AS bytes, NULL::VARCHAR AS problem,
  2056 AS srid, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax FROM zones""",
    "conform_geometry": """SELECT 'MULTIPOINT' AS type, NULL::VARCHAR AS message, count(*) AS n FROM customer
UNION ALL SELECT NULL, 'Geometry does not match output type MULTIPOINT', count(*) FROM customer""",
    "assign_crs_rows": f"WITH {POINTS} SELECT id, 21781 AS srid, x, y FROM points",
    "to_web_mercator": """SELECT c_custkey AS id, round(6378137.0 * radians(c_custkey % 360 - 180), 3) AS x,
  round(6378137.0 * ln(tan(pi() / 4 + radians(c_custkey % 160 - 80) / 2)), 3) AS y FROM customer""",
    "swiss_shift": f"WITH {POINTS} SELECT id, 21781 AS srid, x - 2000000 AS x, y - 1000000 AS y FROM points",
    "snap_grid": """SELECT c_custkey AS id, round(round_even(c_acctbal / 0.25, 0) * 0.25, 4) AS x,
  round(round_even(c_custkey / 8.0 / 0.25, 0) * 0.25, 4) AS y FROM customer""",
    # Interior vertices are symmetric; the closing vertex repeats the first one.
    "densified_box": f"""WITH {zones()}, n AS (SELECT *, x1 - x0 AS w, y1 - y0 AS h, greatest(x1 - x0, y1 - y0) / 100 AS s FROM zones),
k AS (SELECT *, greatest(ceil(w / s), 1) AS a, greatest(ceil(h / s), 1) AS b FROM n)
SELECT id, (2 * a + 2 * b + 1)::INTEGER AS vertices,
  round((a + b) * (x0 + x1) + x0, 6) AS sum_x, round((a + b) * (y0 + y1) + y0, 6) AS sum_y FROM k""",
    "hilbert_cluster": f"WITH RECURSIVE {POINTS}, {HILBERT} SELECT id, hilbert, rank FROM ranked",
    "rtree_levels": f"""WITH RECURSIVE {POINTS}, n AS (
  SELECT 0 AS level, count(*) AS nodes FROM points
  UNION ALL SELECT level + 1, (nodes + 15) // 16 FROM n WHERE nodes > 1 OR level = 0)
SELECT level, nodes, e.* FROM n, (SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM points) e""",
    "rtree_search": f"WITH {POINTS} SELECT id, x, y FROM points WHERE {IN_BOX}",
    "spatial_join": f"""WITH {zones()}, p AS (SELECT c_custkey AS pid, {LOCAL} FROM customer)
SELECT pid AS id, id AS zone FROM p JOIN zones ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1""",
    "spatial_join_triangles": f"""WITH {zones()}, p AS (SELECT c_custkey AS pid, {LOCAL} FROM customer)
SELECT pid AS id, id AS zone FROM p JOIN zones ON x >= x0 AND y >= y0
  AND (x1 - x0) * (y - y0) + (y1 - y0) * (x - x0) <= (x1 - x0) * (y1 - y0)""",
    "append_plan": """WITH c AS (SELECT *, length(p_name) > 9 AS long_name, p_size > 127 AS big,
    p_retailprice::FLOAT::DOUBLE <> p_retailprice AS lossy FROM part)
SELECT p_partkey AS partkey, p_name AS name, CASE WHEN big THEN NULL ELSE p_size::BIGINT END AS size, p_retailprice AS price,
  'new' AS state, NULL::VARCHAR AS note,
  CASE WHEN long_name THEN 'P_Name' WHEN big THEN 'p_size' WHEN lossy THEN 'p_retailprice' END AS error_field,
  CASE WHEN long_name THEN 'Value exceeds declared length' WHEN big THEN 'Integer outside TINYINT range'
       WHEN lossy THEN 'Number loses precision in FLOAT' END AS error_message FROM c""",
    "validate_domains": """SELECT field, count(*) AS n FROM (
  SELECT CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'o_orderstatus' END AS field FROM orders
  UNION ALL SELECT CASE WHEN l_discount NOT BETWEEN 0 AND 0.05 THEN 'l_discount' END FROM lineitem) GROUP BY 1""",
    "convert_fields": """WITH c AS (SELECT *, o_orderkey > 32767 AS big, o_orderstatus NOT IN ('F', 'O') AS outside,
    o_totalprice::FLOAT::DOUBLE <> o_totalprice AS lossy FROM orders)
SELECT CASE WHEN big THEN 'orders.KEY' WHEN outside THEN 'orders.STATUS' WHEN lossy THEN 'orders.PRICE' END AS field,
  CASE WHEN big THEN 'Not an exact INT16' WHEN outside THEN 'Value outside domain status'
       WHEN lossy THEN 'Value cannot be represented without loss' END AS message,
  count(*) AS n, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day,
  sum(CASE WHEN big THEN NULL ELSE o_orderkey END)::BIGINT AS keys FROM c GROUP BY 1, 2""",
    "relationship_check": """WITH c AS (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0),
r AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1),
o AS (SELECT * FROM r WHERE k NOT IN (SELECT c_custkey FROM c)),
d AS (SELECT c_custkey, count(*) AS n FROM c GROUP BY 1 HAVING count(*) > 1),
u AS (SELECT 'ORPHAN' AS finding, n FROM o UNION ALL SELECT 'DUPLICATE_KEY', n FROM d)
SELECT finding, count(*) AS keys, sum(n)::BIGINT AS rows FROM u GROUP BY 1""",
    "relationship_join": """SELECT c_mktsegment, count(*) AS rows, count(o_orderkey) AS orders, round(sum(o_totalprice), 2) AS price
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "feature_decode": """SELECT event_id, user_id::DOUBLE AS x, value AS y, 4326 AS srid, event_id::VARCHAR AS id_json,
  (props::JSON ->> '$.k')::BIGINT AS k FROM events""",
    "feature_project": """SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k, NULL::VARCHAR AS missing,
  NULL::VARCHAR AS message FROM events""",
    "feature_overlay": """SELECT event_id, event_type AS kind, event_id AS id, (props::JSON ->> '$.k')::BIGINT AS k FROM events""",
    "feature_encode": """SELECT event_id, 'Feature' AS type, event_id AS id, 'Point' AS shape, user_id::DOUBLE AS x, value AS y,
  (props::JSON ->> '$.k')::BIGINT AS k FROM events""",
    "feature_profile": """SELECT CASE event_id % 3 WHEN 0 THEN 'LEGACY2008' WHEN 1 THEN 'JSONFG10' ELSE 'RFC7946' END AS profile,
  count(*) AS n FROM events GROUP BY 1""",
    "feature_time": """SELECT CASE WHEN ts > date_trunc('day', ts) + INTERVAL 12 HOUR THEN 'JSON-FG timestamp lies outside interval' END
  AS message, count(*) AS n FROM events GROUP BY 1""",
    "error_route": """SELECT CASE WHEN event_id % 7 = 0 THEN 'FEATURE' ELSE 'ok' END AS route, count(*) AS n,
  sum(event_id)::BIGINT AS ids FROM events GROUP BY 1""",
    "features_per_hour_cell": """SELECT date_trunc('hour', ts) AS window_start, user_id % 16 AS cell_x, floor(value / 10)::BIGINT AS cell_y,
  count(*) AS n FROM events GROUP BY 1, 2, 3""",
    "warning_summary": """SELECT 'p_name' AS field, 'text-truncation' AS cause, count(*) AS n FROM part WHERE strlen(p_name) > 10
UNION ALL SELECT 'price', 'rounding', count(*) FROM (SELECT (o_totalprice / 7)::VARCHAR::DECIMAL(38, 18) AS p FROM orders)
WHERE p <> round(p, 2)""",
    "dbf_conform": """SELECT p_partkey, left(p_name, 10) AS name, floor(p_retailprice::VARCHAR::DECIMAL(18, 6) + 0.5)::BIGINT AS price FROM part""",
    "dbf_values": """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey END AS number,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag, ' ' || o_orderpriority AS text FROM orders""",
    "generate_text": f"""WITH {POINTS} SELECT id, id || ',' || x::BIGINT || ',' || y::BIGINT AS text FROM points""",
    # Rings start at the lower left corner and come out clockwise.
    "generate_polygons": f"""WITH {zones()}, t AS (SELECT id, x0::DECIMAL(18, 1) AS a, y0::DECIMAL(18, 1) AS b,
  x1::DECIMAL(18, 1) AS c, y1::DECIMAL(18, 1) AS d FROM zones)
SELECT 1000 + row_number() OVER (ORDER BY id) - 1 AS id,
  (999 + row_number() OVER (ORDER BY id)) || ' AUTO' || chr(10) || a || ' ' || b || chr(10) || a || ' ' || d || chr(10)
  || c || ' ' || d || chr(10) || c || ' ' || b || chr(10) || a || ' ' || b || chr(10) || 'END' AS text FROM t""",
    "geopackage_blobs": f"WITH {POINTS} SELECT id, 29 AS bytes, NULL::VARCHAR AS problem, 2056 AS srid, x, y FROM points",
    # A multipolygon header, a polygon header and two rings of five points.
    "ring_assembly": f"""WITH {zones()} SELECT id, 'MULTIPOLYGON' AS type, 9 + 9 + 2 * (4 + 5 * 16) AS bytes, x0 AS xmin, y0 AS ymin,
  x1 AS xmax, y1 AS ymax FROM zones""",
    "root_metadata": """WITH e AS (SELECT event_type, props::JSON ->> '$.k' AS k, 'c' || (event_id % 3) AS c FROM events),
c AS (SELECT event_type, c FROM e UNION SELECT event_type, 'c0' FROM e)
SELECT event_type, 'source' AS key, '"' || event_type || '"' AS value, false AS conflict FROM e GROUP BY 1
UNION ALL SELECT event_type, 'k', min(k), count(DISTINCT k) > 1 FROM e GROUP BY 1
UNION ALL SELECT event_type, 'conformsTo', '["' || string_agg(c, '","' ORDER BY c) || '"]', false FROM c GROUP BY 1""",
    "jsonfg_validation": """SELECT 'core: conformsTo must be a list with the core class of version 1.0' AS message, count(*) AS n
  FROM events WHERE event_id % 3 = 0
UNION ALL SELECT 'JSON-FG interval is reversed', count(*) FROM events WHERE event_id % 5 = 0
UNION ALL SELECT NULL, count(*) FROM events WHERE event_id % 3 <> 0 AND event_id % 5 <> 0""",
}
