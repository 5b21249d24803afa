from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapweave.functions import wkb as W
from mapweave.functions.geometry import st_geomfromwkb
from mapweave.operators.vector import GeometrySchema
from mapweave.sources.dbf import DbfOverride
from mapweave.sources.shapefile import read_shapefile
from mapweave.sources.shapefile_writer import write_shapefile

RING = np.array([[0, 0, 1], [4, 0, 1], [4, 4, 1], [0, 4, 1], [0, 0, 1]], float)
HOLE = np.array([[1, 1, 1], [1, 2, 1], [2, 2, 1], [1, 1, 1]], float)


def layer(spark, shapes):
    rows = [(i, f"nämé{i}", i / 4, i % 2 == 0, date(2024, 1, 1 + i), None if s is None else bytearray(W.write(s))) for i, s in enumerate(shapes)]
    df = spark.createDataFrame(rows, "id int, name string, size double, ok boolean, day date, wkb binary")
    return df.select("id", "name", "size", "ok", "day", st_geomfromwkb("wkb", 2056).alias("g"))


def read_all(spark, path):
    out = None
    for shp in sorted(path.glob("*.shp")):
        df = read_shapefile(spark, str(shp))
        out = df if out is None else out.unionByName(df)
    return out


@pytest.mark.parametrize("dimension", ["XY", "XYZ", "XYM", "XYZM"])
def test_round_trip(spark, tmp_path, dimension):
    z, m = "Z" in dimension, "M" in dimension
    cut = lambda block: np.column_stack([block[:, :2]] + [block[:, 2]] * z + [block[:, 2] * 5] * m)
    polygon = W.Shape(W.POLYGON, z, m, [cut(RING), cut(HOLE)])
    df = layer(spark, [polygon, None, polygon, polygon]).repartition(2, "id")
    schema = GeometrySchema.explicit("MULTIPOLYGON", dimension, 2056)
    path = tmp_path / "out"
    write_shapefile(df, str(path), "g", schema, overrides={"size": DbfOverride(width=10, scale=2)}, prj='PROJCS["x",AUTHORITY["EPSG","2056"]]')
    rows = {r["id"]: r for r in read_all(spark, path).collect()}
    assert len(rows) == 4 and not list(path.glob("_staging*"))
    r = rows[2]
    assert (r["name"], float(r["size"]), r["ok"], r["day"].date()) == ("nämé2", 0.5, True, date(2024, 1, 3))
    shape = W.read(bytes(r["the_geom"]["wkb"]))
    assert (shape.z, shape.m or z and not m) == (z, m or z and not m) and r["the_geom"]["srid"] == 2056
    assert [len(p.parts) for p in shape.parts] == [2] and rows[1]["the_geom"] is None
    if z:
        assert set(shape.parts[0].parts[0][:, 2]) == {1.0}
    if m:
        assert set(shape.parts[0].parts[0][:, 2 + z]) == {5.0}


def test_failed_rows_publish_nothing(spark, tmp_path):
    line = W.Shape(W.LINESTRING, False, False, np.array([[0, 0], [1, 1.0]]))
    path = tmp_path / "out"
    with pytest.raises(Exception):
        write_shapefile(layer(spark, [line]), str(path), "g", GeometrySchema("POINT", srid=2056))
    assert not list(path.glob("*.shp")) if path.exists() else True


def test_existing_target_wins(spark, tmp_path):
    point = W.Shape(W.POINT, False, False, np.array([[1, 2.0]]))
    df = layer(spark, [point]).select("id", "g")
    write_shapefile(df, str(tmp_path / "o"), "g", GeometrySchema("POINT", srid=2056), by=[F.col("id")])
    with pytest.raises(ValueError, match="exists"):
        write_shapefile(df, str(tmp_path / "o"), "g", GeometrySchema("POINT", srid=2056))
