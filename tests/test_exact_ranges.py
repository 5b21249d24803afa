"""Range bounds against exact decimals, type by type."""

import math
import random
from decimal import Decimal, localcontext

import numpy as np
import pytest

from pyspark.sql import functions as F

from mapweave.functions.exact import outside_range

BOUNDS = [
    "0", "-0", "0.1", "0.05", "-0.1", "1", "99.995", "1e22", "-1e22", "1e400", "-1e400", "1e-400", "-1e-400", "0.30000000000000004",
    "0.3000000000000000166", "127.5", "-128.5", "2147483647.1", "9223372036854775807", "9223372036854775808", "1.7976931348623157e308", "16777217",
]


def values(kind):
    rng = random.Random(1)
    if kind == "double":
        near = [float(Decimal(b)) for b in BOUNDS if abs(Decimal(b).adjusted()) < 300]
        out = [v for x in near for v in (x, math.nextafter(x, math.inf), math.nextafter(x, -math.inf))]
        return [*out, *(rng.uniform(-200, 200) for _ in range(20)), math.nan, math.inf, -math.inf, 5e-324, None]
    if kind == "float":
        near = [np.float32(b) for b in BOUNDS if abs(Decimal(b).adjusted()) < 30]
        out = [v for x in near for v in (x, np.nextafter(x, np.float32(np.inf)), np.nextafter(x, np.float32(-np.inf)))]
        return [*map(float, out), math.nan, math.inf, None]
    if kind.startswith("decimal"):
        return [Decimal(v).scaleb(-2) for v in (0, 1, -1, 5, 10, -10, 11, 9999, 10000, 10**9 - 1, 1 - 10**9)] + [None]
    bits = {"tinyint": 8, "int": 32, "bigint": 64}[kind]
    return [0, 1, -1, 99, 100, 127, -128, 2 ** (bits - 1) - 1, -(2 ** (bits - 1)), None]


def outside(kind, value, low, high):
    if value is None:
        return False
    if isinstance(value, float):
        if not math.isfinite(value):
            return True
        value = Decimal(str(np.float32(value)) if kind == "float" else repr(value))
    return not Decimal(low) <= Decimal(value) <= Decimal(high)


@pytest.mark.parametrize("kind", ["double", "float", "tinyint", "int", "bigint", "decimal(9,2)"])
def test_every_bound(spark, kind):
    df = spark.createDataFrame([(v,) for v in values(kind)], f"v {kind}")
    pairs = [(low, high) for low in BOUNDS for high in BOUNDS if Decimal(low) <= Decimal(high)][::3]
    rows = df.select("v", *[outside_range(F.col("v"), df.schema["v"].dataType, *p).alias(f"p{i}") for i, p in enumerate(pairs)]).collect()
    with localcontext() as context:
        context.prec = 900
        for row in rows:
            for i, p in enumerate(pairs):
                assert row[f"p{i}"] == outside(kind, row["v"], *p), (row["v"], p)


def test_numbers_stay_in_their_type(spark):
    """No text, pattern or array function in the plan of a numeric column."""
    df = spark.range(3).select(F.col("id").cast("double").alias("v"))
    plan = df.filter(outside_range(F.col("v"), df.schema["v"].dataType, "0.5", "1.25"))._jdf.queryExecution().toString()
    assert "regexp" not in plan and "transform" not in plan and "cast(v" not in plan.lower()


def test_texts(spark):
    df = spark.createDataFrame([("1.0000000000000000001",), ("1",), ("x",), ("-1e-30",), (None,)], "v string")
    got = [r.o for r in df.select(outside_range(F.col("v"), df.schema["v"].dataType, "0", "1").alias("o")).collect()]
    assert got == [True, False, True, True, False]
