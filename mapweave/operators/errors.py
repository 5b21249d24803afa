"""Row error policies and warning summaries.

Operators that can reject a row add an ``error STRUCT<code, field, message>``
column; operators that lose information add ``warnings ARRAY<STRUCT<field,
cause>>``.  Wrong configuration never becomes a row error, it raises at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR = T.StructType([T.StructField(n, T.StringType()) for n in ("code", "field", "message")])
WARNING = T.StructType([T.StructField(n, T.StringType()) for n in ("field", "cause")])
WARNINGS = T.ArrayType(WARNING)

MODES = ("FAIL", "RETURN_NULL", "ROUTE_TO_ERROR")


def error(code: str, field, message) -> Column:
    field = field if isinstance(field, Column) else F.lit(field)
    message = message if isinstance(message, Column) else F.lit(message)
    return F.struct(F.lit(code).alias("code"), field.alias("field"), message.alias("message")).cast(ERROR)


def first_error(*errors: Column) -> Column:
    return F.coalesce(*errors, F.lit(None).cast(ERROR))


def warning(field: str, cause: str) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(cause).alias("cause"))


def warnings_of(conditions: dict) -> Column:
    """Array of the warnings whose condition holds; keys are (field, cause)."""
    found = F.array(*[F.when(c, warning(*key)) for key, c in conditions.items()])
    return F.filter(found, lambda w: w.isNotNull()) if conditions else F.array().cast(WARNINGS)


def with_errors(df: DataFrame, mode: str, new_columns=(), column: str = "error"):
    """Apply an error policy; returns (rows, errors).

    FAIL stops the job at the first rejected row.  RETURN_NULL keeps every row
    and clears only the new columns.  ROUTE_TO_ERROR gives the good rows and,
    as the second DataFrame, the original columns of the others with code,
    field and message.  The second DataFrame is None for the other modes.
    """
    if mode not in MODES:
        raise ValueError(f"Unknown error mode: {mode}")
    failed = F.col(column).isNotNull()
    if mode == "FAIL":
        stop = F.raise_error(F.concat_ws(": ", f"{column}.code", f"{column}.field", f"{column}.message"))
        return df.filter(F.when(failed, stop.cast("boolean")).otherwise(F.lit(True))).drop(column), None
    if mode == "RETURN_NULL":
        cleared = {n: F.when(~failed, F.col(n)) for n in new_columns}
        return (df.withColumns(cleared) if cleared else df).drop(column), None
    rows = df.filter(~failed).drop(column)
    return rows, df.filter(failed).drop(*new_columns).select(
        *[c for c in df.columns if c != column and c not in new_columns],
        F.col(f"{column}.code").alias("error_code"),
        F.col(f"{column}.field").alias("error_field"),
        F.col(f"{column}.message").alias("error_message"),
    )


def summarize_warnings(df: DataFrame, column: str = "warnings") -> DataFrame:
    """Rows per (field, cause); a row counts once per pair."""
    return (
        df.select(F.explode(F.array_distinct(F.col(column))).alias("w"))
        .groupBy(F.col("w.field").alias("field"), F.col("w.cause").alias("cause"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
