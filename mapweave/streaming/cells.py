"""Event-time counts per grid cell and streaming runs of row operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def features_per_cell(
    df: DataFrame, time: str, x, y, cell_x: float, cell_y: float, window: str = "1 hour", watermark: str = "10 minutes"
) -> DataFrame:
    """Features per tumbling window and grid cell.

    The same plan serves a stream and a table.  On a stream the watermark
    drops late rows and bounds the state to the open windows.
    """
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    kind = df.schema[time].dataType
    # Event time must be an instant; the result keeps the column's own type.
    rows = df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark) if df.isStreaming else df
    return (
        rows.groupBy(
            F.window(time, window).alias("w"),
            F.floor(x / cell_x).cast("long").alias("cell_x"),
            F.floor(y / cell_y).cast("long").alias("cell_y"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").cast(kind).alias("window_start"), "cell_x", "cell_y", "n")
    )


def write_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Append a stream to a Parquet table; the checkpoint folder gives
    exactly-once output after a failure."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
