from pyspark.sql import functions as F

from mapweave.plans import tables as P
from mapweave.streaming.cells import features_per_cell, write_stream


def test_stream_equals_batch(spark, folder, tmp_path):
    """Closed windows of the stream hold the counts of the batch."""
    events = P.table(spark, folder, "events")
    source = tmp_path / "in"
    events.orderBy("ts").coalesce(1).write.parquet(str(source))
    # A far later row closes all windows of the real events.
    last = events.orderBy(F.desc("ts")).limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 DAYS"))
    last.coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    args = ("ts", F.col("user_id") % 16, "value", 1, 10)
    query = write_stream(features_per_cell(stream, *args), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {tuple(r) for r in features_per_cell(events, *args).collect()}
    assert got == want


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "ts timestamp, x double, y double"
    for i, rows in enumerate((["2024-01-01 10:05:00"], ["2024-01-01 15:00:00"], ["2024-01-01 10:06:00"], ["2024-01-01 23:00:00"])):
        df = spark.createDataFrame([(t, 1.0, 1.0) for t in rows], "t string, x double, y double")
        df.selectExpr("CAST(t AS TIMESTAMP) AS ts", "x", "y").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    sources = [str(tmp_path / "in" / str(i)) for i in range(4)]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for path in sources:
        # One batch per file, in this order, through a shared folder.
        import shutil
        from pathlib import Path

        Path(tmp_path / "all").mkdir(exist_ok=True)
        for part in Path(path).glob("part-*.parquet"):
            shutil.copy(part, tmp_path / "all")
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "all"))
        write_stream(features_per_cell(stream, "ts", "x", "y", 1, 1), out, checkpoint).awaitTermination(60)
    rows = {(r["window_start"].hour, r["n"]) for r in spark.read.parquet(out).collect()}
    assert rows == {(10, 1), (15, 1)}
