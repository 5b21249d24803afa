"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import shutil

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings the operators rely on.  Tile rows are large (a 512 x 512
#: tile of doubles is 2 MiB), so Arrow batches are also limited by bytes.  A
#: worker holds two batches and what it makes of them, and a core has up to three
#: workers at a time: the limit, not the partition, decides on their memory.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Geometry and pixel kernels cost far more per byte than a plain scan, so
    # small shuffle partitions are worth keeping apart.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # The JIT does not compile methods beyond 8000 bytes; a stage that large is
    # faster without whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME` to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``, so that it stays the same when an executor
    is lost, and is not computed again by what reads it.

    The folder is the one named by ``spark.checkpoint.dir``.  A session without
    that setting gets one in the warehouse, which driver and executors share
    too; it is deleted when the driver ends.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.checkpoints-{context.applicationId}"
            local = folder.removeprefix("file:")
            if local.startswith("/"):
                atexit.register(shutil.rmtree, local, ignore_errors=True)
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
