"""Splitting hot keys into bounded parts.

A key that holds many rows is cut into parts of about ``limit`` rows: the
many-rows side gets a part number by hash, the other side one copy per part.
Only keys above the limit are touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: hot keys that may be sent to all executors; beyond it a shuffle join is used
BROADCAST_KEYS = 50_000


class HotKeys:
    """Keys above a row limit with their number of parts."""

    def __init__(self, rows: DataFrame, keys: list[str], limit: int):
        self.keys = keys
        counts = (
            rows.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > limit)
            .select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_parts"))
        )
        found = counts.limit(BROADCAST_KEYS + 1).collect()
        self.parts = None
        if len(found) > BROADCAST_KEYS:
            self.parts = counts
        elif found:
            local = rows.sparkSession.createDataFrame(found, counts.schema)
            self.parts = F.broadcast(local)

    def _with_parts(self, df: DataFrame) -> DataFrame:
        return df.join(self.parts, self.keys, "left")

    def spread(self, df: DataFrame, *by) -> DataFrame:
        """Add ``_part``, chosen by the hash of ``by``."""
        if self.parts is None:
            return df.withColumn("_part", F.lit(0))
        part = F.pmod(F.xxhash64(*by), F.coalesce("_parts", F.lit(1)).cast("long")).cast("int")
        return self._with_parts(df).withColumn("_part", part).drop("_parts")

    def replicate(self, df: DataFrame) -> DataFrame:
        """One copy of each row per part of its key."""
        if self.parts is None:
            return df.withColumn("_part", F.lit(0))
        copies = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
        return self._with_parts(df).withColumn("_part", F.explode(copies)).drop("_parts")
