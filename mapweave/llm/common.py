"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.session import cut_lineage  # noqa: F401  shared by the operators

#: Arrow batches stay small, so that a task's Python memory does not depend on
#: the number of documents in its partition.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
    # lists of small numbers per document are gathered by hashing
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
}

#: stands for a document without id wherever ids are joined or ordered
NO_ID = -(2**63)

#: keys with more than one text that go to every task
SHARED = 100_000

#: words are runs of anything but these bytes: space, tab to carriage return
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

#: the same as a Java pattern
WORD = r"[^\x20\x09-\x0D]+"

#: units of text that one numpy pass works on
CHUNK = 1 << 17


def settle(spark: SparkSession) -> SparkSession:
    """Set the Arrow batch limits that the operators rely on."""
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def read(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    """One of the given tables, with the named columns only."""
    df = settle(spark).read.parquet(f"{folder}/{table}.parquet")
    return df.select(*columns) if columns else df


def give_back() -> None:
    """Returns the memory that a finished task has freed to the system: Spark
    keeps the worker for later tasks, beside those of other operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def keyed(documents: DataFrame, *more) -> DataFrame:
    """``key`` (the id, :data:`NO_ID` if NULL), ``tid`` (16 bits of the text's
    hash, which keep rows apart that share an id), ``text`` and further columns."""
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND((1 << 16) - 1).cast("int").alias("tid"),
        F.coalesce("text", F.lit("")).alias("text"),
        *more,
    )


def text_hash(seed: int) -> Column:
    """64 bits of a hash of the text; each seed has its own."""
    return F.xxhash64(F.lit(seed), F.coalesce("text", F.lit("")))


def apart(documents: DataFrame, *more) -> tuple[DataFrame, bool]:
    """``key``, ``tid``, ``text`` and further columns as :func:`keyed` gives
    them, but ``tid`` is 64 bits and differs between any two texts that share a
    key; and whether any two texts do.

    The hash is one under which no two of them are equal, judged by another one
    of 64 bits.  ``tid`` is 0 where no other text has the key, so that it takes
    no room where rows are dealt out; with more than :data:`SHARED` shared keys
    every row has its hash.
    """
    for seed in itertools.count(1):
        texts = keyed(documents, *more).withColumn("tid", text_hash(seed))
        hashes = texts.select("key", "tid", text_hash(0).alias("other"))
        kinds = hashes.groupBy("key", "tid").agg((F.min("other") != F.max("other")).alias("clash"))
        keys = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("clash").alias("clash")).filter("n > 1 OR clash")
        found = keys.orderBy(F.desc("clash"), "key").limit(SHARED + 1).collect()
        if not found:
            return texts.withColumn("tid", F.lit(0).cast("long")), False
        if found[0].clash:
            continue
        if len(found) > SHARED:
            return texts, True
        few = texts.sparkSession.createDataFrame([(r.key, True) for r in found], "key long, _shared boolean")
        tid = F.when(F.col("_shared"), F.col("tid")).otherwise(F.lit(0).cast("long"))
        return texts.join(F.broadcast(few), "key", "left").withColumn("tid", tid).drop("_shared"), True


def widened(df: DataFrame, more: str) -> T.StructType:
    """The schema of ``df`` with more columns at the end."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array one after the other, and the offsets."""
    column = column.cast(pa.string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


# ---------------------------------------------------------------- hashing

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(n: int, base: np.uint64, name: str) -> np.ndarray:
    """Powers of ``base`` modulo 2**64, kept for the next call."""
    known = _powers.get(name)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[name] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the entropy of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


def _prefix(values: np.ndarray) -> np.ndarray:
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power(n, BASE, "up"), out=sums[1:])
    return sums


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` consecutive values."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = _prefix(values)
    return mix((sums[k:] - sums[:n]) * _power(n, _INVERSE, "down"))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``[start, end)``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = _prefix(values)
    return mix((sums[ends] - sums[starts]) * _power(len(values) + 1, _INVERSE, "down")[starts])


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per text the number of its first
    word; words never cross texts."""
    n = len(data)
    inside = ~_IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def slices(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` units together, one text at least."""
    n, start = len(offsets) - 1, 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(n, max(start + 1, end))
        yield start, end
        start = end
