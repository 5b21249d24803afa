"""Suffix-array dedup: remove bytes that a long earlier string repeats.

The suffixes that begin at anchors (a sparse suffix array: any string of
``width`` bytes holds an anchor, and equal strings hold it at the same place)
are range-partitioned by their leading bytes with sampled splitters, sorted in
their bucket by multikey quicksort, and compared with their neighbours; see
:mod:`mapweave.llm.windows`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import NO_ID, apart, settle
from mapweave.llm.windows import HOT, Windows, merge, repeated_spans

#: bytes of a string that counts as repeated, and bytes of an anchor
WIDTH, GRAM = 100, 16


def suffix_dedup(documents: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Per row of ``documents`` (``doc_id``, ``text``): the text without
    repeated strings.

    A byte goes if a string of ``width`` bytes that covers it also starts
    earlier: in a document with a smaller id, or before it in the same one.
    Strings are judged on the input and never cross documents.

    Returns ``doc_id``, ``n_bytes``, ``removed`` (array of [start, end) byte
    ranges) and ``kept`` (the remaining bytes).  A NULL text is empty; texts
    shorter than ``width`` stay whole; a NULL id comes before all others; rows
    with the same id and text are one document given twice, so neither is
    earlier; rows with the same id but different texts are not ordered by it,
    their starts decide.  No rows give no rows; other columns are not read.
    """
    if gram < 8 or width > 127 or gram >= width:
        raise ValueError("gram must be 8 or more and less than width, width 127 or less")
    settle(documents.sparkSession)
    texts, shared = apart(documents)
    spans = repeated_spans(texts, Windows(False, width, gram, True), hot=hot, shared=shared)
    held = spans.groupBy("key", "tid").agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def run(batches):
        for batch in batches:
            names = "n_bytes", "removed", "kept"
            out = {c: [] for c in names}
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = text.as_py().encode()
                low, high = _ranges(found)
                kept = np.ones(len(data), bool)
                for a, b in zip(low, high, strict=True):
                    kept[a:b] = False
                out["n_bytes"].append(len(data))
                out["removed"].append([{"start": a, "end": b} for a, b in zip(low.tolist(), high.tolist(), strict=True)])
                out["kept"].append(np.frombuffer(data, np.uint8)[kept].tobytes() if len(low) else data)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [pa.array(out["n_bytes"], pa.int64()), pa.array(out["removed"], kind), pa.array(out["kept"], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *arrays], ["key", *names])

    schema = "key long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary"
    done = texts.join(held, ["key", "tid"], "left").select("key", "text", "spans").mapInArrow(run, schema)
    return done.select(F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), "n_bytes", "removed", "kept")


def _ranges(found: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    if not found.is_valid:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return merge(found.values.field("low").to_numpy(), found.values.field("high").to_numpy())


def digest(result: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return result.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
