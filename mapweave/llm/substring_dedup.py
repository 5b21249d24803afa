"""Substring dedup: remove words covered by repeated windows of words.

Super-k-mer partitioning: consecutive windows that share a minimiser (the
smallest hashed run of ``gram`` words) travel as one packed string to the bucket
of their minimiser, where sorting counts the windows exactly; see
:mod:`mapweave.llm.windows`.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import NO_ID, apart, settle
from mapweave.llm.suffix_dedup import _ranges
from mapweave.llm.windows import HOT, Windows, repeated_spans

#: words of a window, and words of a minimiser
WIDTH, GRAM = 35, 4


def substring_dedup(documents: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Per row of ``documents`` (``doc_id``, ``text``): the words that are left.

    A word goes if a window of ``width`` words that covers it also starts
    anywhere else, in another row or in its own.  Words are runs of anything
    but space and tab to carriage return; windows never cross documents.

    Returns ``doc_id``, ``n_words``, ``removed`` (array of [start, end) word
    ranges) and ``kept`` (the remaining words, joined by one space).  A NULL
    text has no words; texts shorter than ``width`` words stay whole; repeated
    rows repeat each other's windows, so all of them go; a NULL id is an id like
    any other.  No rows give no rows; other columns are not read.
    """
    if width > 127 or not 0 < gram < width:
        raise ValueError("gram must be less than width, width 127 or less")
    settle(documents.sparkSession)
    texts, shared = apart(documents)
    spans = repeated_spans(texts, Windows(True, width, gram, False), hot=hot, shared=shared)
    held = spans.groupBy("key", "tid").agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def run(batches):
        for batch in batches:
            names = "n_words", "removed", "kept"
            out = {c: [] for c in names}
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_py().encode().split()
                low, high = (c.tolist() for c in _ranges(found))
                kept = words if not low else [w for a, b in zip([0, *high], [*low, len(words)], strict=True) for w in words[a:b]]
                out["n_words"].append(len(words))
                out["removed"].append([{"start": a, "end": b} for a, b in zip(low, high, strict=True)])
                out["kept"].append(b" ".join(kept))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [pa.array(out["n_words"], pa.int64()), pa.array(out["removed"], kind), pa.array(out["kept"], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *arrays], ["key", *names])

    schema = "key long, n_words long, removed array<struct<start: long, end: long>>, kept binary"
    done = texts.join(held, ["key", "tid"], "left").select("key", "text", "spans").mapInArrow(run, schema)
    doc_id = F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id")
    return done.select(doc_id, "n_words", "removed", F.col("kept").cast("string").alias("kept"))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return result.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
