"""Quality by importance resampling.

Two generative models over hashed n-grams (words and pairs of words) are
counted: one of target text (documents labelled good), one of all text.  A
document's importance weight is the log ratio of its probability under both.
The documents kept are the top k by weight plus Gumbel noise, which samples k
documents without replacement in proportion to their weights.  k is the number
of documents whose weight reaches a calibrated cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import NO_ID, cut_lineage, mix, settle, slices, span_hashes, text_bytes, widened, word_spans

#: cells of the n-gram tables, count added to each cell, seed of the noise
CELLS, PRIOR, SEED = 1 << 14, 1.0, 23

#: documents labelled good that make the target model
SAMPLE = 20_000

#: weights are binned for the cut: width and largest size
BIN, LARGEST = 0.25, 250.0

#: how much worse it is to reject a good document than to keep a bad one
CARE = 5.0

#: rows that the search for the k-th key may collect
FEW = 10_000


@dataclass
class Model:
    """Log ratio of every cell, and the cut between bad and good weights."""

    ratio: np.ndarray
    cut: float = float("-inf")


def _lower(data: np.ndarray) -> np.ndarray:
    upper = (data >= 0x41) & (data <= 0x5A)
    return data + upper * np.uint8(0x20)


def _cells(texts: pa.Array):
    """Per group of texts: cells of all n-grams and each text's first n-gram."""
    data, offsets = text_bytes(texts)
    for a, b in slices(offsets):
        part, bound = _lower(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a]
        if not len(part):
            yield np.zeros(0, np.int64), np.zeros(b - a + 1, np.int64)
            continue
        starts, ends, first = word_spans(part, bound)
        h = span_hashes(part, starts, ends)
        # each word, and each but a text's first also as the end of a pair
        pair = np.zeros(len(h), np.uint64)
        pair[1:] = mix(h[:-1] * np.uint64(3) + h[1:])
        paired = np.ones(len(h), bool)
        paired[first[:-1][first[:-1] < len(h)]] = False
        size = np.concatenate([[0], np.cumsum(1 + paired)])
        out = np.empty(size[-1], np.uint64)
        out[size[:-1]] = h
        out[size[:-1][paired] + 1] = pair[paired]
        yield (out >> np.uint64(64 - (CELLS.bit_length() - 1))).astype(np.int64), size[first]


def weights(texts: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """Log importance weight of every text; 0 for a text without words."""
    out = [np.zeros(0)]
    for cells, first in _cells(texts):
        total = np.concatenate([[0.0], np.cumsum(ratio[cells])])
        out.append(total[first[1:]] - total[first[:-1]])
    return np.concatenate(out)


def gumbel(ids: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Standard Gumbel noise that depends on the id alone."""
    h = mix(mix(ids.astype(np.int64).view(np.uint64) + np.uint64(seed)) + np.uint64(seed))
    u = ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    return -np.log(-np.log(u))


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The n-gram models: of all documents, and of at most ``sample`` documents
    with ``quality`` 1 (by a hash of the id).  NULL ids and labels do not count.
    Without any good document all weights are 0.

    Cells are counted in every task and added up by Spark.
    """
    spark = settle(documents.sparkSession)
    good = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q"))
    ids = good.filter("q = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id").collect()
    chosen = spark.createDataFrame([(r.doc_id, True) for r in ids], "doc_id long, good boolean")

    def count(batches):
        total = np.zeros((2, CELLS), np.int64)
        for batch in batches:
            good = batch.column("good").fill_null(False)
            total[0] += sum((np.bincount(c, minlength=CELLS) for c, _ in _cells(batch.column("text"))), np.zeros(CELLS, np.int64))
            best = batch.column("text").filter(good)
            total[1] += sum((np.bincount(c, minlength=CELLS) for c, _ in _cells(best)), np.zeros(CELLS, np.int64))
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[0, used]), pa.array(total[1, used])], ["cell", "raw", "target"])

    marked = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left").select("text", "good")
    rows = marked.mapInArrow(count, "cell int, raw long, target long").groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    # one row per cell: a fixed number
    table = np.zeros((2, CELLS))
    for r in rows:
        table[:, r.cell] = r.raw, r.target
    if not table[1].sum():
        return Model(np.zeros(CELLS))
    # counts are added in proportion to both totals, so a rare cell that target
    # text happens to lack says little
    added = PRIOR * table.sum(axis=1, keepdims=True) / table[0].sum()
    share = (table + added) / (table + added).sum(axis=1, keepdims=True)
    return Model(np.log(share[1]) - np.log(share[0]))


def score(documents: DataFrame, model: Model, seed: int = SEED) -> DataFrame:
    """All columns of ``documents`` with ``weight`` and ``key`` (weight and
    noise); columns of these names are replaced."""
    settle(documents.sparkSession)
    kept = documents.select(*[c for c in documents.columns if c not in ("weight", "key")])
    schema = widened(kept, "weight double, key double")

    def run(batches):
        for batch in batches:
            weight = weights(batch.column("text"), model.ratio)
            ids = batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy()
            arrays = [*batch.columns, pa.array(weight), pa.array(weight + gumbel(ids, seed))]
            yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    return kept.mapInArrow(run, schema)


def calibrate(scored: DataFrame, labels: DataFrame) -> float:
    """The weight that best tells quality 0 from 1, over all labelled rows: the
    shares of both that it gets right are added, good ones :data:`CARE` times.
    Without both labels there is no cut."""
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q")).filter("q IN (0, 1)")
    bins = F.least(F.lit(LARGEST), F.greatest(F.lit(-LARGEST), F.floor(F.col("weight") / BIN) * BIN))
    rows = scored.join(known, "doc_id").groupBy(bins.alias("low"), "q").agg(F.count(F.lit(1)).alias("n")).collect()
    lows = sorted({r.low for r in rows})
    count = {(r.low, r.q): r.n for r in rows}
    total = [sum(r.n for r in rows if r.q == q) for q in (0, 1)]
    if not all(total):
        return float("-inf")
    best, cut, below = -1.0, float("-inf"), [0, 0]
    for low, last in zip(lows, [lows[0], *lows], strict=False):
        right = below[0] / total[0] + CARE * (1 - below[1] / total[1])
        if right > best:
            # in the middle of the gap below, where there is one
            best, cut = right, (low + last + BIN) / 2 if low > lows[0] else float("-inf")
        below = [below[q] + count.get((low, q), 0) for q in (0, 1)]
    return float(cut)


def kth(scored: DataFrame, k: int) -> tuple[float, int]:
    """Key and id of the k-th row by key, then by id; a bounded number of
    counts is collected at a time."""
    if k <= 0:
        return float("inf"), NO_ID
    rows = scored.select("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"))
    low, high, n = rows.agg(F.min("key"), F.max("key"), F.count(F.lit(1))).first()
    if k >= n:
        return float("-inf"), NO_ID
    above, inside = 0, n
    while inside > FEW and high > low:
        step = (high - low) / 1000
        if low + step == low:
            break
        part = F.least(F.lit(999), F.floor((F.col("key") - low) / step)).cast("int").alias("part")
        bins = rows.filter((F.col("key") >= low) & (F.col("key") <= high)).groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("a"), F.max("key").alias("b")).collect()
        for b in sorted(bins, key=lambda b: -b.part):
            if above + b.n >= k:
                low, high, inside = b.a, b.b, b.n
                break
            above += b.n
    found = rows.filter((F.col("key") >= low) & (F.col("key") <= high)).orderBy(F.desc("key"), "id").limit(max(FEW, 1)).collect()
    place = min(k - above, len(found)) - 1
    return float(found[place].key), int(found[place].id)


def _chosen(limit: tuple[float, int]):
    key, id_ = limit
    same = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) <= id_
    return (F.col("key") > key) | ((F.col("key") == key) & same)


def resample(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> tuple[DataFrame, Model, tuple[float, int]]:
    """Scores of all rows (``doc_id``, ``weight``, ``key``, ``kept``), the
    model, and key and id of the last document kept.

    A NULL or empty text has weight 0.  Rows with equal keys are kept by id;
    rows with the same id and text stay or go together.  Without good or
    without bad labels every row is kept.  No rows give none.  Other columns
    are not read.
    """
    model = learn(documents, labels, sample)
    # read for the cut, the number to keep, the k-th key and the result
    scored = cut_lineage(score(documents.select("doc_id", "text"), model, seed).drop("text"))
    model.cut = calibrate(scored, labels)
    k = scored.filter(F.col("weight") >= model.cut).count()
    limit = kth(scored, k)
    return scored.withColumn("kept", _chosen(limit)), model, limit


def keep(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """The rows of ``documents`` that :func:`resample` keeps, with all their
    columns; texts are scored again instead of being joined."""
    _, model, limit = resample(documents, labels, sample, seed)
    own = [c for c in documents.columns if c in ("weight", "key")]
    renamed = documents.withColumnsRenamed({c: f"_own_{c}" for c in own})
    kept = score(renamed, model, seed).filter(_chosen(limit)).drop("weight", "key")
    return kept.withColumnsRenamed({f"_own_{c}": c for c in own}).select(*documents.columns)
