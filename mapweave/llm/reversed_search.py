"""Ranked lexical search the other way round.

Not the documents are indexed but the items: an inverted index from each term to
the items that hold it is broadcast, and every document's term counts are
streamed through it once.  A task keeps one bounded heap per item with the best
documents so far; the heaps of all tasks are merged, first in small groups and
then per item.

The index is bounded: items are dealt into parts of at most ``PART_TERMS``
terms, and each part is a pass of its own over the documents.  A first pass
counts documents, terms and, for the terms of the items, the documents that hold
them; these counts cover every document.

Scores are whole numbers.  A task sums them in doubles, which hold every whole
number below 2**53 exactly; an item whose scores may reach that is summed in
64-bit integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapweave.llm.common import cut_lineage, settle, slices, span_hashes, text_bytes

#: documents returned per item
BEST = 20

#: different terms of the items of one broadcast index, counted per item
PART_TERMS = 1_000_000

#: scores of one numpy pass
CELLS = 2_000_000

#: groups that the heaps of the tasks are merged in before the last merge
MERGES = 64

_IS_TERM = np.ones(256, bool)
_IS_TERM[:0x80] = False
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _IS_TERM[_low : _high + 1] = True

#: stands for a missing id in a heap: it comes after all others
_LAST = 2**63


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every term, and per text the number of its first
    term; terms never cross texts."""
    inside = _IS_TERM[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def terms(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts: the 64-bit hashes of all terms, and per text the
    number of its first one (and the end).  A text is never cut."""
    data, offsets = text_bytes(texts)
    for a, b in slices(offsets):
        part, bound = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if not len(part):
            yield np.zeros(0, np.uint64), np.zeros(b - a + 1, np.int64)
            continue
        upper = (part >= 0x41) & (part <= 0x5A)
        part = part + upper * np.uint8(0x20)
        starts, ends, first = term_spans(part, bound)
        yield span_hashes(part, starts, ends), first


@dataclass
class Index:
    """Inverted index of a part of the items: per term (sorted hashes) its
    postings (item, times) from ``first[t]`` to ``first[t + 1]``."""

    ids: list[int | None]
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray
    weight: np.ndarray | None = None


def _item_terms(items: DataFrame) -> DataFrame:
    """(``item_id``, ``h``, ``times``): the terms of every item."""

    def run(batches):
        for batch in batches:
            rows = [np.unique(h[a:b], return_counts=True) for h, first in terms(batch.column("text")) for a, b in zip(first[:-1], first[1:], strict=True)]
            sizes = np.array([len(h) for h, _ in rows], np.int64)
            if not sizes.sum():
                continue
            at = pa.array(np.repeat(np.arange(len(rows)), sizes))
            h, n = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(at), pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["item_id", "h", "times"])

    kept = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").distinct()
    return kept.mapInArrow(run, "item_id long, h long, times long").groupBy("item_id", "h").agg(F.sum("times").alias("times"))


def indexes(items: DataFrame, part_terms: int = PART_TERMS) -> Iterator[Index]:
    """The items' inverted indexes, one part at a time.

    A part holds whole items; only an item that alone has more terms than
    ``part_terms`` makes a larger part.
    """
    found = cut_lineage(_item_terms(items))
    # running numbers of terms before an item, summed in buckets of items so
    # that no window holds all of them
    sizes = found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    total = found.count()
    parts = max(1, -(-total // part_terms))
    sizes = sizes.withColumn("deal", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    order = Window.partitionBy("deal").orderBy("item_id").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("part", F.floor(F.coalesce(F.sum("n").over(order), F.lit(0)) / part_terms))
    sizes = sizes.select(F.col("item_id").alias("id"), "deal", "part")
    dealt = cut_lineage(found.join(sizes, F.col("item_id").eqNullSafe(F.col("id"))).drop("id"))
    for deal, part in sorted((r.deal, r.part) for r in dealt.select("deal", "part").distinct().collect()):
        rows = dealt.filter((F.col("deal") == deal) & (F.col("part") == part)).select("item_id", "h", "times").toArrow()
        if not rows.num_rows:
            continue
        column = rows.column("item_id").to_pylist()
        ids = sorted(set(column), key=lambda i: (i is None, i or 0))
        number = {i: k for k, i in enumerate(ids)}
        h = rows.column("h").to_numpy().view(np.uint64)
        item = np.array([number[i] for i in column], np.int64)
        order_ = np.lexsort((item, h))
        hashes, first = np.unique(h[order_], return_index=True)
        yield Index(ids, hashes, np.append(first, len(h)), item[order_], rows.column("times").to_numpy()[order_])


def _counts(documents: DataFrame, index: Index) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and per term of the index the
    documents that hold it."""
    sent = documents.sparkSession.sparkContext.broadcast(index.hashes)

    def run(batches):
        known = sent.value
        df, n, total = np.zeros(len(known), np.int64), 0, 0
        for batch in batches:
            for h, first in terms(batch.column("text")):
                n += int((np.diff(first) > 0).sum())
                total += len(h)
                doc, term, _ = _found(h, first, known)
                df += np.bincount(term, minlength=len(known))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-2, -1])), pa.array(np.append(df[at], [n, total]))], ["term", "n"])

    rows = documents.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = (rows.column(c).to_numpy() for c in ("term", "n"))
    df = np.zeros(len(index.hashes), np.int64)
    df[term[term >= 0]] = n[term >= 0]
    totals = dict(zip(term[term < 0].tolist(), n[term < 0].tolist(), strict=True))
    sent.destroy()
    return totals.get(-2, 0), totals.get(-1, 0), df


def _found(h: np.ndarray, first: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, times): the known terms of a run of texts."""
    if not len(known) or not len(h):
        return (np.zeros(0, np.int64),) * 3
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    place = np.flatnonzero(known[at] == h)
    text = np.searchsorted(first, place, "right") - 1
    pair, times = np.unique(text * len(known) + at[place], return_counts=True)
    return pair // len(known), pair % len(known), times


def weights(n: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) of every term."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Heaps:
    """The best documents of every item, at most ``best`` each."""

    def __init__(self, items: int, best: int):
        self.best = best
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(items)]
        # what a document has to reach to be looked at
        self.least = np.ones(items, np.int64)

    def offer(self, ids: list[int], scores: np.ndarray) -> None:
        """``scores``: one row per document, one column per item."""
        for doc, item in np.argwhere(scores >= self.least).tolist():
            heap, entry = self.heaps[item], (int(scores[doc, item]), -ids[doc])
            if len(heap) < self.best:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.best:
                self.least[item] = heap[0][0]


def _scores(index: Index, docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, exact: bool) -> np.ndarray:
    """Sums of impact x times per (document, item)."""
    size = index.first[term + 1] - index.first[term]
    post = np.repeat(index.first[term] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(int(size.sum()))
    cell = np.repeat(doc, size) * len(index.ids) + index.item[post]
    value = np.repeat(impact, size) * index.times[post]
    if exact:
        return np.bincount(cell, weights=value, minlength=docs * len(index.ids)).astype(np.int64).reshape(docs, -1)
    out = np.zeros(docs * len(index.ids), np.int64)
    np.add.at(out, cell, value)
    return out.reshape(docs, -1)


def _stream(documents: DataFrame, index: Index, n: int, total: int, best: int) -> DataFrame:
    """(``task``, ``item``, ``doc_id``, ``score``): the heaps of every task."""
    sent = documents.sparkSession.sparkContext.broadcast(index)
    # a term adds less than w * 10**6 for each time the item holds it
    most = np.bincount(index.item, weights=np.repeat(index.weight, np.diff(index.first)) * 1e6 * index.times)
    exact = bool(most.max() < 2**53)

    def run(batches):
        index = sent.value
        heaps = Heaps(len(index.ids), best)
        fan = np.diff(index.first)
        for batch in batches:
            ids, done = [_LAST if i is None else i for i in batch.column("doc_id").to_pylist()], 0
            for h, first in terms(batch.column("text")):
                texts = len(first) - 1
                doc, term, times = _found(h, first, index.hashes)
                m = 75 + (25 * np.diff(first) * n) // max(total, 1)
                impact = index.weight[term] * ((1_000_000_000 * times) // (1000 * times + 12 * m[doc]))
                # postings and cells of one pass are bounded; one document at least
                load = np.cumsum(np.bincount(doc, fan[term], texts) + len(index.ids))
                low = 0
                while low < texts:
                    high = max(low + 1, int(np.searchsorted(load, (load[low - 1] if low else 0) + CELLS, "right")))
                    a, b = np.searchsorted(doc, [low, high])
                    if b > a:
                        heaps.offer(ids[done + low : done + high], _scores(index, high - low, doc[a:b] - low, term[a:b], impact[a:b], exact))
                    low = high
                done += texts
        rows = [(i, None if -d == _LAST else -d, s) for i, heap in enumerate(heaps.heaps) for s, d in heap]
        if rows:
            task = TaskContext.get().partitionId()
            item, doc_id, score = (list(c) for c in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([task] * len(rows), pa.int64()), pa.array(item, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64())], ["task", "item", "doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "task long, item long, doc_id long, score long")


def search(documents: DataFrame, items: DataFrame, best: int = BEST, part_terms: int = PART_TERMS) -> DataFrame:
    """The ``best`` documents of every item: ``item_id``, ``rank`` (from 1),
    ``doc_id`` and ``score``.

    Terms are runs of letters, digits and any character beyond ASCII, A-Z in
    lower case, in the whole text; NULL has none.  Equal scores go by ascending
    ``doc_id``; a document without id comes after those and is returned with
    NULL.  Repeated rows are documents of their own: each counts, and each may
    be ranked.  Texts given under one ``item_id`` make one item, an exact copy
    counting once; items without id are one item.  An item without terms, or
    whose terms no document holds, has no rows; no documents or no items give
    none.  Other columns are not read.

    Terms are told apart by 64-bit hashes.
    """
    spark = settle(documents.sparkSession)
    found = None
    for index in indexes(items, part_terms):
        n, total, df = _counts(documents, index)
        index.weight = weights(n, df)
        heaps = _stream(documents, index, n, total, best)
        order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
        # heaps of some tasks first, so that the last merge sees few rows
        for group in (["item", F.col("task") % MERGES], ["item"]):
            heaps = heaps.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= best)
        table = spark.createDataFrame(pa.table({"item": pa.array(range(len(index.ids)), pa.int64()), "item_id": pa.array(index.ids, pa.int64())}))
        named = heaps.join(F.broadcast(table), "item").select("item_id", "rank", "doc_id", "score")
        found = named if found is None else found.unionByName(named)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found
