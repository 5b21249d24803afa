"""Approximate nearest neighbours by projected search with a stopping test.

Vectors are scaled to length one, so the largest cosine is the smallest
distance, and projected to a few dimensions by a random matrix whose entries
follow the 2-stable normal law: for two vectors at distance d the squared
projected distance, divided by d squared, follows the chi-square law.  A kd-tree
over the projections gives a query's neighbours in order of projected distance;
each is verified on the original vectors.  The search stops when a neighbour as
near as the k-th found so far would have come earlier with probability
``CONFIDENCE``.

The upper splits of the kd-tree are fitted on a bounded sample and make cells,
which Spark deals out; the rest of the tree is built in each task.  A query
first searches its own cell and then every cell that the stopping test leaves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapweave.llm.common import cut_lineage, settle

#: projected dimensions, seed of the projection, probability of the stopping
#: test, neighbours
DIMENSIONS, SEED, CONFIDENCE, NEIGHBOURS = 12, 5, 0.995, 5

#: vectors the splits are fitted on, vectors of a cell's part, of a leaf
SAMPLE, PART, LEAF = 20_000, 8192, 64

#: queries that search a part in one group; more are cut into blocks, each with
#: a copy of the part
QUERIES = 8192


def chi_square(p: float, m: int) -> float:
    """The value a chi-square variable of ``m`` (even) degrees exceeds with
    probability 1 - ``p``, by bisection of its closed form."""

    def above(x: float) -> float:
        term = total = 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while above(high) > 1 - p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > 1 - p else (low, middle)
    return high


def projection(size: int, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, size])).standard_normal((size, dimensions))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(lists), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    # row by row in double precision, the same for equal rows
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


# ------------------------------------------------------------ cells of Spark


def _splits(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """(axis, value) of the upper splits as a heap: at the widest axis, at the
    median."""
    out: list[tuple[int, float]] = []
    level = [points]
    for _ in range(depth):
        below = []
        for part in level:
            axis = int(np.ptp(part, axis=0).argmax()) if len(part) else 0
            value = float(np.median(part[:, axis])) if len(part) else 0.0
            out.append((axis, value))
            below += [part[part[:, axis] < value], part[part[:, axis] >= value]]
        level = below
    return out


def _cell(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    axis, value = np.array([a for a, _ in splits], np.int64), np.array([v for _, v in splits])
    for _ in range((len(splits) + 1).bit_length() - 1):
        node = 2 * node + 1 + (points[np.arange(len(points)), axis[node]] >= value[node])
    return node - len(splits)


def _boxes(splits: list[tuple[int, float]], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper corners of the cells, unbounded outside."""
    low, high = [np.full(dimensions, -np.inf)], [np.full(dimensions, np.inf)]
    at = 0
    while at < len(splits):
        n = len(low)
        lows, highs = [], []
        for i, (axis, value) in enumerate(splits[at : at + n]):
            a, b = high[i].copy(), low[i].copy()
            a[axis] = value
            b[axis] = value
            lows += [low[i], b]
            highs += [a, high[i]]
        low, high, at = lows, highs, at + n
    return np.stack(low), np.stack(high)


# ------------------------------------------------------- the tree of a part


class Part:
    """A kd-tree over some vectors: leaves with boxes, in projected space."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray):
        self.ids, self.unit = ids, _unit(vectors)
        self.points = self.unit @ matrix
        leaves: list[np.ndarray] = []
        stack = [np.arange(len(ids))]
        while stack:
            rows = stack.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            axis = int(np.ptp(self.points[rows], axis=0).argmax())
            half = np.argpartition(self.points[rows, axis], len(rows) // 2)
            stack += [rows[half[: len(rows) // 2]], rows[half[len(rows) // 2 :]]]
        self.low = np.stack([self.points[r].min(axis=0) for r in leaves])
        self.high = np.stack([self.points[r].max(axis=0) for r in leaves])
        self.leaves = np.full((len(leaves), LEAF), -1, np.int64)
        for i, rows in enumerate(leaves):
            self.leaves[i, : len(rows)] = rows

    def search(self, own: int, query: np.ndarray, point: np.ndarray, k: int, reach: float, known: float) -> list[tuple[float, int]]:
        """The ``k`` best of all verified: (cosine, id), ties to smaller ids.

        Leaves come in order of their least projected distance, in batches of
        growing size; only points that the stopping test leaves are verified.
        ``known`` is a distance within which ``k`` vectors were found elsewhere.
        """
        gap = np.maximum(0, np.maximum(self.low - point, point - self.high))
        far = np.sqrt((gap * gap).sum(axis=1))
        order = np.argsort(far, kind="stable")
        far, limit = far[order], known
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        at, size = 0, 1
        while at < len(order):
            radius = reach * limit + 1e-9
            end = min(at + size, int(np.searchsorted(far, radius, "right")))
            if end <= at:
                break
            rows = self.leaves[order[at:end]].ravel()
            rows = rows[rows >= 0]
            d = self.points[rows] - point
            near = rows[((d * d).sum(axis=1) <= radius * radius) & (self.ids[rows] != own)]
            if len(ids) >= k:
                # only what may be among the best is scored exactly
                near = near[self.unit[near] @ query >= scores[k - 1] - 1e-12]
            ids = np.concatenate([ids, self.ids[near]])
            scores = np.concatenate([scores, (self.unit[near] * query).sum(axis=1)])
            best = np.lexsort((ids, -scores))
            # an id given more than once counts by its nearest row
            _, first = np.unique(ids[best], return_index=True)
            best = best[np.sort(first)[:k]]
            ids, scores = ids[best], scores[best]
            if len(ids) >= k:
                limit = min(limit, math.sqrt(max(0.0, 2 - 2 * float(scores[k - 1]))))
            at, size = end, 2 * size
        return list(zip(scores.tolist(), ids.tolist(), strict=True))


def search(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, confidence: float = CONFIDENCE) -> DataFrame:
    """The ``k`` vectors with the largest cosine for each query: ``query_id``,
    ``rank`` (from 1), ``vec_id``, ``score``.

    Both sides have ``vec_id`` and ``embedding``.  A vector that is NULL, zero,
    empty or holds a NULL or non-finite component, and a row without id, take no
    part.  A query is compared with vectors of its own length, but never with
    its own id; ties go to the smaller id; with fewer than ``k`` candidates all
    are returned.  Rows that share an id are one item, as near as its nearest
    row.  Every candidate is indexed: the sample of at most about
    :data:`SAMPLE` vectors only chooses the splits.  No rows give none; other
    columns are not read.
    """
    settle(vectors.sparkSession)
    whole = F.expr("size(embedding) > 0 AND forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity')) AND exists(embedding, v -> v <> 0)")

    def usable(df: DataFrame) -> DataFrame:
        return df.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))

    rows, asked = usable(vectors), usable(queries)
    reach = math.sqrt(chi_square(confidence, DIMENSIONS))
    sizes = {r.size: r["n"] for r in rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    splits: dict[int, list[tuple[int, float]]] = {}
    for size, n in sizes.items():
        # about one part of vectors per cell, if the splits are even
        depth = max(0, min(14, math.ceil(math.log2(max(1, n / PART)))))
        every = max(1, n // SAMPLE)
        some = rows.filter((F.size("v") == size) & (F.pmod(F.xxhash64("vec_id"), F.lit(every)) == 0)).select("v").orderBy(F.xxhash64("v")).limit(SAMPLE) if depth else None
        points = _unit(np.array([r.v for r in some.collect()])) @ projection(size) if depth else np.zeros((0, DIMENSIONS))
        splits[size] = _splits(points, depth) if len(points) else []
    boxes = {size: _boxes(s, DIMENSIONS) for size, s in splits.items()}

    def place(batches):
        for batch in batches:
            size = pa.compute.list_value_length(batch.column("v")).to_numpy()
            out = np.zeros(len(size), np.int64)
            for s in np.unique(size).tolist():
                mine = np.flatnonzero(size == s)
                points = _unit(_matrix(batch.column("v").take(pa.array(mine)))) @ projection(s)
                out[mine] = _cell(points, splits[s]) if splits.get(s) else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size.astype(np.int32)), pa.array(out)], ["vec_id", "v", "size", "cell"])

    placed, homes = (df.mapInArrow(place, "vec_id long, v array<double>, size int, cell long") for df in (rows, asked))
    # a cell that holds more than a part of the vectors is cut by id
    counts = placed.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"))
    parts = counts.select("size", "cell", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    dealt = placed.join(F.broadcast(parts), ["size", "cell"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).drop("parts")
    items = dealt.select("size", "cell", "part", F.col("vec_id").alias("id"), "v", F.lit(None).cast("double").alias("known"))

    def within(group: pa.Table) -> pa.Table:
        known = group.column("known").combine_chunks()
        is_query = known.is_valid().to_numpy(zero_copy_only=False)
        data, ask = group.filter(pa.array(~is_query)), group.filter(pa.array(is_query))
        out: list[tuple[int, int, float]] = []
        if data.num_rows and ask.num_rows:
            matrix = projection(group.column("size")[0].as_py())
            part = Part(data.column("id").to_numpy(), _matrix(data.column("v")), matrix)
            wanted = _unit(_matrix(ask.column("v")))
            points = wanted @ matrix
            for i, (own, limit) in enumerate(zip(ask.column("id").to_pylist(), ask.column("known").to_pylist(), strict=True)):
                out += [(own, j, c) for c, j in part.search(own, wanted[i], points[i], k, reach, limit)]
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

    def run(targets: DataFrame, asking: DataFrame) -> DataFrame:
        """``asking``: how many queries ``n`` search each cell.  A group has at
        most about PART vectors and QUERIES queries; a part that no query
        searches is not sent."""
        blocks = asking.select("size", "cell", F.ceil(F.col("n") / QUERIES).cast("int").alias("blocks"))
        each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        copies = items.join(F.broadcast(blocks), ["size", "cell"]).select(*items.columns, each)
        dealt_out = targets.join(F.broadcast(blocks), ["size", "cell"]).select(*items.columns, F.pmod(F.xxhash64(F.lit(2), "id"), F.col("blocks")).cast("int").alias("block"))
        both = copies.unionByName(dealt_out)
        return both.groupBy("size", "cell", "part", "block").applyInArrow(within, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    # each query in its own cell, in all of its parts; the largest distance of
    # two vectors of length one is 2
    everywhere = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    home = homes.join(F.broadcast(parts), ["size", "cell"]).select("size", "cell", everywhere, F.col("vec_id").alias("id"), "v", F.lit(2.0).alias("known"))
    at_home = homes.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"))
    near = cut_lineage(ranked(run(home, at_home)).select("query_id", "vec_id", "score"))
    if not any(splits.values()):
        return ranked(near).select("query_id", "rank", "vec_id", "score")
    worst = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
    known = F.when(F.col("n") >= k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("worst")))).otherwise(F.lit(2.0))

    def visit(batches):
        for batch in batches:
            size, cell, limit = (batch.column(c).to_numpy() for c in ("size", "cell", "known"))
            cells: list[list[int]] = []
            for i in range(batch.num_rows):
                low, high = boxes[int(size[i])]
                vector = np.array(batch.column("v")[i].as_py())[None]
                point = (_unit(vector) @ projection(int(size[i])))[0]
                gap = np.maximum(0, np.maximum(low - point, point - high))
                far = np.sqrt((gap * gap).sum(axis=1))
                cells.append([c for c in np.flatnonzero(far <= reach * limit[i] + 1e-9).tolist() if c != cell[i]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "v", "size", "known")), pa.array(cells, pa.list_(pa.int64()))], ["vec_id", "v", "size", "known", "cells"])

    bounded = homes.join(worst, homes["vec_id"] == worst["query_id"], "left").select("vec_id", "v", "size", "cell", known.alias("known"))
    visits = cut_lineage(bounded.mapInArrow(visit, "vec_id long, v array<double>, size int, known double, cells array<long>"))
    visiting = visits.select("size", F.explode("cells").alias("cell")).groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"))
    other = visits.select("size", F.explode("cells").alias("cell"), F.col("vec_id").alias("id"), "v", "known")
    other = other.join(F.broadcast(parts), ["size", "cell"]).select("size", "cell", everywhere, "id", "v", "known")
    return ranked(near.unionByName(run(other, visiting))).select("query_id", "rank", "vec_id", "score")
