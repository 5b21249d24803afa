"""Near copies by a chosen-path set similarity join.

Every set of shingles is known by ``POSITIONS`` minwise tokens (the least shingle
under as many hash functions).  A tree starts with all sets.  A node chooses
``CHOSEN`` positions by a hash of its own path; the sets that have the same
minwise token there make a child.  Sets with a similarity s share each choice with
probability s, so of two sets that link (0.85) at least one of two choices
agrees with 0.98 per level, and the expected number of common children is 1.7: a
path to a common leaf dies out with a probability of 0.03, however deep the tree.
Sets with little in common part quickly.

A node becomes a leaf when it is small, or when it is hardly smaller than the
node above it: then it holds copies, which further choices do not part.  The sets
of a leaf are compared exhaustively, first by their tokens at all positions, then
by their full sets.  ``TREES`` independent trees miss a pair with 0.031 ** 5, less
than 1 in 10 million (for a pair whose tokens agree as often as its similarity
says).

Sets are dealt by node, a level at a time; a node's rows are the names of its
sets, not their tokens.  Large leaves are joined in blocks around a leader first,
then what is still apart, so only small groups and blocks are ever in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import NO_ID, apart, cut_lineage, settle
from mapweave.llm.jaccard_join import WORDS, _connect, _digest, _edges, _Joined, classes, distinct_sets, same_ids, shingles

#: two sets link when 100 * intersection >= SHARE * union
SHARE = 85

#: minwise tokens of a set, those a node chooses, and trees
POSITIONS, CHOSEN, TREES = 64, 2, 5

#: a node with so many sets is a leaf, and one that keeps this share of the node
#: above it
LEAF, DENSE = 64, 0.6

#: least number of positions at which two sets agree that are compared in full: a
#: pair that links has fewer with a probability below 1e-7
AGREE = 39

#: nodes that are sent to all tasks
FEW_NODES = 200_000

#: parts of a large node where its size is sent by a shuffle
SALTS = 32

#: shingles whose tokens are found together
TOGETHER = 200_000

#: pairs that one numpy pass compares
PAIRS = 500_000

_rng = np.random.default_rng(20)
_FACTORS = (_rng.integers(0, 2**32, POSITIONS, dtype=np.uint64) | 1).astype(np.uint32)
_ADDED = _rng.integers(0, 2**32, POSITIONS, dtype=np.uint64).astype(np.uint32)


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """The minwise tokens (32 bits) of every set, one row each; 0 for an empty one."""
    out = np.zeros((len(sets), POSITIONS), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        tokens = np.concatenate([sets[i] for i in full])
        tokens = (tokens ^ (tokens >> np.uint64(32))).astype(np.uint32)
        first = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        for p in range(POSITIONS):
            h = tokens * _FACTORS[p] + _ADDED[p]
            h ^= h >> np.uint32(15)
            out[full, p] = np.minimum.reduceat(h * np.uint32(0x2C1B3C6D), first)
    return out


def _sketches(texts: DataFrame, words: int) -> DataFrame:
    """Per text its size ``n``, the digest ``d1``, ``d2`` of its set and its
    minwise ``tokens``."""

    def run(batches):
        for batch in batches:
            key, tid = batch.column("key"), batch.column("tid")
            held: list[np.ndarray] = []
            done = size = 0

            def out() -> pa.RecordBatch:
                d = np.stack([_digest(s) for s in held])
                tokens = [row.tobytes() for row in minwise(held)]
                sizes = pa.array([len(s) for s in held], pa.int64())
                a, b = done, len(held)
                return pa.RecordBatch.from_arrays([key.slice(a, b), tid.slice(a, b), sizes, pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(tokens, pa.binary())], ["key", "tid", "n", "d1", "d2", "tokens"])

            for found in shingles(batch.column("text"), words):
                held.append(found)
                size += len(found)
                if size > TOGETHER:
                    yield out()
                    done, held, size = done + len(held), [], 0
            if held:
                yield out()

    return texts.mapInArrow(run, "key long, tid long, n long, d1 long, d2 long, tokens binary")


def _children(node: Column, tokens: Column) -> Column:
    """The children of ``node`` that a set with these tokens goes to."""
    first = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(POSITIONS))
    other = F.pmod(first + 1 + F.pmod(F.xxhash64(node, F.lit(2)), F.lit(POSITIONS - 1)), F.lit(POSITIONS))
    assert CHOSEN == 2
    return F.array(*[F.xxhash64(node, p, F.substring(tokens, (4 * p + 1).cast("int"), F.lit(4))) for p in (first, other)])


def leaves(sets: DataFrame) -> DataFrame:
    """(``list``, ``name``): the leaves of all trees with two sets or more."""
    names = sets.select(F.col("d1").alias("name"), "tokens")
    roots = F.array(*[F.xxhash64(F.lit(t)) for t in range(TREES)])
    above = names.select("name").distinct().count()
    down = sets.select(F.col("d1").alias("name"), "tokens", F.explode(roots).alias("root"))
    rows = down.select("name", F.explode(_children(F.col("root"), F.col("tokens"))).alias("node"), F.lit(above).cast("long").alias("above")).distinct()
    found = None
    while True:
        rows = cut_lineage(rows)
        sizes = cut_lineage(rows.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.first("above").alias("above")).filter("c > 1"))
        leaf = (F.col("c") <= LEAF) | (F.col("c") > DENSE * F.col("above"))
        here = _of_nodes(rows.drop("above"), sizes.filter(leaf)).select(F.col("node").alias("list"), "name")
        found = here if found is None else found.unionByName(here)
        large = cut_lineage(sizes.filter(~leaf))
        if large.isEmpty():
            return found
        tokens = names.groupBy("name").agg(F.min("tokens").alias("tokens"))
        rows = _of_nodes(rows.drop("above"), large).join(tokens, "name")
        rows = rows.select("name", F.explode(_children(F.col("node"), F.col("tokens"))).alias("node"), F.col("c").alias("above")).distinct()


def _of_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of these nodes with ``c``.  Few nodes are sent to the rows; of
    more, the large ones in parts, so that a hot node is in many tasks."""
    nodes = nodes.select("node", "c")
    if nodes.limit(FEW_NODES + 1).count() <= FEW_NODES:
        return rows.join(F.broadcast(nodes), "node")
    salts = F.when(F.col("c") > 1000, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(-1)))
    hot = F.broadcast(nodes.filter("c > 1000").orderBy(F.desc("c")).limit(FEW_NODES).select("node", F.lit(True).alias("hot")))
    salted = rows.join(hot, "node", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int")).otherwise(-1)).drop("hot")
    return salted.join(nodes.withColumn("salt", F.explode(salts)), ["node", "salt"]).drop("salt")


def agreeing(tokens: list[bytes], sizes: np.ndarray, components: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of sets of a leaf that may link, enough to connect all that do."""
    rows = np.frombuffer(b"".join(tokens), np.uint8).reshape(len(tokens), -1)[:, ::4]
    joined, found = _Joined(components), []
    step = max(1, PAIRS // len(rows))
    for low in range(0, len(rows), step):
        same = (rows[low : low + step, None] == rows[None]).sum(axis=2, dtype=np.uint8)
        a, b = sizes[low : low + step, None], sizes[None]
        good = (same >= AGREE) & (100 * np.minimum(a, b) >= SHARE * np.maximum(a, b))
        good &= (components[low : low + step, None] != components[None]) & ((sides[low : low + step, None] == 0) | (sides[None] == 0))
        for i, j in np.argwhere(good).tolist():
            if joined.union(low + i, j):
                found.append((low + i, j))
    return found


def confirm(sets: list[np.ndarray], components: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of full sets that link, enough to connect all that the links connect.

    Each set (on side 0) is held against all others at once, until nothing is
    apart: its tokens are marked, and the marks of every other set are counted.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.append(0, np.cumsum(sizes))
    _, group = np.unique(components, return_inverse=True)
    found = []
    for i in np.flatnonzero(sides == 0):
        if (group == group[0]).all():
            break
        mark = np.zeros(len(tokens), np.int64)
        mark[tokens[first[i] : first[i + 1]]] = 1
        shared = np.add.reduceat(mark[tokens], first[:-1])
        good = (100 + SHARE) * shared >= SHARE * (sizes + sizes[i])
        for j in np.flatnonzero(good & (group != group[i])):
            if group[i] != group[j]:
                found.append((int(i), int(j)))
                group[group == group[j]] = group[i]
    return found


def _by_tokens(table: pa.Table) -> pa.RecordBatch:
    size, component, side = (table.column(c).to_numpy() for c in ("size", "component", "side"))
    return _edges(table, agreeing(table.column("tokens").to_pylist(), size, component, side))


def _by_sets(words: int):
    def run(table: pa.Table) -> pa.RecordBatch:
        component, side = (table.column(c).to_numpy() for c in ("component", "side"))
        return _edges(table, confirm(list(shingles(table.column("text").combine_chunks(), words)), component, side))

    return run


def join(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row of ``documents`` (``doc_id``, ``text``): ``doc_id``,
    ``n_shingles``, ``component_id`` (the smallest id reachable by links, its own
    included) and ``kept`` (whether that is its own).

    A-Z count as lower case.  A text of fewer words has its whole sequence as
    one shingle; a text without words, or NULL, has none and no links.  Rows
    with equal sets link.  A row without id takes no part: its component and
    ``kept`` are NULL.  Texts given under one id are one document, and rows given
    twice are alike.  No rows give none; other columns are not read.
    """
    settle(documents.sparkSession)
    texts, shared = apart(documents)
    sketches = cut_lineage(_sketches(texts, words))
    sets = sketches.drop("tokens")
    nodes = distinct_sets(sets)
    lists = cut_lineage(leaves(sketches.filter((F.col("key") != NO_ID) & (F.col("n") > 0))))
    reps = nodes.select(F.col("d1").alias("name"), "rep.key", "rep.tid", "rep.n")
    members = cut_lineage(lists.join(reps, "name").select("list", "name", "key", "tid", "n"))
    near = _connect(members, sketches.select("key", "tid", F.col("n").alias("size"), "tokens"), _by_tokens)
    groups = cut_lineage(near.join(reps, "name").select(F.col("component").alias("list"), "name", "key", "tid", "n"))
    labels = _connect(groups, texts, _by_sets(words))
    found = classes(sets, same_ids(sets, labels) if shared else labels)
    own = lambda c: F.when(F.col("key") != NO_ID, c)
    return found.select(
        own(F.col("key")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        own(F.col("component_id")).alias("component_id"),
        own(F.col("key") == F.col("component_id")).alias("kept"),
    )
