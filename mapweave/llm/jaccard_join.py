"""N-gram Jaccard join with signature trees.

Two documents link when their sets of shingles (runs of ``WORDS`` words) have a
Jaccard similarity of 0.75 or more.  The steps are

1. documents with equal sets become one node;
2. of a set of n shingles the first n - ceil(0.75 n) + 1 in a fixed order are
   its prefix; sets that link share a prefix shingle, so the sets that share
   one are a list, cut where sizes differ too much to link.  Equal lists are kept
   once.  Shingles that are frequent come last in the order, which only makes
   lists shorter;
3. in every list signatures (a few bits per shingle) are compared: pairs that
   share too few bits to link are out, the others make plausible components;
4. the texts of each plausible component of two sets or more go to one task,
   which joins them exactly by a signature tree.

Steps 3 and 4 join long lists twice: first in blocks around a common leader,
which connects most groups of near copies, then what is still apart in full.

A signature tree has one node per block of similar sets, with the OR of their
token bitmaps and the range of their sizes.  A dual traversal prunes pairs of
nodes whose bitmaps share too few tokens for any two of their sets to link, or
whose sets are connected already; at the leaves the overlap is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import NO_ID, apart, cut_lineage, give_back, gram_hashes, mix, settle, slices, span_hashes, text_bytes, word_spans

#: words of a shingle
WORDS = 5

#: sets and shingles of a block
BLOCK_SETS, BLOCK_SHINGLES = 1000, 1_000_000

#: a shingle counts as frequent from so many sets of a task's part; the list of
#: frequent shingles is bounded
FREQUENT, FREQUENT_MOST = 8, 100_000

#: shingles of a task that are counted together
COUNTED = 4_000_000

#: ids that may be sent to all executors; more are joined by a shuffle
BROADCAST_IDS = 1_000_000

#: edges that one task may hold
FEW_EDGES = 300_000

#: children of a tree node
FAN = 8


def _lower(data: np.ndarray) -> np.ndarray:
    upper = (data >= 0x41) & (data <= 0x5A)
    return data + upper * np.uint8(0x20)


def shingles(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted set of 64-bit shingle hashes of every text."""
    data, offsets = text_bytes(texts)
    for a, b in slices(offsets):
        part, bound = _lower(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a]
        if not len(part):
            yield from (np.zeros(0, np.uint64) for _ in range(a, b))
            continue
        starts, ends, first = word_spans(part, bound)
        h = span_hashes(part, starts, ends)
        grams = gram_hashes(h, words)
        for i in range(b - a):
            low, high = int(first[i]), int(first[i + 1])
            if high - low >= words:
                yield np.unique(grams[low : high - words + 1])
            elif high > low:
                # the whole sequence, apart from shingles of full length
                yield mix(gram_hashes(h[low:high], high - low) + np.uint64(high - low))
            else:
                yield np.zeros(0, np.uint64)


def _digest(hashes: np.ndarray) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), np.int64)


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """``kind`` 0: per document ``n``, the digest ``d1``, ``d2`` of its set and
    its signature; ``kind`` 1: frequent shingles (``d1``) with a count (``n``)."""

    def frequent(held: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(held)
        held.clear()
        h.sort()
        # only what is repeated often enough is counted
        many = h[: max(0, len(h) - FREQUENT + 1)]
        many = np.unique(many[many == h[FREQUENT - 1 :]])
        n = np.searchsorted(h, many, "right") - np.searchsorted(h, many, "left")
        h = many.view(np.int64)
        zero = np.zeros(len(h), np.int64)
        return batch_of(np.ones(len(h), np.int32), zero, zero, n, h, zero, [None] * len(h))

    def batch_of(kind, key, tid, n, d1, d2, signature) -> pa.RecordBatch:
        arrays = [pa.array(kind), pa.array(key), pa.array(np.asarray(tid).astype(np.int64)), pa.array(n), pa.array(d1), pa.array(d2), pa.array(signature, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["kind", "key", "tid", "n", "d1", "d2", "signature"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            n, digests, signatures = [], [], []
            for found in shingles(batch.column("text"), words):
                n.append(len(found))
                digests.append(_digest(found))
                signatures.append(signature(found))
                held.append(found)
                size += len(found)
                if size > COUNTED:
                    yield frequent(held)
                    held, size = [], 0
            d = np.stack(digests)
            key, tid = (batch.column(c).to_numpy() for c in ("key", "tid"))
            yield batch_of(np.zeros(len(n), np.int32), key, tid, np.array(n, np.int64), d[:, 0], d[:, 1], signatures)
        if held:
            yield frequent(held)
        held.clear()
        give_back()

    return texts.mapInArrow(run, "kind int, key long, tid long, n long, d1 long, d2 long, signature binary")


def signature(hashes: np.ndarray) -> bytes:
    """A bitmap of 2 to 4 bits per shingle, 64 at least."""
    width = max(64, 1 << (2 * len(hashes) - 1).bit_length()) if len(hashes) else 64
    bits = np.zeros(width, bool)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def plausible(signatures: list[bytes], sizes: np.ndarray, components: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of sets that may link, enough to connect all that do.

    Two sets share at most |a| less the bits of a that b lacks, since each such
    bit stands for a shingle that b does not have.  Of signatures of different
    width the wider one is folded; sets that link differ by one fold at most.
    """
    width = np.array([len(s) for s in signatures])
    joined, found = _Joined(components), []

    def rows(which: np.ndarray, folds: int) -> tuple[np.ndarray, np.ndarray]:
        bits = np.frombuffer(b"".join(signatures[i] for i in which), np.uint64).reshape(len(which), -1)
        for _ in range(folds):
            half = bits.shape[1] // 2
            bits = bits[:, :half] | bits[:, half:]
        return bits, np.bitwise_count(bits).sum(axis=1, dtype=np.int64)

    for w in np.unique(width):
        here = np.flatnonzero(width == w)
        a, ones = rows(here, 0)
        for folds in (0, 1):
            there = here if not folds else np.flatnonzero(width == 2 * w)
            if not len(there):
                continue
            b, others = rows(there, folds)
            step = max(1, 2_000_000 // b.size)
            for low in range(0, len(here), step):
                part = here[low : low + step]
                both = np.bitwise_count(a[low : low + step, None] & b[None]).sum(axis=2, dtype=np.int64)
                na, nb = sizes[part][:, None], sizes[there][None]
                most = np.minimum(na - ones[low : low + step, None], nb - others[None]) + both
                good = (7 * most >= 3 * (na + nb)) & (components[part][:, None] != components[there][None])
                good &= (sides[part][:, None] == 0) | (sides[there][None] == 0)
                for i, j in np.argwhere(good).tolist():
                    if joined.union(int(part[i]), int(there[j])):
                        found.append((int(part[i]), int(there[j])))
    return found


def _needed(n: np.ndarray | int):
    """Least number of shingles a set of ``n`` shares with any set it links to."""
    return -(-3 * n // 4)


def _prefixes(texts: DataFrame, frequent: np.ndarray, words: int) -> DataFrame:
    """(``h``, ``n``, ``d1``) for every prefix shingle; a set once per task."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            hs, ds, ns, sizes = [], [], [], []
            for found in shingles(batch.column("text"), words):
                if not len(found):
                    continue
                digest = _digest(found)
                if digest.tobytes() in seen:
                    continue
                seen.add(digest.tobytes())
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
                    common = frequent[at] == found
                    found = np.concatenate([found[~common], found[common]])
                ns.append(len(found))
                found = found[: len(found) - _needed(len(found)) + 1]
                hs.append(found)
                ds.append(digest[0])
                sizes.append(len(found))
            if len(seen) > 1_000_000:
                seen.clear()
            if hs:
                columns = [np.concatenate(hs).view(np.int64), *(np.repeat(np.array(c, np.int64), sizes) for c in (ns, ds))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "n", "d1"])
        give_back()

    return texts.mapInArrow(run, "h long, n long, d1 long")


#: sets of one list that are held to find equal lists; longer lists pass as they
#: come, under the name of their shingle
HELD = 4096


def _lists(prefixes: DataFrame) -> DataFrame:
    """(``list``, ``d1``): the sets that share a prefix shingle, two or more.

    Rows come sorted by ``h`` and size.  Where a set is less than three quarters
    of the next one, no set before links to one after: the list is cut there.
    """

    def run(batches):
        seen: set[bytes] = set()
        held = np.zeros((3, 0), np.int64)
        going = None  # shingle, last size and cuts so far of a list passed on as it comes

        def out(names, members) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(names, np.int64)), pa.array(members)], ["list", "d1"])

        def cuts(sizes: np.ndarray, before: int) -> np.ndarray:
            return 4 * np.append(before, sizes[:-1]) < 3 * sizes

        def passed(rows: np.ndarray) -> pa.RecordBatch:
            nonlocal going
            h, last, number = going
            numbers = number + np.cumsum(cuts(rows[1], last))
            if len(numbers):
                going = h, int(rows[1, -1]), int(numbers[-1])
            names = mix(rows[0].view(np.uint64) + numbers.astype(np.uint64)).view(np.int64)
            return out(names, rows[2])

        def lists(rows: np.ndarray) -> pa.RecordBatch:
            new = cuts(rows[1], 0)
            new[:1] = True
            new[1:] |= rows[0, 1:] != rows[0, :-1]
            first = np.flatnonzero(new)
            ends = np.append(first[1:], rows.shape[1])
            names, members = [], [np.zeros(0, np.int64)]
            for a, b in zip(first[ends - first > 1].tolist(), ends[ends - first > 1].tolist(), strict=True):
                one = rows[2, a:b]
                digest = hashlib.blake2b(one.tobytes(), digest_size=16).digest()
                if digest not in seen:
                    seen.add(digest)
                    names.append(np.full(b - a, int.from_bytes(digest[:8], "little", signed=True)))
                    members.append(one)
            if len(seen) > 1_000_000:
                seen.clear()
            return out(np.concatenate(names) if names else [], np.concatenate(members))

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in ("h", "n", "d1")])
            same = np.zeros(rows.shape[1], bool)
            same[1:] = (rows[:, 1:] == rows[:, :-1]).all(axis=0)
            if held.shape[1] and rows.shape[1]:
                same[0] = (rows[:, 0] == held[:, -1]).all()
            rows = np.concatenate([held, rows[:, ~same]], axis=1)
            if going is not None:
                n = int(np.argmax(np.append(rows[0] != going[0], True)))
                yield passed(rows[:, :n])
                rows = rows[:, n:]
                going = None if rows.shape[1] else going
            held = rows
            if rows.shape[1]:
                end = rows.shape[1] - int(np.argmax(np.append(rows[0, ::-1] != rows[0, -1], True)))
                yield lists(rows[:, :end])
                held = rows[:, end:]
                if held.shape[1] > HELD:
                    going = held[0, 0], int(held[1, 0]), 0
                    yield passed(held)
                    held = held[:, :0]
        if held.shape[1]:
            yield lists(held)

    dealt = prefixes.repartition("h").sortWithinPartitions("h", "n", "d1")
    return dealt.mapInArrow(run, "list long, d1 long").dropDuplicates(["list", "d1"])


# ----------------------------------------------------------- signature tree


class Tree:
    """Levels of OR-combined bitmaps with size ranges over sorted sets."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray):
        self.bitmaps, self.low, self.high = [bitmaps], [sizes], [sizes]
        while len(self.bitmaps[-1]) > 1:
            first = np.arange(0, len(self.bitmaps[-1]), FAN)
            self.bitmaps.append(np.bitwise_or.reduceat(self.bitmaps[-1], first, axis=0))
            self.low.append(np.minimum.reduceat(self.low[-1], first))
            self.high.append(np.maximum.reduceat(self.high[-1], first))

    def children(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * FAN, min((node + 1) * FAN, len(self.bitmaps[level - 1])))


class _Joined:
    """Components of the sets of a block."""

    def __init__(self, names: np.ndarray):
        _, self.parent = np.unique(names, return_inverse=True)
        first = {}
        self.parent = np.array([first.setdefault(p, i) for i, p in enumerate(self.parent.tolist())], np.int64)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def union(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)
        return i != j


def link(sets: list[np.ndarray], components: np.ndarray, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of sets that link and connect different components.

    ``sides``: only pairs with a set on side 0 are asked for.  Enough pairs are
    returned to connect all that the links connect.
    """
    order = np.lexsort(([s[0] if len(s) else 0 for s in sets], components, [len(s) for s in sets]))
    sets = [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets], np.int64)
    side = np.zeros(len(sets), np.int8) if sides is None else np.asarray(sides)[order]
    # tokens that one set alone has are in no overlap
    tokens, row, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    width = int(shared.sum())
    owner = np.repeat(np.arange(len(sets)), sizes)
    bitmaps = np.zeros((len(sets), -(-max(width, 1) // 64) * 8), np.uint8)
    some = shared[row]
    at, who = column[row[some]], owner[some]
    np.bitwise_or.at(bitmaps, (who, at >> 3), np.left_shift(1, at & 7).astype(np.uint8))
    tree = Tree(bitmaps.view(np.uint64), sizes)
    joined, found = _Joined(np.asarray(components)[order]), []
    top = len(tree.bitmaps) - 1
    stack = [(top, 0, 0)]
    while stack:
        level, p, q = stack.pop()
        if level == 0:
            if joined.union(p, q):
                found.append((int(order[p]), int(order[q])))
            continue
        left, right = tree.children(level, p), tree.children(level, q)
        low = tree.low[level - 1]
        shared_bits = np.bitwise_count(tree.bitmaps[level - 1][left][:, None] & tree.bitmaps[level - 1][right][None]).sum(axis=2, dtype=np.int64)
        least = low[left][:, None] + low[right][None]
        possible = 7 * shared_bits >= 3 * least
        if level == 1:
            possible &= (side[left][:, None] == 0) | (side[right][None] == 0)
        high = tree.high[level - 1]
        possible &= (4 * high[left][:, None] >= 3 * low[right][None]) & (4 * high[right][None] >= 3 * low[left][:, None])
        if p == q:
            possible &= left[:, None] < right[None] if level == 1 else left[:, None] <= right[None]
        if level == 1:
            root = np.array([joined.find(int(i)) for i in left]), np.array([joined.find(int(i)) for i in right])
            possible &= root[0][:, None] != root[1][None]
        for i, j in np.argwhere(possible)[::-1].tolist():
            stack.append((level - 1, int(left[i]), int(right[j])))
    return found


def _by_task(rows: DataFrame, function, schema: str) -> DataFrame:
    """Applies ``function`` (table to edges) to every task of more than one
    component; tasks are bounded, see :func:`_blocks`."""

    def run(batches):
        held: list[pa.Table] = []

        def done() -> Iterator[pa.RecordBatch]:
            table = pa.concat_tables(held)
            task, component = table.column("task").to_numpy(), table.column("component").to_numpy()
            cuts = np.flatnonzero(np.diff(task)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(task)], strict=True):
                if (component[a:b] != component[a]).any():
                    yield function(table.slice(a, b - a))

        for batch in batches:
            # whole tasks only: the last one of a batch may go on
            task = batch.column("task").to_numpy()
            cut = int(np.searchsorted(task, task[-1]))
            table = pa.Table.from_batches([batch])
            if cut or held and held[0].column("task")[0].as_py() != task[-1]:
                held.append(table.slice(0, cut))
                yield from done()
                held = [table.slice(cut)]
            else:
                held.append(table)
        if held:
            yield from done()

    def connecting(batches):
        # in the same worker: of a task's edges only those that connect something
        yield from _spanning(run(batches))
        give_back()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(connecting, schema)


def _with(members: DataFrame, rows: DataFrame) -> DataFrame:
    """Joins rows (texts, signatures) to members by key and tid.  Few ids are
    sent to the rows, so that only rows asked for are shuffled."""
    ids = members.select("key", "tid").distinct()
    wanted = ids.limit(BROADCAST_IDS + 1).count()
    few = rows.join(F.broadcast(ids) if wanted <= BROADCAST_IDS else ids, ["key", "tid"], "left_semi")
    # rows given twice are one
    return members.join(few.dropDuplicates(["key", "tid"]), ["key", "tid"])


def _edges(table: pa.Table, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    name, pairs = table.column("name").to_numpy(), np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(name[pairs[:, 0]]), pa.array(name[pairs[:, 1]])], ["a", "b"])


def _by_signature(table: pa.Table) -> pa.RecordBatch:
    size, component, side = (table.column(c).to_numpy() for c in ("size", "component", "side"))
    return _edges(table, plausible(table.column("signature").to_pylist(), size, component, side))


def _by_text(words: int):
    def run(table: pa.Table) -> pa.RecordBatch:
        component, side = (table.column(c).to_numpy() for c in ("component", "side"))
        return _edges(table, link(list(shingles(table.column("text").combine_chunks(), words)), component, side))

    return run


class _Forest:
    """Components of keys as they come."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, i: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(i, i)) != i:
            parent[i] = parent[up]
            i = up
        return i

    def union(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)
        return i != j


def _spanning(batches):
    """Of a task's edges those that connect something new."""
    forest = _Forest()
    for batch in batches:
        a, b = (batch.column(c).to_pylist() for c in ("a", "b"))
        new = np.array([forest.union(i, j) for i, j in zip(a, b, strict=True)], bool)
        if len(forest.parent) > FEW_EDGES:
            forest = _Forest()
        yield batch.filter(pa.array(new))


def _labels(batches):
    """(``key``, ``component``) of all edges of one task."""
    forest = _Forest()
    for batch in batches:
        for i, j in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            forest.union(i, j)
    keys = list(forest.parent)
    for start in range(0, len(keys), 100_000):
        part = keys[start : start + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([forest.find(k) for k in part], pa.int64())], ["key", "component"])


def components(edges: DataFrame) -> DataFrame:
    """(``key``, ``component``): the smallest key that is reachable, for every
    key on an edge.

    Few edges (:data:`FEW_EDGES`) are settled by one task.  Of more, every task
    first keeps a spanning forest of its own; if these are still many, large and
    small stars alternate (each key's larger, then smaller neighbours move to the
    smallest), which ends after few rounds.
    """
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b"))
    for step in range(2):
        if edges.limit(FEW_EDGES + 1).count() <= FEW_EDGES:
            return edges.coalesce(1).mapInArrow(_labels, "key long, component long")
        if step == 0:
            edges = cut_lineage(edges.mapInArrow(_spanning, "a long, b long"))
    edges, before = edges.distinct(), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = cut_lineage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        after = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first())
        if after == before:
            break
        before = after
    # every key now has one edge, to the smallest
    return edges.select(F.col("a").alias("key"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("key"), F.col("b").alias("component")).distinct())


def _blocks(count, total):
    """Blocks of so many sets with so many shingles."""
    return F.greatest(F.lit(1), F.ceil(count / BLOCK_SETS), F.ceil(total / BLOCK_SHINGLES)).cast("int")


def _connect(members: DataFrame, rows: DataFrame, function) -> DataFrame:
    """Components (``name``, ``component``) of the pairs that ``function`` finds
    in the lists of ``members`` (``list``, ``name``, ``key``, ``tid``, ``n``),
    with what ``rows`` has for each set."""
    # first each set in one of its lists, long lists in blocks around a leader
    one = members.groupBy("name", "key", "tid", "n").agg(F.min("list").alias("list"))
    size = one.groupBy("list").agg(F.count(F.lit(1)).alias("chosen"), F.sum("n").alias("s"), F.min("name").alias("leader"))
    size = cut_lineage(size.withColumn("blocks", _blocks(F.col("chosen"), F.col("s"))))
    dealt = one.join(size.filter("chosen > 1"), "list")
    block = F.when(F.col("name") == F.col("leader"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")))
    tasks = dealt.select(F.explode(block).alias("block"), "list", "name", "key", "tid").select(F.xxhash64("list", "block").alias("task"), "name", "key", "tid", F.col("name").alias("component"), F.lit(0).cast("byte").alias("side"))
    first = cut_lineage(components(_by_task(_with(cut_lineage(tasks), rows), function, "a long, b long")).withColumnRenamed("key", "name"))

    # lists that were not joined whole and are not in one component yet: the
    # sets outside the list's largest component against each other and that one
    labelled = members.join(first, "name", "left").withColumn("component", F.coalesce("component", "name"))
    part = labelled.groupBy("list", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    whole = part.groupBy("list").agg(F.max(F.struct("c", "component", "s")).alias("major"), F.sum("c").alias("c"), F.sum("s").alias("s"))
    whole = whole.join(size.select("list", "chosen", "blocks"), "list", "left")
    open_ = whole.filter("major.c < c AND (chosen IS NULL OR chosen < c OR blocks > 1)").select(
        "list",
        F.col("major.component").alias("major"),
        _blocks(F.col("major.c"), F.col("major.s")).alias("majors"),
        _blocks(F.col("c") - F.col("major.c"), F.col("s") - F.col("major.s")).alias("minors"),
    )
    open_ = cut_lineage(open_)
    if open_.isEmpty():
        return first
    rest = labelled.join(open_, "list").withColumn("side", (F.col("component") == F.col("major")).cast("byte"))
    blocks = F.when(F.col("side") == 1, F.col("majors")).otherwise(F.col("minors"))
    rest = rest.withColumn("mine", F.pmod(F.xxhash64("name"), blocks).cast("int"))
    minors = F.sequence(F.lit(0), F.col("minors") - 1)
    # a pair of blocks is named by the smaller number first; majors come after
    with_minor = F.transform(minors, lambda m: F.array(F.least(m, F.col("mine")), F.greatest(m, F.col("mine"))))
    with_major = F.transform(F.sequence(F.lit(0), F.col("majors") - 1), lambda m: F.array(F.col("mine"), F.col("minors") + m))
    to_minor = F.transform(minors, lambda m: F.array(m, F.col("minors") + F.col("mine")))
    pairs = F.when(F.col("side") == 1, to_minor).otherwise(F.concat(with_minor, with_major))
    tasks = rest.select(F.explode(pairs).alias("pair"), "list", "name", "key", "tid", "component", "side").select(F.xxhash64("list", "pair").alias("task"), "name", "key", "tid", "component", "side")
    more = _by_task(_with(cut_lineage(tasks), rows), function, "a long, b long")
    return cut_lineage(components(first.select(F.col("name").alias("a"), F.col("component").alias("b")).unionByName(more)).withColumnRenamed("key", "name"))


def distinct_sets(sets: DataFrame) -> DataFrame:
    """One row per set that has shingles and an id: its digest, and where its
    text is found."""
    return sets.filter((F.col("key") != NO_ID) & (F.col("n") > 0)).groupBy("d1", "d2").agg(F.min(F.struct("key", "tid", "n")).alias("rep"))


def same_ids(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` (``name``, ``component``) when the texts given under one id are
    one document."""
    names = sets.filter((F.col("key") != NO_ID) & (F.col("n") > 0)).groupBy("key").agg(F.min("d1").alias("b"), F.max("d1").alias("a")).filter("a <> b")
    again = sets.join(names.select("key", "b"), "key").filter("n > 0").select(F.col("d1").alias("a"), "b")
    return components(labels.select(F.col("name").alias("a"), F.col("component").alias("b")).unionByName(again)).withColumnRenamed("key", "name")


def classes(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``sets`` its ``key``, ``tid``, ``n``, and the smallest ``key``
    of its component as ``component_id``; a row without id or shingles has its
    own key."""
    nodes = distinct_sets(sets)
    # only sets on an edge have a label, and these are few
    known = cut_lineage(labels.join(nodes.select(F.col("d1").alias("name"), F.col("rep.key").alias("key")), "name"))
    least = known.groupBy("component").agg(F.min("key").alias("component_id"))
    named = known.join(least, "component").select(F.col("name").alias("d1"), "component_id").distinct()
    names = nodes.select("d1", "d2", F.col("rep.key").alias("key")).join(named, "d1", "left").select("d1", "d2", F.coalesce("component_id", "key").alias("component_id"))
    alone = (F.col("key") == NO_ID) | (F.col("n") == 0)
    linked = sets.filter(~alone).join(names, ["d1", "d2"]).select("key", "tid", "n", "component_id")
    return linked.unionByName(sets.filter(alone).select("key", "tid", "n", F.col("key").alias("component_id")))


def link_sets(texts: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """The sets of ``texts`` (``key``, ``tid``, ``text``) and the components
    (``name``, ``component``) of those that link; a set's name is half its digest."""
    found = cut_lineage(_sets(texts, words))
    sets = found.filter("kind = 0").drop("kind")
    most = found.filter("kind = 1").groupBy("d1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "d1").limit(FREQUENT_MOST).collect()
    # most frequent last: the smallest shingles by hash lead the order
    frequent = np.sort(np.array([r.d1 for r in most], np.int64).view(np.uint64))
    known = texts.filter(F.col("key") != NO_ID)
    lists = cut_lineage(_lists(_prefixes(known, frequent, words)))
    nodes = distinct_sets(sets)
    members = cut_lineage(lists.join(nodes, "d1").select("list", F.col("d1").alias("name"), "rep.key", "rep.tid", "rep.n"))

    near = _connect(members, sets.select("key", "tid", F.col("n").alias("size"), "signature"), _by_signature)
    reps = nodes.select(F.col("d1").alias("name"), "rep.key", "rep.tid", "rep.n")
    groups = cut_lineage(near.join(reps, "name").select(F.col("component").alias("list"), "name", "key", "tid", "n"))
    return sets, _connect(groups, texts, _by_text(words))


def join(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row of ``documents`` (``doc_id``, ``text``): ``doc_id``,
    ``n_shingles`` (size of its set) and ``component_id``, the smallest id
    reachable by links, its own included.

    A-Z count as lower case.  A text of fewer words has its whole sequence as
    one shingle; a text without words, or NULL, has none and no links.  Rows
    with equal sets link.  A row without id takes no part: its component is
    NULL.  Texts given under one id are one document: a link of one of them is a
    link of all.  No rows give none; other columns are not read.
    """
    settle(documents.sparkSession)
    texts, shared = apart(documents)
    sets, labels = link_sets(texts, words)
    found = classes(sets, same_ids(sets, labels) if shared else labels)
    own = lambda c: F.when(F.col("key") != NO_ID, F.col(c))
    return found.select(own("key").alias("doc_id"), F.col("n").alias("n_shingles"), own("component_id").alias("component_id"))


def keep_first(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``documents`` that stay if each group of linked texts keeps
    one, the one with the smallest id.

    Every row counts by its own text, also where ids are shared.  Of the rows of
    a group that share the smallest id one stays (the smallest by a hash of the
    text, then by all columns).  Rows without id, and texts without words, are in
    no group and stay, but of exact copies of such a text under one id one stays.
    """
    settle(documents.sparkSession)
    texts, _ = apart(documents, F.struct(*documents.columns).alias("_row"))
    sets, labels = link_sets(texts.select("key", "tid", "text"), words)
    found = cut_lineage(classes(sets, labels).filter(F.col("key") != NO_ID).groupBy("key", "tid").agg(F.first("n").alias("n"), F.first("component_id").alias("component_id"), F.count(F.lit(1)).alias("rows")))
    # a text goes if a smaller id is in its group, or a smaller text under its id
    several = found.filter("n > 0 AND key = component_id").groupBy("component_id").agg(F.min("tid").alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    gone = found.filter("key <> component_id").select("key", "tid")
    twins = found.filter("key = component_id").join(several, "component_id").filter("tid <> first").select("key", "tid")
    gone = cut_lineage(gone.unionByName(twins))
    kept = texts.join(_sent(gone), ["key", "tid"], "left_anti")
    again = cut_lineage(found.filter("rows > 1").join(gone, ["key", "tid"], "left_anti").select("key", "tid"))
    if again.isEmpty():
        return kept.select("_row.*")
    copies = kept.join(_sent(again), ["key", "tid"]).groupBy("key", "tid").agg(F.min("_row").alias("_row"))
    return kept.join(_sent(again), ["key", "tid"], "left_anti").select("_row.*").unionByName(copies.select("_row.*"))


def _sent(ids: DataFrame) -> DataFrame:
    """Few ids go to the documents; more are joined by a shuffle."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids
