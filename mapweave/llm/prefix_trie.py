"""Prefix trie of conversations by adaptive radix trees.

A turn (role, text) is known by an id of ``WIDTH`` bytes, big-endian: the bytes
of the text in UTF-8 (4 bytes), then the MD5 of role and text.  A conversation is
the ids of its turns one after the other.

1. Conversations are range-partitioned and sorted by that key and their id, so
   a prefix is one range, and equal conversations may lie in several tasks.
2. A task reads blocks of bounded size.  Each block becomes a radix tree with
   nodes of 4, 16, 48 or 256 places and compressed paths.  Only byte depths at the
   end of a turn emit nodes.
3. A node on the path of a block's first or last key may go on in other blocks:
   it is given out in part.  All others are whole.
4. The parts of a node are merged: members and ends add up.  What merged nodes
   add to the sums of their ancestors is added in the block that holds a node
   first, along the block's two border paths, and then per node.

Nothing but the SHA-256 of the conversations that end at one node is sequential;
it reads them in order, block by block.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapweave.llm.common import cut_lineage, remainder, settle

#: bytes of a turn's id, and of the length in it
WIDTH, LENGTH = 20, 4

#: conversations and bytes of keys of one radix tree
BLOCK_ROWS, BLOCK_BYTES = 20_000, 16_000_000

#: turns that a conversation may take over, and the ids that share them
HEADS, GROUP = 9, 5

_GROWS = {4: 16, 16: 48, 48: 256}


class Node:
    """A radix tree node: a compressed path, the ids that end after it, and its
    children in one of four layouts.

    ``4`` and ``16``: sorted bytes beside a list; ``48``: 256 slots that point
    into a list; ``256``: one place per byte.
    """

    __slots__ = ("path", "ends", "layout", "keys", "kids", "count")

    def __init__(self, path: bytes):
        self.path, self.ends = path, []
        self.layout, self.keys, self.kids, self.count = 4, bytearray(), [], 0

    def child(self, byte: int) -> Node | None:
        if self.layout == 256:
            return self.kids[byte]
        if self.layout == 48:
            slot = self.keys[byte]
            return self.kids[slot - 1] if slot else None
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> None:
        """Sets the child at ``byte``; a full node grows to the next layout."""
        known = self.child(byte)
        if known is None and self.count == self.layout:
            self._grow()
        if self.layout == 256:
            self.kids[byte] = node
        elif self.layout == 48:
            if known is None:
                self.kids.append(node)
                self.keys[byte] = len(self.kids)
            else:
                self.kids[self.keys[byte] - 1] = node
        elif known is None:
            at = sum(k < byte for k in self.keys)
            self.keys.insert(at, byte)
            self.kids.insert(at, node)
        else:
            self.kids[self.keys.find(byte)] = node
        self.count += known is None

    def _grow(self) -> None:
        pairs = list(self.children())
        self.layout = _GROWS[self.layout]
        if self.layout == 16:
            return
        self.keys = bytearray(256 if self.layout == 48 else 0)
        self.kids = [] if self.layout == 48 else [None] * 256
        for byte, node in pairs:
            if self.layout == 48:
                self.kids.append(node)
                self.keys[byte] = len(self.kids)
            else:
                self.kids[byte] = node

    def children(self) -> Iterator[tuple[int, Node]]:
        """(byte, child) in ascending order."""
        if self.layout == 256:
            return ((b, n) for b, n in enumerate(self.kids) if n is not None)
        if self.layout == 48:
            return ((b, self.kids[s - 1]) for b, s in enumerate(self.keys) if s)
        return iter(zip(self.keys, self.kids, strict=True))


def insert(root: Node, key: bytes, name: int) -> None:
    """Adds ``name`` at the end of ``key``."""
    node, at = root, 0
    while at < len(key):
        child = node.child(key[at])
        if child is None:
            child = Node(key[at:])
            node.put(key[at], child)
            node = child
            break
        path = child.path
        if key.startswith(path, at):
            node, at = child, at + len(path)
            continue
        # the paths part: a node for what they share
        low, high = 1, min(len(path), len(key) - at)
        while low < high:
            middle = (low + high + 1) // 2
            if key.startswith(path[:middle], at):
                low = middle
            else:
                high = middle - 1
        shared = Node(path[:low])
        child.path = path[low:]
        shared.put(child.path[0], child)
        node.put(path[0], shared)
        node, at = shared, at + low
    node.ends.append(name)


def _digest(ends: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()


class Border:
    """One of the two border paths of a block: a key and the names (128-bit
    digests) of its prefixes that end with a turn."""

    def __init__(self, key: bytes):
        self.key, self.names = key, []
        digest = hashlib.blake2b(digest_size=16)
        for start in range(0, len(key) + 1, WIDTH):
            self.names.append(digest.digest())
            digest.update(key[start : start + WIDTH])

    def matched(self, start: int, before: int, path: bytes) -> int:
        """Bytes of this key that a node shares whose path begins at ``start``,
        if its parent shares ``before``."""
        if before < start:
            return before
        mine = self.key[start : start + len(path)]
        if mine == path:
            return start + len(path)
        low, high = 0, min(len(mine), len(path))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if mine[:middle] == path[:middle] else (low, middle - 1)
        return start + low


def walk(root: Node, first: bytes, last: bytes) -> Iterator[tuple]:
    """The nodes at the end of a turn, in post-order, as rows of a block, see
    :data:`ROW`.

    A prefix of the first or last key may go on in other blocks.  Its row has a
    name, and its sums leave out all such nodes, itself included.
    """
    paths = Border(first), Border(last)
    key = bytearray()
    # node, where its path begins, bytes shared with both borders, totals so far
    stack: list[list] = [[root, 0, (0, 0), None]]
    result = None
    while stack:
        node, start, shared, state = stack[-1]
        if state is None:
            key[start:] = node.path
            shared = stack[-1][2] = tuple(p.matched(start, b, node.path) for p, b in zip(paths, shared, strict=True))
            # members, least id, children, leaves, saved, rows that wait for the parent's id
            state = stack[-1][3] = [len(node.ends), min(node.ends, default=None), 0, 0, 0, [], node.children()]
        elif result is not None:
            n, least, tops, leaves, saved, waiting = result
            state[0] += n
            state[1] = least if state[1] is None else min(state[1], least)
            state[2] += tops
            state[3] += leaves
            state[4] += saved
            state[5] += waiting
            result = None
        below = next(state[6], None)
        end = start + len(node.path)
        if below is not None:
            stack.append([below[1], end, shared, None])
            continue
        stack.pop()
        n, least, tops, leaves, saved, waiting, _ = state
        depth = end // WIDTH
        # every end of a turn on the path, the deepest first
        while depth * WIDTH > start or node is root and depth == 0:
            size = depth * WIDTH
            length = int.from_bytes(key[size - WIDTH : size - WIDTH + LENGTH]) if depth else 0
            ends = node.ends if size == end else []
            if size <= max(shared):
                side = 0 if size <= shared[0] else 1
                names = paths[side].names
                for row in waiting:
                    yield (None, names[depth], None, None, None, *row)
                text = ",".join(map(str, ends))
                parent = names[depth - 1] if depth else None
                yield (names[depth], parent, side, size <= min(shared), ends[0] if ends else None, least, depth, None, n, tops, leaves, saved, length, text)
                tops, waiting = 0, []
            else:
                for row in waiting:
                    yield (None, None, None, None, None, *row[:2], least, *row[3:])
                leaves += tops == 0
                saved += (n - 1) * length
                waiting = [(least, depth, None, n, tops, leaves, saved, length, _digest(ends))]
                tops = 1
            depth -= 1
            if depth < 0:
                break
        result = n, least, tops, leaves, saved, waiting


#: a node of a block: a node with ``name`` may go on in other blocks (``side``
#: of the border it is on, ``shared`` by both; ``ends`` are ids, from
#: ``first_end``); others are whole (``ends`` is the digest), and their
#: ``parent`` is named if it may go on
ROW = """block long, name binary, parent binary, side int, shared boolean, first_end long, conv_id long, depth long, parent_conv_id long,
n_convs long, n_children long, n_leaves long, saved long, length long, ends string"""


def _blocks(keys: DataFrame) -> DataFrame:
    """Rows of all blocks of sorted ``key``, ``conv_id``."""
    fields = [f.split()[0] for f in ROW.replace("\n", " ").split(",")]

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[bytes, int]] = []
        size = 0

        def block() -> Iterator[pa.RecordBatch]:
            root = Node(b"")
            for key, name in held:
                insert(root, key, name)
            rows = walk(root, held[0][0], held[-1][0])
            while part := list(itertools.islice(rows, 20_000)):
                columns = [[number] * len(part), *zip(*part, strict=True)]
                types = [pa.binary() if f in ("name", "parent") else pa.int32() if f == "side" else pa.bool_() if f == "shared" else pa.string() if f == "ends" else pa.int64() for f in fields]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], fields)

        for batch in batches:
            for key, name in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                held.append((key, name))
                size += len(key)
                if len(held) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                    yield from block()
                    held, size, number = [], 0, number + 1
        if held:
            yield from block()

    return keys.mapInArrow(run, ROW)


def _joined_ends(parts: DataFrame) -> DataFrame:
    """(``name``, ``ends_sha256``): runs of ids in order, one after the other."""

    def run(batches):
        name, digest = None, None
        for batch in batches:
            names, found = [], []
            for mine, ends in zip(batch.column("name").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if mine != name:
                    if name is not None:
                        names.append(name)
                        found.append(digest.hexdigest())
                    name, digest = mine, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], ["name", "ends_sha256"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()])], ["name", "ends_sha256"])

    runs = parts.filter("first_end IS NOT NULL").select("name", "first_end", "ends")
    return runs.repartition("name").sortWithinPartitions("name", "first_end").select("name", "ends").mapInArrow(run, "name binary, ends_sha256 string")


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn: the text's bytes, then the MD5 of role and text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.unhex(F.concat(F.lpad(F.hex(F.octet_length(text)), 2 * LENGTH, "0"), digest))


def keys(conversations: DataFrame) -> DataFrame:
    """(``conv_id``, ``ids``): the ids of a conversation's turns in order.

    NULL turns come first; turns with the same number go by their ids, that is
    by the bytes of their texts, then by MD5.  Rows without ``conv_id`` belong
    to no conversation.
    """
    turns = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", turn_id(F.col("role"), F.col("text")).alias("id")).alias("turn"))
    # ids that share their first turns meet in one task, so one shuffle is enough
    dealt = turns.repartition(_group("conv_id"))
    return dealt.groupBy(_group("conv_id").alias("group"), "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select("group", "conv_id", F.col("turns.id").alias("ids"))


def _group(column: str) -> Column:
    return F.col(column) - F.col(column) % GROUP


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(``conv_id``, ``key``): every conversation after its rebuilding.

    With h = crc32(conv_id) mod 9 conversation c is the first h turns of
    conversation c - c mod 5 (mod as in Java and SQL: -7 mod 5 = -2) and c's own
    turns after its first h.
    """
    own = keys(conversations)
    heads = own.filter("conv_id = group").select("group", F.slice("ids", 1, HEADS - 1).alias("head"))
    h = remainder("conv_id", HEADS).cast("int")
    taken = F.slice(F.coalesce("head", F.array().cast("array<binary>")), F.lit(1), h)
    rest = F.slice("ids", h + 1, F.greatest(F.size("ids") - h, F.lit(0)))
    joined = own.join(heads, "group", "left").select("conv_id", F.concat(taken, rest).alias("ids"))
    return joined.select("conv_id", F.unhex(F.array_join(F.transform("ids", F.hex), "")).alias("key"))


def trie(keys: DataFrame) -> DataFrame:
    """The nodes of the trie of ``key`` (ids of ``WIDTH`` bytes) by ``conv_id``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (NULL for the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``; all but the last two columns are long.  Without
    conversations there is no node, not even a root.
    """
    settle(keys.sparkSession)
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the ranges are sampled first, so the keys are read twice
    keys = cut_lineage(keys)
    rows = cut_lineage(_blocks(keys.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id").select("key", "conv_id")))

    counts = ["n_convs", "n_children", "n_leaves"]
    named = rows.filter("name IS NOT NULL")
    merged = named.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.first("length").alias("length"),
        F.min("block").alias("owner"),
        *[F.sum(c).alias(c) for c in [*counts, "saved"]],
    )
    kin = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("kin"))
    merged = merged.join(kin, "name", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kin", F.lit(0))).drop("kin")
    merged = cut_lineage(merged.join(_joined_ends(named), "name", "left"))

    # what merged nodes add to their ancestors, in the block that holds them first
    own = merged.select("name", "owner", F.col("conv_id").alias("least"), ((F.col("n_convs") - 1) * F.col("length")).alias("own"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    dealt = named.select("block", "name", "side", "shared", "depth").join(own, "name")
    below = Window.partitionBy("block", "side").orderBy(F.desc("depth"))
    whole = Window.partitionBy("block")
    sums = []
    for value in ("own", "leaf"):
        here = F.when(F.col("block") == F.col("owner"), F.col(value)).otherwise(0)
        other = F.sum(F.when(F.col("side") == 1, here).otherwise(0)).over(whole)
        sums.append((F.sum(here).over(below) + F.when(F.col("shared"), other).otherwise(0)).alias(value))
    dealt = cut_lineage(dealt.select("block", "name", "least", *sums))
    added = dealt.groupBy("name").agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf"))
    parents = dealt.select("block", F.col("name").alias("parent"), F.col("least").alias("parent_conv_id"))

    columns = ["conv_id", "depth", "parent_conv_id", *counts, F.col("saved").alias("saved_tokens"), "ends_sha256"]
    inner = rows.filter("name IS NULL").withColumnRenamed("ends", "ends_sha256")
    hanging = inner.filter("parent IS NOT NULL").drop("parent_conv_id").join(parents, ["block", "parent"])
    border = merged.join(added, "name").withColumn("n_leaves", F.col("n_leaves") + F.col("leaf")).withColumn("saved", F.col("saved") + F.col("own"))
    border = border.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_digest([])))).join(parents.withColumnRenamed("block", "owner"), ["owner", "parent"], "left")
    return inner.filter("parent IS NULL").select(*columns).unionByName(hanging.select(*columns)).unionByName(border.select(*columns))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the rebuilt ``conversations`` (``conv_id``, ``turn``,
    ``role``, ``text``), see :func:`trie`.

    NULL role or text is empty.  Repeated rows are turns of their own.  A
    conversation that is left without turns is a member of the root.  The order
    of turns with one number is given at :func:`keys`.  A conversation's ids are
    one row (20 bytes a turn).  No rows give none; other columns are not read.
    """
    settle(conversations.sparkSession)
    return trie(rebuilt(conversations))
