"""Mixing sources to target weights.

The words of each source form one stream, packed into blocks of ``BLOCK`` words
(fewer in a source of few words, so that a block is a small share of it).
The mix is a row of slots, dealt to output shards; each shard draws how many
slots a source gets from a multinomial, given how
many slots it has in all.  A source's slots are numbered through
all shards and mapped to its blocks by pseudorandom permutations of the block
numbers, one permutation after the other, so no block comes once more before all
others have come.  Slots and the words of the blocks are joined by source and
block number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mapweave.llm.common import WORD, cut_lineage, keyed, settle, text_hash

#: words of a block, slots of a shard, seed of the draws
BLOCK, SHARD, SEED = 256, 4096, 11

#: blocks of a source at least, as far as it has the words
FINE = 200

#: weights by the rank of a source, repeating; most repeats of a source
WEIGHTS, REPEATS = (5, 2, 1), 3

#: documents of one step of the running word counts
STEP = 20_000


def targets(sizes: list[int], weights: list[float], repeats: float = REPEATS) -> list[float]:
    """Shares ``sum(sizes)`` by weight; no share exceeds ``repeats`` times its
    size, the excess is shared again among the others."""
    total = float(sum(sizes))
    out = [0.0] * len(sizes)
    open_ = {i for i, s in enumerate(sizes) if s > 0}
    left = total
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > repeats * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(repeats * sizes[i])
        left -= sum(out[i] for i in over)
        open_ -= set(over)
    return out


def _sources(documents: DataFrame) -> list[tuple]:
    """(source, size) by code point, NULL last: one row per source."""
    rows = documents.groupBy("source").agg(F.sum("size").alias("size")).collect()
    return sorted(((r.source, r["size"]) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: four Feistel rounds over the next
    even number of bits, walked until the value is below ``n``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    value = index.astype(np.uint64)
    todo = np.ones(len(value), bool)
    while todo.any():
        left, right = value[todo] >> np.uint64(half), value[todo] & mask
        for turn in range(4):
            h = right * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 4 + turn) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xA0761D6478BD642F)
            h ^= h >> np.uint64(29)
            left, right = right, left ^ (h & mask)
        value[todo] = left << np.uint64(half) | right
        todo &= value >= n
    return value.astype(np.int64)


def _draws(slots: list[int], shards: int, shard: int, seed: int) -> np.ndarray:
    """Slots of every source in shards 0 to ``shard`` - 1, of ``slots`` in all.

    The slots of a run of shards are drawn for its first half from what the run
    has (a multinomial given its total), down to ``shard``, so the draws of all
    shards add up to ``slots`` and any shard is found in a few steps.
    """
    before, have = np.zeros(len(slots), np.int64), np.array(slots, np.int64)
    low, high, total = 0, shards, int(sum(slots))
    while high - low > 1 and shard > low:
        middle = (low + high) // 2
        size = min(total, middle * SHARD) - min(total, low * SHARD)
        rng = np.random.Generator(np.random.PCG64([seed, low, high]))
        part = _split(rng, have, size)
        if shard >= middle:
            before, have, low = before + part, have - part, middle
        else:
            have, high = part, middle
    return before if shard <= low else before + have


def _split(rng: np.random.Generator, have: np.ndarray, size: int) -> np.ndarray:
    """``size`` of the slots in ``have``, drawn source by source."""
    out, left = np.zeros(len(have), np.int64), int(have.sum())
    for i, n in enumerate(have.tolist()):
        left -= n
        # the generator's own limit is 1e9; larger counts use the normal limit
        if n + left < 10**9:
            k = int(rng.hypergeometric(n, left, size)) if n and size else 0
        else:
            p = n / (n + left)
            spread = (size * p * (1 - p) * left / max(1, n + left - 1)) ** 0.5
            k = int(np.clip(round(rng.normal(size * p, spread)), max(0, size - left), min(n, size)))
        out[i], size = k, size - k
    return out


def _block(size: int, block: int) -> int:
    """Words of a block of a source with ``size`` words."""
    return max(1, min(block, size // FINE))


def _plan(sources: list[tuple], weights, repeats: float, block: int) -> list[dict]:
    """Per source: target, words of a block, blocks and slots."""
    sizes = [s for _, s in sources]
    share = targets(sizes, [weights[i % len(weights)] for i in range(len(sources))], repeats)
    plan = []
    for (name, size), target in zip(sources, share, strict=True):
        length = _block(size, block)
        blocks = -(-size // length)
        # a last block that is not full makes a slot shorter on average
        slots = min(round(target * blocks / size), int(repeats * blocks)) if size else 0
        plan.append({"source": name, "size": size, "target": target, "block": length, "blocks": blocks, "slots": slots})
    return plan


def slots(spark: SparkSession, sources: list[tuple], weights=WEIGHTS, repeats: float = REPEATS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mix: ``shard``, ``slot``, ``source_no`` and ``block_no``."""
    plan = _plan(sources, weights, repeats, block)
    counts = [p["slots"] for p in plan]
    total = sum(counts)
    shards = -(-total // SHARD)

    def run(batches):
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                first, after = (_draws(counts, shards, s, seed) for s in (shard, shard + 1))
                source = np.repeat(np.arange(len(plan)), after - first)
                number = np.concatenate([np.arange(a, b) for a, b in zip(first, after, strict=True)])
                blocks = np.zeros(len(number), np.int64)
                for i in np.unique(source):
                    mine = np.flatnonzero(source == i)
                    turn, index = number[mine] // plan[i]["blocks"], number[mine] % plan[i]["blocks"]
                    for t in np.unique(turn):
                        blocks[mine[turn == t]] = permuted(index[turn == t], plan[i]["blocks"], seed + (int(i) << 20) + int(t))
                # the order within the shard is pseudorandom too
                place = permuted(np.arange(len(number)), max(1, len(number)), seed ^ shard << 8)
                arrays = [pa.array(np.full(len(number), shard)), pa.array(place), pa.array(source.astype(np.int32)), pa.array(blocks)]
                yield pa.RecordBatch.from_arrays(arrays, ["shard", "slot", "source_no", "block_no"])

    ids = spark.range(0, shards, 1, max(1, min(shards, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return ids.mapInArrow(run, "shard long, slot long, source_no int, block_no long")


def _sizes(documents: DataFrame) -> DataFrame:
    """``key``, ``tid``, ``hid`` (64 bits more of the text), ``doc_id``, ``source`` and ``size`` (words, 0 for
    NULL) of every row, written once: all plans below read these few bytes."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    rows = keyed(documents.select("doc_id", "text", "source"), "doc_id", "source", size, text_hash(1).alias("hid"))
    return cut_lineage(rows.drop("text"))


def _numbered(rows: DataFrame, sources: list[tuple], block: int) -> DataFrame:
    """Adds ``source_no`` and ``block`` (words) by a join with the table of sources."""
    table = rows.sparkSession.createDataFrame([(i, n, _block(s, block)) for i, (n, s) in enumerate(sources)], "source_no int, _name string, block long")
    return rows.join(table, rows["source"].eqNullSafe(table["_name"])).drop("_name", "source")


def places(rows: DataFrame) -> DataFrame:
    """Adds ``low``, the number of words in the source's stream before the row.

    The stream goes by a hash of id and text and then by id, so that the running
    counts are made in groups of about :data:`STEP` rows, also where many rows
    share an id or have none, and shifted by the sums of the groups before.
    """
    steps = F.lit(max(1, rows.count() // STEP))
    stepped = rows.withColumn("step", F.pmod(F.xxhash64("key", "tid", "hid"), steps))
    sums = stepped.groupBy("source_no", "step").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source_no").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("source_no", "step", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inner = Window.partitionBy("source_no", "step").orderBy("key", "size", "tid", "hid").rowsBetween(Window.unboundedPreceding, -1)
    counted = stepped.withColumn("low", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return counted.join(shift, ["source_no", "step"]).withColumn("low", F.col("low") + F.col("shift")).drop("shift", "step")


def taken(documents: DataFrame, weights=WEIGHTS, repeats: float = REPEATS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Per row of ``documents`` (``doc_id``, ``text``, ``source``) what the mix
    takes of it: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``.

    Sources in order of code point, NULL last, have the weights in turn, and
    share the number of all words; a target stops at ``repeats`` times the
    size.  Documents without words, and all documents if there are no words at
    all, have ``taken`` 0.  Repeated rows are documents of their own.  NULL ids
    come first in the stream.  No rows give none.  Other columns are not read.
    """
    spark = settle(documents.sparkSession)
    rows = _sizes(documents)
    sources = _sources(rows)
    plan = _plan(sources, weights, repeats, block)
    placed = places(_numbered(rows, sources, block))
    covers = placed.filter("size > 0").withColumn("block_no", F.explode(F.expr("sequence(low div block, (low + size - 1) div block)")))
    words = F.col("block")
    overlap = F.least(F.col("low") + F.col("size"), (F.col("block_no") + 1) * words) - F.greatest(F.col("low"), F.col("block_no") * words)
    times = slots(spark, sources, weights, repeats, block, seed).groupBy("source_no", "block_no").agg(F.count(F.lit(1)).alias("times"))
    parts = covers.join(times, ["source_no", "block_no"]).select("source_no", "key", "low", (overlap * F.col("times")).alias("n"))
    # a document is known by its place in the stream
    used = parts.groupBy("source_no", "low").agg(F.sum("n").alias("taken"))
    shown = spark.createDataFrame([(i, p["size"], p["target"]) for i, p in enumerate(plan)], "source_no int, source_size long, target double")
    words, none = placed.filter("size > 0"), placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    done = words.join(used, ["source_no", "low"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    every = done.select("doc_id", "size", "source_no", "taken").unionByName(none.select("doc_id", "size", "source_no", "taken"))
    return every.join(shown, "source_no").select("doc_id", "size", "source_size", "target", "taken")


def mix(documents: DataFrame, weights=WEIGHTS, repeats: float = REPEATS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mixed text: ``shard``, ``slot``, ``source``, ``block_no``, ``part``
    (place in the block), ``doc_id`` and ``text`` (the document's words in the
    block, joined by one space).

    Documents without words have no part in it; for the other cases see
    :func:`taken`, whose counts are those of this result.
    """
    spark = settle(documents.sparkSession)
    rows = _sizes(documents)
    sources = _sources(rows)
    # only sizes travel until the places are known; a text given twice is read
    # once and packed at both its places
    placed = places(_numbered(rows, sources, block)).filter("size > 0")
    lows = placed.groupBy("key", "tid", "hid").agg(F.collect_list(F.struct("doc_id", "source_no", "low", "block")).alias("lows"))
    texts = keyed(documents.select("doc_id", "text"), text_hash(1).alias("hid")).dropDuplicates(["key", "tid", "hid"])
    schema = "doc_id long, source_no int, block_no long, part long, text string"

    def pack(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            texts = batch.column("text").cast(pa.binary())
            every = [(i, *p.values()) for i, ps in enumerate(batch.column("lows").to_pylist()) for p in ps]
            size = 0
            for i, doc, number, low, block in every:
                words = texts[i].as_py().split()
                at = 0
                while at < len(words):
                    end = min(len(words), at + block - (low + at) % block)
                    text = b" ".join(words[at:end]).decode()
                    for column, value in zip(out, (doc, number, (low + at) // block, (low + at) % block, text), strict=True):
                        column.append(value)
                    size += len(text)
                    at = end
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)
                    out, size = [[], [], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    kinds, names = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()], [c.split()[0] for c in schema.split(", ")]
    parts = texts.join(lows, ["key", "tid", "hid"]).select("text", "lows").mapInArrow(pack, schema)
    chosen = slots(spark, sources, weights, repeats, block, seed)
    shown = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(sources)], "source_no int, source string")
    joined = chosen.join(parts, ["source_no", "block_no"]).join(shown, "source_no")
    return joined.select("shard", "slot", "source", "block_no", "part", "doc_id", "text")
