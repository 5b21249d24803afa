"""Large feature documents, read by many tasks.

A document is cut into byte ranges.  What a range does to a reader's state, being
in a string or not and the nesting depth, follows from its bytes alone, for each
state it may begin in:

1. every range gives its effect for both starts: whether it ends in a string, by
   how much the depth changes, and how low it gets;
2. the effects are composed along the document, which gives the state at the
   start of every range;
3. the few ranges that reach the members of the root are read again for the place
   of the features array;
4. every range gives the elements that begin in it, and reads on to the end of the
   last one.

The rest of the document (the root without its features) is read like a small
document of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .files import open_file, size

#: bytes of a range, and of a read
RANGE, BLOCK = 32 * 1024 * 1024, 1 << 20

#: tasks of one pass at most; ranges beyond that share a task
MOST_TASKS = 20_000

_NAME = re.compile(rb'"features"\s*:\s*$')
_BEFORE = re.compile(rb'[\s{,\xbf]$')

_KIND = np.zeros(256, np.int8)
_KIND[list(b"{[")] = 1
_KIND[list(b"}]")] = -1
_IS_MARK = _KIND != 0
_IS_MARK[ord(",")] = True


def _backslashes(f, at: int) -> bool:
    """Whether the byte at ``at`` follows an odd run of backslashes."""
    run = 0
    while at > 0:
        low = max(0, at - 4096)
        f.seek(low)
        data = f.read(at - low)
        tail = len(data) - len(data.rstrip(b"\\"))
        run += tail
        if tail < len(data):
            break
        at = low
    return run % 2 == 1


class Blocks:
    """The marks (brackets and commas) of a file from ``start`` to ``end``, a
    block at a time: positions, bytes, and whether a string is open there,
    counted from ``quoted`` at the start."""

    def __init__(self, f, start: int, end: int, quoted: int = 0):
        self.f, self.at, self.end, self.quoted = f, start, end, quoted
        self.escaped = _backslashes(f, start)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        while self.at < self.end:
            self.f.seek(self.at)
            raw = self.f.read(min(BLOCK, self.end - self.at))
            if not raw:
                return
            data = np.frombuffer(raw, np.uint8)
            quotes = np.flatnonzero(data == 0x22)
            slash = data == 0x5C
            if slash.any() or self.escaped:
                places = np.arange(len(data))
                last = np.maximum.accumulate(np.where(slash, -1, places))
                # backslashes right before a byte; a run from before counts on
                before = np.append(-1, last[:-1])
                run = places - 1 - before + np.where(before < 0, int(self.escaped), 0)
                quotes = quotes[run[quotes] % 2 == 0]
                self.escaped = bool((len(data) - 1 - last[-1] + (int(self.escaped) if last[-1] < 0 else 0)) % 2)
            marks = np.flatnonzero(_IS_MARK[data])
            inside = (np.searchsorted(quotes, marks) + self.quoted) % 2
            yield marks + self.at, data[marks], inside
            self.quoted = (self.quoted + len(quotes)) % 2
            self.at += len(data)


def effect(path: str, start: int, end: int) -> tuple[int, int, int, int, int]:
    """(parity of quotes, depth change and lowest depth if the range begins
    outside a string, the same if inside)."""
    depth, low = [0, 0], [0, 0]
    with open_file(path) as f:
        blocks = Blocks(f, start, end)
        for _, marks, inside in blocks:
            steps = _KIND[marks].astype(np.int64)
            for state in (0, 1):
                run = np.cumsum(steps[inside == state])
                if len(run):
                    low[state] = min(low[state], depth[state] + int(run.min()))
                    depth[state] += int(run[-1])
        return blocks.quoted, depth[0], low[0], depth[1], low[1]


def _is_features(f, at: int) -> bool:
    """Whether the bracket at ``at`` is the value of a member "features"."""
    width = 64
    while True:
        low = max(0, at - width)
        f.seek(low)
        text = f.read(at - low)
        found = _NAME.search(text)
        if found:
            return _BEFORE.search(text[: found.start()]) is not None or (found.start() == 0 and low == 0)
        # white space may hide the name
        if low == 0 or len(text.rstrip().rstrip(b":").rstrip()) > len(b'"features"'):
            return False
        width *= 4


def array_places(path: str, start: int, end: int, quoted: int, depth: int) -> tuple[list[int], list[int]]:
    """Where features arrays open in a range, and where members of the root that
    are arrays or objects close, as far as they decide the end of one: the
    first, and the first after each opening."""
    opens, closes = [], []
    with open_file(path) as f:
        for at, marks, inside in Blocks(f, start, end, quoted):
            keep = (inside == 0) & (marks != 0x2C)
            at, marks = at[keep], marks[keep]
            steps = _KIND[marks].astype(np.int64)
            now = depth + np.cumsum(steps)
            opened = at[(steps > 0) & (now == 2) & (marks == 0x5B)]
            closed = at[(steps < 0) & (now == 1)]
            for place in opened.tolist():
                if _is_features(f, place):
                    opens.append(place)
            for place in [*opens, -1]:
                after = closed[closed > place]
                if len(after) and not any(c > place for c in closes):
                    closes.append(int(after[0]))
            depth = int(now[-1]) if len(now) else depth
    return opens, sorted(closes)


def elements(path: str, start: int, end: int, quoted: int, depth: int, first: int, last: int) -> Iterator[str]:
    """The elements between the brackets at ``first`` and ``last`` whose leading
    bracket or comma lies in the range."""
    with open_file(path) as f:
        open_ = None
        for at, marks, inside in Blocks(f, start, last + 1, quoted):
            steps = _KIND[marks].astype(np.int64) * (inside == 0)
            now = depth + np.cumsum(steps)
            border = (inside == 0) & (at >= first) & ((marks == 0x2C) & (now == 2) | (at == first) | (at == last))
            for place in at[border].tolist():
                if open_ is not None:
                    f.seek(open_ + 1)
                    piece = f.read(place - open_ - 1).decode("utf-8")
                    if piece.strip():
                        yield piece
                    elif place != last:
                        raise ValueError("Feature array element must be an object")
                if place >= end:
                    return
                open_ = place
            depth = int(now[-1]) if len(now) else depth


def rest_of(path: str, first: int, last: int) -> Iterator[bytes]:
    """The document without the elements of its features array."""
    with open_file(path) as f:
        for low, high in ((0, first + 1), (last, size(path))):
            for at in range(low, high, BLOCK):
                f.seek(at)
                yield f.read(min(BLOCK, high - at))


def _mapped(rows: DataFrame, schema: str, function) -> DataFrame:
    """``function`` of every row, as rows of ``schema`` (with the row's own path
    and start)."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string()}
    kinds = [types.get(c.split()[1]) or pa.list_(pa.int64()) for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = function(row)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(found, kinds, strict=True)], names)

    return rows.mapInArrow(run, schema)


def document_ranges(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(``path``, ``start``, ``end``, ``quoted``, ``depth``, ``first``, ``last``):
    the ranges of every document with the state each begins in, and the brackets
    of the features array.

    A document without exactly one features array has NULL for both.
    """
    sizes = spark.createDataFrame([(p, size(p)) for p in paths], "path string, size long")
    ranges = sizes.select("path", "size", F.explode(F.expr(f"sequence(0L, greatest(size - 1, 0L), {RANGE}L)")).alias("start"))
    total = sum(-(-max(size(p), 1) // RANGE) for p in paths)
    ranges = ranges.select("path", "start", F.least(F.col("start") + RANGE, "size").alias("end")).repartitionByRange(min(total, MOST_TASKS), "path", "start")

    schema = "path string, start long, end long, quotes long, d0 long, low0 long, d1 long, low1 long"
    effects = cut_lineage(_mapped(ranges, schema, lambda r: (r["path"], r["start"], r["end"], *effect(r["path"], r["start"], r["end"]))))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = effects.withColumn("quoted", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    for name in ("d", "low"):
        states = states.withColumn(name, F.when(F.col("quoted") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1")))
    states = cut_lineage(states.withColumn("depth", F.coalesce(F.sum("d").over(before), F.lit(0))).select("path", "start", "end", "quoted", "depth", "low"))

    shallow = states.filter("depth + low <= 1 OR depth <= 1").repartitionByRange(min(total, MOST_TASKS), "path", "start")
    found = _mapped(shallow, "path string, opens array<long>, closes array<long>", lambda r: (r["path"], *array_places(r["path"], r["start"], r["end"], r["quoted"], r["depth"])))
    places = found.groupBy("path").agg(F.flatten(F.collect_list("opens")).alias("opens"), F.flatten(F.collect_list("closes")).alias("closes"))
    first = F.when(F.size("opens") == 1, F.col("opens")[0])
    places = places.select("path", first.alias("first"), F.array_min(F.filter("closes", lambda c: c > first)).alias("last"))
    return states.drop("low").join(F.broadcast(places) if len(paths) <= 10_000 else places, "path", "left")
