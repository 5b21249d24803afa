"""Repeated windows: which runs of W units occur more than once.

Units are bytes or words.  Every window is assigned to an anchor, the smallest
hashed gram inside it, so equal windows have equal anchors at the same place.
Consecutive windows with one anchor form a piece.  The steps are

1. ``anchors``: pieces as (hash, key, place), without their content.  Only
   those whose hash occurs again can hold a repeated window;
2. ``pieces``: the content of the pieces that are left, copies collapsed within
   a task.  Pieces of a hot anchor are cut into single windows, each a key of
   its own, so that no key gathers more than :data:`HOT` different pieces;
3. ``compare``: pieces are dealt out by anchor (by range with sampled splitters,
   or by hash) and sorted in their bucket by the units after and before the
   anchor; windows with enough units in common on both sides are equal.

All steps stream in bounded blocks, whatever the number of copies.  A splitter
never separates equal keys, so nothing is left to compare between buckets; a
single-window key that fills more than one block hands its first row on.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import CHUNK, gram_hashes, slices, span_hashes, text_bytes, word_spans

#: bits of a packed place: start, number of windows, units before the anchor
N_BITS, A_BITS = 7, 7

#: places of an anchor beyond which its windows are keyed one by one
HOT = 20_000

#: pieces that are sorted together, and bytes of pieces kept to collapse copies
BLOCK_ROWS, KEPT_BYTES = 20_000, 24 << 20


@dataclass(frozen=True)
class Windows:
    """What a window is made of.

    ``words``: units are words, otherwise bytes.  ``width``: units of a window.
    ``gram``: units of an anchor.  ``later_only``: a window counts as repeated
    only if an equal one comes earlier, by key and then by start.
    """

    words: bool
    width: int
    gram: int
    later_only: bool


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _find(units: np.ndarray, offsets: np.ndarray, spec: Windows) -> Iterator[tuple]:
    """(text, start, windows, units before the anchor, hash) of all pieces."""
    places = spec.width - spec.gram + 1
    for a, b in slices(offsets):
        base = int(offsets[a])
        for low in range(base, max(base + 1, int(offsets[b])), CHUNK):
            # long texts are cut into blocks that overlap by a window
            high = min(int(offsets[b]), low + CHUNK + spec.width - 1)
            part = units[low:high]
            n = len(part) - spec.width + 1
            if n <= 0:
                continue
            h = gram_hashes(part, spec.gram)
            ranked = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
            at = (sliding_min(ranked, places)[:n] & np.uint64(0xFFFFFF)).astype(np.int64)
            # windows that cross the end of a text are none
            bounds = offsets[a : b + 1] - low
            inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(part))]
            crossing = np.zeros(n + 1, np.int32)
            np.add.at(crossing, np.clip(inner - spec.width + 1, 0, n), 1)
            np.add.at(crossing, np.clip(inner, 0, n), -1)
            whole = np.cumsum(crossing[:-1]) == 0
            new = whole.copy()
            new[1:] &= (at[1:] != at[:-1]) | ~whole[:-1]
            # a text's first window always begins a piece
            new[inner[inner < n]] = whole[inner[inner < n]]
            starts = np.flatnonzero(new)
            last = whole.copy()
            last[:-1] &= new[1:] | ~whole[1:]
            ends = np.flatnonzero(last) + 1
            where = np.searchsorted(bounds, starts, "right") - 1
            yield a + where, starts + low - offsets[a + where], ends - starts, at[starts] - starts, h[at[starts]]


def _units(column: pa.Array, spec: Windows):
    """Unit values and offsets of all texts, with the bytes they stand for."""
    data, offsets = text_bytes(column)
    if not spec.words:
        return data, offsets, (data, offsets)
    starts, ends, first = word_spans(data, offsets)
    values = np.empty(len(starts), np.uint64)
    for a, b in slices(offsets, 4 * CHUNK):
        part = slice(int(first[a]), int(first[b]))
        low, high = int(offsets[a]), int(offsets[b])
        values[part] = span_hashes(data[low:high], starts[part] - low, ends[part] - low)
    return values, first, (data, starts, ends, first)


def anchors(texts: DataFrame, spec: Windows, shared: bool = True) -> DataFrame:
    """One row per piece: ``h``, ``key``, the packed ``place`` and, if keys are
    shared, ``tid`` (else it is 0)."""
    columns = {"h": "long", "key": "long", "place": "long"} | ({"tid": "long"} if shared else {})

    def run(batches):
        for batch in batches:
            units, offsets, _ = _units(batch.column("text"), spec)
            key, tid = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "tid"))
            for text, start, n, before, h in _find(units, offsets, spec):
                place = _pack(start, n, before)
                arrays = [pa.array(h.view(np.int64)), pa.array(key[text]), pa.array(place), pa.array(tid[text].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays[: len(columns)], list(columns))

    return texts.mapInArrow(run, ", ".join(map(" ".join, columns.items())))


def _again(hot: int) -> Callable:
    """Of anchors sorted by hash, the places of those that occur again; only
    the last anchor of a batch is kept for the next one."""

    def run(batches):
        held = np.zeros((4, 0), np.int64)
        going = None  # the hash of a hot anchor whose rows are passed on as they come

        def emit(rows: np.ndarray, is_hot) -> pa.RecordBatch:
            place = rows[2]
            arrays = [pa.array(rows[1]), pa.array(rows[3]), pa.array(np.where(is_hot, -place, place))]
            return pa.RecordBatch.from_arrays(arrays, ["key", "tid", "place"])

        def settled(rows: np.ndarray) -> pa.RecordBatch:
            new = np.ones(rows.shape[1], bool)
            new[1:] = rows[0, 1:] != rows[0, :-1]
            count = np.diff(np.append(np.flatnonzero(new), len(new)))[np.cumsum(new) - 1]
            keep = count > 1
            return emit(rows[:, keep], count[keep] > hot)

        for batch in batches:
            tid = batch.column("tid").to_numpy() if "tid" in batch.schema.names else np.zeros(batch.num_rows, np.int64)
            rows = np.stack([*(batch.column(c).to_numpy() for c in ("h", "key", "place")), tid])
            rows = np.concatenate([held, rows], axis=1)
            if going is not None:
                n = int(np.argmax(np.append(rows[0] != going, True)))
                yield emit(rows[:, :n], True)
                rows = rows[:, n:]
                going = None if rows.shape[1] else going
            held = rows
            if rows.shape[1]:
                # the last anchor may go on
                end = rows.shape[1] - int(np.argmax(np.append(rows[0, ::-1] != rows[0, -1], True)))
                yield settled(rows[:, :end])
                held = rows[:, end:]
                if held.shape[1] > hot:
                    going = held[0, 0]
                    yield emit(held, True)
                    held = held[:, :0]
        yield settled(held)

    return run


def repeated(found: DataFrame, hot: int = HOT) -> DataFrame:
    """Per text the places of pieces whose anchor occurs again, negative where
    the anchor is hot."""
    dealt = found.repartition("h").sortWithinPartitions("h")
    places = dealt.mapInArrow(_again(hot), "key long, tid long, place long")
    return places.groupBy("key", "tid").agg(F.collect_list("place").alias("places"))


#: ``place`` as the anchors have it; without content, ``copies`` is the number
#: of windows
PIECE = "g binary, x binary, key long, place long, copies long, tid long"


class _Kept:
    """Pieces of a task, so that copies collapse before they are sent."""

    def __init__(self, spec: Windows):
        self.spec = spec
        self.clear()

    def clear(self) -> None:
        self.known: dict[tuple[bytes, int], int] = {}
        self.content: list[tuple[bytes, bytes]] = []
        self.numbers: list[int] = []
        self.columns: list[np.ndarray] = []
        self.size = 0

    def add(self, contents: list[tuple[bytes, bytes]], columns: np.ndarray) -> None:
        """(anchor, piece) pairs and their key, tid, start, n and before."""
        known, content = self.known, self.content
        for pair, before in zip(contents, columns[4].tolist(), strict=True):
            number = known.setdefault((pair[1], before), len(content))
            if number == len(content):
                content.append(pair)
                self.size += len(pair[1]) + 200
            self.numbers.append(number)
        self.columns.append(columns)

    def full(self) -> bool:
        return self.size > KEPT_BYTES or len(self.numbers) > 300_000

    def flush(self) -> pa.RecordBatch:
        columns = np.concatenate(self.columns, axis=1) if self.columns else np.zeros((5, 0), np.int64)
        number = np.array(self.numbers, np.int64)
        order = np.lexsort((columns[2], columns[0], number))
        columns, number = columns[:, order], number[order]
        key, tid, start, n, before = columns
        first = np.ones(len(number), bool)
        first[1:] = number[1:] != number[:-1]
        heads = np.flatnonzero(first)
        copies = np.diff(np.append(heads, len(number)))
        rest = ~first
        if self.spec.later_only and len(heads):
            # the same place given twice (repeated rows) is no later one
            head = heads[np.cumsum(first) - 1]
            rest &= (key != key[head]) | (start != start[head])
        # settled windows travel on without content, runs of them as one row
        done = np.flatnonzero(rest)
        done = done[np.lexsort((start[done], tid[done], key[done]))]
        low, high = start[done], start[done] + n[done]
        new = np.ones(len(done), bool)
        new[1:] = (key[done[1:]] != key[done[:-1]]) | (tid[done[1:]] != tid[done[:-1]]) | (low[1:] > high[:-1])
        runs = np.flatnonzero(new)
        length = (np.maximum.reduceat(high, runs) if len(runs) else high) - low[runs]
        done = done[runs]
        rows = np.concatenate([heads, done])
        content = [self.content[i] for i in number[heads].tolist()]
        g = [c[0] for c in content] + [_digest(b"%d %d" % p) for p in zip(key[done].tolist(), start[done].tolist(), strict=True)]
        x = [c[1] for c in content] + [None] * len(done)
        place = _pack(start[rows], np.concatenate([n[heads], np.ones_like(done)]), np.concatenate([before[heads], np.zeros_like(done)]))
        copies = np.concatenate([copies, length])
        arrays = [pa.array(g, pa.binary()), pa.array(x, pa.binary()), pa.array(key[rows]), pa.array(place), pa.array(copies), pa.array(tid[rows])]
        self.clear()
        return pa.RecordBatch.from_arrays(arrays, _names(PIECE))


#: first byte of keys that are digests; no UTF-8 text holds it
DIGEST = b"\xff"


def _digest(x: bytes) -> bytes:
    return DIGEST + hashlib.blake2b(x, digest_size=16).digest()


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _pack(start: np.ndarray, n: np.ndarray, before: np.ndarray) -> np.ndarray:
    """One number for a place; the order of places is the order of starts."""
    return (start << N_BITS | n) << A_BITS | before


def _unpack(places: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, number of windows, units before the anchor, hot."""
    hot = places < 0
    place = np.abs(places)
    before, place = place & (1 << A_BITS) - 1, place >> A_BITS
    return place >> N_BITS, place & (1 << N_BITS) - 1, before, hot


def pieces(texts: DataFrame, places: DataFrame, spec: Windows, splitters: list[bytes] | None = None) -> DataFrame:
    """The content of the pieces; a piece without content is settled: all its
    windows are repeated.  With splitters each also has its bucket."""

    def run(batches):
        kept = _Kept(spec)
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "tid")])
            texts = batch.column("text").cast(pa.binary())
            for i, packed in enumerate(batch.column("places")):
                text = texts[i].as_py()
                units = text.split() if spec.words else text
                start, n, before, hot = _unpack(packed.values.to_numpy())
                if hot.any():
                    # every window by itself
                    one = np.repeat(start[hot], n[hot]) + np.concatenate([np.arange(k) for k in n[hot]])
                    contents = [_window(units, s, spec) for s in one.tolist()]
                    kept.add(contents, _columns(ids[:, i], one, np.ones_like(one), np.zeros_like(one)))
                    start, n, before = start[~hot], n[~hot], before[~hot]
                at, end = start + before, start + n + spec.width - 1
                places = zip(at.tolist(), start.tolist(), end.tolist(), strict=True)
                if spec.words:
                    contents = [(_digest(b" ".join(units[p : p + spec.gram])), b" ".join(units[s:e])) for p, s, e in places]
                else:
                    contents = [(units[p : p + spec.gram], units[s:e]) for p, s, e in places]
                kept.add(contents, _columns(ids[:, i], start, n, before))
                if kept.full():
                    yield kept.flush()
        yield kept.flush()

    def run_dealt(batches):
        for batch in run(batches):
            # digests have no order to keep: they are spread over all buckets
            bucket = [int.from_bytes(g[1:5]) % (len(splitters) + 1) if g[:1] == DIGEST else bisect.bisect_right(splitters, g) for g in batch.column("g").to_pylist()]
            yield batch.append_column("bucket", pa.array(bucket, pa.int32()))

    held = texts.join(places, ["key", "tid"])
    return held.mapInArrow(run, PIECE) if splitters is None else held.mapInArrow(run_dealt, f"{PIECE}, bucket int")


def _columns(ids: np.ndarray, start: np.ndarray, n: np.ndarray, before: np.ndarray) -> np.ndarray:
    return np.stack([np.full(len(start), ids[0]), np.full(len(start), ids[1]), start, n, before])


def _window(units, start: int, spec: Windows) -> tuple[bytes, bytes]:
    part = units[start : start + spec.width]
    part = b" ".join(part) if spec.words else part
    return _digest(part), part


# ------------------------------------------------- comparing within a block


def _ranks(units: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``units`` within their group, by multikey sorting
    of eight bytes at a time, and the units each row has in common with the
    row before it in that order (-1 at the first of a group)."""
    rows, width = units.shape
    per = 8 // units.dtype.itemsize
    padded = np.zeros((rows, -(-max(width, 1) // per) * per), units.dtype.newbyteorder(">"))
    padded[:, :width] = units
    keys = padded.view(">u8").astype(np.uint64)
    # where one row continues another with zeros, the shorter one comes first
    order = np.lexsort((lengths, group))
    part = group[order]
    # rows whose order is not decided yet, as positions in ``order``
    open_ = np.arange(rows)
    for column in range(keys.shape[1]):
        same = np.zeros(len(open_), bool)
        same[1:] = part[open_[1:]] == part[open_[:-1]]
        open_ = open_[same | np.append(same[1:], False)]
        if not len(open_):
            break
        key = keys[order[open_], column]
        sub = np.lexsort((key, part[open_]))
        order[open_] = order[open_][sub]
        key, old = key[sub], part[open_]
        new = np.ones(len(open_), bool)
        new[1:] = (old[1:] != old[:-1]) | (key[1:] != key[:-1])
        # the first position of a part names it
        part[open_] = open_[np.flatnonzero(new)][np.cumsum(new) - 1] + rows * 2
    common = np.full(rows, -1, np.int64)
    pair = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1
    if len(pair):
        a, b = order[pair], order[pair - 1]
        differ = units[a] != units[b]
        n = np.where(differ.any(axis=1), differ.argmax(axis=1), width) if width else np.zeros(len(pair), np.int64)
        common[pair] = np.minimum(n, np.minimum(lengths[a], lengths[b]))
    return order, common


def _matrix(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int) -> np.ndarray:
    width = int(lengths.max()) if len(lengths) else 0
    index = starts[:, None] + step * np.arange(width)
    inside = np.arange(width) < lengths[:, None]
    out = np.zeros(index.shape, values.dtype)
    out[inside] = values[index[inside]]
    return out


class _Block:
    """Some pieces of whole anchors (or of one cut anchor) with their content."""

    def __init__(self, batch: pa.Table, spec: Windows):
        self.spec = spec
        x = batch.column("x").combine_chunks()
        self.key, place, self.copies, self.tid = (batch.column(c).to_numpy() for c in ("key", "place", "copies", "tid"))
        self.start, self.n, self.before, _ = _unpack(place)
        g = batch.column("g").combine_chunks().dictionary_encode()
        self.group = g.indices.to_numpy().astype(np.int64)
        self.x = x.to_pylist()
        if spec.words:
            words = [w for s in self.x for w in s.split(b" ")]
            ids = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy()
            values, lengths = ids.astype(np.uint32), np.array([s.count(b" ") + 1 for s in self.x])
        else:
            values, lengths = np.frombuffer(b"".join(self.x), np.uint8), np.array([len(s) for s in self.x])
        begin = np.cumsum(lengths) - lengths
        at = begin + self.before
        self.right, self.right_n = _matrix(values, at, lengths - self.before, 1), lengths - self.before
        self.left, self.left_n = _matrix(values, at - 1, self.before, -1), self.before
        self.rows = len(self.x)

    def flags(self) -> np.ndarray:
        """Per row and window whether it is repeated."""
        spec, rows = self.spec, self.rows
        order_r, common_r = _ranks(self.right, self.right_n, self.group)
        order_l, common_l = _ranks(self.left, self.left_n, self.group)
        hit = np.zeros((rows, int(self.n.max())), bool)
        # by key and start, so that the first of equal windows comes first
        rank = np.empty(rows, np.int64)
        rank[np.lexsort((self.start, self.key))] = np.arange(rows)
        side_r, side_l = np.empty(rows, np.int64), np.empty(rows, np.int64)

        def alike(have: np.ndarray, right: np.ndarray, left: np.ndarray):
            """Rows sorted by what they have in common and by rank; where
            each group of alike rows begins; the group of each row."""
            side_r[order_r], side_l[order_l] = np.cumsum(right), np.cumsum(left)
            same = (side_r[have] * (rows + 1) + side_l[have]) * rows + rank[have]
            sort = np.argsort(same)
            have, same = have[sort], same[sort] // rows
            first = np.ones(len(have), bool)
            first[1:] = same[1:] != same[:-1]
            return have, np.flatnonzero(first), np.cumsum(first) - 1

        # equal pieces first: one of them stands for all
        have, heads, part = alike(np.arange(rows), common_r < self.right_n[order_r], common_l < self.left_n[order_l])
        stands = have[heads]
        copies = np.zeros(rows, np.int64)
        copies[stands] = np.add.reduceat(self.copies[have], heads)
        numbers = np.arange(hit.shape[1])
        if spec.later_only:
            # the same piece given twice (repeated rows) is no earlier one
            later = (self.key[have] != self.key[stands][part]) | (self.start[have] != self.start[stands][part])
            hit[have[later]] = numbers < self.n[have[later], None]
        # anchors with one piece hold no other equal windows
        work = np.zeros(rows, bool)
        work[stands] = np.bincount(self.group[stands])[self.group[stands]] > 1
        for before in range(int(self.before[work].max()) + 1 if work.any() else 0):
            number = self.before - before
            have = np.flatnonzero(work & (number >= 0) & (number < self.n))
            if not len(have):
                continue
            have, heads, part = alike(have, common_r < spec.width - before, common_l < before)
            if spec.later_only:
                head, at = have[heads][part], self.start + number
                repeat = (self.key[have] != self.key[head]) | (at[have] != at[head])
            else:
                repeat = np.add.reduceat(copies[have], heads)[part] > 1
            hit[have, number[have]] = repeat
        if not spec.later_only:
            hit[stands] |= (copies[stands] > 1)[:, None] & (numbers < self.n[stands, None])
            have, heads, part = alike(np.arange(rows), common_r < self.right_n[order_r], common_l < self.left_n[order_l])
            hit[have] = hit[stands][part]
        return hit

    def spans(self) -> pa.RecordBatch:
        hit = self.flags()
        wide = np.zeros((self.rows, hit.shape[1] + 2), np.int8)
        wide[:, 1:-1] = hit
        turn = np.diff(wide, axis=1)
        row, first = np.nonzero(turn == 1)
        _, last = np.nonzero(turn == -1)
        start = self.start[row]
        return _spans(self.key[row], self.tid[row], start + first, start + last + self.spec.width - 1)


SPAN = "key long, tid long, low long, high long"


def _spans(key, tid, low, high) -> pa.RecordBatch:
    arrays = [pa.array(key, pa.int64()), pa.array(tid, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, _names(SPAN))


def _blocks(batches, limit: int) -> Iterator[pa.Table]:
    """Sorted rows in blocks of whole keys.  Only a single-window key can have
    more rows than ``limit``; its first row then begins the next block too."""
    held: list[pa.Table] = []
    count = size = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        count, size = count + batch.num_rows, size + batch.nbytes
        if count < limit and size < 2 * KEPT_BYTES:
            continue
        table = pa.concat_tables(held)
        codes = table.column("g").combine_chunks().dictionary_encode().indices.to_numpy()
        cut = int(np.searchsorted(codes, codes[-1]))
        if cut:
            yield table.slice(0, cut)
            held = [table.slice(cut)]
        elif _single(table.column("place").to_numpy()):
            yield table
            held = [table.slice(0, 1)]
        else:
            held = [table]
        count, size = len(held[0]), held[0].nbytes
    if count:
        yield pa.concat_tables(held)


def _single(places: np.ndarray) -> bool:
    _, n, before, _ = _unpack(places)
    return bool((n == 1).all() and (before == 0).all())


def _compare(spec: Windows, limit: int) -> Callable:
    def run(batches):
        ready: list[pa.RecordBatch] = []

        def content():
            for batch in batches:
                settled = pa.compute.is_null(batch.column("x"))
                b = batch.filter(settled)
                if b.num_rows:
                    low, n = _unpack(b.column("place").to_numpy())[0], b.column("copies").to_numpy()
                    ready.append(_spans(b.column("key"), b.column("tid"), low, low + n + spec.width - 1))
                batch = batch.filter(pa.compute.invert(settled))
                if batch.num_rows:
                    yield batch

        for table in _blocks(content(), limit):
            yield from ready
            ready.clear()
            yield _Block(table, spec).spans()
        yield from ready

    return run


def compare(found: DataFrame, spec: Windows, limit: int = BLOCK_ROWS) -> DataFrame:
    """Spans of units (``key``, ``tid``, ``low``, ``high``) covered by repeated
    windows, not merged.  ``found`` has pieces, dealt out by ``bucket`` if it
    has one and else by the hash of their anchor."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = found.repartitionById(parts, "bucket").drop("bucket") if "bucket" in found.columns else found.repartition(parts, "g")
    return buckets.sortWithinPartitions("g", "key", "place").mapInArrow(_compare(spec, limit), SPAN)


#: documents whose anchors choose the splitters, and anchors of each
SPLIT_DOCUMENTS, SPLIT_ANCHORS = 2_000, 20


def splitters(texts: DataFrame, spec: Windows, parts: int) -> list[bytes]:
    """``parts`` - 1 anchors that cut a sample of all anchors into ranges of
    equal size.  The sample only balances the buckets."""
    every = max(1, texts.count() // SPLIT_DOCUMENTS)
    sample = texts.filter(F.pmod(F.xxhash64("key", "tid"), F.lit(every)) == 0)

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw, out = data.tobytes(), []
            for text, start, _, before, h in _find(data, offsets, spec):
                at = offsets[text] + start + before
                # a few of each text, whatever its length
                order = np.lexsort((h, text))
                first = np.flatnonzero(np.diff(text[order], prepend=-1))
                turn = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
                out += [raw[p : p + spec.gram] for p in at[order[turn < SPLIT_ANCHORS]].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["g"])

    size = SPLIT_ANCHORS * 4 * SPLIT_DOCUMENTS
    found = sample.mapInArrow(run, "g binary").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    few = found.orderBy(F.xxhash64("g")).limit(min(size, 1000 * parts)).select("g").collect()
    grams = sorted(bytes(r.g) for r in few)
    return sorted({grams[len(grams) * i // parts] for i in range(1, parts)} if grams else set())


def repeated_spans(texts: DataFrame, spec: Windows, limit: int = BLOCK_ROWS, hot: int = HOT, shared: bool = True) -> DataFrame:
    """All steps; ``texts`` and ``shared`` as :func:`mapweave.llm.common.apart` gives them.
    Bytes go to ranges of anchors, words to the hash of their anchor."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = None if spec.words else splitters(texts, spec, parts)
    return compare(pieces(texts, repeated(anchors(texts, spec, shared), hot), spec, cuts), spec, limit)


def merge(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, sorted; intervals that touch become one."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > high[:-1]
    return low[new], high[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)]
