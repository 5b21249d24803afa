"""Benchmark decontamination by q-gram lemma filtering.

Benchmark items are cut into overlapping segments.  A segment of L bytes that
occurs in a document with at most e edits shares at least L - q + 1 - q*e of its
q-grams with it, all on diagonals (place in the document less place in the
segment) that differ by e at most.  Shared q-grams are counted in overlapping
diagonal bands; a region that reaches the bound is verified by a banded
alignment.

A shorter part of an item is found if it is exact: pieces of :data:`EXACT` bytes
at every :data:`STEP`-th byte of an item are looked up by their hash and compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import CHUNK, SPACES, cut_lineage, give_back, gram_hashes, settle, slices, span_hashes, text_bytes, text_hash, widened

#: bytes of a segment and between segments, of a q-gram, of the shortest item
#: that may have edits, and edits per byte; a shorter item, of a q-gram at least,
#: is looked for whole and between word borders
SEGMENT, STRIDE, GRAM, SHORTEST, RATE = 80, 40, 10, 30, 0.075

#: bytes of an exact piece and between such pieces: every exact passage of
#: EXACT + STEP - 1 bytes holds one
EXACT, STEP = 48, 8

#: bytes of benchmark text that one pass over the documents looks for; its index
#: takes some 50 times as much in every worker
PASS_BYTES = 2 << 20

#: shared q-grams that are handled at a time
PAIRS = 1_000_000

#: bytes of documents that are handled at a time (a longer text alone)
SLICE = 1 << 20

#: texts with matches that may be sent to all executors; more are joined by a shuffle
BROADCAST_TEXTS = 200_000

MATCHES = "matches array<struct<item_id: long, start: long, end: long, edits: int>>"

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A-Z in lower case and every run of spaces as one space, none at the ends
    of a text; the new offsets, and where each byte was."""
    upper = (data >= 0x41) & (data <= 0x5A)
    low = data + upper * np.uint8(0x20)
    space = _SPACE[data]
    low[space] = 0x20
    keep = ~space
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    # a space is kept if a word comes directly before it in the same text
    after = np.zeros(len(data), bool)
    after[1:] = ~space[:-1]
    after[first] = False
    keep |= space & after
    # but not where no word follows
    index = np.flatnonzero(keep)
    new = np.searchsorted(index, offsets)
    ends = new[1:][new[1:] > new[:-1]] - 1
    trailing = ends[low[index[ends]] == 0x20]
    index = np.delete(index, trailing)
    # places take half the room while they fit
    small = index.astype(np.int32) if len(data) < 1 << 31 else index
    return low[index], np.searchsorted(index, offsets), small


@dataclass
class Index:
    """Segments of one pass and the places of their q-grams."""

    items: np.ndarray
    segments: list[np.ndarray]
    budgets: np.ndarray
    least: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    segment: np.ndarray
    place: np.ndarray
    bits: np.ndarray
    source: np.ndarray
    exact: np.ndarray
    exact_at: np.ndarray
    exact_item: np.ndarray


def index(items: list[tuple[int, str]], rate: float = RATE) -> Index:
    """Of (id, text) pairs; items under :data:`GRAM` bytes are left out."""
    ids, segments, whole, owners = [], [], [], []
    for item, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        data = normal(raw, np.array([0, len(raw)]))[0] if len(raw) else raw
        if len(data) < GRAM:
            continue
        whole.append(data)
        owners.append(item)
        last = max(0, len(data) - SEGMENT)
        for start in [*range(0, last, STRIDE), last]:
            ids.append(item)
            segments.append(data[start : start + SEGMENT])
    size = np.array([len(s) for s in segments], np.int64)
    # no more edits than leave a q-gram to count
    budgets = np.minimum((size * rate).astype(np.int64), (size - GRAM) // GRAM) * (size >= SHORTEST)
    hashes = [gram_hashes(s, GRAM) for s in segments]
    h = np.concatenate([np.zeros(0, np.uint64), *hashes])
    order = np.argsort(h, kind="stable")
    known, first = np.unique(h[order], return_index=True)
    owner = np.repeat(np.arange(len(segments)), [len(x) for x in hashes]) if segments else np.zeros(0, np.int64)
    place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) for x in hashes)])
    bits = np.zeros(1 << 22, bool)
    bits[(known >> np.uint64(42)).astype(np.int64)] = True
    return Index(np.array(ids, np.int64), segments, budgets, size - GRAM + 1 - GRAM * budgets, known, np.append(first, len(h)), owner[order].astype(np.int32), place[order].astype(np.int32), bits, *_exact_pieces(whole, owners))


def _exact_pieces(whole: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, ...]:
    """All items in one, and by hash the hash, place and item of their pieces;
    equal pieces of an item once."""
    source = np.concatenate([np.zeros(0, np.uint8), *whole])
    begin = np.cumsum([0, *map(len, whole)])
    starts = [np.unique(np.append(np.arange(0, len(w) - EXACT + 1, STEP), len(w) - EXACT)) + b for w, b in zip(whole, begin, strict=False) if len(w) >= EXACT]
    item = np.repeat(np.array([i for i, w in zip(owners, whole, strict=True) if len(w) >= EXACT], np.int64), [len(s) for s in starts])
    at = np.concatenate([np.zeros(0, np.int64), *starts])
    h = span_hashes(source, at, at + EXACT)
    order = np.lexsort((at, item, h))
    h, at, item = h[order], at[order], item[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (item[1:] != item[:-1])
    return source, h[new], at[new], item[new]


def _grams_at(data: np.ndarray, known: Index) -> tuple[np.ndarray, np.ndarray]:
    """Number of the known q-grams in ``data`` and where they begin."""
    h = gram_hashes(data, GRAM)
    maybe = np.flatnonzero(known.bits[(h >> np.uint64(42)).astype(np.int64)])
    if not len(maybe) or not len(known.hashes):
        return maybe[:0], maybe[:0]
    at = np.minimum(np.searchsorted(known.hashes, h[maybe]), len(known.hashes) - 1)
    found = known.hashes[at] == h[maybe]
    return at[found], maybe[found]


def _passages(data: np.ndarray, bound: np.ndarray, where: np.ndarray, known: Index) -> Iterator[tuple]:
    """(text, item, start, end) of runs of exact pieces; all q-grams of a piece
    are known ones, so they begin at consecutive places of ``where``."""
    n = EXACT - GRAM
    starts = where[: max(0, len(where) - n)][where[n:] - where[: max(0, len(where) - n)] == n]
    text = np.searchsorted(bound, starts, "right") - 1
    inside = starts + EXACT <= bound[text + 1]
    starts = starts[inside]
    if not len(starts):
        return
    h = span_hashes(data, starts, starts + EXACT)
    low, high = (np.searchsorted(known.exact, h, side) for side in ("left", "right"))
    total = np.concatenate([[0], np.cumsum(high - low)])
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(total, total[first] + PAIRS // EXACT, "right")) - 1)
        count = (high - low)[first:last]
        row = np.repeat(np.arange(first, last), count)
        piece = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        step = np.arange(EXACT)
        same = (data[starts[row][:, None] + step] == known.source[known.exact_at[piece][:, None] + step]).all(axis=1)
        place, item = starts[row[same]], known.exact_item[piece[same]]
        where_ = np.searchsorted(bound, place, "right") - 1
        order = np.lexsort((place, item, where_))
        place, item, where_ = place[order], item[order], where_[order]
        new = np.ones(len(place), bool)
        new[1:] = (item[1:] != item[:-1]) | (where_[1:] != where_[:-1]) | (place[1:] >= place[:-1] + EXACT)
        runs = np.flatnonzero(new)
        ends = place[np.append(runs[1:], len(place)) - 1] + EXACT if len(runs) else place
        yield from zip(where_[runs].tolist(), item[runs].tolist(), place[runs].tolist(), ends.tolist(), strict=True)
        first = last


def _candidates(at: np.ndarray, where: np.ndarray, known: Index) -> Iterator[np.ndarray]:
    """(segment, lowest diagonal) of bands with enough shared q-grams, given
    those of :func:`_grams_at`."""
    count = known.first[at + 1] - known.first[at]
    total = np.concatenate([[0], np.cumsum(count)])
    low = 0
    while low < len(where):
        # bounded blocks; a block goes back by more than any band is long
        high = max(low + 1, int(np.searchsorted(total, total[low] + PAIRS, "right")) - 1)
        back = int(np.searchsorted(where, where[low] - 4 * SEGMENT)) if low else 0
        some = np.arange(back, high)
        row = np.repeat(some, count[some])
        inner = np.arange(len(row)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
        posting = known.first[at[row]] + inner
        segment = known.segment[posting]
        diagonal = where[row] - known.place[posting]
        step = known.budgets[segment] + 1
        # bands of step + e diagonals begin at every step: two hold a diagonal
        band = diagonal // step
        pair = np.concatenate([np.stack([segment, band]), np.stack([segment, band - 1])], axis=1)
        keys, n = np.unique(pair, axis=1, return_counts=True) if pair.shape[1] < 2 else _counted(pair)
        good = n >= known.least[keys[0]]
        yield np.stack([keys[0][good], (keys[1] * (known.budgets[keys[0]] + 1))[good]])
        low = high


def _counted(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    base = int(pair[1].min())
    width = int(pair[1].max()) - base + 1
    keys, n = np.unique(pair[0] * width + pair[1] - base, return_counts=True)
    return np.stack([keys // width, keys % width + base]), n


#: an alignment's cost and its first diagonal in one number
_COST = 1 << 20


def align(data: np.ndarray, segment: np.ndarray, lows: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of ``segment`` against ``data`` on the diagonals from
    ``low`` - e to ``low`` + 3e + 1, with the start and the end of the place in
    ``data``; one result per low diagonal."""
    width = 4 * budget + 2
    base = lows - budget
    shift = np.arange(width)
    padded = np.concatenate([np.zeros(1, np.uint8), data, np.zeros(1, np.uint8)])

    def letters(i: int) -> np.ndarray:
        return padded[np.clip(base[:, None] + shift + i + 1, 0, len(data) + 1)]

    value = np.broadcast_to(shift.astype(np.int64), (len(lows), width)).copy()
    for i, letter in enumerate(segment.tolist()):
        change = value + (letters(i) != letter) * _COST
        # a letter of the segment left out: one diagonal down
        change[:, :-1] = np.minimum(change[:, :-1], value[:, 1:] + _COST)
        # letters of the text left out: any number of diagonals up
        value = np.minimum.accumulate(change - shift * _COST, axis=1) + shift * _COST
    best = value.argmin(axis=1)
    found = value[np.arange(len(lows)), best]
    return found // _COST, base + found % _COST, base + best + len(segment)


def _matches(data: np.ndarray, offsets: np.ndarray, known: Index, passages: list | None = None) -> Iterator[tuple]:
    """(text, item, start, end, edits) with places in ``data``; of overlapping
    places of one item those with the fewest edits.  Exact passages, which may
    be shorter than a segment, are added to ``passages``."""
    for a, b in slices(offsets):
        for low in range(int(offsets[a]), int(offsets[b]), CHUNK):
            # long texts are cut into blocks that overlap by more than a band
            high = min(int(offsets[b]), low + CHUNK + 8 * SEGMENT)
            part, bound = data[low:high], offsets[a : b + 1] - low
            at, where = _grams_at(part, known)
            if passages is not None:
                passages += [(a + text, item, x + low, y + low, 0) for text, item, x, y in _passages(part, bound, where, known)]
            for segment, diagonal in _candidates(at, where, known):
                for s in np.unique(segment).tolist():
                    pattern, budget = known.segments[s], int(known.budgets[s])
                    lows = diagonal[segment == s]
                    edits, start, end = align(part, pattern, lows, budget)
                    good = edits <= budget
                    for e, x, y in zip(edits[good].tolist(), start[good].tolist(), end[good].tolist(), strict=True):
                        x, y = max(0, x), min(y, len(part))
                        text = int(np.searchsorted(bound, (x + y) // 2, "right")) - 1
                        # a place that reaches into the next text is cut off there
                        x2, y2 = max(x, int(bound[text])), min(y, int(bound[text + 1]))
                        if x2 != x or y2 != y:
                            e = _edits(part[x2:y2], pattern, budget)
                        if e <= budget and (len(pattern) >= SHORTEST or _apart(part, x2, y2, bound[text], bound[text + 1])):
                            yield a + text, int(known.items[s]), x2 + low, y2 + low, e


def _apart(data: np.ndarray, start: int, end: int, low: int, high: int) -> bool:
    """Whether a place in the text [low, high) begins and ends a word."""
    letter = [bytes([c]).isalnum() or c > 0x7F for c in (*data[max(start - 1, low) : start].tolist(), *data[end : min(end + 1, high)].tolist())]
    return not any(letter)


def _edits(text: np.ndarray, pattern: np.ndarray, budget: int) -> int:
    """Least edits of the whole pattern against any part of a short text."""
    lows = np.arange(-len(pattern) - 1, len(text) + 2, budget + 1)
    return int(align(text, pattern, lows, budget)[0].min())


def find(documents: DataFrame, benchmark: DataFrame, rate: float = RATE, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """All columns of ``documents`` with ``matches``: where a segment of a
    benchmark item occurs with at most ``rate`` edits per byte, or an exact passage
    of :data:`EXACT` bytes or more of it (always found from ``EXACT + STEP - 1``
    bytes on), as ``item_id``,
    ``start``, ``end`` (code points of the text) and ``edits``, by place.

    A-Z count as lower case and runs of spaces as one space.  Items shorter
    than :data:`SHORTEST` bytes match whole, without edits and between word
    borders; items shorter than :data:`GRAM` bytes, NULL items and items without id match nothing;
    so does a NULL or empty text.  Equal rows get equal matches.  A column
    called ``matches`` is replaced.  A benchmark of at most about ``pass_bytes`` is
    looked for without a shuffle, in one pass over the documents.  A larger one
    is read in such parts, a job each, that write down the matches of every text
    that has some; these are joined to the documents by 128 bits of the text's hash.
    """
    settle(documents.sparkSession)
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // pass_bytes)
    none = F.expr(f"CAST(array() AS {MATCHES.split(' ', 1)[1]})")
    plain = documents.drop("matches")

    def known(part: int) -> Index:
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        return index([(r.item_id, r.text) for r in mine], rate)

    if parts <= 1:
        result = plain.withColumn("matches", none)
        return _pass(result, known(0)) if parts else result
    texts = plain.select(text_hash(1).alias("_h1"), text_hash(2).alias("_h2"), "text", none.alias("matches"))
    found = None
    for part in range(parts):
        # one index and one worker per core at a time, whatever the benchmark's size
        hits = cut_lineage(_pass(texts, known(part)).filter(F.size("matches") > 0).select("_h1", "_h2", "matches").dropDuplicates(["_h1", "_h2"]))
        found = hits if found is None else found.unionByName(hits)
    by_place = F.expr("array_sort(flatten(collect_list(transform(matches, m -> struct(m.start AS a, m.end AS b, m.item_id AS c, m.edits AS d)))))")
    ordered = found.groupBy("_h1", "_h2").agg(by_place.alias("_places"))
    hits = cut_lineage(ordered.selectExpr("_h1", "_h2", "transform(_places, p -> struct(p.c AS item_id, p.a AS start, p.b AS end, p.d AS edits)) AS _found"))
    few = hits.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS and (hits.agg(F.sum(F.size("_found"))).first()[0] or 0) <= 4 * BROADCAST_TEXTS
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(plain.columns)]
    joined = plain.select(*own, text_hash(1).alias("_h1"), text_hash(2).alias("_h2")).join(F.broadcast(hits) if few else hits, ["_h1", "_h2"], "left")
    return joined.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(plain.columns)), F.coalesce("_found", none).alias("matches"))


def _pass(documents: DataFrame, known: Index) -> DataFrame:
    schema = widened(documents.drop("matches"), MATCHES)

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            found: dict[int, tuple[set, set]] = {}
            for a, b in slices(offsets, SLICE):
                begin = int(offsets[a])
                part, inner = data[begin : int(offsets[b])], offsets[a : b + 1] - begin
                if len(part) < GRAM:
                    continue
                low, bound, origin = normal(part, inner)
                passages: list[tuple] = []
                matches = list(_matches(low, bound, known, passages)) if len(low) >= GRAM else []
                for kind, places in enumerate((matches, passages)):
                    for text, item, start, end, edits in places:
                        found.setdefault(a + text, (set(), set()))[kind].add((item, begin + int(origin[start]), begin + int(origin[end - 1]) + 1, edits))
            out = batch.column("matches")
            if found:
                lists = out.to_pylist()
                for text, places in found.items():
                    begin = int(offsets[text])
                    point = np.cumsum((data[begin : int(offsets[text + 1])] & 0xC0) != 0x80)
                    for item, start, end, edits in _joined(*places):
                        lists[text].append({"item_id": item, "start": int(point[start - begin]) - 1, "end": int(point[end - 1 - begin]), "edits": edits})
                    lists[text].sort(key=lambda m: (m["start"], m["end"], m["item_id"]))
                out = pa.array(lists, out.type)
            columns = [batch.column(f) for f in schema.fieldNames()[:-1]] + [out]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())
        give_back()

    return documents.select(schema.fieldNames()).mapInArrow(run, schema)


def _fewest(places: set) -> list[tuple]:
    """Places of an item that overlap become one, with the fewest edits."""
    out: list[list] = []
    for item, start, end, edits in sorted(places):
        if out and out[-1][0] == item and start < out[-1][2]:
            out[-1][2] = max(out[-1][2], end)
            out[-1][3] = min(out[-1][3], edits)
        else:
            out.append([item, start, end, edits])
    return [tuple(p) for p in out]


def _joined(places: set, passages: set) -> list[tuple]:
    """The places, and the exact passages that overlap none of their item."""
    out = _fewest(places)
    of_item: dict[int, list] = {}
    for p in out:
        of_item.setdefault(p[0], []).append(p)
    return out + [p for p in _fewest(passages) if not any(p[1] < q[2] and q[1] < p[2] for q in of_item.get(p[0], ()))]


def keep(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``documents`` without a match, with all their columns."""
    own = "matches" in documents.columns
    renamed = documents.withColumnRenamed("matches", "_own_matches") if own else documents
    kept = find(renamed, benchmark, rate).filter(F.size("matches") == 0).drop("matches")
    kept = kept.withColumnRenamed("_own_matches", "matches") if own else kept
    return kept.select(*documents.columns)
