"""Toxicity by compression distance.

Two zstandard dictionaries hold ordinary content, which the zstandard trainer
picks from windows of ordinary text; one of them ends with a part of its own:
segments of words typical of toxic text.  A text is cut into short windows; a
window that the toxic dictionary makes shorter by more than a calibrated number of
bytes speaks for toxic text.  A logistic model over the sizes and the number of
such windows gives the score.

The toxic part is chosen here by document frequencies, not by the zstandard
trainer: a trainer that is given toxic text keeps what is frequent in it, which is
ordinary (README gives the figures of both).  The ordinary dictionary ends with as
many zero bytes instead.  A window that shares no ``MATCH`` bytes with that
part compresses alike under both, so only the others are compressed.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import gram_hashes, settle, slices, widened

#: labelled documents of each class to learn from, and the longest of them
SAMPLE, LONGEST = 3000, 65_536

#: bytes of a window, of the shortest match, of the ordinary dictionary and of
#: the toxic part
WINDOW, MATCH, COMMON, OWN = 64, 5, 4096, 4096

#: windows that train the ordinary dictionary
TRAINING_WINDOWS = 40_000

#: a word is typical if its document frequencies differ by so many deviations
TYPICAL = 4.5

#: and a run of bytes if it is so many times as frequent in toxic texts
RATIO = 8

_WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]{3,40}")


@dataclass
class Model:
    """Both dictionaries, the window threshold and the logistic weights."""

    ordinary: bytes
    toxic: bytes
    own: bytes
    threshold: int
    weights: np.ndarray


def _normal(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY,
        min_match=MATCH,
        window_log=14,
        hash_log=13,
        chain_log=13,
        search_log=3,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(compression_params=parameters)
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=parameters)


def _words_at(data: np.ndarray) -> np.ndarray:
    """Positions where a word begins, and the end of the text."""
    gap = data <= 0x20
    begins = ~gap
    begins[1:] &= gap[:-1]
    return np.append(np.flatnonzero(begins), len(data))


class Scorer:
    """Windows of texts and what the dictionaries make of them."""

    def __init__(self, model: Model):
        self.model = model
        self.pair = _compressor(model.ordinary), _compressor(model.toxic)
        own = np.frombuffer(model.own, np.uint8)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(gram_hashes(own, MATCH) >> np.uint64(44)).astype(np.int64)] = True
        self.known: dict[bytes, int] = {}

    def _saved(self, window: bytes) -> int:
        found = self.known.get(window)
        if found is None:
            ordinary, toxic = (len(c.compress(window)) for c in self.pair)
            found = ordinary - toxic
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[window] = found
        return found

    def saved(self, texts: list[bytes]) -> list[tuple[int, list[int]]]:
        """Per text its number of windows, and the bytes saved by those that
        can save any.

        A window holds the words that begin in one cell of ``WINDOW`` bytes.
        """
        offsets = np.cumsum([0, *map(len, texts)])
        out: list[tuple[int, list[int]]] = []
        for a, b in slices(offsets):
            raw = b"".join(texts[a:b])
            data = np.frombuffer(raw, np.uint8)
            hit = np.flatnonzero(self.bits[(gram_hashes(data, MATCH) >> np.uint64(44)).astype(np.int64)]) if len(self.model.own) >= MATCH else np.zeros(0, np.int64)
            begin = offsets[a : b + 1] - offsets[a]
            first = np.searchsorted(hit, begin)
            for i in range(b - a):
                low, high = int(begin[i]), int(begin[i + 1])
                if first[i] == first[i + 1]:
                    out.append((-(-(high - low) // WINDOW), []))
                    continue
                starts = _words_at(data[low:high])
                places = hit[first[i] : first[i + 1]] - low
                # the words that a hit touches: at its first and last byte
                word = np.searchsorted(starts[:-1], np.concatenate([places, places + MATCH - 1]), "right") - 1
                word = np.unique(word[(word >= 0) & (np.concatenate([places, places]) < high - low)])
                cell = np.unique(starts[word] // WINDOW)
                from_ = starts[np.searchsorted(starts, cell * WINDOW)]
                to = starts[np.searchsorted(starts, np.minimum((cell + 1) * WINDOW, high - low))]
                out.append((-(-(high - low) // WINDOW), [self._saved(raw[low + s : low + e]) for s, e in zip(from_.tolist(), to.tolist(), strict=True)]))
        return out

    def features(self, texts: list[bytes]) -> np.ndarray:
        rows = []
        for n, saved in self.saved(texts):
            strong = [d for d in saved if d >= self.model.threshold]
            total = sum(strong)
            rows.append([1.0, math.log1p(total), math.log1p(len(strong)), max(strong, default=0) / 10, math.log1p(1000 * total / max(20, n)), math.log1p(n) / 5])
        return np.array(rows).reshape(-1, 6)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.model.weights, -30, 30)))


def _deviations(c: int, other: int, n1: int, n0: int) -> float:
    p = (c + other + 1) / (n1 + n0 + 2)
    return (c / n1 - other / n0) / math.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))


def _grams(word: bytes) -> list[bytes]:
    """Runs of ``MATCH`` bytes of a word with its borders."""
    whole = b" " + word + b" "
    return [whole[i : i + MATCH] for i in range(len(whole) - MATCH + 1)]


def _typical(toxic: list[bytes], ordinary: list[bytes]) -> bytes:
    """The toxic dictionary's own part: segments of words typical of toxic
    texts, the most typical last (where a match costs least).

    Words first, then the runs of ``MATCH`` bytes inside them: a segment is
    what is typical of a word, so common endings match nothing.
    """
    n1, n0 = max(1, len(toxic)), max(1, len(ordinary))
    words: list[Counter[bytes]] = [Counter(), Counter()]
    for count, texts in zip(words, (toxic, ordinary), strict=True):
        for t in texts:
            count.update(set(_WORD.findall(t)))
    found = sorted(((_deviations(c, words[1][w], n1, n0), w) for w, c in words[0].items() if c >= 3), reverse=True)
    found = [w for z, w in found if z >= TYPICAL]
    del words
    grams = {g for w in found for g in _grams(w)}
    # the texts are read again, as their words would fill the driver
    seen: list[Counter[bytes]] = [Counter(), Counter()]
    for count, texts in zip(seen, (toxic, ordinary), strict=True):
        for t in texts:
            count.update({g for w in set(_WORD.findall(t)) for g in _grams(w) if g in grams})
    strong = {g for g, c in seen[0].items() if c / n1 >= RATIO * (seen[1][g] + 0.5) / n0 and _deviations(c, seen[1][g], n1, n0) >= TYPICAL}
    kept, covered, size = [], set(), 0
    for word in found:
        whole, here = b" " + word + b" ", _grams(word)
        i = 0
        while i < len(here):
            j = i
            while j < len(here) and here[j] in strong:
                j += 1
            run = here[i:j]
            if run and not covered.issuperset(run) and size < OWN:
                kept.append(whole[i : j + MATCH - 1])
                size += j + MATCH - i
                covered.update(run)
            i = j + 1
    # zero bytes keep neighbours from matching together
    return b"\0".join([b"", *kept[::-1], b""]) if kept else b""


def _ordinary(texts: list[bytes]) -> bytes:
    """Content of a dictionary trained on windows of ordinary texts."""
    windows = [t[i : i + WINDOW] for t in texts for i in range(0, len(t), WINDOW)]
    step = max(1, len(windows) // TRAINING_WINDOWS)
    windows = windows[::step]
    if sum(map(len, windows)) < 16 * COMMON:
        return b"".join(windows)[-COMMON:]  # too little for the trainer: the text itself
    return zstandard.train_dictionary(2 * COMMON, windows).as_bytes()[-COMMON:]


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights, with a small penalty, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.01 * np.eye(len(w)), x.T @ (p - y) + 0.01 * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _best_cut(score: np.ndarray, y: np.ndarray) -> float:
    """The logit with the best F1."""
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + max(1, y.sum()))
    # only between different scores
    f1[:-1][score[order][:-1] == score[order][1:]] = -1
    i = int(f1.argmax())
    return float(score[order][i] if i + 1 == len(y) else (score[order][i] + score[order][i + 1]) / 2)


def train(rows: list[tuple[str | None, int]], prior: float | None = None) -> Model:
    """A model from (text, label) rows; without both labels every score is 0.

    The dictionaries come from half of the rows, threshold and weights from the
    other half, so that words met by chance do not count.  ``prior`` is the
    share of toxic rows where the sample is not in proportion.
    """
    texts = [(_normal(t), int(y)) for t, y in rows]
    labels = {y for _, y in texts}
    if labels != {0, 1}:
        weights = np.zeros(6)
        weights[0] = -30.0
        return Model(b"", b"", b"", 1, weights)
    learn, check = texts[::2], texts[1::2]

    def dictionaries(part) -> tuple[bytes, bytes]:
        ordinary = [t for t, y in part if not y]
        common = _ordinary(ordinary)
        return common, _typical([t for t, y in part if y], ordinary)

    common, own = dictionaries(learn)
    y = np.array([y for _, y in check], float)
    share = float(y.mean()) if prior is None else prior
    weight = np.where(y > 0, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    best = None
    for threshold in (2, 3, 4, 5):
        model = Model(common + bytes(len(own)), common + own, own, threshold, np.zeros(6))
        x = Scorer(model).features([t for t, _ in check])
        w = _fit(x, y)
        p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
        loss = -float((y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
        if best is None or loss < best[0]:
            logit = x @ w
            order = np.repeat(np.arange(len(y)), np.maximum(1, np.round(weight * 10)).astype(int))
            w[0] -= _best_cut(logit[order], y[order])
            best = loss, threshold, w
    # with threshold and weights known, all rows give the dictionaries
    common, own = dictionaries(texts)
    return Model(common + bytes(len(own)), common + own, own, best[1], best[2])


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from a sample of at most ``sample`` labelled documents of each
    class (by a hash of the id), none longer than :data:`LONGEST` characters; of
    several texts under one id the smallest.

    ``labels`` has ``doc_id`` and ``toxic``; NULL labels and ids do not count,
    and a document with both labels is toxic.
    """
    spark = settle(documents.sparkSession)
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {r.toxic: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [r for y in (0, 1) for r in known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()]
    few = spark.createDataFrame(chosen, "doc_id long, toxic int")
    found = documents.select("doc_id", "text").join(F.broadcast(few), "doc_id").filter(f"text IS NULL OR length(text) <= {LONGEST}").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    rows = [(r.text, r.toxic) for r in found.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").select("text", "toxic").collect()]
    total = sizes.get(0, 0) + sizes.get(1, 0)
    return train(rows, sizes.get(1, 0) / total if total else None)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents`` with ``score`` and ``predicted``.

    ``score`` depends on ``text`` alone: the whole text, in lower case.  A NULL
    text is empty and gets the score of a text without any typical word, as any
    such text does.  Columns of the input called ``score`` or ``predicted`` are
    replaced.  Repeated rows get equal scores; no rows give none.
    """
    settle(documents.sparkSession)
    kept = documents.select(*[c for c in documents.columns if c not in ("score", "predicted")])
    schema = widened(kept, "score double, predicted int")

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            found = scorer.scores([_normal(t) for t in batch.column("text").to_pylist()])
            arrays = [*batch.columns, pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    return kept.mapInArrow(run, schema)
