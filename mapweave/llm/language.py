"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point.  The
vector of a trigram binds the letters' vectors, rotated by their place, with the
elementwise product; a text's profile bundles (adds) the vectors of its
trigrams.  A language's prototype bundles all its texts.  A text gets the
language whose prototype has the largest cosine with its profile.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import settle, widened

#: length of the vectors, and the seed of the letters' vectors
DIMENSIONS, SEED = 1024, 7

#: the language of a text without letters
UNKNOWN = "und"

#: letters of one numpy pass; dense tables (trigrams, or texts by trigrams) up to
#: so many cells; trigrams that are bound together beyond that
LETTERS, DENSE, BOUND = 1 << 19, 1 << 22, 8192


@lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for anything else."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


@lru_cache(65_536)
def _vector(letter: int, dimensions: int, turn: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([SEED, letter])).integers(0, 2, dimensions, dtype=np.int8)
    return np.roll(bits * 2 - 1, turn)


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigrams of lower-case letters as rows of three code points, and per
    trigram of the texts its row and its text.  Anything between letters is one
    0, also at both ends; the middle is always a letter."""
    code = np.frombuffer(("\0" + "\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    owner = np.append(owner[:1], owner)[: len(code)]
    code = _letters()[code]
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    code, owner = code[keep], owner[keep]
    used, small = np.unique(code, return_inverse=True) if code.max(initial=0) > 0xFFFF else _compact(code)
    middle = np.flatnonzero(code[1:-1]) if len(code) > 2 else np.zeros(0, np.int64)
    n = len(used)
    ids = (small[middle] * n + small[middle + 1]) * n + small[middle + 2]
    if n**3 <= DENSE:
        present = np.zeros(n**3, np.int64)
        present[ids] = 1
        which = np.flatnonzero(present)
        row = (np.cumsum(present) - 1)[ids]
    else:
        which, row = np.unique(ids, return_inverse=True)
    grams = np.stack([used[which // (n * n)], used[which // n % n], used[which % n]], axis=1)
    return grams, row, owner[middle + 1], used


def _compact(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    used = np.flatnonzero(np.bincount(code, minlength=1))
    place = np.zeros(int(used[-1]) + 1 if len(used) else 1, np.int64)
    place[used] = np.arange(len(used))
    return used.astype(np.uint32), place[code]


def _bind(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """Vectors of trigrams."""
    out = np.ones((len(grams), dimensions), np.int8)
    for place in range(3):
        letters, row = np.unique(grams[:, place], return_inverse=True)
        if len(letters):
            out *= np.stack([_vector(int(c), dimensions, 2 - place) for c in letters])[row]
    return out


def _cut(text: str):
    """Parts of a long text, cut where no trigram goes across: behind a character
    that is no letter (a longer run of letters stays in one part)."""
    start = 0
    while len(text) - start > LETTERS:
        end = start + LETTERS
        while end > start and text[end - 1].isalpha():
            end -= 1
        if end == start:
            end = start + LETTERS
            while end < len(text) and text[end].isalpha():
                end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def _slices(texts: list[str]):
    """(numbers of texts, parts of them) of bounded length together."""
    numbers, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for part in _cut(text):
            if size and size + len(part) > LETTERS:
                yield numbers, parts
                numbers, parts, size = [], [], 0
            numbers.append(i)
            parts.append(part)
            size += len(part)
    if parts:
        yield numbers, parts


def profiles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """The profile of every text, not normalised; zero without letters.

    Few trigrams are bound once and multiplied with their counts per text; of
    many, as ideographs make, only those that a text holds are bound, in
    bounded runs.  Both give the same whole numbers.
    """
    out = np.zeros((len(texts), dimensions), np.float32)
    for numbers, parts in _slices(texts):
        grams, row, text, _ = _trigrams(parts)
        n = len(grams)
        if not n:
            continue
        numbers = np.array(numbers)
        if len(parts) * n <= DENSE:
            counts = np.bincount(text * n + row, minlength=len(parts) * n).reshape(len(parts), n)
            # whole numbers far below 2**24: exact in any order
            np.add.at(out, numbers, counts.astype(np.float32) @ _bind(grams, dimensions).astype(np.float32))
            continue
        pairs, counts = np.unique(text * n + row, return_counts=True)
        for start in range(0, len(pairs), BOUND):
            part, times = pairs[start : start + BOUND], counts[start : start + BOUND, None]
            vectors = _bind(grams[part % n], dimensions) * times.astype(np.float32)
            first = np.flatnonzero(np.append(True, np.diff(part // n) > 0))
            np.add.at(out, numbers[part[first] // n], np.add.reduceat(vectors, first, axis=0))
    return out


def learn(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages in order of code point and their prototypes, from rows of
    ``lang`` and ``text``; all rows count.

    Trigrams are counted per language in every task and added up by Spark, so
    the number of rows that travel follows the alphabet, not the corpus.
    """

    def count(batches):
        totals: dict[str, dict] = {}

        def rows():
            names, grams, n = [], [], []
            for lang, table in totals.items():
                names += [lang] * len(table)
                grams += list(table)
                n += list(table.values())
            totals.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())], ["lang", "gram", "n"])

        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            names = sorted(set(langs))
            for numbers, parts in _slices(texts):
                grams, row, text, _ = _trigrams(parts)
                lang = np.array([names.index(langs[i]) for i in numbers], np.int64)
                found, counts = np.unique(lang[text] * len(grams) + row, return_counts=True)
                words = ["".join(map(chr, g)) for g in grams.tolist()]
                for at, n in zip(found.tolist(), counts.tolist(), strict=True):
                    table = totals.setdefault(names[at // len(grams)], {})
                    word = words[at % len(grams)]
                    table[word] = table.get(word, 0) + n
            if sum(map(len, totals.values())) > 200_000:
                yield rows()
        yield rows()

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, grams, n = (batch.column(c).to_pylist() for c in ("lang", "gram", "n"))
            code = np.array([list(map(ord, g)) for g in grams], np.uint32).reshape(-1, 3)
            names = sorted(set(langs))
            weight = np.zeros((len(names), len(grams)))
            weight[[names.index(x) for x in langs], np.arange(len(grams))] = n
            for name, part in zip(names, weight @ _bind(code, dimensions), strict=True):
                sums[name] = sums.get(name, 0) + part
        names = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sums[n].tolist() for n in names], pa.list_(pa.float64()))], ["lang", "v"])

    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInArrow(count, "lang string, gram string, n long")
    grams = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total: dict[str, np.ndarray] = {}
    # one vector per language and partition
    for r in grams.mapInArrow(bundle, "lang string, v array<double>").collect():
        total[r.lang] = total.get(r.lang, 0) + np.array(r.v)
    names = sorted(total)
    return names, np.stack([total[n] for n in names]) if names else np.zeros((0, dimensions))


def identify(documents: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """All columns of ``documents`` with ``lang_pred`` and ``score``.

    ``score`` is the cosine, 0 where it is negative.  A NULL text, a text
    without a letter, and any text if no language was learned get ``und`` and
    0.  Of equally near languages the first by code point is taken.  Columns of
    the input called ``lang_pred`` or ``score`` are replaced.  Rows are
    independent of each other, so repeated rows get the same result and no rows
    give none.
    """
    settle(documents.sparkSession)
    names, prototypes = model
    norms = np.linalg.norm(prototypes, axis=1)
    unit = (prototypes / np.where(norms > 0, norms, 1)[:, None]).astype(np.float32)
    kept = documents.select(*[c for c in documents.columns if c not in ("lang_pred", "score")])
    schema = widened(kept, "lang_pred string, score double")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = profiles(texts, unit.shape[1])
            length = np.linalg.norm(found, axis=1).astype(np.float64)
            if len(names):
                dots = (found @ unit.T).astype(np.float64)
                best = dots.argmax(axis=1)
                cosine = dots[np.arange(len(texts)), best] / np.where(length > 0, length, 1)
            else:
                best, cosine = np.zeros(len(texts), int), np.zeros(len(texts))
                length[:] = 0
            lang = [names[i] if n > 0 else UNKNOWN for i, n in zip(best, length, strict=True)]
            score = np.clip(np.where(length > 0, cosine, 0.0), 0, 1)
            arrays = [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    return kept.mapInArrow(run, schema)
