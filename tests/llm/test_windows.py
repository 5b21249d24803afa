"""Suffix-array dedup and substring dedup against brute force."""

import hashlib
import random

import pytest

from mapweave.llm import substring_dedup as words
from mapweave.llm import suffix_dedup as strings


def _sha(data):
    return hashlib.sha256(data).hexdigest()


def brute_bytes(rows, width=100):
    """Expected digest rows for documents with different ids."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            w = data[p : p + width]
            if w in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        out.append((rows[i][0], len(data), sum(gone), spans, _sha(kept)))
    return sorted(out, key=repr)


def brute_words(rows, width=35):
    split = [(t or "").encode().split() for _, t in rows]
    count = {}
    for w in split:
        for p in range(len(w) - width + 1):
            k = tuple(w[p : p + width])
            count[k] = count.get(k, 0) + 1
    out = []
    for (i, _), w in zip(rows, split):
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if count[tuple(w[p : p + width])] > 1:
                gone[p : p + width] = [True] * width
        out.append((i, len(w), sum(gone), _sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["the", "ea", "tion", "größe", "é", "ing", "re", "x" * 30] + [f"w{i}" for i in range(60)]

    def prose(n):
        return "".join(rng.choice(vocab) + rng.choice([" ", " ", "\n", "\t ", "  "]) for _ in range(n))

    shared = [prose(n) for n in (20, 40, 60, 120)]
    rows = []
    for i in range(40):
        parts = [prose(rng.randrange(1, 90)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s) // 2)
            parts.insert(rng.randrange(len(parts) + 1), s[a:])
        rows.append("".join(parts))
    base = prose(150)
    rows += [base] * 4
    for _ in range(8):  # near copies
        w = base.split(" ")
        w[rng.randrange(len(w))] = "edit%d" % rng.randrange(5)
        rows.append(" ".join(w))
    rows += ["ab " * 300, "ab " * 300, "z" * 700, "é" * 200, "", "short", None, "x\x0by" * 80]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(None if i == 3 else i * 3 - 5, rows[k]) for i, k in enumerate(order)]


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("hot", [20_000, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(docs, seed, hot):
    rows = corpus(seed)
    assert got(strings.digest(strings.suffix_dedup(docs(rows), hot=hot))) == brute_bytes(rows)


@pytest.mark.parametrize("hot", [20_000, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_words(docs, seed, hot):
    rows = corpus(seed)
    assert got(words.digest(words.substring_dedup(docs(rows), hot=hot))) == brute_words(rows)


def test_small_blocks(docs, spark):
    """Blocks of a few rows give the same as one block."""
    from mapweave.llm import windows
    from mapweave.llm.common import keyed

    rows = corpus(5)
    for spec in (windows.Windows(False, 100, 16, True), windows.Windows(True, 35, 4, False)):
        want = None
        for limit in (20_000, 7, 2):
            spans = windows.repeated_spans(keyed(docs(rows)), spec, limit=limit, hot=5)
            covered = {(r.key, p) for r in spans.collect() for p in range(r.low, r.high)}
            want = covered if want is None else want
            assert covered == want


def test_cases(docs, spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, None), (2, ""), (3, text + " more")]
    result = {(r.doc_id, r.n_removed) for r in strings.digest(strings.suffix_dedup(docs(rows))).collect()}
    n = len(text)
    assert result == {(1, 0), (None, 0), (2, 0), (3, n)}
    result = {(r.doc_id, r.n_removed) for r in words.digest(words.substring_dedup(docs(rows))).collect()}
    assert result == {(1, 60), (None, 0), (2, 0), (3, 60)}
    empty = docs([])
    assert strings.suffix_dedup(empty).count() == words.substring_dedup(empty).count() == 0
    extra = docs(rows).withColumnsRenamed({"source": "key", "lang": "tid"})
    assert strings.suffix_dedup(extra).count() == 5


def test_long_text(docs):
    """A text longer than a block, with a repeat across the block's edge."""
    from mapweave.llm.common import CHUNK

    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ") for _ in range(4 * CHUNK + 5000))
    again = base[4 * CHUNK - 500 : 4 * CHUNK + 500]
    rows = [(1, base), (2, "q" + again)]
    out = {r.doc_id: r.n_removed for r in strings.digest(strings.suffix_dedup(docs(rows))).collect()}
    assert out == {1: 0, 2: 1000}


def alike(spark, long, short):
    """A long and a short text whose 16 bits (``tid``) agree."""
    from mapweave.llm.common import keyed

    def known(make):
        rows = spark.createDataFrame([(None, make(i)) for i in range(1500)], "doc_id long, text string")
        return {r.tid: r.text for r in keyed(rows).collect()}

    first, second = known(long), known(short)
    tid = min(set(first) & set(second))
    return first[tid], second[tid]


@pytest.mark.parametrize("key", [None, 4])
def test_texts_that_share_an_id_and_16_bits(docs, spark, key):
    """Neither gets the places of the other."""
    again = " ".join(f"w{i}" for i in range(40))
    long, short = alike(spark, lambda i: f"n{i} {again}. {again}.", lambda i: f"short {i}")
    rows = [(key, long), (key, short), (9, "other")]
    assert got(words.digest(words.substring_dedup(docs(rows)))) == brute_words(rows)
    assert got(strings.digest(strings.suffix_dedup(docs(rows)))) == brute_bytes(rows)


def test_many_shared_ids(docs, monkeypatch):
    """With more shared ids than are sent to the tasks the result is the same."""
    from mapweave.llm import common

    rows = [(i % 7, t) for i, (_, t) in enumerate(corpus(1))]
    want = got(words.digest(words.substring_dedup(docs(rows))))
    monkeypatch.setattr(common, "SHARED", 2)
    assert got(words.digest(words.substring_dedup(docs(rows)))) == want == brute_words(rows)
