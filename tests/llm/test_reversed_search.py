"""Reversed search against scores computed item by item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from mapweave.llm import queries
from mapweave.llm import reversed_search as rs


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, items, best=20):
    docs = [(i, Counter(words(t))) for i, t in rows]
    n_docs = sum(1 for _, c in docs if c)
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    texts = {}
    for i, t in set(items):
        texts.setdefault(i, Counter()).update(words(t))
    out = []
    for item, query in texts.items():
        found = []
        for i, c in docs:
            n = sum(c.values())
            m = 75 + (25 * n * n_docs) // total if total else 0
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in query.items() if c[t])
            if score > 0:
                found.append((-score, i is None, i, i))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(found[:best])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["The", "é", "größe", "x-y", "日本", "A1", "\x00q"]
    rows = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, range(len(vocab), 0, -1), k=rng.randrange(60)))) for i in rng.sample(range(-40, 900), 90)]
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), rows[1], (2000, ""), (2001, None), (None, rows[2][1]), (3000, " ".join(vocab) * 400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(1, 12)))) for i in range(25)]
    items += [(3, "w1 w1 w2"), items[0], (50, None), (51, "?!"), (52, "nowhere"), (None, "w3 THE")]
    return rows, items


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, docs, seed):
    rows, items = corpus(seed)
    table = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, score int")
    got = rs.search(docs(rows).withColumnRenamed("source", "rank"), table)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == brute(rows, items)


def test_parts_and_small_passes(spark, docs, monkeypatch):
    """Several parts of the index, passes of few cells and few heaps give the same."""
    rows, items = corpus(5)
    monkeypatch.setattr(rs, "CELLS", 50)
    table = spark.createDataFrame(items, "item_id long, text string")
    indexes = list(rs.indexes(table, 30))
    assert len(indexes) > 3 and all(len(i.item) <= 30 + max(np.bincount(i.item)) for i in indexes)
    assert rows_of(rs.search(docs(rows).repartition(7), table, best=3, part_terms=30)) == brute(rows, items, 3)


def test_large_scores_stay_exact():
    rng = np.random.default_rng(1)
    index = rs.Index([0, 1], np.arange(5, dtype=np.uint64), np.arange(0, 11, 2), np.tile([0, 1], 5), rng.integers(1, 9, 10))
    doc, term = np.repeat(np.arange(3), 5), np.tile(np.arange(5), 3)
    impact = rng.integers(2**54, 2**55, 15)
    want = np.zeros((3, 2), np.int64)
    for d, t, v in zip(doc, term, impact, strict=True):
        for p in range(index.first[t], index.first[t + 1]):
            want[d, index.item[p]] += v * index.times[p]
    assert (rs._scores(index, 3, doc, term, impact, False) == want).all()


def test_empty(spark, docs):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rs.search(docs([]), items).count() == 0
    assert rs.search(docs([(1, "a b")]), items.filter("false")).count() == 0
    assert rows_of(rs.search(docs([(1, None), (2, "")]), items)) == []


def test_query(spark, folder):
    got = rows_of(queries.op13_lexical_search(spark, folder))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert got == brute(rows, items) and len(got) > 100
