"""Importance resampling against a direct computation."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from mapweave.llm import quality, queries


def grams(text):
    words = [w.lower() if w.isascii() else w for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return Counter(words) + Counter(zip(words, words[1:]))


def cells(text):
    return Counter(c for part, _ in quality._cells(pa.array([text])) for c in part.tolist())


def test_cells():
    texts = ["a b a b c", "", None, "One one ONE", "x", "é É", " \n a\x0bb "] * 3
    got = list(quality._cells(pa.array(texts)))
    assert sum(len(c) for c, _ in got) == sum(sum(grams(t).values()) for t in texts)
    assert cells("a b") == cells(" A\tB ") and cells("a b c") != cells("a c b")
    # a text's cells do not depend on its neighbours
    first = got[0][1]
    for i, t in enumerate(texts):
        assert Counter(got[0][0][first[i] : first[i + 1]].tolist()) == cells(t)


def test_weights_are_log_ratios(spark, docs):
    rng = random.Random(0)
    good = [" ".join(rng.choice("the of and to in cat dog sun".split()) for _ in range(30)) for _ in range(40)]
    bad = [" ".join(rng.choice("$$ %% && !! ||".split()) for _ in range(30)) for _ in range(15)]
    rows = list(enumerate(good + bad))
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(0, 55, 2)] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    df = docs(rows)
    result, model, _ = quality.resample(df, labels)
    got = {r.doc_id: r for r in result.collect()}
    raw, target = Counter(), Counter()
    for i, t in rows:
        c = cells(t)
        raw += c
        if i < 40 and i % 2 == 0:
            target += c
    size = [sum(raw.values()), sum(target.values())]
    both = [math.log(n) + math.log(1 + quality.CELLS / size[0]) for n in size]
    added = size[1] / size[0]
    for i, t in rows:
        want = sum(n * (math.log(target[c] + added) - both[1] - math.log(raw[c] + 1) + both[0]) for c, n in cells(t).items())
        assert abs(got[i].weight - want) < 1e-9
        assert got[i].key == got[i].weight + quality.gumbel(np.array([i]))[0]
    assert all(got[i].kept == (i < 40) for i, _ in rows)
    kept = quality.keep(df.withColumnRenamed("source", "key"), labels)
    assert kept.columns == ["doc_id", "text", "lang", "key", "n_chars"]
    assert {r.doc_id for r in kept.collect()} == set(range(40))


def test_top_k(spark):
    rng = random.Random(1)
    data = [(i, round(rng.gauss(0, 1), 2)) for i in range(30_000)] + [(None, 0.5)] * 3
    df = spark.createDataFrame(data, "doc_id long, key double")
    order = sorted(data, key=lambda r: (-r[1], -(2**63) if r[0] is None else r[0]))
    for k in (1, 2, 9999, 10_001, 17_000, 29_999):
        key, id_ = quality.kth(df, k)
        assert (order[k - 1][1], order[k - 1][0]) == (key, None if id_ == -(2**63) else id_)
    assert quality.kth(df, 0)[0] == float("inf") and quality.kth(df, 40_000)[0] == float("-inf")


def test_noise():
    g = quality.gumbel(np.arange(100_000))
    assert abs(g.mean() - 0.5772) < 0.02 and abs(g.var() - math.pi**2 / 6) < 0.05


def test_cases(spark, docs):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a " * 200_000), (4, "b"), (4, "b")]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    result = quality.resample(docs(rows), none)[0].collect()
    assert len(result) == 6 and all(r.kept and r.weight == 0 for r in result)
    assert quality.resample(docs([]), none)[0].count() == 0 == quality.keep(docs([]), none).count()


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op10_quality(spark, folder).collect()}
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    good = [rows[i].kept for i, q in truth.items() if q == 1]
    bad = [rows[i].kept for i, q in truth.items() if q == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.2
