"""Projected search against brute force."""

import numpy as np
import pytest

from mapweave.llm import neighbours as nn
from mapweave.llm import queries


def brute(ids, vectors, asked, k=5):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in asked:
        i = ids.index(q)
        c = unit @ unit[i]
        order = sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-c[j], ids[j]))[:k]
        out[q] = [(ids[j], c[j]) for j in order]
    return out


def recall(rows, want):
    hits = total = 0
    got = {}
    for r in rows:
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    for q, best in want.items():
        worst = best[-1][1]
        hits += sum(s >= worst - 1e-12 for s in got.get(q, {}).values())
        total += len(best)
    return hits / total


def test_chi_square():
    # the median and an upper point of the law with 2 degrees: -2 ln(1 - p)
    assert nn.chi_square(0.5, 2) == pytest.approx(2 * np.log(2))
    assert nn.chi_square(0.99, 2) == pytest.approx(-2 * np.log(0.01))
    d = np.random.default_rng(0).standard_normal((200_000, 12))
    assert (np.square(d).sum(axis=1) < nn.chi_square(0.95, 12)).mean() == pytest.approx(0.95, abs=0.003)


@pytest.mark.parametrize("part", [8192, 60])
def test_recall(spark, monkeypatch, part):
    monkeypatch.setattr(nn, "PART", part)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((8, 32))
    vectors = centres[rng.integers(0, 8, 1200)] + 0.4 * rng.standard_normal((1200, 32))
    vectors[300:420] = vectors[300]  # a hot vector
    ids = [int(i) * 7 - 100 for i in range(1200)]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, cell int")
    asked = ids[::10]
    rows = nn.search(df, df.filter(df.vec_id.isin(asked))).collect()
    want = brute(ids, vectors, asked)
    assert recall(rows, want) > 0.97
    by = {}
    for r in rows:
        by.setdefault(r.query_id, []).append(r)
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]
        assert sorted(found, key=lambda r: (-r.score, r.vec_id)) == found
        assert all(r.vec_id != q for r in found)
    # equal vectors: the smallest ids
    hot = [i for i in ids[300:420]]
    q = next(i for i in asked if i in hot)
    assert [r.vec_id for r in by[q]] == [i for i in hot if i != q][:5]


def test_cases(spark):
    data = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (7, [None, 1.0]), (8, [1.0, 1.0, 1.0]), (9, []), (None, [1.0, 0.0]), (50, [1e300, 1e300]), (51, [-1.0, 0.0]), (51, [0.5, 0.0]), (100, [0.0, 0.0]),
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    rows = nn.search(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in rows]
    half = round(0.5**0.5, 6)
    assert got == [(0, 1, 1, 1.0), (0, 2, 51, 1.0), (0, 3, 50, half), (0, 4, 2, 0.0), (50, 1, 0, half), (50, 2, 1, half), (50, 3, 2, half), (50, 4, 51, half)]
    none = df.limit(0)
    assert nn.search(none, none).count() == nn.search(df, none).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.1"
    data = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = [r.vec_id for r in data]
    vectors = np.array([r.embedding for r in data], np.float64)
    want = brute(ids, vectors, [i for i in ids if i % 50 == 0])
    rows = queries.op2_neighbours(spark, folder).collect()
    assert len(rows) == 5 * len(want) and recall(rows, want) > 0.95
    exact = {(q, i): s for q, best in want.items() for i, s in best}
    assert all(abs(r.score - exact[r.query_id, r.vec_id]) < 1e-12 for r in rows if (r.query_id, r.vec_id) in exact)


def test_groups_are_bounded(spark, monkeypatch):
    """Neither the vectors nor the queries of a group grow with the input, and
    blocks of queries find what one group finds."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 16)))], "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 3 = 0")
    monkeypatch.setattr(nn, "PART", 100)
    want = nn.search(df, asked).collect()
    sizes = spark.sparkContext.accumulator(0)
    most = 40

    class Counted(nn.Part):
        def __init__(self, ids, vectors, matrix):
            super().__init__(ids, vectors, matrix)
            self.asked = 0

        def search(self, *arguments):
            self.asked += 1
            if self.asked > most:
                sizes.add(1)
            return super().search(*arguments)

    monkeypatch.setattr(nn, "QUERIES", 20)
    monkeypatch.setattr(nn, "Part", Counted)
    got = nn.search(df, asked).collect()
    key = lambda r: (r.query_id, r["rank"], r.vec_id, r.score)
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert sizes.value == 0
