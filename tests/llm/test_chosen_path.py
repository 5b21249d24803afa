"""Chosen-path join against all pairs on small tables."""

import random

import numpy as np
import pytest

from mapweave.llm import chosen_path as cp
from mapweave.llm import jaccard_join as jj
from mapweave.llm import queries
from tests.llm.test_jaccard_join import corpus, shingle_set


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    joined = {i: i for i, _ in sets}

    def find(i):
        while joined[i] != i:
            i = joined[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is None or j is None or not a or not b:
                continue
            o = len(a & b)
            if 100 * o >= 85 * (len(a) + len(b) - o):
                p, q = find(i), find(j)
                joined[max(p, q)] = min(p, q)
    return sorted(((i, len(s), None if i is None else find(i), None if i is None else find(i) == i) for i, s in sets), key=repr)


def rows_of(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(docs, seed):
    rows = corpus(seed)
    assert rows_of(cp.join(docs(rows).withColumnRenamed("source", "component"))) == brute(rows)


def test_deep_trees_and_blocks(docs, monkeypatch):
    """Leaves of two sets, tiny blocks and nodes sent by shuffle give the same."""
    rows = corpus(7, 8, 25)
    monkeypatch.setattr(cp, "LEAF", 2)
    monkeypatch.setattr(cp, "FEW_NODES", 1)
    monkeypatch.setattr(cp, "PAIRS", 7)
    monkeypatch.setattr(jj, "BLOCK_SETS", 4)
    assert rows_of(cp.join(docs(rows))) == brute(rows)


def test_one_group_without_leader(docs):
    """A chain of texts, each a copy of the one before, and a shared passage."""
    rng = random.Random(5)
    words = [f"c{i}" for i in range(200)]
    rows, passage = [], [f"p{i}" for i in range(30)]
    for i in range(80):
        words = list(words)
        words[(7 * i) % 200] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join([f"d{rng.randrange(10**6)}" for _ in range(40)] + passage)) for i in range(100)]
    got = rows_of(cp.join(docs(rows)))
    assert got == brute(rows) and sum(c == 0 for _, _, c, _ in got) == 80


def test_minwise_agreement_is_similarity():
    rng = np.random.default_rng(1)
    pairs = []
    for _ in range(300):
        base = rng.integers(0, 2**63, 200).astype(np.uint64)
        pairs += [base[:185], base[15:]]
    tokens = cp.minwise(pairs)
    share = (tokens[::2] == tokens[1::2]).mean()
    assert abs(share - 0.85) < 0.01
    assert ((tokens[::2] == tokens[1::2]).sum(axis=1) >= cp.AGREE).all()
    assert not cp.minwise([np.zeros(0, np.uint64)]).any()


def test_confirm_equals_all_pairs():
    rng = np.random.default_rng(2)
    for _ in range(20):
        base = rng.integers(0, 2**63, 120).astype(np.uint64)
        sets = [np.unique(base[rng.random(120) > rng.choice([0.02, 0.1, 0.3])]) for _ in range(25)]
        names, sides = rng.integers(0, 20, 25), rng.integers(0, 2, 25)
        joined, want = jj._Joined(names), jj._Joined(names)
        for a, b in cp.confirm(sets, names, sides):
            assert 185 * len(np.intersect1d(sets[a], sets[b])) >= 85 * (len(sets[a]) + len(sets[b]))
            assert joined.union(a, b)
        for a in range(25):
            for b in range(a):
                if not (sides[a] and sides[b]) and 185 * len(np.intersect1d(sets[a], sets[b])) >= 85 * (len(sets[a]) + len(sets[b])):
                    want.union(a, b)
        assert [joined.find(i) for i in range(25)] == [want.find(i) for i in range(25)]


def test_empty_and_shared_ids(docs):
    assert cp.join(docs([])).count() == 0
    a, b = (" ".join(f"{x}{i}" for i in range(50)) for x in "ab")
    rows = [(7, a + " x"), (7, b + " y"), (1, a), (2, b), (2, b), (4, None), (None, a)]
    got = [(i, c, k) for i, _, c, k in rows_of(cp.join(docs(rows)))]
    assert sorted(got, key=repr) == sorted([(7, 1, False), (7, 1, False), (1, 1, True), (2, 1, False), (2, 1, False), (4, 4, True), (None, None, None)], key=repr)


def test_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows_of(queries.op11_near_copies(spark, folder)) == brute(rows)
