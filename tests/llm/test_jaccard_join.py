"""Jaccard join against all pairs on small tables."""

import random
import re

import numpy as np
import pytest
import xxhash

from mapweave.llm import jaccard_join as jj
from mapweave.llm import queries


def shingle_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is None or j is None or not a or not b:
                continue
            o = len(a & b)
            if 100 * o >= 75 * (len(a) + len(b) - o):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def corpus(seed, n=12, copies=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["The", "of", "größe"]

    def prose(k):
        return [rng.choice(vocab) for _ in range(k)]

    common = [prose(25) for _ in range(3)]
    texts = []
    for _ in range(n):
        base = prose(rng.randrange(20, 150))
        if rng.random() < 0.6:
            base[5:5] = rng.choice(common)
        texts.append(base)
        for _ in range(rng.randrange(copies)):
            w = list(rng.choice(texts[-4:]))
            for _ in range(rng.randrange(1 + len(w) // 20)):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], ["x"], [w[k], "y"], [w[k].upper()]])
            texts.append(w)
    out = [rng.choice([" ", "\n", "\x0b "]).join(t) for t in texts]
    out += ["", None, "a b", "A  b", "a b c d", "a b c d e", " ", "q " * 50, "q " * 9]
    rng.shuffle(out)
    ids = rng.sample(range(-50, 1000), len(out))
    return list(zip(ids, out)) + [(None, out[0]), (None, None)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(docs, seed):
    rows = corpus(seed)
    got = sorted(map(tuple, jj.join(docs(rows).withColumnRenamed("source", "component")).collect()), key=repr)
    assert got == brute(rows)


def test_blocks_and_long_lists(docs, monkeypatch):
    """Tiny blocks, long lists that pass as they come, frequent shingles and
    ids joined by shuffle give the same."""
    rows = corpus(7, 6, 30)
    want = brute(rows)
    for name, value in (("BLOCK_SETS", 3), ("HELD", 4), ("FREQUENT", 2), ("BROADCAST_IDS", 1), ("COUNTED", 500)):
        monkeypatch.setattr(jj, name, value)
    assert sorted(map(tuple, jj.join(docs(rows)).collect()), key=repr) == want


def test_tree_equals_all_pairs():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sets, base = [], rng.integers(0, 10**9, 300).astype(np.uint64)
        for _ in range(60):
            s = rng.choice(base, rng.integers(1, 200), replace=False) if rng.random() < 0.5 else sets[rng.integers(len(sets))][rng.random() < 2 :] if sets else base
            keep = rng.random(len(s)) > rng.choice([0, 0.05, 0.2])
            s = np.unique(s[keep])
            sets.append(s if len(s) else base[:1])
        names = np.arange(len(sets))
        joined = jj._Joined(names)
        for a, b in jj.link(sets, names):
            o = len(np.intersect1d(sets[a], sets[b]))
            assert 7 * o >= 3 * (len(sets[a]) + len(sets[b]))
            joined.union(a, b)
        for a in range(len(sets)):
            for b in range(a):
                if 7 * len(np.intersect1d(sets[a], sets[b])) >= 3 * (len(sets[a]) + len(sets[b])):
                    assert joined.find(a) == joined.find(b)


def test_signatures_lose_nothing():
    rng = np.random.default_rng(3)
    apart = 0
    for _ in range(60):
        base = rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64)
        sets = []
        for _ in range(25):
            s = base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.3, 0.9])]
            sets.append(np.unique(np.concatenate([s, rng.integers(0, 2**63, 1 + rng.integers(0, 1 + len(base) // 5)).astype(np.uint64)])))
        sizes, names, sides = np.array([len(s) for s in sets]), rng.integers(0, 20, 25), rng.integers(0, 2, 25)
        joined = jj._Joined(names)
        for a, b in jj.plausible([jj.signature(s) for s in sets], sizes, names, sides):
            assert joined.union(a, b)
        roots = {joined.find(i) for i in range(25)}
        apart += len(roots)
        for a in range(25):
            for b in range(a):
                o = len(np.intersect1d(sets[a], sets[b]))
                if not (sides[a] and sides[b]) and 7 * o >= 3 * (sizes[a] + sizes[b]):
                    assert joined.find(a) == joined.find(b)
    assert apart > 300


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(250)]
    got = {r.key: r.component for r in jj.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    joined = jj._Joined(np.arange(401))
    for a, b in edges:
        joined.union(a, b)
    used = {k for e in edges for k in e if e[0] != e[1]}
    assert got == {k: joined.find(k) for k in used}


def test_empty(docs):
    assert jj.join(docs([])).count() == 0
    assert [tuple(r) for r in jj.join(docs([(4, "one two"), (4, "one two")])).collect()] == [(4, 1, 4)] * 2


def test_query(spark, folder):
    got = sorted(map(tuple, queries.op8_jaccard_join(spark, folder).collect()), key=repr)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert got == brute(rows)


def test_shared_ids_with_equal_hash_bits(docs):
    """Two texts under one id, one near a copy under 1, the other under 2: no
    link is lost, whatever the bits of their hashes."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")

    def bits(text):
        return xxhash.xxh64(text.encode(), seed=42).intdigest() & 0xFFFF

    found = {bits(f"{a} n{n}"): f"{a} n{n}" for n in range(2000)}
    second = next(t for t in (f"{b} m{n}" for n in range(10_000)) if bits(t) in found)
    rows = [(7, found[bits(second)]), (7, second), (1, a), (2, b), (3, "else " * 9)]
    got = sorted(map(tuple, jj.join(docs(rows)).collect()))
    assert [(i, c) for i, _, c in got] == [(1, 1), (2, 1), (3, 3), (7, 1), (7, 1)]


def test_keep_first_by_text(docs):
    """A text that shares an id with a copy, but is itself near nothing, stays."""
    a, b = (" ".join(f"{x}{i}" for i in range(50)) for x in "ab")
    rows = [(1, a), (2, a + " more"), (2, b), (2, b), (3, b + " more"), (None, a), (4, ""), (4, None)]
    kept = [(r.doc_id, r.text or "") for r in jj.keep_first(docs(rows)).collect()]
    assert sorted(kept, key=repr) == sorted([(1, a), (2, b), (None, a), (4, "")], key=repr)


def test_many_edges(spark, monkeypatch):
    """Edges beyond those of one task are joined by rounds of stars."""
    monkeypatch.setattr(jj, "FEW_EDGES", 20)
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)]
    got = {r.key: r.component for r in jj.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    joined = jj._Joined(np.arange(300))
    for a, b in edges:
        joined.union(a, b)
    assert got == {k: joined.find(k) for k in {k for e in edges for k in e if e[0] != e[1]}}


def test_no_edges(spark):
    assert jj.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
