"""Mixing against its definition."""

import random
from collections import Counter

import pytest

from mapweave.llm import mixing


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    out = mixing.targets([10, 100, 100], [5, 2, 1])
    assert out[0] == 30 and out[1] == pytest.approx(120) and out[2] == pytest.approx(60)
    assert mixing.targets([], []) == [] and mixing.targets([0, 5], [5, 2]) == [0.0, 5.0]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permuted(n):
    import numpy as np

    out = mixing.permuted(np.arange(n), n, 5)
    assert sorted(out.tolist()) == list(range(n))
    assert n < 10 or out.tolist() != list(range(n))


def test_draws():
    slots = [9000, 500, 0, 3000]
    shards = -(-sum(slots) // mixing.SHARD)
    cuts = [mixing._draws(slots, shards, s, 3) for s in range(shards + 1)]
    assert cuts[0].tolist() == [0, 0, 0, 0] and cuts[-1].tolist() == slots
    sizes = [int((b - a).sum()) for a, b in zip(cuts, cuts[1:])]
    assert sizes == [min(mixing.SHARD, sum(slots) - s * mixing.SHARD) for s in range(shards)]
    assert all((b >= a).all() for a, b in zip(cuts, cuts[1:]))


def rows(n=400):
    rng = random.Random(1)
    out = [(i, " ".join(f"d{i}w{k}" for k in range(rng.randrange(0, 60))) + rng.choice(["", "\n", "\x0b  "]), rng.choice("aaaabc")) for i in range(n)]
    return out + [(None, "no id here", "a"), (900, None, "b"), (901, "x y z", None), (902, "", None), (903, "same", "c"), (903, "same", "c")]


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, source string")


def test_taken_is_what_the_mix_holds(spark):
    data = rows()
    df = frame(spark, data).withColumn("size", __import__("pyspark").sql.functions.lit("clash"))
    got = mixing.taken(df, block=16).collect()
    assert len(got) == len(data)
    sizes = Counter()
    for _, t, s in data:
        sizes[s] += len((t or "").encode().split())
    total = sum(sizes.values())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    share = dict(zip(names, mixing.targets([sizes[n] for n in names], [5, 2, 1, 5][: len(names)])))
    assert sum(share.values()) == pytest.approx(total)
    by_target = Counter()
    for r in got:
        assert r.taken <= 3 * r["size"]
        by_target[round(r.target, 6)] += r.taken
    for name in names:
        assert by_target[round(share[name], 6)] == pytest.approx(share[name], abs=3 * 16)
    words = Counter()
    mixed = mixing.mix(df, block=16).collect()
    for r in mixed:
        assert len(r.text.split()) <= 16
        words[r.doc_id] += len(r.text.split())
    want = Counter()
    for r in got:
        want[r.doc_id] += r.taken
    assert words == +want
    # a block is one place of the source's stream: its parts are in order
    again = mixing.mix(df, block=16).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, mixed))
    slots = {(r.shard, r.slot) for r in mixed}
    blocks = {(r.shard, r.slot, r.source, r.block_no) for r in mixed}
    assert len(slots) == len(blocks)


def test_empty(spark):
    empty = frame(spark, [])
    assert mixing.taken(empty).count() == mixing.mix(empty).count() == 0
    no_words = frame(spark, [(1, None, "a"), (2, " \n", None)])
    assert [(r.taken, r.target) for r in mixing.taken(no_words).collect()] == [(0, 0.0), (0, 0.0)]
    assert mixing.mix(no_words).count() == 0


@pytest.mark.parametrize("key", [None, 4])
def test_texts_that_share_an_id_and_16_bits(spark, key):
    """Both are in the mix, each with its own words."""
    from mapweave.llm.common import keyed

    known, pair = {}, None
    for r in keyed(frame(spark, [(None, f"a{i} b{i} c{i}", "s") for i in range(2000)])).collect():
        if known.setdefault(r.tid, r.text) != r.text:
            pair = known[r.tid], r.text
    mixed = mixing.mix(frame(spark, [(key, t, "s") for t in pair]), block=4).collect()
    assert sorted(w for r in mixed for w in r.text.split()) == sorted(" ".join(pair).split())


def test_small_sources_come_near_their_targets(spark):
    """Sources of less than a block take what their targets say."""
    for sizes in ([200, 150, 400], [40, 5000, 9], [1, 2, 3], [30_000, 700, 60]):
        data = [(100 * k + i, " ".join(["w"] * len(range(i, n, 10))), "abc"[k]) for k, n in enumerate(sizes) for i in range(10)]
        got = mixing.taken(frame(spark, data)).collect()
        want = mixing.targets(sizes, [5, 2, 1])
        used = [sum(r.taken for r in got if r.source_size == n and r.target == t) for n, t in zip(sizes, want)]
        for n, t, u in zip(sizes, want, used):
            assert abs(u - t) <= 1 + 0.01 * n, (sizes, want, used)
        mixed = mixing.mix(frame(spark, data)).collect()
        assert sum(len(r.text.split()) for r in mixed) == sum(used)
