"""The prefix trie against dictionaries of prefixes."""

import hashlib
import random
import zlib

import pytest

from mapweave.llm import prefix_trie as pt
from mapweave.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, name int"


def order(turn):
    role, text = turn[1] or "", turn[2] or ""
    size = len(text.encode())
    digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    return turn[0] is not None, turn[0] or 0, size, digest


def brute(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((t, r, x))
    own = {c: [(r or "", x or "") for _, r, x in sorted(ts, key=order)] for c, ts in turns.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + ts[h:])
    return nodes(built)


def nodes(built):
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    kids, saved, leaves = {}, {}, {}
    for k in members:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] = saved.get(k[:d], 0) + (len(m) - 1) * (len(k[-1][1].encode()) if k else 0)
            leaves[k[:d]] = leaves.get(k[:d], 0) + (k not in kids)
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids.get(k, 0), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    texts = ["a", "b", "é", "größer", "", None, "x" * 3000, "a\x1fb"]
    rows = []
    for c in rng.sample(range(-60, 400), 150):
        for t in range(rng.choice([1, 1, 2, 5, 9, 14])):
            rows.append((c, rng.choice([t, t, t, 0, None]), rng.choice(["user", "user", None]), rng.choice(texts[: rng.choice([1, 2, 8])])))
    # a conversation of hundreds of turns, and copies of one first turn
    rows += [(500, t, "user", rng.choice("ab")) for t in range(400)]
    rows += [(600 + 5 * i, 0, "user", "hello") for i in range(80)] + [(None, 1, "user", "lost")]
    rows += rows[:5]
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "d", 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    rows = corpus(seed)
    assert rows_of(pt.prefix_trie(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("size", [1, 3, 17])
def test_blocks(spark, monkeypatch, size):
    """Small blocks, so that nearly every node lies in several."""
    rows = corpus(size)
    monkeypatch.setattr(pt, "BLOCK_ROWS", size)
    assert rows_of(pt.prefix_trie(table(spark, rows))) == brute(rows)


def test_copies_lie_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK_ROWS", 10)
    rows = [(5 * i, t, "user", "same") for i in range(95) for t in range(2)]
    found = rows_of(pt.prefix_trie(table(spark, rows)))
    assert found == brute(rows) and len(found) == 3


def test_layouts():
    """Nodes grow through all layouts and keep their children in order."""
    rng = random.Random(3)
    bytes_ = rng.sample(range(256), 256)
    node, layouts = pt.Node(b""), []
    for i, b in enumerate(bytes_):
        node.put(b, pt.Node(bytes([b])))
        layouts.append(node.layout)
        if i in (3, 15, 47, 255):
            assert [k for k, _ in node.children()] == sorted(bytes_[: i + 1])
            assert all(node.child(k).path == bytes([k]) for k in bytes_[: i + 1])
            assert all(node.child(k) is None for k in bytes_[i + 1 :])
            node.put(b, pt.Node(bytes([b])))
            assert node.count == i + 1
    assert [layouts.index(k) for k in (4, 16, 48, 256)] == [0, 4, 16, 48]


def test_tree_of_one_block():
    """All rows of one block, merged by hand, are the nodes."""
    rng = random.Random(4)
    ids = [rng.randbytes(1) + bytes(3) + rng.randbytes(16) for _ in range(300)]
    built = {i: b"".join(rng.choices(ids[: rng.choice([2, 300])], k=rng.randrange(4))) for i in range(500)}
    root = pt.Node(b"")
    pairs = sorted((k, i) for i, k in built.items())
    for key, name in pairs:
        pt.insert(root, key, name)
    rows = list(pt.walk(root, pairs[0][0], pairs[-1][0]))
    assert len(rows) == len({k[:d] for k in built.values() for d in range(0, len(k) + 1, pt.WIDTH)})
    border = {pairs[j][0][:d] for j in (0, -1) for d in range(0, len(pairs[j][0]) + 1, pt.WIDTH)}
    assert sum(r[0] is not None for r in rows) == len(border)


def test_empty(spark):
    assert pt.prefix_trie(table(spark, [])).count() == 0
    assert pt.prefix_trie(table(spark, [(None, 1, "a", "b")])).count() == 0


def test_turnless(spark):
    """A conversation that loses all its turns is a member of the root."""
    lost = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(lost, 0, "user", "a"), (lost, 1, "user", "b")]
    assert rows_of(pt.prefix_trie(table(spark, rows))) == brute(rows)
    assert brute(rows)[0][:4] == (lost, 0, None, 1)


def test_query(spark, folder):
    got = rows_of(queries.op12_prefix_trie(spark, folder))
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows) and len(got) > 30
