"""Benchmark decontamination against a plain edit distance."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapweave.llm import decontaminate as dc
from mapweave.llm import queries


def norm(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return b" ".join(low.encode().split())


def best(pattern, text):
    """Least edits of the whole pattern against any part of the text."""
    row = np.zeros(len(text) + 1, int)
    t, step = np.frombuffer(text, np.uint8), np.arange(len(text) + 1)
    for i, c in enumerate(pattern):
        new = np.full(len(text) + 1, i + 1)
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (t != c))
        new[0] = i + 1
        row = np.minimum.accumulate(new - step) + step
    return int(row.min())


def expected(items, text):
    out = set()
    data = norm(text)
    for i, t in items:
        if i is None or t is None:
            continue
        known = dc.index([(i, t)])
        if any(best(s.tobytes(), data) <= e for s, e in zip(known.segments, known.budgets)):
            out.add(i)
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["the", "ea", "tion", "größe", "é", "ing", "re", "of", "and"] + [f"w{i}x" for i in range(200)]

    def prose(n):
        return rng.choice([" ", "\n"]).join(rng.choice(vocab) for _ in range(n))

    items = [(i, prose(rng.randrange(12, 60))) for i in range(15)] + [(99, "tiny"), (98, None), (None, prose(20)), (97, prose(9) + "\0" + prose(9))]
    rows = []
    for i in range(60):
        text = prose(rng.randrange(0, 120))
        kind = i % 6
        if kind:
            _, passage = rng.choice(items[:15])
            if kind == 2:
                passage = passage.upper().replace(" ", "  \t")
            if kind >= 3:
                letters = list(passage)
                for _ in range(len(letters) * (kind - 2) * 3 // 100):
                    k = rng.randrange(len(letters))
                    letters[k] = rng.choice(["", "q", letters[k] + "z"])
                passage = "".join(letters)
            if kind == 5:
                passage = passage[len(passage) // 2 :]
            cut = rng.randrange(len(text) + 1)
            text = text[:cut] + rng.choice(["", " "]) + passage + rng.choice(["", " "]) + text[cut:]
        rows.append((i, text))
    return items, rows + [(60, None), (61, ""), (62, "   "), (62, "   "), (None, items[0][1])]


def test_equals_brute_force(spark, docs):
    for seed in (1, 2):
        items, rows = corpus(seed)
        bench = spark.createDataFrame(items, "item_id long, text string")
        for size in (dc.PASS_BYTES, 700):
            got = dc.find(docs(rows).withColumn("matches", F.lit(1)), bench, pass_bytes=size).collect()
            assert len(got) == len(rows)
            texts = dict(rows)
            some = 0
            for r in got:
                want = expected(items, r.text)
                assert {m.item_id for m in r.matches} == want, (r.doc_id, r.matches)
                some += bool(want)
                for m in r.matches:
                    piece = norm(texts[r.doc_id][m.start : m.end])
                    assert len(piece) >= 20 and 0 <= m.edits <= 6
            assert 20 < some < len(rows)


def test_bound_is_met_exactly():
    """A segment with as many edits as allowed is found, one more is not."""
    rng = random.Random(4)
    pattern = "".join(rng.choice("abcdefghijklmnop ") for _ in range(80)).encode()
    pattern = (b"x" + pattern[1:-1].replace(b"  ", b"uv") + b"y").replace(b"  ", b"uv")
    known = dc.index([(1, pattern.decode())])
    e = int(known.budgets[0])
    for n in range(e + 3):
        for _ in range(20):
            letters = [bytes([c]) for c in pattern]
            for k in rng.sample(range(2, 78), n):
                letters[k] = rng.choice([b"", b"Q9"[:1], letters[k] + b"7"])
            text = b"zz " * 30 + b"".join(letters) + b" zz" * 30
            data = np.frombuffer(norm(text.decode()), np.uint8)
            got = list(dc._matches(data, np.array([0, len(data)]), known))
            assert bool(got) == (best(pattern, data.tobytes()) <= e)


def test_long_and_repetitive_texts(spark, docs):
    from mapweave.llm.common import CHUNK

    rng = random.Random(5)
    item = "".join(rng.choice("abcdefgh ") for _ in range(200)).strip()
    filler = "".join(rng.choice("ijklmnop ") for _ in range(CHUNK - 100))
    rows = [(1, filler + item + filler), (2, "ab" * 200_000), (3, "x" * 300_000), (4, filler * 3)]
    bench = spark.createDataFrame([(7, item), (8, "ab" * 100)], "item_id long, text string")
    got = {r.doc_id: {m.item_id for m in r.matches} for r in dc.find(docs(rows), bench).collect()}
    assert got == {1: {7}, 2: {8}, 3: set(), 4: set()}


def test_empty(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.find(docs([(1, "a")]), none).first().matches == []
    bench = spark.createDataFrame([(1, "word " * 30)], "item_id long, text string")
    assert dc.find(docs([]), bench).count() == 0
    kept = dc.keep(docs([(1, "word " * 40), (2, "other"), (3, None)]).withColumnRenamed("source", "matches"), bench)
    assert kept.columns == ["doc_id", "text", "lang", "matches", "n_chars"] and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_query(spark, folder):
    rows = {r.doc_id: r for r in queries.op6_decontaminate(spark, folder).collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        data, whole = norm(r.text), {i for i, t in items if norm(t) in norm(r.text)}
        assert whole <= set(rows[r.doc_id]["items"])
        assert rows[r.doc_id].contaminated == bool(rows[r.doc_id]["items"])
        assert whole or not rows[r.doc_id].contaminated or expected(items, data.decode())


def test_exact_passages_at_any_offset(spark, docs):
    """An exact part of an item is found wherever it begins."""
    rng = random.Random(8)
    item = "".join(rng.choice("abcdefgh ") for _ in range(400)).replace("  ", "xy").strip()
    size = dc.EXACT + dc.STEP - 1
    other = " ".join(f"w{k}" for k in range(20))
    cuts = [item[i : i + size + 2].strip() for i in range(len(item) - size - 2)]
    rows = [(i, f"{other} {c.upper()} {other}") for i, c in enumerate(cuts)] + [(-1, other + item[:40])]
    bench = spark.createDataFrame([(7, item), (8, "w" + item[:20])], "item_id long, text string")
    got = {r.doc_id: r.matches for r in dc.find(docs(rows), bench).collect()}
    assert not got.pop(-1)
    for i, c in enumerate(cuts):
        assert len(c) >= size and [m.item_id for m in got[i]] == [7], i
        assert norm(rows[i][1][got[i][0].start : got[i][0].end]) in c.encode() and got[i][0].end - got[i][0].start >= dc.EXACT


def test_short_items(spark, docs):
    """Whole words only, from a q-gram's length on."""
    bench = spark.createDataFrame([(1, "capital of peru"), (2, "yes")], "item_id long, text string")
    rows = [(1, "the Capital  of Peru."), (2, "capital of perul"), (3, "yes"), (4, "capital of Peru"), (5, "capital of")]
    got = {r.doc_id: [m.item_id for m in r.matches] for r in dc.find(docs(rows), bench).collect()}
    assert got == {1: [1], 2: [], 3: [], 4: [1], 5: []}


@pytest.mark.parametrize("most", [200_000, 0])
def test_parts_of_the_benchmark(spark, docs, monkeypatch, most):
    """Parts are looked for one after the other, no worker waits for another,
    and give what one pass gives; also for columns with the names used inside."""
    monkeypatch.setattr(dc, "BROADCAST_TEXTS", most)
    items, rows = corpus(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = docs([*rows, *rows[:5]]).withColumn("_h1", F.lit("x")).withColumn("_found", F.lit(2))
    plain = lambda df: sorted((r.doc_id or -1, r.text or "", [tuple(m) for m in r.matches]) for r in df.collect())
    one, many = dc.find(table, bench), dc.find(table, bench, pass_bytes=700)
    assert many.columns == one.columns and many.schema["matches"].dataType == one.schema["matches"].dataType
    assert "MapInArrow" not in many._jdf.queryExecution().executedPlan().toString()
    assert plain(many) == plain(one)
    assert many.select("_h1", "_found").distinct().collect() == [("x", 2)]


def test_long_texts_in_slices(docs, spark, monkeypatch):
    """A batch is handled in slices; places count from the text's own start."""
    items, rows = corpus(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {tuple(r) for r in dc.find(docs(rows[:50]), bench).selectExpr("doc_id", "to_json(matches) m").collect()}
    monkeypatch.setattr(dc, "SLICE", 200)
    assert {tuple(r) for r in dc.find(docs(rows[:50]), bench).selectExpr("doc_id", "to_json(matches) m").collect()} == want
