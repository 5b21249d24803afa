"""The pipeline's stages against brute force on a small corpus."""

import random
import re

import pytest

import corpus_pipeline as cp
from mapweave.llm import mixing, pii
from tests.llm.test_jaccard_join import brute


def words(rng, n):
    return [rng.choice(["the", "of", "and", "to", "in"] + ["".join(rng.choice(["ta", "re", "mi", "on"]) for _ in range(3)) for _ in range(8)]) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, 25))) for i in range(4)]
    rows, kind = [], {}
    for i in range(120):
        w, k = words(rng, rng.randrange(30, 120)), "clean"
        if i % 12 == 5:
            w, k = [x + rng.choice(["%%%", "&&&", "$$$"]) for x in w], "bad"
        elif i % 12 == 7:
            w[10:10], k = items[i % 4][1].split(), "leak"
        elif i % 12 == 9:
            w[10:10], k = ["a.b@mail.example.com", "+1", "(017)", "555-7713"], "private"
        elif i % 12 == 11:
            w, k = rows[i - 11][1].split(), "copy"
            w[3] = "edit"
        rows.append((i, " ".join(w)))
        kind[i] = k
    return rows, kind, items


def test_stages(spark, docs, table, corpus):
    rows, kind, items = corpus
    labels = spark.createDataFrame([(i, int(kind[i] != "bad"), 0) for i, _ in rows if i % 3], "doc_id long, quality int, toxic int")
    folder = table(documents=docs(rows), labels=labels, benchmark=spark.createDataFrame(items, "item_id long, text string"))
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "benchmark", "personal_data", "mixture"]
    now, columns = spark.read.parquet(f"{folder}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, now, folder)
        assert out.columns == columns
        before = {r.doc_id: r.text for r in now.collect()}
        now = spark.createDataFrame(out.collect(), now.schema)
        after = kept[name] = {r.doc_id: r.text for r in now.collect()}
        if name == "quality":
            assert set(after) == {i for i in before if kind[i] != "bad"}
        elif name == "near_duplicates":
            first = brute(list(before.items()))
            assert set(after) == {i for i, _, c in first if i == c}
            assert not any(kind[i] == "copy" for i in after)
        elif name == "benchmark":
            assert set(after) == {i for i in before if kind[i] != "leak"}
        else:
            assert set(after) == set(before)
            for i, text in before.items():
                spans = pii.base_spans(text)
                assert (after[i] == text) == (not spans)
                assert re.search("555-7713|@", after[i]) is None
    mixed = cp.mixture(spark, now, folder).collect()
    size = {i: len(t.split()) for i, t in kept["personal_data"].items()}
    used = {}
    for r in mixed:
        used[r.doc_id] = used.get(r.doc_id, 0) + len(r.text.split())
    assert all(n <= 3 * size[i] for i, n in used.items())
    assert sum(used.values()) == pytest.approx(sum(size.values()), abs=2 * mixing.BLOCK)
    assert sorted(map(repr, cp.run(spark, folder).collect())) == sorted(map(repr, mixed))


def test_cases(spark, docs, table):
    """Nulls, empty texts, repeated rows and clashing columns in every stage."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (1, text + " other"), (2, text), (None, text), (None, None), (3, None), (4, ""), (5, "mail a@b.cd x"), (5, "mail a@b.cd x")]
    df = docs(rows).withColumnRenamed("lang", "weight").withColumnRenamed("n_chars", "key")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = table(documents=df, labels=none, benchmark=spark.createDataFrame([(1, None)], "item_id long, text string"))
    now = spark.read.parquet(f"{folder}/documents.parquet")
    counts = []
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, now, folder)
        assert out.columns == df.columns
        now = spark.createDataFrame(out.collect(), now.schema)
        counts.append(now.count())
    # of 1 (three rows) and 2 one row stays, of 5 one, and all without id
    assert counts == [10, 6, 6, 6]
    assert {r.doc_id for r in now.collect()} == {1, None, 3, 4, 5}
    assert cp.mixture(spark, now, folder).count() > 0


def test_empty(spark, docs, table):
    folder = table(documents=docs([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert cp.run(spark, folder).count() == 0


def test_on_given_tables(spark, folder):
    rows = cp.run(spark, folder).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    left = {r.doc_id for r in rows}
    assert left <= set(texts)
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert not any(i in " ".join(texts[d].split()) for d in left for i in items)
    assert sum(labels.get(d) == 0 for d in left) <= 0.3 * sum(q == 0 for q in labels.values())
