"""Language identification: exact vectors on small texts, accuracy on held-out rows."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from mapweave.llm import language, queries


def brute(text):
    code = [0]
    for c in text:
        k = int(language._letters()[ord(c)])
        if k or code[-1]:
            code.append(k)
    if code[-1]:
        code.append(0)
    out = np.zeros(language.DIMENSIONS)
    for (a, b, c), n in Counter(zip(code, code[1:], code[2:])).items():
        if b:
            v = [language._vector(x, language.DIMENSIONS, t).astype(float) for x, t in ((a, 2), (b, 1), (c, 0))]
            out += n * v[0] * v[1] * v[2]
    return out


def test_profiles():
    texts = ["The quick brown fox", "", "12 34", "é", "größe Größe GRÖSSE", "日本語 テキスト", "a", "x\0y", "\U0001f600 ok ퟿"] * 2
    got = language.profiles(texts)
    for t, v in zip(texts, got):
        assert (v == brute(t)).all(), t


def test_many_letters():
    text = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 300))
    assert (language.profiles([text])[0] == brute(text)).all()


def test_query(spark, folder):
    rows = queries.op9_language(spark, folder).collect()
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum(r.lang_pred == truth[r.doc_id][0] for r in held)
    assert right / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_cases(spark, docs):
    rows = [(1, "the cat and the dog"), (2, None), (3, "123"), (4, ""), (None, "the dog"), (5, "le chat et le chien"), (5, "le chat et le chien")]
    df = docs(rows).withColumn("lang", F.when(F.col("doc_id") == 5, "fr").when(F.col("doc_id") == 1, "en")).withColumn("score", F.lit("x"))
    model = language.learn(df)
    assert model[0] == ["en", "fr"]
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, None, 5)] == ["en", "und", "und", "und", "en", "fr"]
    assert got[2].score == 0 and got[1].score > 0.9 and got[1].source == "s"
    none = language.learn(docs([]))
    assert none[0] == [] and {r.lang_pred for r in language.identify(df, none).collect()} == {"und"}
    assert language.identify(docs([]), model).count() == 0


def test_many_trigrams_and_long_texts(monkeypatch):
    """Sparse and dense tables, and texts in parts, give the same profiles."""
    import random


    rng = random.Random(1)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(80)) for _ in range(30)]
    texts += ["", "ab c", "Größe und Maß, " * 40, "x" * 300, "a " * 200 + "b"]
    want = language.profiles(texts)
    monkeypatch.setattr(language, "DENSE", 1)
    monkeypatch.setattr(language, "BOUND", 7)
    assert (language.profiles(texts) == want).all()
    monkeypatch.setattr(language, "LETTERS", 50)
    assert (language.profiles(texts) == want).all()
    assert all(max(map(len, parts)) <= 300 for _, parts in language._slices(texts))
    assert np.abs(want[-5]).sum() == 0


def test_memory_of_ideographs():
    """A batch of many ideographs stays far below a gigabyte."""
    import random
    import tracemalloc

    rng = random.Random(2)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(500)) for _ in range(400)]
    tracemalloc.start()
    language.profiles(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 * 2**20
