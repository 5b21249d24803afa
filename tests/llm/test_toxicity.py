"""Toxicity: dictionaries on hand-made text, accuracy on held-out rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from mapweave.llm import queries, toxicity

BAD = ["gronkulous", "flimblewad", "snorkbag"]


def corpus(n, seed=0):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice(["ta", "re", "mi", "on", "es", "ul", "go"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randrange(20, 300))]
        y = i % 5 == 0
        for _ in range(rng.randrange(3, 8) if y else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((" ".join(words), int(y)))
    return rows


def test_separates():
    model = toxicity.train(corpus(400))
    check = corpus(200, 1)
    # another vocabulary of ordinary words, the same insults
    scores = toxicity.Scorer(model).scores([toxicity._normal(t) for t, _ in check])
    y = np.array([y for _, y in check])
    assert ((scores >= 0.5) == y).mean() > 0.97


def test_only_windows_with_a_match_differ():
    """Leaving out the other windows changes nothing."""
    model = toxicity.train(corpus(400))
    scorer = toxicity.Scorer(model)
    for t, _ in corpus(40, 2):
        data = toxicity._normal(t)
        starts = toxicity._words_at(np.frombuffer(data, np.uint8))
        cells = np.unique(starts[:-1] // toxicity.WINDOW)
        every = []
        for c in cells:
            a = starts[np.searchsorted(starts, c * toxicity.WINDOW)]
            b = starts[np.searchsorted(starts, min((c + 1) * toxicity.WINDOW, len(data)))]
            every.append(scorer._saved(data[a:b]))
        assert sorted(d for d in every if d) == sorted(d for d in scorer.saved([data])[0][1] if d)


def test_one_class_or_none():
    for rows in ([], [("a b", 0)], [("a b", 1), (None, 1)]):
        model = toxicity.train(rows)
        assert (toxicity.Scorer(model).scores([b"", b"a b c"]) < 0.5).all()


def test_cases(spark, docs):
    data = corpus(300)
    rows = [(i, t) for i, (t, _) in enumerate(data)]
    labels = spark.createDataFrame([(i, None, y) for i, (_, y) in enumerate(data)] + [(None, None, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    df = docs(rows)
    model = toxicity.learn(df, labels)
    odd = docs([(1, None), (2, ""), (3, " ".join(BAD) * 3), (None, "ta re mi"), (4, "x" * 300_000), (4, "x" * 300_000), (5, ("ta re " * 50_000) + "gronkulous " * 2000)])
    odd = odd.withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in toxicity.score(odd, model).collect()}
    assert got[1].score == got[2].score < 0.5 and got[None].predicted == 0 and got[4].predicted == 0
    assert got[3].predicted == 1 and got[5].predicted == 1
    assert toxicity.score(docs([]), model).count() == 0
    assert toxicity.learn(docs([]), labels.limit(0)).own == b""


def test_query(spark, folder):
    rows = queries.op1_toxicity(spark, folder).collect()
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert len(rows) == n
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_rows(spark):
    """Labelled rows that were not learned from."""
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op1_toxicity(spark, folder).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(truth[i], r.score) for i, r in rows.items() if r.held_out and i in truth]
    pos, neg = [s for y, s in held if y], [s for y, s in held if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    # a hundred labelled toxic rows only, in four languages
    assert auc > 0.6
