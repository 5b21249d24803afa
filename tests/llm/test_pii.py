"""Personal data: patterns against plain regular expressions, the field's
messages against exact sums on small graphs."""

import hashlib
import itertools
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from mapweave.llm import pii, queries

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (
                k == 0
                or (k == 1 and all(int(x) <= 255 for x in m.group().split(".")))
                or (k == 2 and 16 <= len(digits) <= 19 and luhn(digits))
                or (k == 3 and 8 <= len(digits) <= 15)
            )
            if ok:
                out.append((k, m.start(), m.end()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab0123459.@+-% ()\n_é", max_size=60))
def test_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_patterns_on_likely_texts():
    rng = random.Random(0)
    pieces = ["a.b@c.d-e.fr", "x@y", "@@", "1.2.3.4", "256.1.1.1", "0001.2.3.255.9", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "4242424242424242424", "+1 (017) 555-7713", "+12345", "+1234567890123456", "٣٤", "word", ",", " ", "\n", "7", "a@b.c@d.e"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + rng.choice(["", " ", "."]) for _ in range(rng.randrange(8)))
        assert pii.base_spans(text) == plain(text), text


def test_linear_on_long_runs():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000, "a@" * 100_000, "+1(" * 60_000, "1 " * 100_000, "+1" + "(" * 200_000, "@" * 100_000):
        pii.base_spans(text)


def exact(field, graph):
    """Marginals by summing over all labelings."""
    unary = pii._unary(field, graph)
    n = len(graph.spans)
    total = np.zeros((n, pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=n):
        if any(o >= 0 and o != y for o, y in zip(graph.observed, labels)):
            continue
        s = sum(unary[i, y] for i, y in enumerate(labels))
        s += sum(field.transition[labels[a], labels[b]] for a, b in graph.chain)
        s += field.skip * sum(labels[a] == labels[b] for a, b in graph.skip)
        for i, y in enumerate(labels):
            total[i, y] += np.exp(s)
    return total / total.sum(axis=1, keepdims=True)


def test_messages():
    rng = np.random.default_rng(0)
    width = len(pii._features(""))
    for text in ("a1 b2 c3 plain d4", "555-7713 word 555-7713 x 5557713", "+1 (017) 555-7713 word 555-7713"):
        field = pii.Field(rng.normal(0, 0.5, (width, pii.LABELS)), rng.normal(0, 0.5, (pii.LABELS, pii.LABELS)), 1.0)
        graph = pii.Graph()
        graph.add(0, text, pii.base_spans(text))
        # no loops: message passing is exact
        assert np.allclose(pii.marginals(field, graph), exact(field, graph), atol=2e-3)


TRAINING = [
    "call +1 (017) 555-7713 now", "mail 55@mail4.example.com please", "from 129.38.82.176 esnd", "card 4111 1111 1111 1111 ok", "version 2.0 of 1999",
    "chapter 12 page 345", "in 2021 there were 1000 items", "4242424242424242 paid", "+44 (020) 555-0000 or +44 (020) 555-0000", "section 3.1 and 3.2", "plain words only", "7 days 24 hours",
] * 5


def test_consistency_across_a_document():
    field = pii.train(TRAINING)
    texts = ["call +1 (017) 555-7713 today. Later she wrote 555-7713 again.", "she wrote 555-7713 once", "mail 55@mail4.example.com or 55@mail4 there", "year 1999 and 2.0"]
    got = pii.find_spans(texts, field)
    assert [texts[0][a:b] for k, a, b in got[0][1]] == ["+1 (017) 555-7713", "555-7713"]
    assert got[1] == ([], []) and got[3] == ([], [])
    assert [texts[2][a:b] for k, a, b in got[2][1]] == ["55@mail4.example.com", "55@mail4"]
    for text, (base, spans) in zip(texts, got):
        assert set(base) <= set(spans) and base == plain(text)
    # documents do not influence each other
    assert [pii.find_spans([t], field)[0] for t in texts] == got


def test_redact(spark, docs):
    field = pii.train(TRAINING)
    rows = [(1, "mail 55@mail4.example.com or +1 (017) 555-7713."), (2, None), (3, ""), (None, "é 1.2.3.4"), (4, "clean 1999"), (4, "clean 1999"), (5, "x 4111111111111111 " * 20_000)]
    df = docs(rows)
    got = {r.doc_id: r for r in pii.redact(df, field).collect()}
    assert got[1].text == "mail [EMAIL] or [PHONE]." and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[3].text == "" and got[None].text == "é [IP]" and got[4].text == "clean 1999"
    assert got[5].text == "x [CARD] " * 20_000
    assert pii.redact(df, field).schema == df.schema
    extra = df.withColumnsRenamed({"source": "spans", "lang": "base"})
    assert pii.find(extra, field).columns == ["doc_id", "text", "n_chars", "base", "spans"]
    assert pii.find(docs([]), field).count() == 0 and pii.learn(docs([])).skip == pii.SKIP_PRIOR


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op3_pii(spark, folder).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        want = plain(text)
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in want)
        assert rows[i].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == j for w in want) for j in range(4)]
        assert set(filter(None, line.split(","))) <= set(filter(None, rows[i].spans.split(",")))
        assert len(list(filter(None, rows[i].spans.split(",")))) == len(want) + rows[i].n_added
