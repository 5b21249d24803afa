"""Personal data by a skip-chain conditional random field.

Fixed patterns find emails, addresses, cards and phones.  A conditional random
field then labels the words that hold a digit or ``@``: neighbouring words share
chain potentials, and equal or similar words of one document, however far
apart, share skip potentials.  Words inside pattern matches are observed; loopy
message passing carries their labels to the other words, so a number that is a
phone once is a phone throughout the document.  All other words are observed as
ordinary.

The field is trained here, by pseudo-likelihood, on a bounded sample of
documents labelled by the patterns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm.common import settle, widened

KINDS = ("email", "ip", "card", "phone")

#: documents the field is trained on, and the longest of them
SAMPLE, LONGEST = 2000, 65_536

#: rounds of message passing, share of the old message kept, and probability
#: from which a word is marked
ROUNDS, DAMPING, CERTAIN = 20, 0.3, 0.9

#: weight that equal labels of similar words have before training
SKIP_PRIOR = 6.0

#: words of one message passing
WORDS_AT_ONCE = 50_000

_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match always begins a run of digits, which keeps the search linear
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^ \t-\r]*[0-9@][^ \t-\r]*")
_SPACES = " \t\n\x0b\x0c\r"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        # the local part is the run of its characters before the sign
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the pattern matches, by kind and start."""
    out = [(0, *span) for span in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(_small(p) for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


# --------------------------------------------------------------- the field

LABELS = 1 + len(KINDS)
_DIGITS = (1, 2, 3, 4, 7, 8, 10, 13, 16, 17, 20)


def _features(word: str) -> list[float]:
    digits = sum("0" <= c <= "9" for c in word)
    dots = min(4, word.strip(".,;:!?").count("."))
    size = sum(digits >= n for n in _DIGITS)
    row = [0.0] * (1 + 5 + len(_DIGITS) + 1 + 6)
    row[0] = 1.0
    row[1 + dots] = 1.0
    row[6 + size] = 1.0
    for i, found in enumerate(("@" in word, "+" in word, "-" in word, "(" in word, any(c.isalpha() for c in word), any(not c.isalnum() and c not in "@+-()." for c in word))):
        row[7 + len(_DIGITS) + i] = float(found)
    return row


def _alike(word: str) -> str | None:
    """What similar words have in common: their letters and digits; of an
    email what comes before the first dot of its domain."""
    local, sign, domain = word.partition("@")
    if sign:
        word = local + "@" + domain.split(".")[0]
    found = "".join(c for c in word.lower() if c.isalnum() or c == "@")
    return found if len(found) >= 6 and any("0" <= c <= "9" for c in found) or sign and len(found) >= 4 else None


class Graph:
    """Words with a digit or ``@`` of some documents, their chain and skip
    edges, and the labels that the patterns give (-1: not observed)."""

    def __init__(self) -> None:
        self.rows: list[list[float]] = []
        self.spans: list[tuple[int, int, int]] = []
        self.observed: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.plain: list[tuple[float, float]] = []

    def add(self, document: int, text: str, base: list[tuple[int, int, int]]) -> None:
        marks = sorted((a, b, k + 1) for k, a, b in base)
        last: dict[str, int] = {}
        before, at, far = -1, 0, 0
        for m in _WORD.finditer(text):
            start, end = m.span()
            i = len(self.spans)
            # matches may overlap: go back as far as the longest reaches
            while at < len(marks) and marks[at][0] < end:
                far = max(far, marks[at][1])
                at += 1
            label = -1
            if far > start:
                label = next((k for a, b, k in reversed(marks[:at]) if b > start), -1)
            self.rows.append(_features(m.group()))
            self.spans.append((document, start, end))
            self.observed.append(label)
            joins = before >= 0 and not text[before:start].strip(_SPACES)
            if joins:
                self.chain.append((i - 1, i))
                self.plain[-1] = (self.plain[-1][0], 0.0)
            # a plain word, or none, beside it
            self.plain.append((0.0 if joins or not text[max(0, start - 2) : start].strip(_SPACES) and start < 2 else 1.0, 1.0 if text[end : end + 64].strip(_SPACES) else 0.0))
            key = _alike(m.group())
            if key is not None:
                if key in last:
                    self.skip.append((last[key], i))
                last[key] = i
            before = end


@dataclass
class Field:
    """Weights: of the words' features, of neighbouring labels, of equal labels
    of similar words."""

    emission: np.ndarray
    transition: np.ndarray
    skip: float


def _pairs(edges: list[tuple[int, int]]) -> np.ndarray:
    return np.array(edges, np.int64).reshape(-1, 2)


def _unary(field: Field, graph: Graph) -> np.ndarray:
    plain = np.array(graph.plain).reshape(-1, 2)
    return np.array(graph.rows) @ field.emission + plain[:, :1] * field.transition[0] + plain[:, 1:] * field.transition[:, 0]


def train(texts: list[str], rounds: int = 300, penalty: float = 1e-2) -> Field:
    """Pseudo-likelihood: every word's label given its neighbours' labels."""
    graph = Graph()
    for i, text in enumerate(texts):
        graph.add(i, text, base_spans(text))
    width = len(_features(""))
    field = Field(np.zeros((width, LABELS)), np.zeros((LABELS, LABELS)), SKIP_PRIOR)
    if not graph.spans:
        return field
    x, y = np.array(graph.rows), np.maximum(0, np.array(graph.observed))
    n = len(y)
    hot = np.eye(LABELS)[y]
    chain, skip, plain = _pairs(graph.chain), _pairs(graph.skip), np.array(graph.plain)
    left, right = np.zeros((n, LABELS)), np.zeros((n, LABELS))
    left[chain[:, 1]] = hot[chain[:, 0]]
    right[chain[:, 0]] = hot[chain[:, 1]]
    left[:, 0] += plain[:, 0]
    right[:, 0] += plain[:, 1]
    same = np.zeros((n, LABELS))
    np.add.at(same, skip[:, 0], hot[skip[:, 1]])
    np.add.at(same, skip[:, 1], hot[skip[:, 0]])
    speed = [np.zeros_like(field.emission), np.zeros_like(field.transition), 0.0]
    for _ in range(rounds):
        score = x @ field.emission + left @ field.transition + right @ field.transition.T + field.skip * same
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        off = (hot - p) / n
        slope = (
            x.T @ off - penalty * field.emission,
            left.T @ off + off.T @ right - penalty * field.transition,
            float((off * same).sum()) - penalty * (field.skip - SKIP_PRIOR),
        )
        speed = [0.9 * v + s for v, s in zip(speed, slope, strict=True)]
        field.emission += speed[0]
        field.transition += speed[1]
        field.skip = max(0.0, field.skip + float(speed[2]))
    return field


def marginals(field: Field, graph: Graph) -> np.ndarray:
    """Label probabilities of every word by loopy message passing."""
    n = len(graph.spans)
    unary = _unary(field, graph)
    observed = np.array(graph.observed)
    fixed = np.flatnonzero(observed >= 0)
    unary[fixed] = -50.0
    unary[fixed, observed[fixed]] = 0.0
    chain, skip = _pairs(graph.chain), _pairs(graph.skip)
    equal = field.skip * np.eye(LABELS)
    tables = np.concatenate([np.broadcast_to(field.transition, (len(chain), LABELS, LABELS)), np.broadcast_to(equal, (len(skip), LABELS, LABELS))])
    edges = np.concatenate([chain, skip])
    # both directions of every edge; back[i] is the other direction of i
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    tables = np.exp(np.concatenate([tables, tables.transpose(0, 2, 1)]))
    back = (np.arange(2 * len(edges)) + len(edges)) % max(1, 2 * len(edges))
    messages = np.full((2 * len(edges), LABELS), -np.log(LABELS))
    for _ in range(ROUNDS if len(edges) else 0):
        total = unary.copy()
        np.add.at(total, target, messages)
        out = total[source] - messages[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.einsum("ei,eij->ej", out, tables)
        new = np.log(new / new.sum(axis=1, keepdims=True))
        change = np.abs(new - messages).max()
        messages = DAMPING * messages + (1 - DAMPING) * new
        if change < 1e-4:
            break
    total = unary.copy()
    np.add.at(total, target, messages)
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True) if n else p


def added_spans(field: Field, texts: dict[int, str], graph: Graph, base: dict[int, list]) -> dict[int, list[tuple[int, int, int]]]:
    """Per document the spans that the field marks beside the patterns'."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    if all(o >= 0 for o in graph.observed):
        return out
    p = marginals(field, graph)
    label = p.argmax(axis=1)
    sure = (label > 0) & (p.max(axis=1) >= CERTAIN) & (np.array(graph.observed) < 0)
    joins = np.zeros(len(label), bool)
    chain = _pairs(graph.chain)
    joins[chain[:, 1]] = True
    i = 0
    for i in np.flatnonzero(sure).tolist():
        document, start, end = graph.spans[i]
        text, kind = texts[document], int(label[i]) - 1
        while start < end and not (text[start].isalnum() or text[start] in "+(@"):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        mine = out.setdefault(document, [])
        if joins[i] and sure[i - 1] and label[i - 1] == label[i] and mine and mine[-1][0] == kind:
            mine[-1] = (kind, mine[-1][1], end)
        elif start < end:
            mine.append((kind, start, end))
    return {d: s for d, s in out.items() if s}


def find_spans(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """Per text the pattern matches and all spans, both by kind and start."""
    out: list[tuple[list, list]] = [([], [])] * len(texts)
    graph, base, held = Graph(), {}, {}

    def settle_graph() -> None:
        added = added_spans(field, held, graph, base)
        for i, spans in base.items():
            out[i] = spans, sorted(spans + added.get(i, [])) if i in added else spans

    for i, text in enumerate(texts):
        if not _MARK.search(text):
            continue
        base[i], held[i] = base_spans(text), text
        graph.add(i, text, base[i])
        if len(graph.spans) > WORDS_AT_ONCE:
            settle_graph()
            graph, base, held = Graph(), {}, {}
    settle_graph()
    return out


# ------------------------------------------------------------------- Spark

SPANS = "base array<struct<kind: string, start: long, end: long>>, spans array<struct<kind: string, start: long, end: long>>"


def learn(documents: DataFrame, sample: int = SAMPLE) -> Field:
    """A field trained on at most ``sample`` documents that hold a digit or
    ``@`` (by a hash of the id), none longer than :data:`LONGEST`; of
    several such texts under one id the smallest."""
    spark = settle(documents.sparkSession)
    some = documents.filter(f"doc_id IS NOT NULL AND length(text) <= {LONGEST}").filter(F.col("text").rlike("[0-9@]"))
    ids = some.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    few = spark.createDataFrame([(r.doc_id,) for r in ids], "doc_id long").distinct()
    rows = some.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    return train([r.text for r in rows])


def find(documents: DataFrame, field: Field) -> DataFrame:
    """All columns of ``documents`` with ``base`` (pattern matches) and
    ``spans`` (those and the field's), each by kind and start.

    Places are code points, ends exclusive.  A NULL or empty text has none.
    Documents do not influence each other, so repeated rows get the same and
    no rows give none.  Columns called ``base`` or ``spans`` are replaced.
    """
    settle(documents.sparkSession)
    kept = documents.drop("base", "spans")
    schema = widened(kept, SPANS)

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = find_spans([t or "" for t in batch.column("text").to_pylist()], field)
            lists = [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in f[j]] for f in found], kind) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], schema.fieldNames())

    return kept.mapInArrow(run, schema)


def redact(documents: DataFrame, field: Field) -> DataFrame:
    """``documents`` with every span replaced by its kind in brackets, and
    ``n_chars``, if there is such a column, counted again where the text has
    changed.  Spans that overlap are replaced together, by the first one's
    kind."""
    settle(documents.sparkSession)
    schema = documents.schema
    place = schema.fieldNames().index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            changed = {}
            for i, (_, spans) in enumerate(find_spans([t or "" for t in texts], field)):
                if spans:
                    texts[i] = changed[i] = replaced(texts[i], spans)
            columns = list(batch.columns)
            if changed:
                columns[place] = pa.array(texts, columns[place].type)
                if "n_chars" in schema.fieldNames():
                    at = schema.fieldNames().index("n_chars")
                    counts = columns[at].to_pylist()
                    for i, text in changed.items():
                        counts[i] = len(text)
                    columns[at] = pa.array(counts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return documents.mapInArrow(run, schema)


def replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, end = [], 0
    for start, stop, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= end:
            out += [text[end:start], f"[{KINDS[kind].upper()}]"]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""

    def line(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))
