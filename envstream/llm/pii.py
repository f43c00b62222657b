"""Personal data by patterns and a skip-chain conditional random field.

Fixed patterns find mail addresses, IP addresses, card and phone numbers; what
they find stays. A random field over the tokens that hold a digit or an ``@``
adds to it. Its labels are the four kinds and none. Node potentials come from
the token's shape; neighbours in the text share a chain potential; repeated
tokens, and tokens with the same digits, share a skip potential with the
occurrence before, however far away. Loopy message passing makes the labels of
one document agree. Tokens of one label in a row become one span.

Weights are learned piecewise from what the patterns mark in a bounded sample
of about ``FIT_DOCS`` different texts with such tokens: shapes by softmax regression,
the two edge potentials from how often the two ends agree.

Defined results: NULL and empty texts have no spans; repeated rows are read
each; without anything to learn from, the base spans are all; an empty table
gives no rows. Time and memory are linear in the text: every edge list holds at
most two edges per token.
"""

from __future__ import annotations

import re
from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import modest_batches, table
from envstream.session import materialise

KINDS = ("email", "ip", "card", "phone")
FIT_DOCS = 4000
FIT_TOKENS = 60_000
SURE = 0.9
ROUNDS = 12
DAMPING = 0.5

Span = namedtuple("Span", "kind begin end")

# --- base -------------------------------------------------------------------

_LOCAL = "[A-Za-z0-9._%+-]"
_MAIL = re.compile(_LOCAL + r"++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Inside a run of such characters no later start matches where the first does not.
_MAIL_BEGIN = re.compile(f"(?<!{_LOCAL}){_MAIL.pattern}")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _mails(text):
    at = 0
    while "@" in text[at:at + 1] or text.find("@", at) >= 0:
        found = _MAIL.match(text, at) or _MAIL_BEGIN.search(text, at)
        if not found:
            return
        yield Span("email", *found.span())
        at = found.end()


def _small(part):
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then by place."""
    spans = list(_mails(text))
    spans += [Span("ip", *m.span()) for m in _IP.finditer(text)
              if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(Span("card", *m.span()))
    spans += [Span("phone", *m.span()) for m in _PHONE.finditer(text)
              if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15]
    return spans


# --- the field --------------------------------------------------------------

_TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_EDGE = re.compile(r"^[^A-Za-z0-9+(]+|[^A-Za-z0-9)]+$")
N_LABELS = len(KINDS) + 1


class Tokens:
    """The tokens of a text with their shapes and edges."""

    def __init__(self, text):
        self.places, self.words = [], []
        for m in _TOKEN.finditer(text):
            word = m.group()
            kept = _EDGE.sub("", word)
            begin = m.start() + (word.find(kept) if kept else 0)
            kept = kept or word
            self.places.append((begin, begin + len(kept)))
            self.words.append(kept)
        self._between = [
            len(text[a:b].split()) == 0 if b - a < 8 else False
            for (_, a), (b, _) in zip(self.places, self.places[1:])
        ]

    def shapes(self):
        near = [False, *self._between, False]
        return np.array([_shape(w, near[i], near[i + 1]) for i, w in enumerate(self.words)],
                        np.float64).reshape(len(self.words), N_SHAPES)

    def chain(self):
        return [(i, i + 1) for i, close in enumerate(self._between) if close]

    def skips(self):
        """Every token with the one before that repeats it or has its digits."""
        last, edges = {}, set()
        for i, word in enumerate(self.words):
            digits = _NO_DIGIT.sub("", word)
            for key in ([word.lower()] if len(word) > 3 else []) + (
                    [digits] if len(digits) >= 7 else []):
                if key in last:
                    edges.add((last[key], i))
                last[key] = i
        return sorted(edges)

    def labels(self, spans):
        """0: none, k: the first kind whose span meets the token."""
        out = np.zeros(len(self.words), np.int64)
        for k in range(len(KINDS), 0, -1):
            own = sorted((s.begin, s.end) for s in spans if s.kind == KINDS[k - 1])
            j = 0
            for i, (begin, end) in enumerate(self.places):
                while j < len(own) and own[j][1] <= begin:
                    j += 1
                if j < len(own) and own[j][0] < end:
                    out[i] = k
        return out


def _shape(word, joined_before, joined_after):
    digits = _NO_DIGIT.sub("", word)
    n, dots = len(digits), word.count(".")
    return [
        1, "@" in word, "@" in word and "." in word.rpartition("@")[2], dots == 0, dots in (1, 2),
        dots == 3, dots > 3, 0 < n < 4, 3 < n < 7, 6 < n < 9, 8 < n < 13, 12 < n < 20, n > 19,
        word.startswith("+"), "(" in word, "-" in word, n == len(word),
        12 < n < 20 and luhn(digits), dots == 3 and all(map(_small, word.split(".")))
        and n + 3 == len(word), any(c.isalpha() for c in word), joined_before, joined_after,
    ]


N_SHAPES = 22


class Field:
    def __init__(self, weights, chain, skip):
        self.weights, self.chain, self.skip = weights, chain, skip

    def beliefs(self, tokens: Tokens):
        """Label probabilities by sum-product messages on the loopy graph."""
        node = tokens.shapes() @ self.weights
        node -= node.max(1, keepdims=True)
        edges = [(a, b, 0) for a, b in tokens.chain()] + [(a, b, 1) for a, b in tokens.skips()]
        if not edges:
            p = np.exp(node)
            return p / p.sum(1, keepdims=True)
        a, b, kind = np.array(edges).T
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        tables = np.stack([self.chain, self.skip])[kind]
        # Backward messages take the tables the other way round.
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        m = len(edges)
        back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        messages = np.zeros((2 * m, N_LABELS))
        for _ in range(ROUNDS):
            sums = node.copy()
            np.add.at(sums, target, messages)
            out = (sums[source] - messages[back])[:, :, None] + tables
            top = out.max(1, keepdims=True)
            new = np.log(np.exp(out - top).sum(1)) + top[:, 0]
            new -= new.max(1, keepdims=True)
            messages = DAMPING * messages + (1 - DAMPING) * new
        sums = node.copy()
        np.add.at(sums, target, messages)
        p = np.exp(sums - sums.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def spans(self, text, base):
        """The base spans and those of confident tokens that no base span meets."""
        tokens = Tokens(text)
        if not tokens.words:
            return base
        p = self.beliefs(tokens)
        label = np.where(p.max(1) >= SURE, p.argmax(1), 0)
        label[tokens.labels(base) > 0] = 0
        joined = {i for i, _ in tokens.chain()}
        found, i = list(base), 0
        while i < len(label):
            j = i
            while j in joined and label[i] and label[j + 1] == label[i]:
                j += 1
            if label[i]:
                found.append(Span(KINDS[label[i] - 1], tokens.places[i][0], tokens.places[j][1]))
            i = j + 1
        return sorted(found, key=lambda s: (KINDS.index(s.kind), s.begin, s.end))


def _softmax_weights(shapes, labels, steps=400, rate=0.5, keep=1e-3):
    w = np.zeros((shapes.shape[1], N_LABELS))
    goal = np.eye(N_LABELS)[labels]
    speed = np.zeros_like(w)
    for _ in range(steps):
        z = shapes @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - rate * (shapes.T @ (p - goal) / len(shapes) + keep * w)
        w += speed
    return w


def _agreement(counts):
    """log of how much more often two labels meet than by chance."""
    joint = (counts + counts.T) / 2 + 0.5
    joint /= joint.sum()
    alone = joint.sum(1)
    return np.clip(np.log(joint / np.outer(alone, alone)), -3, 3)


def _observed(batches):
    """(text, hash) -> shapes and labels of its tokens, counts of label pairs, hash."""
    for batch in batches:
        for i, text in enumerate(batch.column(0).to_pylist()):
            tokens = Tokens(text)
            labels = tokens.labels(base_spans(text))
            pairs = np.zeros((2, N_LABELS, N_LABELS), np.int64)
            for k, edges in enumerate((tokens.chain(), tokens.skips())):
                for a, b in edges:
                    pairs[k, labels[a], labels[b]] += 1
            # Equal tokens of one document teach no more than one of them.
            rows = {tuple(map(int, s)) + (int(y),) for s, y in zip(tokens.shapes(), labels)}
            yield pa.RecordBatch.from_arrays([
                pa.array([[list(r) for r in sorted(rows)]], pa.list_(pa.list_(pa.int32()))),
                pa.array([pairs.reshape(-1).tolist()], pa.list_(pa.int64())),
                batch.column(1).slice(i, 1),
            ], names=["tokens", "pairs", "h"])


def fitted(docs: DataFrame, text="text", fit_docs=FIT_DOCS, fit_tokens=FIT_TOKENS) -> Field | None:
    rows = modest_batches(docs).select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    n = hashed.select("h").distinct().count()
    if n > fit_docs:
        # A share of 63 bits, so that the number holds at any n.
        hashed = hashed.where(F.shiftrightunsigned("h", 1) < fit_docs * (1 << 63) // n)
    # Equal texts teach once, before they travel.
    hashed = hashed.groupBy("text").agg(F.first("h").alias("h"))
    seen = materialise(modest_batches(hashed).mapInArrow(
        _observed, "tokens array<array<int>>, pairs array<bigint>, h bigint"))
    pairs = np.zeros(2 * N_LABELS * N_LABELS)
    sums = seen.select(F.posexplode("pairs").alias("at", "n")).groupBy("at").agg(F.sum("n"))
    for at, total in sums.collect():
        pairs[at] = total
    shapes = []
    # In the order of another hash, so that what is cut off hangs on no partition.
    for row in seen.orderBy(F.xxhash64("h"), "h").select("tokens").toLocalIterator():
        if len(shapes) >= fit_tokens:
            break
        shapes += row.tokens
    data = np.array(shapes, np.int64).reshape(len(shapes), N_SHAPES + 1)
    if not data[:, -1].any():
        return None
    chain, skip = pairs.reshape(2, N_LABELS, N_LABELS)
    weights = _softmax_weights(data[:, :-1].astype(np.float64), data[:, -1])
    return Field(weights, _agreement(chain), _agreement(skip))


def found_spans(docs: DataFrame, field: Field | None, text="text", keep=None,
                into="pii") -> DataFrame:
    """The rows (``keep``: these columns) with ``into``: base and all spans, each an
    array of (kind, begin, end) in characters, by kind as listed, then place."""
    columns = [c for c in keep or docs.columns if c != into]
    span = "array<struct<kind:string,begin:int,end:int>>"
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    spans_type = pa.list_(pa.struct([
        ("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def find(batches):
        some = re.compile("[0-9@]")
        for batch in batches:
            base, every = [], []
            for body in batch.column(1).to_pylist():
                own = base_spans(body) if some.search(body) else []
                more = field.spans(body, own) if field and some.search(body) else own
                base.append([s._asdict() for s in own])
                every.append([s._asdict() for s in more])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, spans_type), pa.array(every, spans_type)],
                names=["row", "base", "spans"])

    found = rows.mapInArrow(find, f"row {kind}, base {span}, spans {span}")
    return found.select(*(F.col(f"row.`{c}`") for c in columns),
                        F.struct("base", "spans").alias(into))


def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def op10_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = found_spans(docs, fitted(docs), keep=["doc_id"])
    kinds = F.col("pii.base.kind")
    # An array without one kind is shorter by the number of its elements.
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long")
              .alias(f"n_{kind}") for kind in KINDS]
    return rows.select(
        "doc_id", *counts,
        F.sha2(_listed(F.col("pii.base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("pii.spans")).alias("spans"))
