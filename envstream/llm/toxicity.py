"""Toxicity by class-conditional Kneser-Ney models.

Two models of the letters of words, one learned from toxic and one from
ordinary texts. The counts of ``ORDER`` letters are kept by class; both classes
back off to the same shorter contexts, with Kneser-Ney continuation counts
(in how many different contexts an expression was seen), so what is rare in
one class is judged by what both know. The score of a word is the difference
of its two log-likelihoods. A text is measured by the difference per letter,
the same for its worst stretches, and the share of telling words; a logistic
curve over these gives the score.

All labelled rows but the held-out ones are counted. The curve is fitted on
about ``FIT_ROWS`` of them (a bounded sample), each measured by models that
leave out its own one of ``FOLDS`` parts.
Every expression keeps counts of its own, however many there are. Up to
``MOST_KEYS`` of them are sent to the tasks (24 bytes each, and 4 to 8 of an
index). Beyond, the expressions of the words that occur are scored by shuffled joins
with the counts, and the scores of the most frequent ones, up to the same number,
are sent. Only words that hold another one are scored by joins, and if there are any,
texts are shuffled once to get the scores of theirs.

Defined results: NULL and empty texts measure 0 and are scored by the curve;
repeated rows are scored each; rows without a label are scored only; without
labels of both classes every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import cache_of, modest_batches, table
from envstream.session import materialise

ORDER = 5
#: Counts of up to this many expressions are sent to all tasks; more are joined by shuffle.
MOST_KEYS = 1 << 20
#: Counts that one task makes ready to be sent.
TASK_KEYS = 1 << 16
FIT_ROWS = 20_000
FOLDS = 3
DISCOUNT = 0.75
STRETCHES = (4, 16, 64)
TELLING = 3.0
THRESHOLD = 0.7
#: Labels up to this many rows are sent to all tasks; more are joined by shuffle.
SMALL_LABELS = 1_000_000
CACHE = 200_000
#: Ratios are added up as whole numbers of this part of one.
UNIT = 1 << 24

_EDGES = re.compile(r"^\W+|\W+$")


def _bare(token):
    """The token without what is no letter, digit or underscore at its ends."""
    return token if token[0].isalnum() and token[-1].isalnum() else _EDGES.sub("", token)


def normal_words(text: str) -> list[str]:
    return [w for w in map(_bare, text.lower().split()) if w]


def remainder(doc_id, by=3):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % by


# --- counts -----------------------------------------------------------------


def _grams(word):
    padded = "\x02" * (ORDER - 1) + word + "\x03"
    return (padded[i:i + ORDER] for i in range(len(word) + 1))


def _count_grams(batches):
    """(part, text) -> expressions of this task with their counts by part, where a
    part is a fold and a class."""
    for words in _word_counts(batches):
        grams = {}
        for part, counts in enumerate(words):
            for word, n in counts.items():
                for gram in _grams(word):
                    grams.setdefault(gram, [0] * len(words))[part] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(grams), pa.string()),
             *(pa.array([v[k] for v in grams.values()], pa.int64()) for k in range(2 * FOLDS))],
            names=["gram", *_PARTS])


_PARTS = [f"{kind}{fold}" for fold in range(FOLDS) for kind in ("ordinary", "toxic")]


def _word_counts(batches, most=500_000):
    words = [Counter() for _ in _PARTS]
    for batch in batches:
        for part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words[part].update(normal_words(text))
            if sum(map(len, words)) > most:
                yield words
                words = [Counter() for _ in _PARTS]
    yield words


def _without(grams: DataFrame) -> DataFrame:
    """The expressions and their counts by class for every model: one of all folds
    (-1) and those that leave one out."""
    def model(fold):
        folds = [k for k in range(FOLDS) if k != fold]
        return F.struct(F.lit(fold).alias("model"), *(
            sum((F.col(f"{kind}{k}") for k in folds), F.lit(0)).alias(kind)
            for kind in ("toxic", "ordinary")))

    models = F.array(*(model(fold) for fold in range(-1, FOLDS)))
    return grams.select("gram", F.inline(models)).where("toxic + ordinary > 0")


def _cells(grams: DataFrame) -> DataFrame:
    """Every number of the models as (model, key, a, b): the key's first letter tells which."""
    def cell(kind, key, a, b):
        return F.struct(F.concat(F.lit(kind), key).alias("key"), *(
            F.coalesce(F.expr(v).cast("double"), F.lit(0.0)).alias(n)
            for n, v in (("a", a), ("b", b))))

    def keyed(df, *cells):
        return df.select("model", F.inline(F.array(*cells)))

    context = grams.groupBy("model", F.expr(f"left(gram, {ORDER - 1})").alias("c")).agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"),
        F.count_if(F.col("toxic") > 0).alias("types1"),
        F.count_if(F.col("ordinary") > 0).alias("types0"))
    middle = grams.groupBy("model", F.expr("right(gram, 3)").alias("g")).agg(
        F.count("*").alias("n"))
    context3 = middle.groupBy("model", F.expr("left(g, 2)").alias("c")).agg(
        F.sum("n").alias("n"), F.count("*").alias("types"))
    letters = middle.groupBy("model", F.expr("right(g, 1)").alias("g")).agg(
        F.count("*").alias("n"))
    total = letters.groupBy("model").agg(F.sum("n").alias("n"), F.count("*").alias("types"))
    parts = [
        keyed(grams, cell("g", F.col("gram"), "toxic", "ordinary")),
        keyed(context, cell("c", F.col("c"), "toxic", "ordinary"),
              cell("t", F.col("c"), "types1", "types0")),
        keyed(middle, cell("m", F.col("g"), "n", "0")),
        keyed(context3, cell("k", F.col("c"), "n", "types")),
        keyed(letters, cell("l", F.col("g"), "n", "0")),
        keyed(total, cell("n", F.lit(""), "n", "types")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h):
    h = (h ^ (h >> np.uint64(30))) * _MIX2
    return h ^ (h >> np.uint64(27))


def _hash(kind, letters, salt):
    """64 bits of expressions; ``letters`` holds one array per place."""
    with np.errstate(over="ignore"):
        h = np.full(letters[0].shape if letters else 1,
                    _mixed(np.array([ord(kind) + 256 * salt], np.uint64) * _MIX)[0], np.uint64)
        for column in letters:
            h = _mixed((h + column.astype(np.uint64) + np.uint64(1)) * _MIX)
    return h


def _hashed_rows(salt):
    """(key, a, b) -> many rows as bytes: hashes of the keys, a, b."""
    def place(batches):
        for batch in batches:
            keys = batch.column(0).to_pylist()
            hashes = np.empty(len(keys), np.uint64)
            by_form = {}
            for i, key in enumerate(keys):
                by_form.setdefault((key[0], len(key)), []).append(i)
            for (kind, n), rows in by_form.items():
                codes = np.array([[ord(c) for c in keys[i][1:]] for i in rows], np.int64)
                codes = codes.reshape(len(rows), n - 1)
                hashes[rows] = _hash(kind, [codes[:, j] for j in range(n - 1)], salt)
            yield pa.RecordBatch.from_arrays([pa.array([
                hashes.astype("<u8").tobytes() + batch.column(1).to_numpy().astype("<f8").tobytes()
                + batch.column(2).to_numpy().astype("<f8").tobytes()])], names=["part"])

    return place


class Table:
    """Counts by the hash of their expression: sorted, with an index of the upper bits."""

    def __init__(self, hashes, counts, salt=0):
        order = np.argsort(hashes)
        # Behind the last one stands one that is never taken for another.
        self._hashes = np.append(hashes[order], np.uint64(2**64 - 1))
        self._counts = np.concatenate([counts[order], np.zeros((1, 2))])
        self._salt = salt
        bits = max(1, (len(hashes) - 1).bit_length())
        self._shift = np.uint64(64 - bits)
        at = np.arange(1 << bits, dtype=np.uint64) << self._shift
        self._index = np.searchsorted(self._hashes[:-1], at).astype(np.int32)

    def look(self, kind, letters):
        """The two numbers of each expression; 0 for those that never occurred."""
        wanted = _hash(kind, letters, self._salt)
        at = self._index[(wanted >> self._shift).astype(np.int64)].astype(np.int64)
        behind = np.flatnonzero(self._hashes[at] < wanted)
        while len(behind):
            at[behind] += 1
            behind = behind[self._hashes[at[behind]] < wanted[behind]]
        found = self._counts[at]
        found[self._hashes[at] != wanted] = 0
        return found


class Joined:
    """Counts that stay in Spark: rows (key, a, b), every key once. At most
    ``most_keys`` scores made of them are sent to the tasks."""

    def __init__(self, cells: DataFrame, most_keys=MOST_KEYS):
        self.cells, self.most_keys = cells, most_keys


def _models(grams: DataFrame, most_keys: int):
    """fold (-1: none) -> the counts of all expressions without it. The cells of all
    models are worked out in one pass; at most ``most_keys`` of a model reach the driver."""
    cells = materialise(_cells(_without(grams)))
    sizes = {r.model: r["count"] for r in cells.groupBy("model").count().collect()}

    def model(fold) -> Table | Joined:
        own, n_keys = cells.where(F.col("model") == fold).drop("model"), sizes.get(fold, 0)
        if n_keys > most_keys:
            return Joined(own, most_keys)
        # Cells lie in many small parts; as many tasks as they fill read them.
        return _table(own.coalesce(n_keys // TASK_KEYS + 1), n_keys)

    return model


def _table(cells: DataFrame, n_keys: int) -> Table:
    if not n_keys:
        return Table(np.empty(0, np.uint64), np.empty((0, 2)))
    salt = 0
    while True:
        parts = [r.part for r in cells.mapInArrow(_hashed_rows(salt), "part binary").collect()]
        parts = [np.frombuffer(p, "<u8").reshape(3, -1) for p in parts]
        hashes, *counts = np.concatenate(parts, axis=1)
        if len(np.unique(hashes)) == n_keys and hashes.max() < np.uint64(2**64 - 1):
            return Table(hashes, np.stack([c.view("<f8") for c in counts], axis=1), salt)
        salt += 1


# --- scores -----------------------------------------------------------------


def _log_ratio(letter, middle, base, full, context, types, n, n_letters):
    """log P(letter | toxic) - log P(letter | ordinary) from the counts of its contexts."""
    letter = (letter + 0.5) / (n + 0.5 * n_letters + 1)
    seen = np.maximum(middle - DISCOUNT, 0)
    # An empty context says nothing: all weight goes to the shorter one.
    low = np.where(base[:, 0] > 0, (seen + DISCOUNT * base[:, 1] * letter)
                   / np.maximum(base[:, 0], 1), letter)
    logs = []
    for k in (0, 1):
        sums = context[:, k]
        top = np.maximum(full[:, k] - DISCOUNT, 0) + DISCOUNT * types[:, k] * low
        logs.append(np.log(np.where(sums > 0, top / np.maximum(sums, 1), low) + 1e-12))
    return logs[0] - logs[1]


def _letters(words):
    """For every predicted letter of some words the five that end there, one array a
    place, and the number of its word; for every word its letters."""
    texts = ["\x02" * (ORDER - 1) + w + "\x03" for w in words]
    lengths = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    inside = np.ones(len(codes), bool)
    for j in range(ORDER - 1):
        inside[starts + j] = False
    at = np.flatnonzero(inside)
    back = [codes[at - j] for j in range(ORDER - 1, -1, -1)]
    return back, np.repeat(np.arange(len(words)), lengths - (ORDER - 1)), lengths - (ORDER - 1)


class Scorer:
    def __init__(self, counts: Table):
        self._counts, self._places = counts, {}
        self._scores = np.empty((0, 2), np.int64)
        self._n, self._types = counts.look("n", [])[0]

    def _ratios(self, words):
        """log P(word | toxic) - log P(word | ordinary), and the letters."""
        back, owner, letters = _letters(words)
        look = self._counts.look
        ratio = _log_ratio(
            look("l", back[-1:])[:, 0], look("m", back[-3:])[:, 0], look("k", back[-3:-1]),
            look("g", back), look("c", back[:-1]), look("t", back[:-1]), self._n, self._types)
        return np.bincount(owner, ratio, len(words)), letters

    def measures(self, texts):
        """One row of numbers per text."""
        split = [t.lower().split() for t in texts]
        return _numbers(self._found(split), [len(words) for words in split])

    def _found(self, split):
        """The rows (ratio, letters) of all tokens, one text after the other."""
        flat = list(chain.from_iterable(split))
        new = set(flat).difference(self._places)
        if new and len(self._places) + len(new) > CACHE:
            self._places.clear()
            self._scores = self._scores[:0]
            new = set(flat)
        if new:
            self._learn(list(new))
        return self._scores[np.fromiter(map(self._places.__getitem__, flat), np.int64, len(flat))]

    def _learn(self, tokens, step=1 << 14):
        """Keeps the scores of tokens, those of their words."""
        words = [_bare(t) for t in tokens]
        known = list({w for w in words if w})
        scores = [np.zeros((1, 2), np.int64)]  # of tokens without a word
        for i in range(0, len(known), step):
            scores.append(_units(*self._ratios(known[i:i + step])))
        at = {w: i for i, w in enumerate(["", *known])}
        self._places.update(zip(tokens, range(len(self._places), len(self._places) + len(tokens))))
        self._scores = np.concatenate([
            self._scores, np.concatenate(scores)[[at[w] for w in words]]])


#: In place of a word's letters where an expression of it was not sent.
PARTLY = -1


class RatioScorer(Scorer):
    """Scores by a table of the ratios of whole expressions, which may lack some."""

    def __init__(self, ratios: Table):
        self._counts, self._places = ratios, {}
        self._scores = np.empty((0, 2), np.int64)

    def _ratios(self, words):
        back, owner, letters = _letters(words)
        found = self._counts.look("r", back)
        whole = np.bincount(owner, found[:, 1] == 0, len(words)) == 0
        return np.bincount(owner, found[:, 0], len(words)), np.where(whole, letters, PARTLY)

    def partly(self, words):
        """Those of some different words that hold an expression which was not sent."""
        return [w for w, n in zip(words, self._ratios(words)[1]) if n == PARTLY] if words else []

    def partly_of(self, texts):
        """For every text its different words of that kind."""
        split = [t.lower().split() for t in texts]
        lacking = self._found(split)[:, 1] == PARTLY
        out, first = [], 0
        for tokens in split:
            at = np.flatnonzero(lacking[first:first + len(tokens)])
            out.append(sorted({_bare(tokens[i]) for i in at}))
            first += len(tokens)
        return out

    def completed(self, texts, others):
        """As ``measures``; ``others``: for each text the rows (word, ratio, letters) of
        its words of that kind."""
        split = [t.lower().split() for t in texts]
        scores, first = self._found(split), 0
        for tokens, some in zip(split, others):
            own = scores[first:first + len(tokens)]
            at = np.flatnonzero(own[:, 1] == PARTLY)
            if len(at):
                known = {r["word"]: (r["ratio"], r["letters"]) for r in some}
                ratios, letters = np.array([known[_bare(tokens[i])] for i in at]).T
                own[at] = _units(ratios, letters.astype(np.int64))
            first += len(tokens)
        return _numbers(scores, [len(tokens) for tokens in split])


def _units(ratios, letters):
    """Rows (ratio, letters) in whole numbers, so that sums do not depend on their order."""
    return np.stack([np.rint(ratios * UNIT).astype(np.int64), letters], axis=1)


def _numbers(scores, sizes):
    """The measures of texts by the rows (ratio, letters) of all their tokens, one text
    after the other; a row without letters is no word."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    is_word = scores[:, 1] > 0
    ratio, letters = scores[is_word].T
    sizes = np.bincount(owner[is_word], minlength=len(sizes))
    ends = np.cumsum(sizes)
    sums, lengths, telling = (
        np.concatenate([[0], np.cumsum(v)]) for v in (ratio, letters, ratio > TELLING * UNIT))

    def between(low, high):
        return (sums[high] - sums[low]) / (lengths[high] - lengths[low]) / UNIT

    out = np.zeros((len(sizes), N_MEASURES))
    some = sizes > 0
    out[some, :-3] = between((ends - sizes)[some], ends[some])[:, None]
    for k, n in enumerate(STRETCHES, 1):
        longer = np.flatnonzero(sizes > n)
        if len(longer):
            counts = sizes[longer] - n + 1
            first = np.cumsum(counts) - counts
            low = np.repeat((ends - sizes)[longer] - first, counts) + np.arange(counts.sum())
            out[longer, k] = np.maximum.reduceat(between(low, low + n), first)
    found = telling[ends] - telling[ends - sizes]
    out[:, -3] = found / np.maximum(sizes, 1)
    out[:, -2] = np.log1p(found)
    out[:, -1] = np.log1p(sizes) / 10
    return out.tolist()


N_MEASURES = 1 + len(STRETCHES) + 3


def _sent(counts: Table | Joined, docs: DataFrame):
    """A table as all tasks get it."""
    if isinstance(counts, Joined):
        return counts
    return docs.sparkSession.sparkContext.broadcast(counts)


def _scorer(name, shared, kind=Scorer):
    scorers = cache_of("toxicity")
    if name not in scorers:
        scorers.clear()
        scorers[name] = kind(shared.value)
    return scorers[name]


def _measured(rows: DataFrame, counts) -> DataFrame:
    """Rows (row, text), or (row) with a field ``text`` -> (row, measures). ``counts``:
    Joined, or a Table that has been sent to all tasks."""
    if isinstance(counts, Joined):
        return _measured_by_join(rows, counts)
    return _measured_by(rows, counts, Scorer)


def _measured_by(rows: DataFrame, shared, make) -> DataFrame:
    name = uuid.uuid4().hex

    def measure(batches):
        scorer = _scorer(name, shared, make)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = part.column(1) if part.num_columns > 1 else part.column(0).field("text")
                found = scorer.measures([t or "" for t in texts.to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.float64()))],
                    names=["row", "measures"])

    kind = rows.schema["row"].dataType.simpleString()
    return modest_batches(rows).mapInArrow(measure, f"row {kind}, measures array<double>")


def _vocabulary(batches, most=300_000):
    """Texts -> the words of this task with how often they occur."""
    tokens = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            tokens.update(text.lower().split())
            if len(tokens) > most:
                yield _words_of_tokens(tokens)
                tokens = Counter()
    yield _words_of_tokens(tokens)


def _words_of_tokens(tokens):
    words = Counter()
    for token, n in tokens.items():
        if word := _bare(token):
            words[word] += n
    return pa.RecordBatch.from_arrays(
        [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())],
        names=["word", "n"])


def _grams_of_vocabulary(batches, most=300_000):
    """(word, n) -> the expressions of this task with how often they occur."""
    def made():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())],
            names=["gram", "n"])

    grams = {}
    for batch in batches:
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for gram in _grams(word):
                grams[gram] = grams.get(gram, 0) + n
            if len(grams) > most:
                yield made()
                grams = {}
    yield made()


def _grams_of_words(batches):
    """Words -> their expressions, each with how often the word has it."""
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            words, grams, times = [], [], []
            for word in batch.column(0).slice(i, 1024).to_pylist():
                found = Counter(_grams(word))
                words += [word] * len(found)
                grams += found.keys()
                times += found.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(grams, pa.string()),
                 pa.array(times, pa.int64())], names=["word", "gram", "times"])


def _gram_scores(grams: DataFrame, cells: DataFrame) -> DataFrame:
    """gram -> gram, ratio, from the counts of the gram and its contexts."""
    n, n_letters = cells.where("key = 'n'").select("a", "b").first()
    for kind, key in (("g", "gram"), ("c", f"left(gram, {ORDER - 1})"),
                      ("t", f"left(gram, {ORDER - 1})"), ("m", "right(gram, 3)"),
                      ("k", "left(right(gram, 3), 2)"), ("l", "right(gram, 1)")):
        counts = cells.where(F.expr("left(key, 1)") == kind).select(
            F.expr("substring(key, 2)").alias("_key"), F.array("a", "b").alias(kind))
        grams = grams.join(counts, F.expr(key) == F.col("_key"), "left").drop("_key")
        grams = grams.withColumn(kind, F.coalesce(kind, F.array(F.lit(0.0), F.lit(0.0))))

    def score(batches):
        for batch in batches:
            g, c, t, m, k, letter = (
                np.array(batch.column(i).to_pylist(), np.float64).reshape(-1, 2)
                for i in range(1, 7))
            ratio = _log_ratio(letter[:, 0], m[:, 0], k, g, c, t, n, n_letters)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ratio)], names=["gram", "ratio"])

    return grams.select("gram", *"gctmkl").mapInArrow(score, "gram string, ratio double")


def _most_frequent(grams: DataFrame, most: int):
    """How often the expressions must occur that are not more than ``most`` (a power of
    two), how many these are, and how many there are in all."""
    by_bits = grams.groupBy(F.length(F.bin("n")).alias("bits")).count().collect()
    sizes, bits, sent = {r.bits: r["count"] for r in by_bits}, 64, 0
    while bits > 1 and sent + sizes.get(bits - 1, 0) <= most:
        bits -= 1
        sent += sizes.get(bits, 0)
    return 1 << bits - 1, sent, sum(sizes.values())


def _measured_by_join(rows: DataFrame, counts: Joined) -> DataFrame:
    """As ``_measured``, where the counts are too many to be sent."""
    text = F.col("text") if "text" in rows.columns else F.col("row.text")
    text = F.coalesce(text, F.lit(""))
    vocabulary = materialise(modest_batches(rows).select(text.alias("text")).mapInArrow(
        _vocabulary, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    grams = materialise(vocabulary.mapInArrow(
        _grams_of_vocabulary, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    scores = materialise(_gram_scores(grams.select("gram"), counts.cells))
    least, n_sent, n_all = _most_frequent(grams, counts.most_keys)
    sent = scores if n_sent == n_all else scores.join(
        grams.where(F.col("n") >= least), "gram", "left_semi")
    sent = sent.select(
        F.concat(F.lit("r"), "gram").alias("key"), F.col("ratio").alias("a"), F.lit(1.0).alias("b"))
    shared = rows.sparkSession.sparkContext.broadcast(
        _table(sent.coalesce(n_sent // TASK_KEYS + 1), n_sent))
    if n_sent == n_all:
        return _measured_by(rows, shared, RatioScorer)
    return _measured_partly(rows, text, vocabulary, scores, shared)


def _measured_partly(rows: DataFrame, text, vocabulary, scores, shared) -> DataFrame:
    """Where not all expressions were sent: words that hold one of the others get their
    scores by joins, and texts those of their words by another. A text is known by
    its digest, so that it need not be written to get a number."""
    name = uuid.uuid4().hex

    def scorer():
        return _scorer(name, shared, RatioScorer)

    def lacking(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1 << 14):
                some = scorer().partly(batch.column(0).slice(i, 1 << 14).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], names=["word"])

    def lacking_of_texts(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = scorer().partly_of(part.column(1).to_pylist())
                keys = np.repeat(np.arange(len(found)), [len(w) for w in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(keys)), pa.array(sum(found, []), pa.string())],
                    names=["text_key", "word"])

    pieces = vocabulary.select("word").mapInArrow(lacking, "word string").mapInArrow(
        _grams_of_words, "word string, gram string, times long")
    words = materialise(pieces.join(scores, "gram").groupBy("word").agg(
        F.sum(F.col("ratio") * F.col("times")).alias("ratio"), F.sum("times").alias("letters")))
    key = F.unhex(F.md5(text.cast("binary"))).alias("text_key")
    found = modest_batches(rows).select(key, text.alias("text")).mapInArrow(
        lacking_of_texts, "text_key binary, word string").join(words, "word").groupBy(
            "text_key").agg(F.collect_set(F.struct("word", "ratio", "letters")).alias("words"))

    def measure(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                texts = part.column(2) if part.num_columns > 2 else part.column(0).field("text")
                out = scorer().completed(
                    [t or "" for t in texts.to_pylist()], part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out, pa.list_(pa.float64()))],
                    names=["row", "measures"])

    kind = rows.schema["row"].dataType.simpleString()
    whole = rows.select("*", key).join(found, "text_key", "left")
    return whole.select("row", "words", *(c for c in rows.columns if c == "text")).mapInArrow(
        measure, f"row {kind}, measures array<double>")


def _curve(features, toxic):
    """Logistic regression with weighted classes by Newton's method."""
    mean, spread = features.mean(0), features.std(0) + 1e-9
    x = np.column_stack([(features - mean) / spread, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - toxic) + 0.1 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[:-1] / spread
    return slopes, w[-1] - (slopes * mean).sum()


def fitted(docs: DataFrame, labels: DataFrame, text="text", doc_id="doc_id",
           most_keys=MOST_KEYS, fit_rows=FIT_ROWS):
    """(counts, slopes, offset) learned from the rows that are not held out, or None."""
    marks = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    marks = marks.where(remainder("doc_id") != 1)
    if marks.count() <= SMALL_LABELS:
        marks = F.broadcast(marks)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where(F.col("text").isNotNull() & (remainder("doc_id") != 1))
    rows = rows.join(marks, "doc_id")
    rows = rows.withColumn("fold", (remainder("doc_id", 3 * FOLDS) / 3).cast("int"))
    grams = rows.select((F.col("fold") * 2 + F.col("toxic")).alias("part"), "text").mapInArrow(
        _count_grams, "gram string, " + ", ".join(f"{p} long" for p in _PARTS))
    grams = materialise(grams.groupBy("gram").agg(*(F.sum(p).alias(p) for p in _PARTS)))
    model = _models(grams, most_keys)
    n = rows.select("doc_id").count()
    if n > fit_rows:
        # A share of 63 bits, so that the number holds at any n.
        rows = rows.where(
            F.shiftrightunsigned(F.xxhash64("doc_id"), 1) < int(fit_rows / n * 2**63))
    features, toxic = [], []
    for fold in range(FOLDS):
        fit = rows.where(F.col("fold") == fold).select(F.struct("toxic").alias("row"), "text")
        counts = _sent(model(fold), docs)
        for r in _measured(fit, counts).collect():
            features.append(r.measures)
            toxic.append(float(r.row.toxic))
        if not isinstance(counts, Joined):
            counts.destroy()
    if len(set(toxic)) < 2:
        return None
    return (model(-1), *_curve(np.array(features), np.array(toxic)))


def scored(docs: DataFrame, model, text="text", keep=None, into="toxicity") -> DataFrame:
    """The rows (``keep``: these columns) with ``into``: a number from 0 to 1."""
    columns = [c for c in keep or docs.columns if c != into]
    if model is None:
        return docs.select(*(F.col(f"`{c}`") for c in columns), F.lit(0.0).alias(into))
    counts, slopes, offset = model
    row = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row")
    # A row that holds the text already need not bring it twice.
    rows = docs.select(row) if text == "text" and "text" in columns else docs.select(
        row, F.col(text).alias("text"))
    sums = F.lit(float(offset))
    for i, slope in enumerate(slopes):
        sums = sums + F.col("measures")[i] * float(slope)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), sums))))
    found = _measured(rows, _sent(counts, docs))
    return found.select(*(F.col(f"row.`{c}`") for c in columns), score.alias(into))


def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, keep=["doc_id"]).select(
        "doc_id", (remainder("doc_id") == 1).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
