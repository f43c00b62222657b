"""Substring dedup: words covered by windows that occur earlier are removed.

A window is ``WINDOW`` words. Each window belongs to its anchor, the smallest
hash among its ``GRAM``-word grams; equal windows have equal anchors. Anchors
that occur once cannot belong to a repeated window and are left alone. Around
the others a document is cut into passages, one for each stretch of windows
with one anchor, and a passage goes to the shard of its anchor. So every
shard's FM-index holds all windows that may be equal, and the passages are
streamed through it: matching statistics give for each window the interval of
its occurrences, and the earliest of these tells whether the window is removed.

Anchors that occur more than ``HOT`` times are dealt out further: each window
is a passage of its own and goes by its own hash. Equal passages of one task
travel once, by their earliest occurrence; the later ones are removed whole.

A match never starts again in the middle of a match that fails (``match``
begins anew); here every passage is indexed, so none fails.

Defined results: NULL and empty texts have no words; rows with equal ids are
at one place in the order, so neither is earlier where both start alike; a
NULL id comes before all others; an empty table gives no rows. A shard's index
takes some 60 bytes a word while it is built.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import compress, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import modest_batches, table
from envstream.llm.fmindex import FmIndex
from envstream.llm.jaccard import mix, packed, unpacked
from envstream.session import materialise

WINDOW = 20
GRAM = 4
HOT = 2048
SHARD_WORDS = 1_000_000
BUCKET_ENTRIES = 500_000
FLUSH_BYTES = 8 << 20
NO_ID = -(2**63)
_U = np.uint64
_PLACE = _U((1 << 28) - 1)



def anchors(words, window=WINDOW):
    """(hash of the gram at each place, place of each window's anchor)."""
    # A hash takes less time than a look into a table of the words met.
    h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    if len(h) < window:
        return h[:0], np.empty(0, np.int64)
    gram = np.zeros(len(h) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        gram = mix(gram + h[j:len(h) - GRAM + 1 + j] + _U(j + 1))
    # The place in the low bits makes the leftmost of equal grams the smallest.
    low = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    span, have = window - GRAM + 1, 1
    while have < span:
        by = min(have, span - have)
        low = np.minimum(low[:len(low) - by], low[by:])
        have += by
    return gram, (low & _PLACE).astype(np.int64)


def row_id(doc, text):
    return F.xxhash64(doc, text)


def words_of(text):
    return (text or "").encode().split()


# --- which anchors are repeated ---------------------------------------------


def _posted(n_buckets, window):
    def post(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                yield _entries(batch.slice(i, 1024), n_buckets, window)

    return post


def _entries(part, n_buckets, window):
    docs, rows = part.column(0).to_numpy(), part.column(1).to_numpy()
    fps = []
    for text in part.column(2).to_pylist():
        gram, places = anchors(words_of(text), window)
        fps.append(gram[np.unique(places)] >> _U(24))
    owner = np.repeat(np.arange(len(docs)), [len(f) for f in fps])
    fps = np.concatenate(fps) if fps else np.empty(0, np.uint64)
    bucket = ((fps >> _U(8)) * _U(n_buckets) >> _U(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    out = []
    for b in range(n_buckets):
        at = order[cuts[b]:cuts[b + 1]]
        if len(at):
            who, n = np.unique(owner[at], return_counts=True)
            out.append((b, packed(fps[at] << _U(24), 5), docs[who].tobytes(),
                        rows[who].tobytes(), n.astype("<u4").tobytes()))
    return pa.RecordBatch.from_arrays([
        pa.array([o[0] for o in out], pa.int32()),
        *(pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3, 4)),
    ], names=["bucket", "fps", "docs", "rows", "counts"])


def _repeated(hot):
    def read(batches):
        held, current = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != current:
                    if held:
                        yield _of_bucket(held, hot)
                    held, current = [], row["bucket"]
                held.append(row)
        if held:
            yield _of_bucket(held, hot)

    return read


def _of_bucket(held, most):
    """The repeated anchors of each row, hot ones marked."""
    fps = np.concatenate([unpacked(r["fps"], 5) for r in held])
    counts = [np.frombuffer(r["counts"], "<u4") for r in held]
    docs = np.concatenate([np.repeat(np.frombuffer(r["docs"], np.int64), c)
                           for r, c in zip(held, counts)])
    rows = np.concatenate([np.repeat(np.frombuffer(r["rows"], np.int64), c)
                           for r, c in zip(held, counts)])
    order = np.argsort(fps, kind="stable")
    ordered = fps[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    runs = np.diff(np.append(first, len(ordered)))
    df = np.empty(len(fps), np.int64)
    df[order] = np.repeat(runs, runs)
    kept = np.flatnonzero(df > 1)
    kept = kept[np.lexsort((rows[kept], docs[kept]))]
    fps, docs, rows, hot = fps[kept], docs[kept], rows[kept], df[kept] > most
    new = np.flatnonzero(np.concatenate(
        [[True], (docs[1:] != docs[:-1]) | (rows[1:] != rows[:-1])])) if len(kept) else []
    ends = np.append(new[1:], len(kept)) if len(kept) else []
    marked = (fps << _U(1)) | hot.astype(np.uint64)
    return pa.RecordBatch.from_arrays([
        pa.array(docs[new] if len(kept) else [], pa.int64()),
        pa.array(rows[new] if len(kept) else [], pa.int64()),
        pa.array([marked[a:b].astype(np.int64) for a, b in zip(new, ends)],
                 pa.list_(pa.int64())),
    ], names=["doc", "row", "anchors"])


# --- passages ---------------------------------------------------------------

_PASSAGE = "shard int, passage binary, doc long, row long, start int, n int"


class _Passages:
    """Passages of a task; equal ones are kept by their earliest occurrence."""

    def __init__(self, n_shards):
        self._n_shards, self._kept, self._gone, self.n_bytes = n_shards, {}, [], 0

    def add(self, key, data, doc, row, start, n):
        place = (doc, start, row)
        old = self._kept.get((key, data, None))
        self.n_bytes += 100
        if old is None:
            self._kept[key, data, None] = (place, n)
            self.n_bytes += len(data) + 100
            return
        first, later = (old[0], place) if old[0] <= place else (place, old[0])
        self._kept[key, data, None] = (first, n)
        if later[:2] != first[:2]:
            self._gone.append((*later, n))
        elif later[2] != first[2]:
            # Two rows at one place: the other has to be judged by itself.
            self._kept[key, data, later[2]] = (later, n)

    def batch(self):
        out = [(key % self._n_shards, data, p[0], p[2], p[1], n)
               for (key, data, _), (p, n) in self._kept.items()]
        out += [(abs(row) % self._n_shards, None, doc, row, start, n)
                for doc, start, row, n in self._gone]
        self._kept, self._gone, self.n_bytes = {}, [], 0
        kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        columns = zip(*out) if out else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)],
            names=["shard", "passage", "doc", "row", "start", "n"])


def _cut(n_shards, window):
    def cut(batches):
        kept = _Passages(n_shards)
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for doc, row, text, marked in zip(*(c.to_pylist() for c in columns)):
                _cut_one(kept, doc, row, text, marked, window)
                if kept.n_bytes > FLUSH_BYTES:
                    yield kept.batch()
        yield kept.batch()

    return cut


def _cut_one(kept, doc, row, text, marked, window):
    words = words_of(text)
    gram, places = anchors(words, window)
    marked = np.unique(np.array([m for part in marked for m in part], np.int64))
    fps = (gram >> _U(24)).astype(np.int64)[places]
    at = np.minimum(np.searchsorted(marked >> 1, fps), len(marked) - 1)
    wanted = (marked >> 1)[at] == fps
    hot = wanted & ((marked & 1)[at] == 1)
    # A stretch ends where the anchor changes or windows are not wanted.
    new = np.ones(len(places), bool)
    new[1:] = (places[1:] != places[:-1]) | hot[1:]
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(places))
    for a, b in zip(begins.tolist(), ends.tolist()):
        if wanted[a]:
            data = b" ".join(words[a:b + window - 1])
            key = xxhash.xxh3_64_intdigest(data) if hot[a] else int(fps[a])
            kept.add(key, data, doc, row, a, b - a + window - 1)


# --- shards -----------------------------------------------------------------

_GONE = (pa.int64(), pa.int64(), pa.int32(), pa.int32())


def _gone(doc, row, begin, end):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip((doc, row, begin, end), _GONE)],
        names=["doc", "row", "begin", "end"])


def _searched(window):
    def search(batches):
        held, current = [], None
        for batch in batches:
            # What is removed whole needs no search.
            whole = pc.is_null(batch.column(1))
            doc, row, start, n = batch.filter(whole).columns[2:]
            yield _gone(doc, row, start, pc.add(start, n))
            rest = batch.filter(pc.invert(whole))
            for shard, *passage in zip(*(c.to_pylist() for c in rest.columns[:5])):
                if shard != current:
                    yield from _of_shard(held, window)
                    held, current = [], shard
                held.append(passage)
        yield from _of_shard(held, window)

    return search


def _of_shard(held, window):
    if held:
        yield _gone(*_repeats(held, window))


def _repeats(passages, window):
    """Stretches of words of the passages that an earlier window covers."""
    numbers, text, starts, lengths = defaultdict(count(1).__next__), [], [], []
    passages, docs, rows, first = zip(*passages)
    for passage in passages:
        words = passage.split()
        starts.append(len(text))
        lengths.append(len(words))
        text.extend(map(numbers.__getitem__, words))
        text.append(0)
    text, starts, lengths = np.array(text, np.int64), np.array(starts), np.array(lengths)
    index = FmIndex(text, len(numbers), window)
    # Where in the corpus each place of the text is, as one number that orders places.
    docs, rows, first = (np.array(c, np.int64) for c in (docs, rows, first))
    rank = np.unique(docs, return_inverse=True)[1]
    inside = np.arange(len(text)) - np.repeat(starts, lengths + 1)
    place = (np.repeat(rank, lengths + 1) << 32) + np.repeat(first, lengths + 1) + inside
    place[inside > np.repeat(lengths, lengths + 1) - window] = np.iinfo(np.int64).max
    groups = np.flatnonzero(np.concatenate([[True], index.group[1:] != index.group[:-1]]))
    earliest = np.minimum.reduceat(place[index.suffixes], groups)
    passage, at, low, _ = index.match(starts, lengths)
    later = earliest[index.group[low]] < place[starts[passage] + at]
    passage, at = passage[later], at[later]
    order = np.lexsort((at, passage))
    passage, at = passage[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (passage[1:] != passage[:-1]) | (at[1:] != at[:-1] + 1)
    begins = np.flatnonzero(new)
    lasts = np.append(begins[1:], len(at))[:len(begins)] - 1
    which = passage[begins]
    begin, end = first[which] + at[begins], first[which] + at[lasts] + window
    return docs[which], rows[which], begin.astype(np.int32), end.astype(np.int32)


# --- the whole --------------------------------------------------------------


def _kept_rows(with_text):
    def keep(batches):
        for batch in batches:
            found, texts, spans = [], batch.column(1).to_pylist(), batch.column(2)
            begins, ends = (spans.flatten().field(k).to_numpy() for k in ("begin", "end"))
            sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
            cuts = np.cumsum(sizes).tolist()
            for text, size, last in zip(texts, sizes.tolist(), cuts):
                words, n_gone = words_of(text), 0
                n_words = len(words)
                if size:
                    gone = (np.bincount(begins[last - size:last], minlength=n_words + 1)
                            - np.bincount(ends[last - size:last], minlength=n_words + 1))
                    left = np.cumsum(gone)[:-1] <= 0
                    n_gone = n_words - int(np.count_nonzero(left))
                    words = compress(words, left.tobytes())
                kept = b" ".join(words)
                found.append((n_words, n_gone, hashlib.sha256(kept).hexdigest(),
                              kept.decode() if with_text else None))
            columns = list(zip(*found)) if found else [[]] * 4
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                *([pa.array(columns[3], pa.string())] if with_text else []),
            ], names=["doc", "n_words", "n_removed", "kept_sha256"]
                + (["kept"] if with_text else []))

    return keep


def deduplicated(docs: DataFrame, text="text", doc_id="doc_id", window=WINDOW,
                 hot=HOT, with_text=True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words (``kept``)."""
    rows = modest_batches(docs).select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc", row_id("doc", "text").alias("row"), "text")
    size = docs.select(F.octet_length(text).alias("n")).agg(F.sum("n")).first()[0] or 0
    # About one anchor for every 50 bytes of text.
    n_buckets = size // (50 * BUCKET_ENTRIES) + 1
    posted = rows.mapInArrow(
        _posted(n_buckets, window),
        "bucket int, fps binary, docs binary, rows binary, counts binary")
    repeated = posted.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _repeated(hot), "doc long, row long, anchors array<bigint>")
    repeated = materialise(repeated)
    n_anchors = repeated.agg(F.sum(F.size("anchors"))).first()[0] or 0
    n_shards = n_anchors * 28 // SHARD_WORDS + 1
    marked = repeated.groupBy("doc", "row").agg(F.collect_list("anchors").alias("anchors"))
    # One row per id and text here; equal rows come back by the last join.
    once = rows.join(marked, ["doc", "row"]).dropDuplicates(["doc", "row"])
    passages = once.select("doc", "row", "text", "anchors").mapInArrow(
        _cut(n_shards, window), _PASSAGE)
    gone = passages.repartition(n_shards, "shard").sortWithinPartitions("shard").mapInArrow(
        _searched(window), "doc long, row long, begin int, end int")
    spans = gone.groupBy("doc", "row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    joined = rows.join(spans, ["doc", "row"], "left").select("doc", "text", "spans")
    kept = joined.mapInArrow(
        _kept_rows(with_text), "doc long, n_words long, n_removed long, kept_sha256 string"
        + (", kept string" if with_text else ""))
    return kept.select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), *kept.columns[1:])


def op3_substring_dedup(spark, sf_dir):
    return deduplicated(table(spark, sf_dir, "documents"), with_text=False)
