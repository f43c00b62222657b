"""Token counts with a sentencepiece model, huge documents in overlapping pieces.

A text of up to ``span`` characters is encoded as it is. A longer one is cut
into spans that overlap. The encodings of two neighbours are spliced where
both have a token boundary in front of the same space that follows a
character other than a space. The vocabulary is looked through first: no
piece holds a space mark behind another character, and the model does not
rewrite its input. A merge therefore never crosses such a place, and what
stands before and after is encoded independently of each other. Where the
overlap holds no such boundary, it is doubled until it does or until the
span takes in the rest of the text.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; repeated rows
are counted each; an empty table gives no rows. Memory: one batch of rows, for
one document its text and the tokens of one span.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import functions as F

from envstream.llm.common import cache_of, modest_batches, table

SPAN = 65_536
OVERLAP = 512
LIMIT = 4096
MODEL = "piece_bpe_32k.model"
MARK = "▁"


def model_path(name=MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCounter:
    """Counts tokens of texts as the sentencepiece library gives them."""

    def __init__(self, model_file: str, span=SPAN, overlap=OVERLAP):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self._span, self._overlap = span, overlap
        pieces = (self._model.id_to_piece(i) for i in range(len(self._model)))
        # Otherwise no boundary is proven, and texts are encoded whole.
        self.splices = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        self.widened = 0

    def counts(self, texts) -> list[int]:
        huge = {i for i, t in enumerate(texts) if self.splices and len(t) > self._span}
        short = ["" if i in huge else t for i, t in enumerate(texts)]
        found = [len(ids) for ids in self._model.encode(short, num_threads=1)]
        for i in huge:
            found[i] = self._long(texts[i])
        return found

    def _pieces(self, data, start, end):
        """Where the tokens of data[start:end] begin, in bytes of the whole text."""
        spans = self._model.encode(data[start:end].decode(), return_type="proto").pieces
        return [start + p.begin for p in spans]

    def _long(self, text) -> int:
        data = text.encode()
        total, begin, start = 0, 0, 0
        end = _character(data, self._span)
        left, overlap = self._pieces(data, start, end), self._overlap
        while end < len(data):
            next_start = _character(data, max(begin + 1, end - overlap))
            next_end = _character(data, next_start + self._span)
            right = self._pieces(data, next_start, next_end)
            cut = _common(data, left, right, max(begin, next_start), end)
            if cut is not None:
                total += sum(1 for at in left if begin <= at < cut)
                begin, start, end, left = cut, next_start, next_end, right
                overlap = self._overlap
                continue
            self.widened += 1
            if overlap < self._span // 2:
                overlap *= 2
            else:  # no place to splice in half a span: the left one grows instead
                end = _character(data, end + (end - start))
                left, overlap = self._pieces(data, start, end), self._overlap
        return total + sum(1 for at in left if at >= begin)


def _character(data, at):
    """The next place at or after ``at`` where a character begins."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return min(at, len(data))


def _common(data, left, right, low, high):
    """The middle one of the boundaries that both have inside the overlap."""
    mark = MARK.encode()
    shared = sorted(
        at for at in set(left) & set(right)
        if low < at < high - 1 and data[at] == 0x20 and data[at - 1] != 0x20
        and data[at - 3:at] != mark
    )
    return shared[len(shared) // 2] if shared else None


def _cached(path, span, overlap):
    counters, key = cache_of("counts"), (path, span, overlap)
    if key not in counters:
        counters[key] = PieceCounter(path, span, overlap)
    return counters[key]


def token_counts(df, text="text", id_col="doc_id", model_file=None, span=SPAN, overlap=OVERLAP,
                 limit=LIMIT):
    """One row per row: id, n_bytes, n_tokens, over_limit.

    ``model_file`` must be at the same place on all executors; without it the
    file comes from the installed package, found where the task runs.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def count(batches):
        counter = _cached(model_file or model_path(), span, overlap)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counter.counts(texts), pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"],
            )

    body = F.coalesce(F.col(text), F.lit(""))
    rows = modest_batches(df).select(
        id_col, body.alias("text"), F.octet_length(body).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op5_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
