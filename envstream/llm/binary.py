"""Token ids in a compressed binary format.

Documents are dealt to tasks by ranges of their ids and sorted there. A task
cuts its documents into segments of about ``SEGMENT`` tokens. A segment is one
record of a Parquet file: the ids and lengths of its documents, a frequency
table, and blocks coded with it (see ``rans``). Records are written by Spark's
committed writer, so a lost executor leaves nothing half done, and are decoded
each by itself. (part, segment) orders them as the documents are ordered.

Defined results: NULL and empty texts have the end id only; repeated ids stay
documents of their own, in no set order among them; an empty table makes a
file without records. Memory: a segment, or the ids of one document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstream.llm import rans
from envstream.llm.bpe import bpe, model_path
from envstream.llm.common import modest_batches, table
from envstream.session import shared_dir

SEGMENT = 1 << 20
END = 0

_BLOCK = pa.struct([
    ("n", pa.int32()), ("lanes", pa.int32()), ("crc", pa.int64()), ("words", pa.binary()),
    ("checkpoints", pa.list_(pa.struct([
        ("step", pa.int32()), ("word", pa.int64()), ("states", pa.binary())]))),
])
_BLOCK_DDL = ("struct<n:int,lanes:int,crc:bigint,words:binary,"
              "checkpoints:array<struct<step:int,word:bigint,states:binary>>>")


def _record(part, number, ids, kind, lengths, tokens):
    if len(tokens):
        freq = rans.Table.of(tokens)
        coded, blocks = freq.to_bytes(), rans.encode(tokens, freq)
    else:
        coded, blocks = b"", []
    return pa.RecordBatch.from_arrays([
        pa.array([part], pa.int32()), pa.array([number], pa.int32()),
        pa.array([len(tokens)], pa.int64()), pa.array([ids], pa.list_(kind)),
        pa.array([lengths], pa.list_(pa.int64())), pa.array([coded], pa.binary()),
        pa.array([blocks], pa.list_(_BLOCK)),
    ], names=["part", "segment", "n_tokens", "doc_ids", "lengths", "table", "blocks"])


def write_ids(docs: DataFrame, path: str, text="text", doc_id="doc_id", model_file=None,
              end=END, segment=SEGMENT) -> None:
    """Encode, append ``end`` to each document, write in ascending order of ids."""
    kind = docs.schema[doc_id].dataType.simpleString()
    ending = np.array([end], np.uint32).tobytes()

    def encode(batches):
        model, part = bpe(model_file or model_path()), TaskContext.get().partitionId()
        ids, lengths, parts, size, number, id_type = [], [], [], 0, 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            coded = model.encode(t or "" for t in batch.column(1).to_pylist())
            for key, data in zip(batch.column(0).to_pylist(), coded):
                ids.append(key)
                lengths.append(len(data) // 4 + 1)
                parts += (data, ending)
                size += lengths[-1]
                if size >= segment:
                    tokens = np.frombuffer(b"".join(parts), np.uint32)
                    yield _record(part, number, ids, id_type, lengths, tokens)
                    ids, lengths, parts, size, number = [], [], [], 0, number + 1
        if ids:
            tokens = np.frombuffer(b"".join(parts), np.uint32)
            yield _record(part, number, ids, id_type, lengths, tokens)

    ordered = modest_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    records = ordered.mapInArrow(
        encode, f"part int, segment int, n_tokens long, doc_ids array<{kind}>, "
        f"lengths array<bigint>, table binary, blocks array<{_BLOCK_DDL}>")
    records.write.mode("errorifexists").parquet(path)


def segment_ids(record: dict):
    """All ids of a segment, every block's checksum tested."""
    if not record["blocks"]:
        return np.empty(0, np.uint32)
    decoder = rans.Decoder(rans.Table.from_bytes(record["table"]))
    return np.concatenate([decoder.block(b) for b in record["blocks"]])


def read_ids(spark, path: str, with_ids=True) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens, ids_crc32, and the ids."""
    records = spark.read.parquet(path)
    kind = records.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                record = batch.slice(i, 1).to_pylist()[0]
                ids, lengths = segment_ids(record), np.array(record["lengths"], np.int64)
                ends = np.cumsum(lengths)
                cut = [ids[e - n:e] for e, n in zip(ends, lengths)]
                columns = [
                    pa.array([record["part"]] * len(cut), pa.int32()),
                    pa.array([record["segment"]] * len(cut), pa.int32()),
                    batch.column(batch.schema.get_field_index("doc_ids"))[i].values,
                    pa.array(ends - lengths), pa.array(lengths),
                    pa.array([zlib.crc32(c.astype("<u4").tobytes()) for c in cut], pa.int64()),
                ]
                names = ["part", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([c.astype(np.int64) for c in cut],
                                            pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = records.select("part", "segment", "doc_ids", "lengths", "table", "blocks").mapInArrow(
        decode, f"part int, segment int, doc_id {kind}, inside long, n_tokens long, "
        "ids_crc32 long" + (", ids array<bigint>" if with_ids else ""))
    # One short row per segment of a million ids.
    before = Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = records.select(
        "part", "segment", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before"))
    joined = rows.join(starts, ["part", "segment"])
    return joined.select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []))


def op4_token_binary(spark, sf_dir):
    path = shared_dir(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path, with_ids=False)
