"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, mixing, token ids.

Each stage takes the documents the stage before has kept. ``run`` writes every
stage's result to the shared folder and reads it again, so a lost executor
costs one stage at most. The result has one row per copy of a document in the
mixed corpus, as read back from the compressed token files: doc_id, start,
n_tokens, ids_crc32.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from envstream.llm import binary, decontaminate, jaccard, mixing, toxicity
from envstream.llm.common import table
from envstream.session import shared_dir


def without_toxic(spark, docs, sf_dir):
    """Documents whose score stays under the threshold."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(docs, model, into="_toxicity")
    return scored.where(F.col("_toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def without_near_copies(spark, docs, sf_dir):
    """The document with the smallest id of each group of near copies."""
    return jaccard.first_of_each(docs).select(*docs.columns)


def without_leaks(spark, docs, sf_dir):
    """Documents in which no window of a benchmark item occurs."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"), into="_leak")
    return found.where(F.col("_leak.n_hit") == 0).select(*docs.columns)


def to_target_weights(spark, docs, sf_dir):
    """Every document at least once, those of rare sources again."""
    return mixing.mixed(docs).select(*docs.columns)


def to_token_ids(spark, docs, sf_dir):
    """What is read back from the token files."""
    path = shared_dir(spark, "token-ids")
    binary.write_ids(docs, path)
    return binary.read_ids(spark, path, with_ids=False)


STAGES = [
    ("toxicity", without_toxic),
    ("near copies", without_near_copies),
    ("benchmark leaks", without_leaks),
    ("source mixing", to_target_weights),
    ("token ids", to_token_ids),
]

#: Models, hashes and tokenizers are beyond SQL; tests hold it against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    root = shared_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
