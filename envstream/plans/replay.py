"""Landing a bounded set of messages in time order and draining queries over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envstream.session import shared_dir, streaming_session
from envstream.sinks.outputs import write_feed
from envstream.sources.files import read_feed
from envstream.streaming.queries import start_batches, start_files


def time_slices(messages: DataFrame, slices: int, key="dt"):
    """The messages cut into stretches of time, oldest first; an hour is never split."""
    low, high = messages.agg(F.min(key), F.max(key)).first()
    if low is None:
        return []
    width = (high - low) // slices + 1
    number = F.expr(f"({key} - {low}) div {width}")
    return [messages.where(number == i) for i in range(slices)]


def drain_in_slices(spark: SparkSession, messages: DataFrame, start, slices=4,
                    positions=False) -> None:
    """Land one slice, let ``start(stream)`` take it in until it is done, go on.

    Each slice is a run of its own on the same checkpoint, so a restart is part
    of every replay.
    """
    session = streaming_session(spark)
    path = shared_dir(spark, "feed")
    for part in time_slices(messages, slices):
        write_feed(part, path)
        start(read_feed(session, path, positions=positions)).awaitTermination()


def replay_to_files(spark: SparkSession, messages: DataFrame, build, slices=4,
                    positions=False, checkpoint=None) -> DataFrame:
    """Rows of the streaming frame ``build(messages)`` after the whole replay."""
    out, checkpoint = shared_dir(spark, "rows"), checkpoint or shared_dir(spark, "state")
    drain_in_slices(
        spark, messages,
        lambda stream: start_files(build(stream), out, checkpoint, drain=True), slices,
        positions,
    )
    return spark.read.parquet(out)


def replay_to_batches(spark: SparkSession, messages: DataFrame, build, handle, slices=4,
                      mode="append") -> None:
    """The same, with ``handle(batch, batch_id)`` on each micro-batch."""
    checkpoint = shared_dir(spark, "state")
    drain_in_slices(
        spark, messages,
        lambda stream: start_batches(build(stream), handle, checkpoint, drain=True, mode=mode),
        slices,
    )
