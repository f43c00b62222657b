"""Starting and stopping streaming queries."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from envstream.operators.parse import air_rows, weather_rows
from envstream.operators.unify import unify_streams


def unified_stream(messages: DataFrame, air_topic, weather_topic, delay=None, parts=1) -> DataFrame:
    """Both topics of one message stream -> complete, distinct, joined readings.

    ``parts`` > 1 is for feeds where one reading is sent very many times or one
    place and hour has very many readings.
    """
    number = "_message" if parts > 1 else None
    air = air_rows(messages.where(F.col("topic") == air_topic), number)
    weather = weather_rows(messages.where(F.col("topic") == weather_topic), number)
    return unify_streams(air, weather, delay, parts, number)


def _writer(df, checkpoint, drain, interval, name, mode="append"):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def start_batches(df: DataFrame, handle, checkpoint: str, drain=False, interval=None, name=None,
                  mode="append"):
    """Run ``handle(batch, batch_id)`` for each micro-batch.

    The checkpoint is what makes a restart go on where the last run stopped; to
    begin anew, name a new one. ``drain`` takes what there is and then ends.
    """
    return _writer(df, checkpoint, drain, interval, name, mode).foreachBatch(handle).start()


def start_files(df: DataFrame, path: str, checkpoint: str, drain=False, interval=None, name=None):
    """Append the rows to parquet files, each exactly once."""
    return _writer(df, checkpoint, drain, interval, name).format("parquet").start(path)


def start_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, **how):
    """Send ``value`` to a topic as rows arrive."""
    writer = _writer(df, checkpoint, how.get("drain"), how.get("interval"), how.get("name"))
    return (
        writer.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .start()
    )


class LastInput(StreamingQueryListener):
    """Time since any query of the application last took in rows, and the number
    of rows that came behind a watermark and were dropped."""

    def __init__(self, clock=time.monotonic):
        self._clock = clock
        self._last = clock()
        self.dropped = {}

    def idle_seconds(self) -> float:
        return self._clock() - self._last

    def touch(self) -> None:
        self._last = self._clock()

    def onQueryStarted(self, event):
        self._last = self._clock()

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.numInputRows > 0:
            self.touch()
        operators = getattr(progress, "stateOperators", None) or ()
        late = sum(s.numRowsDroppedByWatermark or 0 for s in operators)
        if late:
            self.dropped[progress.batchId] = self.dropped.get(progress.batchId, 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def in_batch(query) -> bool:
    """True while a micro-batch that has data is being worked on."""
    status = query.status
    return status["isDataAvailable"] and status["isTriggerActive"]


def stop_when_idle(queries, last_input: LastInput, timeout=120.0, poll=1.0) -> None:
    """Wait until no query has taken in rows for ``timeout`` seconds, then stop all.

    The clock is shared: input on one topic keeps the other query alive as well.
    It stands still while a batch runs, however long, so none is cut off.
    """
    running = list(queries)
    while running and last_input.idle_seconds() <= timeout:
        running[0].awaitTermination(poll)
        running = [query for query in running if query.isActive]
        if any(in_batch(query) for query in running):
            last_input.touch()
    for query in running:
        query.stop()
