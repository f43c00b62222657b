"""Topics. The readers only build options and load; every later step takes any
frame with a ``value`` column (and ``topic``, where two topics share a query)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Topics:
    """Settings of one application that reads both topics."""

    servers: str
    air: str
    weather: str
    starting: str = "latest"
    group_id: str | None = None
    max_offsets: int | None = None
    min_partitions: int | None = None
    extra: dict = field(default_factory=dict)

    def options(self, *topics: str) -> dict:
        """Options for reading the named topics (default: both)."""
        chosen = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(topics or (self.air, self.weather)),
            "startingOffsets": self.starting,
            "kafka.group.id": self.group_id,
            "maxOffsetsPerTrigger": self.max_offsets,
            "minPartitions": self.min_partitions,
            **self.extra,
        }
        return {key: str(value) for key, value in chosen.items() if value is not None}


def read_topic(spark: SparkSession, topics: Topics, *names: str) -> DataFrame:
    """Unbounded frame of the named topics (default: both, told apart by ``topic``)."""
    return spark.readStream.format("kafka").options(**topics.options(*names)).load()


def backfill_topics(spark: SparkSession, topics: Topics, *names: str) -> DataFrame:
    """Bounded frame of everything the named topics hold, from the earliest offset.

    Spark keeps its own offsets, so a group id names the reader and commits nothing.
    """
    options = {**topics.options(*names), "startingOffsets": "earliest", "endingOffsets": "latest"}
    options.pop("maxOffsetsPerTrigger", None)
    return spark.read.format("kafka").options(**options).load()
