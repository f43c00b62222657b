"""The last reading of every key over the life of a stream.

The state holds one row per key, whatever the length of the stream. Each batch gives
the keys that changed (update mode) and writes them under its number, so a repeated
batch replaces itself. Readers merge the batches; ``compact`` makes one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LAST = "_last"


def last_rows(rows: DataFrame, keys, order) -> DataFrame:
    """One row per key: the last in ``order``, ties by the other columns. Streaming or
    not; rows of one key are merged before the shuffle, and a NULL comes before all."""
    rest = [c for c in rows.columns if c not in {*keys, *order}]
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias(_LAST))


def _flat(rows: DataFrame, keys) -> DataFrame:
    return rows.select(*keys, f"{_LAST}.*")


@dataclass(frozen=True)
class LastValues:
    """Where the changes of a stream are kept, and the table they make up."""

    path: str
    keys: tuple[str, ...]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch function of a query over ``last_rows`` in update mode."""
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "batch_id").parquet(self.path)

    def changes(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The last row of every key; a later change is never smaller than one before."""
        merged = self.changes(spark).groupBy(*self.keys).agg(F.max(_LAST).alias(_LAST))
        return _flat(merged, self.keys)

    def compact(self, spark: SparkSession, into: str) -> LastValues:
        """The same table in another folder, one row per key; further batches go there."""
        merged = self.changes(spark).groupBy(*self.keys).agg(
            F.max(_LAST).alias(_LAST), F.max("batch_id").alias("batch_id"))
        newest = merged.agg(F.max("batch_id")).first()[0]
        target = LastValues(into, self.keys)
        if newest is not None:
            # Under a number before all others, so no batch replaces it.
            target.write(merged.drop("batch_id"), -1)
        return target
