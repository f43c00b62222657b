"""Partial results of micro-batches that later runs merge.

Every batch keeps its part under its number, so a batch that Spark runs again
replaces its own part and nothing counts twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BatchParts:
    """A folder of small rows by ``batch_id``; ``shape`` is their schema without it."""

    path: str
    shape: str

    def create(self, spark: SparkSession) -> BatchParts:
        """Makes the folder, so that it can be read before the first batch."""
        none = spark.createDataFrame([], f"{self.shape}, batch_id long")
        none.write.mode("ignore").partitionBy("batch_id").parquet(self.path)
        return self

    def write(self, part: DataFrame, batch_id: int) -> None:
        part.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "batch_id").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{self.shape}, batch_id long").parquet(self.path)
