"""What a stopped query's checkpoint holds, read by Spark's own reader of state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def state_rows(spark: SparkSession, checkpoint: str, operator=0, store=None) -> DataFrame:
    """key, value, partition_id of one stateful operator after its last batch.

    ``operator`` counts from 0 from the sources down; a join has several stores.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if store:
        reader = reader.option("storeName", store)
    return reader.load(checkpoint)


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operatorId, operatorName, stateStoreName, numPartitions and the batches kept."""
    return spark.read.format("state-metadata").load(checkpoint)
