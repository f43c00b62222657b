"""Dimension keys, insert-if-absent and the referential check."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.functions import md5_bucket, name_key, packed_fact_id, text_digest, wide_fact_id
from envstream.operators.clean import first_per_key


def number_rows(df: DataFrame, key: str, start: int, out: str) -> DataFrame:
    """``out`` = start + 1, start + 2, ... over rows with distinct keys, in order
    of the key's md5 (then the key).

    The order starts with 4096 even buckets, so rows are ranked inside a bucket
    and moved up by the size of the buckets before it: no task sees all rows.
    The frame is read twice and must give the same rows both times.
    """
    marked = df.withColumn("_digest", text_digest(key)).withColumn(
        "_bucket", md5_bucket(F.col("_digest"))
    )
    sizes = marked.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", key))
    # At most 4096 rows, whatever the data: safe to broadcast.
    return (
        marked.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(out, F.col("_before") + F.col("_rank") + F.lit(start))
        .drop("_digest", "_bucket", "_before", "_rank")
    )


def absent(existing: DataFrame, incoming: DataFrame, keys) -> DataFrame:
    """Incoming rows whose key does not exist yet."""
    return incoming.join(existing.select(*keys), list(keys), "left_anti")


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys, order) -> DataFrame:
    """Rows to append so that the first writer of a key wins.

    Between batches the table wins; inside a batch the first row in ``order``.
    Rows without a full key are left out: no later batch could recognise them.
    """
    keyed = incoming.dropna(subset=list(keys))
    return absent(existing, first_per_key(keyed, keys, order), keys)


def batch_locations(air: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per location name of a batch. Pollution readings bring the
    coordinates; a name seen only in weather has none."""
    named = (
        air.select("location_name", "longitude", "latitude")
        .unionByName(weather.select("location_name"), allowMissingColumns=True)
        .where(F.col("location_name").isNotNull())
        # Readings collapse here, by hash and before the shuffle; what is left
        # for the pick below is about one row per location.
        .distinct()
    )
    at = F.struct("longitude", "latitude")
    placed = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    return (
        named.groupBy("location_name")
        .agg(F.min(F.when(placed, at)).alias("at"))
        .select("location_name", "at.longitude", "at.latitude")
    )


def fact_rows(readings: DataFrame, locations: DataFrame, measures, id_column) -> DataFrame:
    """Readings with their location's key, in the table's column order.

    Only key and measures go on; Spark broadcasts the dimension if its size
    allows and else joins by sort, splitting a hot name at run time.
    """
    keyed = readings.join(locations.select("location_id", "location_name"), "location_name")
    return keyed.select(
        packed_fact_id("location_id", S.TIME).alias(id_column), "location_id", *measures, S.TIME
    )


def keyed_fact_rows(readings: DataFrame, measures, id_column) -> DataFrame:
    """The same where a location's key stems from its name: no look at the dimension."""
    keyed = readings.withColumn("location_id", name_key("location_name"))
    return keyed.select(
        wide_fact_id("location_id", S.TIME).alias(id_column), "location_id", *measures, S.TIME
    )


def clashing(locations: DataFrame) -> DataFrame:
    """Keys that stand for more than one name, with these."""
    names = locations.groupBy("location_id").agg(
        F.min("location_name").alias("one"), F.max("location_name").alias("other"))
    return names.where("one <> other")


def orphans(facts: DataFrame, locations: DataFrame) -> DataFrame:
    """Facts that point to no location; empty if the tables are sound."""
    return facts.join(locations.select("location_id"), "location_id", "left_anti")


def in_time_order(facts: DataFrame) -> DataFrame:
    return facts.orderBy(S.TIME, "location_id")
