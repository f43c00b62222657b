"""One key with a third of all rows and more."""

import pytest
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators import clean, encode, unify
from helpers import physical_text


def readings(spark, n, hot):
    """``n`` pollution rows, all distinct, of which every ``hot``-th has one key."""
    name = F.when(F.col("id") % hot == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id")))
    columns = [F.col("id").cast("double").alias(p) for p in S.POLLUTANTS]
    air = spark.range(n).select(
        F.timestamp_seconds(F.lit(1704067200)).alias(S.TIME), name.alias("location_name"),
        F.lit(1.0).alias("longitude"), F.lit(2.0).alias("latitude"),
        F.lit(3).alias(S.LABEL), *columns,
    ).select(*S.AIR_COLUMNS)
    numbers = [F.lit(1).alias(c) for c in S.WEATHER_NUMBERS]
    weather = air.select(S.TIME, "location_name").distinct().select(
        S.TIME, "location_name", *numbers, F.lit("mist").alias("weather_description")
    )
    return air, weather


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        # a split is made of whole map outputs, so keep more than one of them
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def test_a_hot_join_key_is_split_at_run_time(small_partitions):
    air, weather = readings(small_partitions, 60000, 2)
    joined = unify.unify(air, weather)
    rows = joined.groupBy("location_name").count()
    rows.persist()
    assert rows.agg(F.sum("count")).first()[0] == 60000
    assert rows.where("location_name = 'hot'").first()["count"] == 30000
    joined.collect()
    assert "skew=true" in physical_text(joined)


def test_copies_collapse_before_the_shuffle(spark):
    air, _ = readings(spark, 30, 3)
    hot = air.where("location_name = 'hot'").limit(1)
    many = hot.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50000)))).drop("n")
    distinct = clean.dedup_batch(many.unionByName(air))
    assert distinct.count() == 30


def test_a_hot_hour_becomes_many_messages_of_bounded_size(spark):
    rows = spark.range(30000).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("dt"),
        F.col("id").alias("entry"),
    )
    groups = encode.regroup(rows, ["dt"], "entry", ["pos"], encode.span_of("pos", 4096), 100)
    sizes = groups.agg(F.max(F.size("entries")), F.sum(F.size("entries"))).first()
    assert sizes[0] == 100 and sizes[1] == 30000
    hot = groups.where("dt = -1").orderBy("stretch", "chunk").select(F.explode("entries").alias("e"))
    assert [r.e for r in hot.collect()] == sorted(range(0, 30000, 3))
