"""From answers and raw documents to the messages of both topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.operators import encode
from envstream.operators.catalogue import with_readings
from envstream.operators.clean import first_per_key

# Locations of one document that may meet in one group.
LOCATION_SPAN = 4096
# Groups that the locations of one hour are dealt to, where they have no number.
SPREAD = 16
ORDER = ("location_no", "location_name", "item_no")


def merge_answers(answers: DataFrame) -> DataFrame:
    """Answers (location_name, fetch_no, list) of overlapping requests -> one
    reading (item) per location and time: the one that was fetched first."""
    unnested = with_readings(answers).select(
        "location_name", "fetch_no", F.posexplode("list").alias("item_no", "item")
    )
    timed = unnested.withColumn("dt", F.col("item.dt"))
    return first_per_key(timed, ["location_name", "dt"], ["fetch_no", "item_no"])


def stretch_for(whole: bool, spread: int) -> Column:
    """How the readings of one hour are cut into groups a task can hold.

    In a whole document locations are numbered and go by number. In documents
    by line they are not, so the name's hash sends them to ``spread`` groups.
    """
    if whole:
        return encode.span_of("location_no", LOCATION_SPAN)
    return F.pmod(F.xxhash64("location_name"), F.lit(spread))


def _groups(readings, entry, stretch, max_entries):
    rows = readings.withColumn("dt", F.col("item.dt")).withColumn("entry", entry)
    return encode.regroup(rows, ["dt"], "entry", list(ORDER), stretch, max_entries)


def replay_messages(air: DataFrame, weather: DataFrame, air_topic, weather_topic, whole=True,
                    spread=SPREAD, first=None, max_entries=encode.MAX_ENTRIES) -> DataFrame:
    """Raw readings of both kinds -> messages (dt, topic, value).

    Both topics get a message for every time found on either side. ``first``
    keeps that many times from the beginning.
    """
    stretch = stretch_for(whole, spread)
    groups = encode.align(
        _groups(air, encode.air_entry(), stretch, max_entries),
        _groups(weather, encode.weather_entry(), stretch, max_entries),
    )
    if first is not None:
        times = encode.key_union(
            air.select(F.col("item.dt").alias("dt")), weather.select(F.col("item.dt").alias("dt"))
        )
        groups = groups.join(encode.first_timestamps(times, first), "dt", "left_semi")
    keep = ["dt", "stretch", "chunk"]
    both = encode.encode(groups, "air_entries", keep).withColumn("topic", F.lit(air_topic))
    both = both.unionByName(
        encode.encode(groups, "weather_entries", keep).withColumn("topic", F.lit(weather_topic))
    )
    return both.select("dt", "topic", "value")
