"""Raw documents -> entries -> one group per timestamp -> messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Entries per message. About 250 bytes each, so a full message stays well below
# the 1 MB a broker accepts by default.
MAX_ENTRIES = 1000
# Source positions that may meet in one group before it is split.
SPAN = 1 << 20


def unnest_raw(documents: DataFrame, number=None) -> DataFrame:
    """Decoded ``data`` maps -> one row per reading, with its place in the source.
    ``number`` names a column that numbers the locations already."""
    per_location = documents.select(
        *([number] if number else []),
        F.posexplode_outer(F.map_entries("data")).alias("location_no", "located")
    ).where(F.col("location_no").isNotNull())
    info = F.col("located.value")
    coord = [info["coord"].alias("coord")] if "coord" in _fields_of(documents) else []
    return per_location.select(
        F.col(number or "location_no").alias("location_no"),
        F.col("located.key").alias("location_name"),
        *coord,
        F.posexplode(info["list"]).alias("item_no", "item"),
    )


def _fields_of(documents):
    return documents.schema["data"].dataType.valueType.fieldNames()


def air_entry(location_name="location_name", lon="coord.lon", lat="coord.lat",
              main="item.main", components="item.components") -> Column:
    """The message entry of one pollution reading."""
    place = F.struct(
        F.col(location_name).alias("location_name"),
        F.col(lon).alias("lon"),
        F.col(lat).alias("lat"),
    )
    reading = F.struct(F.col(main).alias("main"), F.col(components).alias("components"))
    return F.struct(place.alias("location_id"), reading.alias("air_pollution_info"))


def weather_entry(location_name="location_name", item="item") -> Column:
    """The message entry of one weather reading: four blocks, nothing else."""
    blocks = [F.col(f"{item}.{name}") for name in ("main", "wind", "clouds", "weather")]
    return F.struct(
        F.col(location_name).alias("location_id"), F.struct(*blocks).alias("weather_info")
    )


def span_of(position="pos", span=SPAN) -> Column:
    """Which stretch of ``span`` source positions a row lies in."""
    return F.expr(f"`{position}` div {span}")


def regroup(df: DataFrame, keys, payload, order, stretch: Column,
            max_entries=MAX_ENTRIES) -> DataFrame:
    """Lists of ``payload`` per key in source order, at most ``max_entries`` long.

    A key with more rows gets several lists, numbered by ``stretch`` and
    ``chunk``; read in that order they are the whole list. The stretch bounds
    what one task may see of a hot key. Window and aggregate share one shuffle.
    """
    groups = [*keys, "stretch"]
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    listed = F.sort_array(
        F.collect_list(F.struct(F.col("_rank"), F.col(payload).alias("payload")))
    )
    return (
        df.withColumn("stretch", stretch)
        .withColumn("_rank", rank - 1)
        .withColumn("chunk", F.expr(f"_rank div {max_entries}"))
        .groupBy(*groups, "chunk")
        .agg(listed.alias("_listed"))
        .select(*groups, "chunk", F.col("_listed.payload").alias("entries"))
    )


def key_union(left: DataFrame, right: DataFrame, key="dt") -> DataFrame:
    """Keys found on either side, once each; both sides collapse before the shuffle."""
    return left.select(key).union(right.select(key)).distinct()


def timestamp_count(keys: DataFrame, key="dt") -> DataFrame:
    return keys.agg(F.count_distinct(key).alias("n_timestamps"))


def first_timestamps(keys: DataFrame, n=None, key="dt") -> DataFrame:
    """Timestamps in order; only the first ``n`` if given."""
    ordered = keys.orderBy(key)
    return ordered if n is None else ordered.limit(n)


def align(air: DataFrame, weather: DataFrame) -> DataFrame:
    """Groups of both topics side by side; a side without entries has an empty list."""
    keys = ["dt", "stretch", "chunk"]
    joined = air.withColumnRenamed("entries", "air_entries").join(
        weather.withColumnRenamed("entries", "weather_entries"), keys, "full"
    )
    return joined.select(
        *keys,
        F.coalesce("air_entries", F.array()).alias("air_entries"),
        F.coalesce("weather_entries", F.array()).alias("weather_entries"),
    )


def encode(groups: DataFrame, entries="entries", keep=()) -> DataFrame:
    """One UTF-8 JSON message ``{"<dt>": [...]}`` per group."""
    envelope = F.create_map(F.col("dt").cast("string"), F.col(entries))
    return groups.select(*keep, F.to_json(envelope).cast("binary").alias("value"))
