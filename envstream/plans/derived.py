"""Readings derived from the ``events`` table, for checks and benchmarks.

Each event gives a pollution reading unless it is an ``error`` and a weather
reading unless it is a ``signup``; ``signup`` pollution and ``view`` weather
readings are sent twice. A user is a location. See FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators.encode import air_entry, encode, weather_entry

AIR_TOPIC, WEATHER_TOPIC = "air", "weather"

# --- fixed values: what a reading holds, as SQL text that Spark and DuckDB share.
# Factors are powers of two, so both give the same doubles.
LOCATION = "concat('loc_', cast(user_id as string))"
LON = "cast(user_id % 360 - 180 as double)"
LAT = "cast(user_id % 180 - 90 as double)"
AQI = "cast(1 + least(4, floor(value / cast(40 as double))) as int)"
POLLUTANT_FACTORS = {
    "co": 1, "no": 0.5, "no2": 0.25, "o3": 2, "so2": 4, "pm2_5": 8, "pm10": 16, "nh3": 0.125,
}
WEATHER_FACTORS = {"temp": 1, "feels_like": 0.5, "temp_min": 0.25, "temp_max": 2}
WEATHER_INTS = {
    "pressure": "cast(900 + event_id % 100 as int)",
    "humidity": "cast(event_id % 101 as int)",
}
SPEED_FACTOR, GUST_FACTOR = 0.125, 4
DEG = "cast(event_id % 360 as int)"
CLOUDS = "cast(event_id % 101 as int)"
# --- end of fixed values


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*columns)


def hour_of(ts="ts") -> Column:
    """Unix seconds of the hour, free of the session's time zone."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", origin, F.col(ts).cast("timestamp_ntz"))
    return (seconds - F.pmod(seconds, F.lit(3600))).alias("dt")


def _times(name, factor):
    return f"value * {float(factor)}D as {name}"


def _struct(*fields):
    return f"struct({', '.join(fields)})"


def _readings(spark, sf_dir, excluded, twice, item, *extra):
    base = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "value").where(
        F.col("event_type") != excluded
    )
    return base.withColumn("dt", hour_of()).selectExpr(
        "event_id as pos", "dt", f"{LOCATION} as location_name", *extra, f"{item} as item",
        "event_type as kind", f"if(event_type = '{twice}', 2, 1) as copies",
    )


def _twice(df: DataFrame) -> DataFrame:
    """Emit copies: each gets a place of its own, ``copy``."""
    kept = [c for c in df.columns if c != "copies"]
    return df.select(*kept, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))


def _air(spark, sf_dir):
    components = _struct(*(_times(p, POLLUTANT_FACTORS[p]) for p in S.POLLUTANTS))
    item = _struct("dt", f"struct({AQI} as aqi) as main", f"{components} as components")
    coord = f"struct({LON} as lon, {LAT} as lat) as coord"
    return _readings(spark, sf_dir, "error", "signup", item, coord)


def _weather(spark, sf_dir):
    main = _struct(
        _times("temp", WEATHER_FACTORS["temp"]),
        _times("feels_like", WEATHER_FACTORS["feels_like"]),
        f"{WEATHER_INTS['pressure']} as pressure",
        f"{WEATHER_INTS['humidity']} as humidity",
        _times("temp_min", WEATHER_FACTORS["temp_min"]),
        _times("temp_max", WEATHER_FACTORS["temp_max"]),
    )
    gust = f"if(event_id % 4 <> 0, value * {float(GUST_FACTOR)}D, null) as gust"
    wind = _struct(_times("speed", SPEED_FACTOR), f"{DEG} as deg", gust)
    conditions = (
        "if(event_id % 7 <> 0, array(struct(event_type as description)), "
        "cast(array() as array<struct<description: string>>))"
    )
    item = _struct(
        "dt", f"{main} as main", f"{wind} as wind", f"struct({CLOUDS} as all) as clouds",
        f"{conditions} as weather",
    )
    return _readings(spark, sf_dir, "signup", "view", item)


def raw_air(spark, sf_dir) -> DataFrame:
    """pos, dt, location_name, coord, item, kind, copy - one row per reading sent."""
    return _twice(_air(spark, sf_dir))


def raw_weather(spark, sf_dir) -> DataFrame:
    return _twice(_weather(spark, sf_dir))


def _messages(df, entry):
    """One message per event: its entry, repeated as often as it is sent."""
    repeated = df.select(
        "dt", "pos", "kind", F.array_repeat(entry, F.col("copies")).alias("entries")
    )
    return encode(repeated, keep=("dt", "pos", "kind"))


def air_messages(spark, sf_dir) -> DataFrame:
    return _messages(_air(spark, sf_dir), air_entry())


def weather_messages(spark, sf_dir) -> DataFrame:
    return _messages(_weather(spark, sf_dir), weather_entry())


def feed(spark, sf_dir) -> DataFrame:
    """Messages of both topics: dt, pos, kind, topic, value."""
    air = air_messages(spark, sf_dir).withColumn("topic", F.lit(AIR_TOPIC))
    weather = weather_messages(spark, sf_dir).withColumn("topic", F.lit(WEATHER_TOPIC))
    return air.unionByName(weather)


def catalogue(spark, sf_dir) -> DataFrame:
    """Customers as a city catalogue; four neighbours share a name."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customer.select(
        F.col("c_custkey").alias("index"),
        F.col("c_custkey").alias("id"),
        F.expr("concat('n_', cast(c_custkey div 4 as string))").alias("name"),
        F.col("c_mktsegment").alias("country"),
        F.struct(
            F.col("c_nationkey").cast("double").alias("lon"), F.col("c_acctbal").alias("lat")
        ).alias("coord"),
    )


def name_texts(spark, sf_dir) -> DataFrame:
    """One quoted list per supplier: a name, a name with a stray quote in it, and
    the next supplier's name again."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey")
    key = F.col("s_suppkey")
    return supplier.select(
        key.alias("list_no"),
        F.format_string('"n_%d", "odd n"_%d", "n_%d"', key, key, key + 1).alias("value"),
    )
