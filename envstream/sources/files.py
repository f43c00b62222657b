"""Files: message feeds, raw documents, the catalogue, the name list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators.catalogue import name_list
from envstream.operators.encode import unnest_raw

FEED = "topic string, value binary"


def read_feed(spark: SparkSession, path: str, files_per_trigger=None,
              positions=False) -> DataFrame:
    """Landed messages as a stream; the same columns a topic gives. ``positions``
    adds ``position``, a number made of a message's file and row."""
    reader = spark.readStream.schema(FEED)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(path)
    if positions:
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        rows = rows.withColumn("position", place)
    return rows


def backfill_feed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEED).parquet(path)


def documents(spark: SparkSession, path: str, shape: str, whole=True) -> DataFrame:
    """JSON documents decoded to ``data``.

    ``whole`` takes each file as one document, which is what a file with one big
    object needs and ties it to one task. With one document per line the file
    can be split; the writers here produce that form.
    """
    text = spark.read.text(path, wholetext=whole)
    return text.select(F.from_json("value", shape).alias("data"))


def scan_answers(spark: SparkSession, path: str, shape: str) -> DataFrame:
    """Answers to requests, one JSON object per line: location_name, fetch_no and
    what a raw document of ``shape`` holds for a location."""
    inner = shape.removeprefix("map<string, struct<").removesuffix(">>")
    row = f"struct<location_name: string, fetch_no: int, {inner}>"
    text = spark.read.text(path)
    return text.select(F.from_json("value", row).alias("answer")).select("answer.*")


def scan_raw_air(spark: SparkSession, path: str, whole=True) -> DataFrame:
    return unnest_raw(documents(spark, path, S.RAW_AIR, whole))


def scan_raw_weather(spark: SparkSession, path: str, whole=True) -> DataFrame:
    return unnest_raw(documents(spark, path, S.RAW_WEATHER, whole))


def scan_catalogue(spark: SparkSession, path: str, whole=True) -> DataFrame:
    """A JSON array of records -> id, name, country, coord, and ``index``, the
    record's place in its array."""
    arrays = documents(spark, path, f"array<{S.CATALOGUE_RECORD}>", whole)
    return arrays.select(F.posexplode("data").alias("index", "record")).select("index", "record.*")


def scan_name_list(spark: SparkSession, path: str) -> DataFrame:
    return name_list(spark.read.text(path, wholetext=True))
