"""Messages -> nested rows -> flat rows. Works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.functions import epoch_to_timestamp, first_description


def decode(messages: DataFrame, envelope: str, *keep) -> DataFrame:
    """``value`` (binary or text) -> ``json_value`` and its decoded map."""
    text = messages.select(F.col("value").cast("string").alias("json_value"), *keep)
    names = [c for c in text.columns if c != "json_value"]
    return text.select("json_value", *names, F.from_json("json_value", envelope).alias("data"))


def place_of(messages: DataFrame):
    """A number that tells messages apart by their place in the source, so that
    one message sent many times has many: partition and offset, or ``position``.
    Where the source gives neither, the text has to do."""
    if {"partition", "offset"} <= set(messages.columns):
        return F.xxhash64("partition", "offset")
    if "position" in messages.columns:
        return F.col("position")
    return F.xxhash64(F.col("value").cast("string"))


def parse_envelope(messages: DataFrame, envelope: str, message_no=None) -> DataFrame:
    """One row (timestamp, entry) per entry of every message.

    The map is unnested with the outer form and NULL keys are dropped after:
    the inner form makes Catalyst infer a size filter that decodes the JSON
    text a second and third time. The time is worked out before the entries are
    unnested, once per message. ``message_no`` names an extra column that tells
    messages apart (see ``place_of``).
    """
    number = [place_of(messages).alias(message_no)] if message_no else []
    kept = [message_no] if message_no else []
    return (
        decode(messages, envelope, *number)
        .select(*kept, F.explode_outer("data").alias("unix_timestamp", "entries"))
        .where(F.col("unix_timestamp").isNotNull())
        .select(*kept, epoch_to_timestamp("unix_timestamp").alias("timestamp"), "entries")
        .select(*kept, "timestamp", F.explode("entries").alias("entry"))
    )


def rejects(messages: DataFrame, envelope: str) -> DataFrame:
    """Messages that hold no map, or whose key is no time."""
    bad_key = F.exists(F.map_keys("data"), lambda k: epoch_to_timestamp(k).isNull())
    reason = F.when(F.col("data").isNull(), "not an envelope").when(bad_key, "key is no time")
    return (
        decode(messages, envelope)
        .where(F.col("json_value").isNotNull())
        .select("json_value", reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )


def _in_order(columns, paths, keep, **texts):
    """Select list: each flat column with the text that gives it."""
    texts |= {S.TIME: "timestamp", **{name: f"entry.{path}" for name, path in paths.items()}}
    return [*keep, *(f"{texts[name]} as {name}" for name in columns)]


def flatten_air(parsed: DataFrame, keep=()) -> DataFrame:
    return parsed.selectExpr(*_in_order(S.AIR_COLUMNS, S.AIR_FIELDS, keep))


def flatten_weather(parsed: DataFrame, keep=()) -> DataFrame:
    first = first_description("entry.weather_info.weather")
    return parsed.selectExpr(
        *_in_order(S.WEATHER_COLUMNS, S.WEATHER_FIELDS, keep, weather_description=first)
    )


def air_rows(messages: DataFrame, message_no=None) -> DataFrame:
    keep = [message_no] if message_no else []
    return flatten_air(parse_envelope(messages, S.AIR_ENVELOPE, message_no), keep)


def weather_rows(messages: DataFrame, message_no=None) -> DataFrame:
    keep = [message_no] if message_no else []
    return flatten_weather(parse_envelope(messages, S.WEATHER_ENVELOPE, message_no), keep)
