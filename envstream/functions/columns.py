from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds of 0001-01-01 and 9999-12-31T23:59:59 UTC, the range of a timestamp text.
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799

# Fact keys hold a location id (29 bits) and a second of 1697..2242 (34 bits).
_TIME_BITS = 34
_TIME_OFFSET = 1 << 33
_MAX_LOCATION = (1 << 29) - 1


def epoch_to_timestamp(text) -> Column:
    """Unix seconds as text -> timestamp; NULL for anything else.

    A fraction is cut off. No local time text lies in between, so both hours of
    an autumn clock change stay apart.
    """
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)(?:\.\d*)?\s*$", 1)
    seconds = digits.try_cast("bigint")
    return F.when(
        seconds.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(seconds)
    )


def epoch_seconds(timestamp) -> Column:
    return F.unix_seconds(timestamp)


def wall_clock_epoch(wall_clock, zone="UTC") -> Column:
    """Unix seconds of a timestamp without zone, read as local time of ``zone``."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    shifted = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall_clock)
    return F.timestamp_diff("SECOND", origin, shifted)


def first_description(conditions: str) -> str:
    """SQL text: description of the first weather condition, NULL for an empty list."""
    return f"get({conditions}.description, 0)"


def class_of(prediction) -> Column:
    """Predicted class by truncation toward zero: 2.9 -> 2."""
    return F.col(prediction).cast("int")


def nearest_class(prediction) -> Column:
    """Predicted class by rounding: 2.9 -> 3."""
    return F.round(prediction).cast("int")


def text_digest(*columns) -> Column:
    """md5 of the key columns' text; evenly spread whatever the keys look like."""
    return F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in columns)))


def md5_bucket(digest: Column) -> Column:
    """0..4095 from the first three hex digits of a digest."""
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def name_key(name) -> Column:
    """A location's key worked out from its name alone: 60 bits of its md5.

    Writers that know nothing of each other give one name one key. Among N names two
    share a key with a chance of about N * N / 2^61; who writes them finds out.
    """
    return F.conv(F.substring(F.md5(F.col(name)), 1, 15), 16, 10).cast("bigint")


def name_part(key) -> Column:
    """0..255 from the first bits of a name's key."""
    return F.shiftright(F.col(key), 52).cast("int")


def wide_fact_id(location_id, timestamp) -> Column:
    """The row key of a fact whose location has a ``name_key``: both side by side in
    one decimal, as 64 bits cannot hold them."""
    place = F.col(location_id).cast("decimal(19,0)")
    second = (F.unix_seconds(timestamp) + F.lit(_TIME_OFFSET)).cast("decimal(11,0)")
    return (place * F.lit(1 << _TIME_BITS).cast("decimal(11,0)") + second).cast("decimal(32,0)")


def fits_fact_id(timestamp) -> Column:
    """True for the times that a fact key can hold."""
    return F.unix_seconds(timestamp).between(-_TIME_OFFSET, _TIME_OFFSET - 1)


def packed_fact_id(location_id, timestamp) -> Column:
    """A row key that is a function of the fact's own key.

    It needs no counter, no look at the table and no numbering shuffle, and a
    replayed batch gets the same keys again. Outside its range it fails loudly
    rather than give one key twice.
    """
    place, second = F.col(location_id), F.unix_seconds(timestamp)
    fits = place.between(0, _MAX_LOCATION) & second.between(-_TIME_OFFSET, _TIME_OFFSET - 1)
    packed = F.shiftleft(place, _TIME_BITS) + second + F.lit(_TIME_OFFSET)
    return F.when(fits, packed).otherwise(
        F.raise_error(
            F.concat(
                F.lit("no fact id for location "), place.cast("string"),
                F.lit(" at "), second.cast("string"),
            )
        ).cast("bigint")
    )
