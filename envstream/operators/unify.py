"""Both kinds of reading side by side, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators.clean import dedup_batch, dedup_global, dedup_spread, drop_nulls


def join_readings(air: DataFrame, weather: DataFrame, parts=1) -> DataFrame:
    """Inner join on time and location name, 24 columns, label last.

    With ``parts`` the pollution rows of one key are spread over that many
    partitions and each weather row goes to all of them. Bounded frames do not
    need it: there Spark splits a hot key at run time. A streaming join cannot.
    """
    keys = list(S.JOIN_KEYS)
    if parts > 1:
        number = F.pmod(F.xxhash64(*S.AIR_COLUMNS), F.lit(parts))
        air = air.withColumn("_part", number)
        every = F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")
        weather = weather.withColumn("_part", F.explode(every))
        keys.append("_part")
    return air.join(weather, keys, "inner").select(*S.UNIFIED_COLUMNS)


def unify(air: DataFrame, weather: DataFrame) -> DataFrame:
    """Complete, distinct readings of a bounded frame.

    Rows with a NULL go first, on each side: the test is per row and every
    output column stems from one side, so the result is the same and distinct
    and join see fewer rows. Distinct inputs make a distinct after the join
    needless.
    """
    return join_readings(
        dedup_batch(drop_nulls(air)), dedup_batch(drop_nulls(weather))
    )


def unify_streams(air: DataFrame, weather: DataFrame, delay=None, parts=1,
                  message_no=None) -> DataFrame:
    """The same on streams. ``delay`` bounds the state of all operators; ``parts``
    spreads hot keys, and copies too if the rows carry a ``message_no``."""
    def distinct(df):
        if message_no:
            return dedup_spread(drop_nulls(df), message_no, parts, S.TIME, delay)
        return dedup_global(drop_nulls(df), S.TIME, delay)

    return join_readings(distinct(air), distinct(weather), parts)
