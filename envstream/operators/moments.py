"""Count, mean and sum of squares about the mean, by day, merged pairwise.

A day is summed up when its readings come; what was learned from years of them is
then a row per day and feature, and scaling over the whole history reads no reading
a second time. Merging follows the differences of the means, not sums of squares of
the values, so large values with a small spread lose no digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream import schemas as S

MOMENTS = "day long, feature string, n long, mean double, m2 double"
_DAY = 86_400


def day_moments(rows: DataFrame, features=S.FEATURES, time=S.TIME) -> DataFrame:
    """One row per day and feature. NULLs do not count, nor do features without a
    value that day; rows without a time are a day of their own, NULL."""
    day = F.floor(F.unix_seconds(time) / _DAY).alias("day")

    def of(name):
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("feature"), F.count(value).alias("n"), F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("m2"))

    found = rows.groupBy(day).agg(F.array(*(of(name) for name in features)).alias("found"))
    return found.select("day", F.inline("found")).where("n > 0")


def _added(a, b):
    """Moments of two sets of values from those of each."""
    n = a["n"] + b["n"]
    step, share = b["mean"] - a["mean"], b["n"] / n
    return F.struct(
        (a["mean"] + step * share).alias("mean"), n.alias("n"),
        (a["m2"] + b["m2"] + step * step * a["n"] * share).alias("m2"))


def merged(parts: DataFrame, *by: str) -> DataFrame:
    """One row per ``by``; the same rows give the same digits in whatever order."""
    none = F.struct(F.lit(0.0).alias("mean"), F.lit(0).cast("long").alias("n"),
                    F.lit(0.0).alias("m2"))
    listed = F.sort_array(F.collect_list(F.struct("mean", "n", "m2")))
    sums = parts.groupBy(*by).agg(listed.alias("parts"))
    return sums.select(*by, F.aggregate("parts", none, _added).alias("sum")).select(
        *by, "sum.n", "sum.mean", "sum.m2")


def history(parts: DataFrame) -> DataFrame:
    """feature, n, mean, m2, deviation over all days. Parts of a day are merged first,
    so no list is longer than the days or the parts of one day."""
    whole = merged(merged(parts, "feature", "day"), "feature")
    spread = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return whole.withColumn("deviation", spread)


def scaled_by(rows: DataFrame, known: DataFrame, features=S.FEATURES) -> DataFrame:
    """Keys and ``scaled_<feature>``: the feature in units of its deviation, 0 where it
    has none. ``known`` holds a row per feature, which are few."""
    spread = {r["feature"]: r["deviation"] for r in known.collect()}
    return rows.select(*S.JOIN_KEYS, *(
        (F.col(name) / F.lit(spread[name]) if spread.get(name) else F.lit(0.0))
        .alias(f"scaled_{name}") for name in features))
