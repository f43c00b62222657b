"""NULL rows, duplicates, and one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_nulls(df: DataFrame, columns=None) -> DataFrame:
    """Rows with every column (or every named column) present."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def dedup_batch(df: DataFrame) -> DataFrame:
    """Whole-row distinct of a bounded frame; copies collapse before the shuffle."""
    return df.distinct()


def dedup_global(df: DataFrame, time=None, delay=None) -> DataFrame:
    """Whole-row distinct over the life of a streaming query.

    Without ``delay`` nothing is ever forgotten. With it, state older than the
    watermark is dropped, and so are rows that arrive later than that.
    """
    if delay is not None:
        df = df.withWatermark(time, delay)
    return df.dropDuplicates()


def row_digest(columns) -> Column:
    """128 bits of typed columns [(name, type)]; equal for what a distinct calls equal."""
    def plain(name, kind):
        if kind in ("double", "float"):
            return (F.col(name) + F.lit(0.0)).alias(name)  # 0.0 and -0.0 are one value
        return F.unix_micros(name).alias(name) if kind == "timestamp" else F.col(name)

    row = F.struct(*(plain(name, kind) for name, kind in columns))
    return F.unhex(F.md5(F.to_json(row, {"ignoreNullFields": "false"})))


def dedup_digest(df: DataFrame, time, delay) -> DataFrame:
    """Whole-row distinct of a stream with a bounded state of 16 bytes and a time per
    row, whatever the width of the rows.

    Copies of a row have its time, so the state of a row is dropped only when any
    further copy would come behind the watermark and be dropped itself.
    """
    marked = df.withWatermark(time, delay).withColumn("_digest", row_digest(df.dtypes))
    return marked.dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def dedup_spread(df: DataFrame, salt, parts=16, time=None, delay=None) -> DataFrame:
    """Streaming distinct in two steps, for rows copied over very many messages.

    ``salt`` is any column that differs between messages (their text, offset or
    key). The first step keeps at most ``parts`` copies of a row, each in its
    own state partition; the second keeps one.
    """
    if delay is not None:
        df = df.withWatermark(time, delay)
    columns = [c for c in df.columns if c != salt]
    part = F.pmod(F.xxhash64(salt), F.lit(parts)).alias("_part")
    return (
        df.select(*columns, part).dropDuplicates().select(*columns).dropDuplicates()
    )


def _pick(df, keys, order, rank="_rank"):
    # A rank filter of 1 is also applied before the shuffle (WindowGroupLimit),
    # so a hot key sends one row per map task.
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(rank, F.row_number().over(window))
        .where(F.col(rank) == 1)
        .drop(rank)
    )


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The first row of every key in the stated order."""
    return _pick(df, keys, [F.col(c).asc_nulls_last() for c in order])


def last_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The last row of every key in the stated order."""
    return _pick(df, keys, [F.col(c).desc_nulls_last() for c in order])


def categories(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column with their number of rows."""
    return df.groupBy(column).agg(F.count("*").alias("n_rows"))


def category_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n_categories"))
