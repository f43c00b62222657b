"""Which locations to ask for, and when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.functions import wall_clock_epoch


def name_list(texts: DataFrame, column="value") -> DataFrame:
    """Quoted, comma-separated names -> one row per name, in text order.

    Every double quote is removed, inner ones too, then the text is cut at a
    comma and a blank. Repeated names stay.
    """
    bare = F.replace(F.col(column), F.lit('"'), F.lit(""))
    return texts.select(F.posexplode(F.split(bare, ", ")).alias("item_no", "name"))


def in_country(catalogue: DataFrame, country: str) -> DataFrame:
    return catalogue.where(F.col("country") == country)


def named_in(catalogue: DataFrame, names: DataFrame) -> DataFrame:
    """Catalogue rows whose name is listed; repeats in the list do not fan out."""
    return catalogue.join(names.select("name"), "name", "left_semi")


def location_table(catalogue: DataFrame) -> DataFrame:
    """index, name, id, lon, lat - the index is the row's place in the catalogue."""
    return catalogue.select("index", "name", "id", "coord.lon", "coord.lat")


def with_readings(documents: DataFrame, list_column="list") -> DataFrame:
    """Only documents that have a list, and not an empty one."""
    return documents.where(F.size(list_column) > 0)


def fetch_plan(locations: DataFrame, first_day: str, weeks=9, zone="UTC") -> DataFrame:
    """One request per location and week: from that week on to the fixed end.

    The weeks are unnested per row, so no join takes place. Week steps are
    steps of the wall clock in ``zone``.
    """
    first = F.lit(first_day).cast("timestamp_ntz")
    last = F.lit(first_day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(7 * (weeks - 1)))
    end = F.lit(first_day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(7 * weeks))
    starts = F.sequence(first, last, F.make_dt_interval(F.lit(7)))
    return locations.select(
        *locations.columns, F.posexplode(starts).alias("week_no", "_start")
    ).select(
        *locations.columns,
        "week_no",
        wall_clock_epoch(F.col("_start"), zone).alias("start_unix"),
        wall_clock_epoch(end, zone).alias("end_unix"),
    )
