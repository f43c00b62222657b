"""One large document read side by side.

A JSON document of one object or one array, or a list of names in one line, has no
line ends to cut it at. It is read in fragments instead: the text source may split
a file at any byte its records end with, here ``}`` or a comma. Where a fragment
lies in the document follows from the fragments before it. Each fragment's effect
on a reader's state is a number (quotes, braces outside strings, entries ended),
and the effects are added up in file order: inside a split first, then over the
splits, of which there are few. No task sees more than a split, and the driver
sees nothing.

JSON escapes are two signs and never end in a brace, so none is cut in two. A
document that breaks off gives the entries before the break. An entry (a location's
readings, a record) is one value; the document is not.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators.encode import unnest_raw
from envstream.session import materialise

_SPLIT_SETTINGS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
SPLIT = ["file", "split"]
#: Text of one shuffle partition. Rows are short, so a sort holds some ten times that.
PART_BYTES = 16 << 20


@contextmanager
def _splits_of(spark, size):
    before = {name: spark.conf.get(name) for name in _SPLIT_SETTINGS}
    try:
        if size:
            for name in _SPLIT_SETTINGS:
                spark.conf.set(name, str(size))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def fragments(spark: SparkSession, path: str, end: str, split_bytes=None) -> DataFrame:
    """file, split, place, text: what stands between one ``end`` and the next.

    ``split_bytes`` takes the place of the session's split size. ``split`` is the
    byte a split begins at and ``place`` grows inside a split.
    """
    with _splits_of(spark, split_bytes):
        # Read once: places count the rows of a task.
        return materialise(spark.read.option("lineSep", end).text(path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("place"), F.col("value").alias("text")))


def parts_for(rows: DataFrame, part_bytes=PART_BYTES) -> int:
    """How many partitions keep the text of each near ``part_bytes``."""
    return (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // part_bytes + 1


def dealt(rows: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Rows by ``keys`` in ``parts`` partitions, where the session's number is smaller; a
    task's share then does not grow with the document."""
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows if parts <= usual else rows.repartition(parts, *keys)


def added_before(rows: DataFrame, value: Column, name: str, parts=1) -> DataFrame:
    """``name``: the sum of ``value`` over all rows of the file before a row."""
    marked = materialise(rows.withColumn("_value", value))
    starts = marked.groupBy(*SPLIT).agg(F.sum("_value").alias("_sum"))
    # One row per split: a terabyte has some eight thousand.
    over_splits = Window.partitionBy("file").orderBy("split").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = starts.select(*SPLIT, F.coalesce(F.sum("_sum").over(over_splits), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*SPLIT).orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1)
    summed = dealt(marked, parts, *SPLIT).withColumn(
        "_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return summed.join(starts, SPLIT).withColumn(
        name, F.col("_start") + F.col("_inside")).drop("_value", "_start", "_inside")


def _outside_strings(text: Column, in_string: Column) -> Column:
    """What of a fragment (escapes taken out) is not inside a string."""
    opened = F.when(in_string, F.regexp_replace(text, r'^[^"]*"?', "")).otherwise(text)
    return F.regexp_replace(opened, r'"[^"]*("|$)', "")


def _number_of(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def entries(spark: SparkSession, path: str, depth: int, split_bytes=None) -> DataFrame:
    """file, entry_no, text of every entry of the documents under ``path``, one
    document per file. ``depth`` braces are open around an entry: 1 in an object,
    0 in an array. The text begins after the sign that parts it from the one before."""
    rows = fragments(spark, path, "}", split_bytes)
    parts = parts_for(rows)
    rows = rows.withColumn("bare", F.regexp_replace("text", r"\\.", ""))
    quotes = _number_of(F.col("bare"), '"')
    rows = added_before(rows, quotes, "quotes_before", parts)
    started = F.col("quotes_before") % 2 == 1
    outside = _outside_strings(F.col("bare"), started)
    rows = rows.withColumn("in_string", (F.col("quotes_before") + quotes) % 2 == 1)
    # The brace after the fragment closes only outside a string.
    braces = _number_of(outside, "{") - F.when(F.col("in_string"), 0).otherwise(1)
    rows = rows.withColumn("braces", braces).drop("bare", "quotes_before")
    rows = added_before(rows, F.col("braces"), "depth_before", parts)
    ends = ~F.col("in_string") & (F.col("depth_before") + F.col("braces") == depth)
    rows = rows.withColumn("ends", ends)
    rows = added_before(rows, F.col("ends").cast("long"), "entry_no", parts)
    joined = dealt(rows, parts, "file", "entry_no").groupBy("file", "entry_no").agg(
        F.bool_or("ends").alias("whole"),
        F.sort_array(F.collect_list(F.struct("split", "place", "text"))).alias("parts"))
    text = F.concat(F.array_join("parts.text", "}"), F.lit("}"))
    return joined.where("whole").select(
        "file", "entry_no", F.regexp_replace(text, r"^\s*[\[{,]\s*" if depth == 0 else
                                             r"^\s*[{,]\s*", "").alias("text"))


def scan_map_document(spark: SparkSession, path: str, shape: str, split_bytes=None) -> DataFrame:
    """One object per file -> one row per reading, as ``unnest_raw`` gives them;
    ``location_no`` is the location's place in its document."""
    rows = entries(spark, path, 1, split_bytes)
    object_ = F.concat(F.lit("{"), F.col("text"), F.lit("}"))
    decoded = rows.select("entry_no", F.from_json(object_, shape).alias("data"))
    return unnest_raw(decoded, "entry_no")


def scan_raw_air_document(spark, path, split_bytes=None) -> DataFrame:
    return scan_map_document(spark, path, S.RAW_AIR, split_bytes)


def scan_raw_weather_document(spark, path, split_bytes=None) -> DataFrame:
    return scan_map_document(spark, path, S.RAW_WEATHER, split_bytes)


def scan_array_document(spark: SparkSession, path: str, record: str, split_bytes=None) -> DataFrame:
    """One array of objects per file -> ``index``, an object's place in the whole
    array, and its fields."""
    rows = entries(spark, path, 0, split_bytes)
    # The first record's text has lost the bracket, but an object still begins with its brace.
    decoded = rows.select(F.col("entry_no").alias("index"), F.from_json("text", record).alias("record"))
    return decoded.where("record is not null").select("index", "record.*")


def scan_name_line(spark: SparkSession, path: str, split_bytes=None) -> DataFrame:
    """A list of quoted names in one line -> item_no and name, as ``name_list`` gives
    them. A comma parts names only before a blank; a fragment without one goes on with
    the name before, wherever the file was split. A comma that ends the file is no
    part of the last name."""
    rows = fragments(spark, path, ",", split_bytes)
    parts = parts_for(rows)
    rows = dealt(rows, parts, *SPLIT).withColumn("bare", F.replace("text", F.lit('"'), F.lit("")))
    first = (F.col("split") == 0) & (F.col("place") == F.min("place").over(
        Window.partitionBy(*SPLIT)))
    rows = rows.withColumn("begins", F.col("bare").startswith(" ") & ~first)
    rows = added_before(rows, F.col("begins").cast("long"), "names_before", parts)
    item = F.col("names_before") + F.col("begins").cast("long")
    bare = F.when(F.col("begins"), F.expr("substring(bare, 2)")).otherwise(F.col("bare"))
    named = dealt(rows.withColumn("item_no", item), parts, "file", "item_no")
    return named.groupBy("file", "item_no").agg(
        F.sort_array(F.collect_list(F.struct("split", "place", bare.alias("text")))).alias("parts")
    ).select(F.col("item_no").cast("int").alias("item_no"),
             F.array_join("parts.text", ",").alias("name"))
