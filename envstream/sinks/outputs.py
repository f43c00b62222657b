from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from envstream import schemas as S
from envstream.operators.encode import MAX_ENTRIES, regroup
from envstream.session import materialise, shared_dir


def in_stretches(messages: DataFrame, seconds=3600, key="dt"):
    """The messages cut into stretches of time, oldest first.

    They are landed once, by stretch. Whoever writes one stretch after the other
    keeps the order of time between them; inside a stretch the write is parallel.
    A reader with a watermark loses nothing as long as its delay is not shorter
    than a stretch.
    """
    number = F.floor(F.col(key) / F.lit(seconds)).cast("bigint")
    path = shared_dir(messages.sparkSession, "stretches")
    landed = messages.withColumn("_stretch", number).hint("rebalance", "_stretch")
    landed.write.partitionBy("_stretch").parquet(path)
    shape = StructType([*messages.schema.fields, StructField("_stretch", LongType())])
    rows = messages.sparkSession.read.schema(shape).parquet(path)
    # One number per stretch of time, however many messages it holds.
    for found in rows.select("_stretch").distinct().orderBy("_stretch").collect():
        yield rows.where(F.col("_stretch") == found[0]).drop("_stretch")


def write_topic(messages: DataFrame, servers: str, topic: str | None = None) -> None:
    """Send ``value`` (and ``key``, if there is one) to one topic, or to the one
    each row names in ``topic``."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    writer.save()


def write_feed(messages: DataFrame, path: str) -> None:
    """Land messages (topic, value) where a file stream picks them up."""
    messages.select("topic", "value").write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def raw_lines(readings: DataFrame, item="item", coord=None, order=("pos",), stretch=None,
              max_entries=MAX_ENTRIES) -> DataFrame:
    """Readings -> one JSON object ``{"<location>": {...}}`` per line.

    A location's list is cut after ``max_entries`` readings and goes on in a
    further line, so a location with very many readings is no single row.
    """
    place = ["location_name"] + ([coord] if coord else [])
    lists = regroup(readings, place, item, list(order), stretch, max_entries)
    info = [F.col("entries").alias("list")]
    if coord:
        info.insert(0, F.col(coord).alias("coord"))
    return lists.select(
        F.to_json(F.create_map("location_name", F.struct(*info))).alias("value")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_document(parts: DataFrame, path: str, order, opening="", closing=None, comma=",",
                   line_end="\n") -> None:
    """``value`` of all rows as ONE file with one document, in ``order``: the form a
    producer outside leaves. One task writes it, which a single file makes needful; the
    rows are sorted by many tasks before, and the one that writes holds a row at a time."""
    order = [F.col(column).alias(f"_{i}") for i, column in enumerate(order)]
    rows = parts.select(F.lit(0).alias("_end"), *order, "value")
    if closing is not None:
        end = parts.sparkSession.range(1).select(F.lit(1).alias("_end"), F.lit(closing).alias("value"))
        rows = rows.unionByName(end, allowMissingColumns=True)
    ordered = rows.orderBy("_end", *(f"_{i}" for i in range(len(order))))
    placed = materialise(
        ordered.select("_end", F.monotonically_increasing_id().alias("_place"), "value"))
    first = placed.agg(F.min("_place")).first()[0]
    begins = F.col("_place") == F.lit(first).cast("long")
    lead = F.when(F.col("_end") == 1, F.when(begins, opening).otherwise("")).otherwise(
        F.when(begins, opening).otherwise(comma))
    # Joining partitions one after the other keeps their order.
    placed.coalesce(1).select(F.concat(lead, "value").alias("value")).write.mode(
        "overwrite").option("lineSep", line_end).text(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One row per batch id. Other batches stay, a replayed batch replaces its row."""
    (
        metrics.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def read_metrics(spark, path: str) -> DataFrame:
    rows = spark.read.schema(S.METRICS_ROW).parquet(path)
    return rows.select("batch_id", "rmse", "mae", "accuracy")


def write_model(model, path: str, batch_id: int) -> str:
    target = f"{path.rstrip('/')}/{batch_id}"
    model.write().overwrite().save(target)
    return target


def show_batch(df: DataFrame, rows=5) -> None:
    """Shape and a few rows on the console, for a look while trying things out."""
    df.printSchema()
    df.show(rows, truncate=False)
