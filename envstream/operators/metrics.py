"""Error, accuracy and confusion of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.functions import class_of, nearest_class


def prediction_pairs(df: DataFrame, prediction="prediction", label=S.LABEL) -> DataFrame:
    """Raw prediction, label, and the class by truncation and by rounding."""
    return df.select(
        F.col(prediction).cast("double").alias("prediction"),
        F.col(label).cast("double").alias("label"),
        class_of(prediction).alias("rounded_prediction"),
        nearest_class(prediction).alias("nearest_prediction"),
    )


def regression_metrics(pairs: DataFrame) -> DataFrame:
    """RMSE and MAE of the raw prediction, accuracy of the truncated one; one pass."""
    error = F.col("prediction") - F.col("label")
    hit = (F.col("rounded_prediction").cast("double") == F.col("label")).cast("double")
    return pairs.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(hit).alias("accuracy"),
    )


SCORE_PARTS = ("label double, predicted double, n_rows long, squares double, "
               "distances double")


def score_parts(pairs: DataFrame) -> DataFrame:
    """What later scores need of some pairs: rows and error sums of every cell (label,
    predicted class). Sums of several batches add up."""
    error = F.col("prediction") - F.col("label")
    return pairs.groupBy(
        "label", F.col("rounded_prediction").cast("double").alias("predicted")
    ).agg(
        F.count("*").alias("n_rows"), F.sum(error * error).alias("squares"),
        F.sum(F.abs(error)).alias("distances"),
    )


def metrics_of_parts(parts: DataFrame) -> DataFrame:
    """``regression_metrics`` of all pairs that went into the parts. Pairs without
    label or prediction have no error and do not count."""
    known = parts.where("squares is not null")
    n = F.sum("n_rows")
    return known.agg(
        F.sqrt(F.sum("squares") / n).alias("rmse"),
        (F.sum("distances") / n).alias("mae"),
        (F.sum(F.when(F.col("predicted") == F.col("label"), F.col("n_rows")).otherwise(0)) / n)
        .alias("accuracy"),
    )


def cells_of_parts(parts: DataFrame) -> DataFrame:
    """``confusion_counts`` of all pairs that went into the parts; a class counts as a
    label wherever in the history it was one."""
    return _known_cells(parts.groupBy("label", "predicted").agg(F.sum("n_rows").alias("n_rows")))


def confusion_counts(pairs: DataFrame) -> DataFrame:
    """Rows per (label, predicted class), for classes that occur as labels.

    A prediction outside the label set has no cell, though it counts against
    accuracy. Counting comes first; then each cell stands once under its
    predicted class and once, as a marker, under its label, so that the label
    test is a window over cells and the predictions are worked out only once.
    """
    cells = pairs.groupBy(
        "label", F.col("rounded_prediction").cast("double").alias("predicted")
    ).agg(F.count("*").alias("n_rows"))
    return _known_cells(cells)


def _known_cells(cells: DataFrame) -> DataFrame:
    places = F.array(
        F.struct(F.col("predicted").alias("class"), F.lit(False).alias("is_label")),
        F.struct(F.col("label").alias("class"), F.lit(True).alias("is_label")),
    )
    known = F.max("is_label").over(Window.partitionBy("class"))
    return (
        cells.select("label", "predicted", "n_rows", F.inline(places))
        .withColumn("known", known)
        .where(F.col("known") & ~F.col("is_label"))
        .select("label", "predicted", "n_rows")
    )


def confusion_table(cells: DataFrame, labels) -> DataFrame:
    """The cells as a matrix for display: one row per label, one column per class."""
    wide = cells.groupBy("label").pivot("predicted", list(labels)).sum("n_rows")
    return wide.na.fill(0).orderBy("label")
