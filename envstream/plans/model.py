"""Random forest for the air quality index: pipeline, split, scores."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators.metrics import prediction_pairs, regression_metrics

SEED = 20240101


def scaling_stages(features=S.FEATURES):
    return [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled_features"),
    ]


def build_pipeline(seed=SEED, label=S.LABEL, features=S.FEATURES) -> Pipeline:
    forest = RandomForestRegressor(featuresCol="scaled_features", labelCol=label, seed=seed)
    return Pipeline(stages=[*scaling_stages(features), forest])


def in_training(share=0.8):
    """True for ``share`` of the readings, by the digest of place and time: the
    same rows on every run, and copies of a key never on both sides."""
    if not 0 < share < 1:
        raise ValueError("the share must lie between 0 and 1")
    second = F.unix_seconds(S.TIME).cast("string")
    digest = F.md5(F.concat_ws("|", "location_name", second))
    number = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")
    return number < F.lit(round(share * 65536))


def split(df: DataFrame, share=0.8, seed=None):
    """Training and test rows; with ``seed`` Spark's random split instead."""
    if seed is not None:
        return df.randomSplit([share, 1 - share], seed=seed)
    return df.where(in_training(share)), df.where(~in_training(share))


def scaled_columns(df: DataFrame, features=S.FEATURES) -> DataFrame:
    """Fitted scaling, one column ``scaled_<feature>`` per input."""
    model = Pipeline(stages=scaling_stages(features)).fit(df)
    values = vector_to_array("scaled_features")
    scaled = [values[i].alias(f"scaled_{name}") for i, name in enumerate(features)]
    return model.transform(df).select(*S.JOIN_KEYS, *scaled)


def fit_and_score(df: DataFrame, seed=SEED, share=0.8):
    """(model, pairs of the test rows), or None if either side of the split is empty."""
    train, test = split(df, share)
    if train.isEmpty() or test.isEmpty():
        return None
    model = build_pipeline(seed).fit(train)
    return model, prediction_pairs(model.transform(test))


def metrics_for(pairs: DataFrame, batch_id: int) -> DataFrame:
    return regression_metrics(pairs).select(
        F.lit(batch_id).cast("bigint").alias("batch_id"), "rmse", "mae", "accuracy"
    )
