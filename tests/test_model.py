import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators import metrics, parse, unify
from envstream.plans import derived, model
from envstream.sinks import outputs
from envstream.streaming.batch_parts import BatchParts
from envstream.streaming.trainer import BatchTrainer
from helpers import counted


@pytest.fixture(scope="module")
def readings(spark, sf_dir):
    air = parse.air_rows(derived.air_messages(spark, sf_dir))
    weather = parse.weather_rows(derived.weather_messages(spark, sf_dir))
    return unify.unify(air, weather).cache()


def pairs(spark, rows):
    df = spark.createDataFrame(rows, "prediction double, air_quality_index int")
    return metrics.prediction_pairs(df)


def test_classes_are_cut_not_rounded(spark):
    rows = pairs(spark, [(2.9, 2), (2.5, 2), (1.999, 2)]).collect()
    assert [r.rounded_prediction for r in rows] == [2, 2, 1]
    assert [r.nearest_prediction for r in rows] == [3, 3, 2]


def test_scores_and_matrix(spark):
    df = pairs(spark, [(2.0, 1), (1.0, 1), (3.0, 3)])
    row = metrics.regression_metrics(df).first()
    assert row.accuracy == pytest.approx(2 / 3)
    assert row.rmse == pytest.approx(math.sqrt(1 / 3)) and row.mae == pytest.approx(1 / 3)
    cells = metrics.confusion_counts(df)
    assert counted(cells) == [(1.0, 1.0, 1), (3.0, 3.0, 1)]
    assert counted(metrics.confusion_table(cells, [1.0, 3.0])) == [(1.0, 1, 0), (3.0, 0, 1)]


def test_scores_equal_the_evaluators(readings):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

    _, scored = model.fit_and_score(readings)
    row = metrics.regression_metrics(scored).first()
    for name in ("rmse", "mae"):
        expected = RegressionEvaluator(labelCol="label", metricName=name).evaluate(scored)
        assert row[name] == pytest.approx(expected)
    hits = scored.withColumn("prediction", F.col("rounded_prediction").cast("double"))
    assert row.accuracy == pytest.approx(
        MulticlassClassificationEvaluator(metricName="accuracy").evaluate(hits)
    )


def test_forest_defaults(readings):
    fitted, scored = model.fit_and_score(readings)
    forest = fitted.stages[-1]
    assert forest.getNumTrees == 20 and forest.getMaxDepth() == 5 and forest.getMaxBins() == 32
    assert forest.getImpurity() == "variance" and forest.numFeatures == 20
    again = model.fit_and_score(readings)[1]
    assert counted(metrics.regression_metrics(scored)) == counted(metrics.regression_metrics(again))


def test_split_repeats_and_keeps_all_rows(readings):
    train, test = model.split(readings)
    assert train.count() + test.count() == readings.count()
    assert 0.6 < train.count() / readings.count() < 0.95
    assert train.select(*S.JOIN_KEYS).intersect(test.select(*S.JOIN_KEYS)).count() == 0
    assert counted(train) == counted(model.split(readings)[0])
    a, b = model.split(readings, seed=1)
    assert a.count() + b.count() == readings.count()


def test_constant_column_scales_to_zero(readings):
    flat = readings.withColumn("co", F.lit(7.0))
    row = model.scaled_columns(flat).select("scaled_co", "scaled_no").first()
    assert row.scaled_co == 0.0 and row.scaled_no != 0.0


def test_trainer_keeps_one_model_and_row_per_batch(spark, readings, tmp_path):
    scores = str(tmp_path / "scores")
    train = BatchTrainer(str(tmp_path / "models"), str(tmp_path / "metrics"), scores=scores)
    train(readings, 0)
    only = metrics.metrics_of_parts(BatchParts(scores, metrics.SCORE_PARTS).read(spark)).first()
    assert tuple(only) == pytest.approx(tuple(outputs.read_metrics(spark, train.metrics).first()[1:]))
    train(readings.where("air_quality_index < 4"), 1)
    parts = BatchParts(scores, metrics.SCORE_PARTS).read(spark)
    whole = tuple(metrics.metrics_of_parts(parts).first())
    first = counted(outputs.read_metrics(spark, train.metrics))
    assert [r[0] for r in first] == [0, 1]
    train(readings, 0)
    assert counted(outputs.read_metrics(spark, train.metrics)) == first
    again = BatchParts(scores, metrics.SCORE_PARTS).read(spark)
    assert tuple(metrics.metrics_of_parts(again).first()) == pytest.approx(whole)
    loaded = PipelineModel.load(f"{train.models}/1")
    assert "prediction" in loaded.transform(readings).columns


def test_trainer_shows_what_it_does(readings, tmp_path, capsys):
    BatchTrainer(str(tmp_path / "m"), str(tmp_path / "s"), verbose=True)(readings, 0)
    shown = capsys.readouterr().out
    assert "air_quality_index" in shown and "predicted" in shown


@pytest.mark.parametrize("rows", [0, 1])
def test_trainer_skips_a_batch_without_both_parts(readings, tmp_path, rows):
    train = BatchTrainer(str(tmp_path / "models"), str(tmp_path / "metrics"))
    train(readings.limit(rows), 0)
    assert not (tmp_path / "models").exists() and not (tmp_path / "metrics").exists()


def test_trainer_on_a_stream(spark, sf_dir, tmp_path):
    from envstream.plans.replay import replay_to_batches
    from envstream.streaming.queries import unified_stream

    train = BatchTrainer(str(tmp_path / "models"), str(tmp_path / "metrics"))
    replay_to_batches(
        spark, derived.feed(spark, sf_dir),
        lambda m: unified_stream(m, derived.AIR_TOPIC, derived.WEATHER_TOPIC), train, slices=2,
    )
    assert outputs.read_metrics(spark, train.metrics).count() == 2
