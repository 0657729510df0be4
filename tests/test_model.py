"""The delay model."""

import math

import pyarrow as pa
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from ontime_spark.ml import forest, nodes, training
from ontime_spark.operators.records import clean_for_training
from ontime_spark.sources import testdata
from ontime_spark.sources.marts import read_mart


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    flights = testdata.flights(spark, sf_dir)
    pipeline = forest.build_pipeline(trees=5, depth=4)
    return training.train(flights, pipeline, fraction=0.9, seed=7)


def test_published_settings(spark):
    stage = forest.build_pipeline().getStages()[-1]
    assert (stage.getNumTrees(), stage.getMaxDepth(), stage.getMaxBins(), stage.getSeed()) == (100, 10, 400, 42)


def test_counts(spark, sf_dir, trained):
    counts = trained.counts
    cleaned = clean_for_training(testdata.flights(spark, sf_dir)).count()
    assert counts["cleaned"] == cleaned
    assert 0 < counts["test"] < counts["train"] < counts["sampled"] < cleaned
    assert counts["train"] + counts["test"] == counts["sampled"]
    assert trained.predictions.count() == counts["test"]


def test_metrics_agree_with_the_evaluator(trained):
    ours = trained.metrics.first()
    for name in ("mae", "rmse", "r2"):
        evaluator = RegressionEvaluator(labelCol="arrDelay", predictionCol="prediction", metricName=name)
        assert math.isclose(evaluator.evaluate(trained.predictions), ours[name], rel_tol=1e-9)
    assert ours["r2"] > 0.5


def test_metrics_of_a_constant_label(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "arrDelay double, prediction double")
    assert tuple(forest.regression_metrics(frame).first()) == (2, 0.5, math.sqrt(0.5), None)


def test_importance(trained):
    rows = trained.importance.collect()
    assert {r["feature_name"] for r in rows} == set(forest.FEATURES)
    assert math.isclose(sum(r["importance"] for r in rows), 1.0)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    assert forest.top_feature(trained.importance).first()["feature_name"] == "depDelay"


def test_stored_results(spark, trained, tmp_path):
    root, path = str(tmp_path / "marts"), str(tmp_path / "model")
    for _ in range(2):
        training.store_results(trained, path, root)
    result = read_mart(spark, "ml_results", root).collect()
    assert len(result) == 2 and result[0]["total_records"] == trained.counts["cleaned"]
    assert result[0]["top_feature"] == "depDelay" and result[0]["created_at"] is not None
    assert read_mart(spark, "ml_feature_importance", root).count() == 10
    again = forest.load_model(path).transform(trained.predictions.drop(
        "carrierIdx", "originIdx", "destIdx", "features", "prediction"))
    assert again.exceptAll(trained.predictions).isEmpty()


def test_missing_models(tmp_path):
    assert forest.load_model(None, required=False) is None
    assert forest.load_model(str(tmp_path / "none"), required=False) is None
    with pytest.raises(Exception):
        forest.load_model(str(tmp_path / "none"))


def test_unseen_text_is_scored_and_missing_numbers_are_not(spark, sf_dir, trained):
    flights = testdata.flights(spark, sf_dir).limit(3)
    unseen = flights.withColumn("carrier", F.lit("??")).withColumn("depDelay", F.lit(None).cast("double"))
    assert forest.score(unseen, trained.model).where("prediction is not null").count() == 3
    missing = flights.withColumn("distance", F.when(F.col("eventId") > 0, F.col("distance")))
    dropped = flights.count() - missing.where("distance is not null").count()
    scored = forest.score(missing, trained.model)
    assert scored.count() == 3 - dropped == forest.scorable(missing, trained.model).count()


def test_the_same_rows_by_key_on_any_partitioning(spark, sf_dir):
    flights = testdata.flights(spark, sf_dir)
    draws = [
        training.draw_sample(flights.repartition(n), key="eventId", fraction=0.5) for n in (2, 5)
    ]
    ids = [sorted(r[0] for r in d.train.select("eventId").collect()) for d in draws]
    assert ids[0] == ids[1] and len(ids[0]) == draws[0].counts["train"]


def test_importance_names_follow_the_model(spark, sf_dir):
    numbers = forest.NUMBER_FEATURES[::-1][:3]
    pipeline = forest.build_pipeline(text=("origin",), numbers=numbers, trees=2, depth=2)
    done = training.train(testdata.flights(spark, sf_dir), pipeline, key="eventId")
    assert forest.feature_names(done.model) == ["origin", *numbers]
    assert {r["feature_name"] for r in done.importance.collect()} == {"origin", *numbers}


def test_a_row_keeps_the_node_it_has_reached(spark, sf_dir, trained):
    """Without walking each tree anew in every pass, and to the same forest."""
    stage = forest.build_pipeline().getStages()[-1]
    assert stage.getCacheNodeIds()
    walking = forest.build_pipeline(trees=5, depth=4)
    walking.getStages()[-1].setCacheNodeIds(False)
    again = training.train(testdata.flights(spark, sf_dir), walking, fraction=0.9, seed=7)
    assert again.model.stages[-1].toDebugString.split("\n")[1:] == trained.model.stages[-1].toDebugString.split("\n")[1:]


def test_a_batch_down_the_trees_gives_the_models_predictions(spark, sf_dir, trained):
    flights = testdata.flights(spark, sf_dir).withColumn("carrier", F.when(F.col("eventId") % 7 == 0, "unseen").otherwise(F.col("carrier")))
    flights = flights.withColumn("distance", F.when(F.col("eventId") % 11 != 0, F.col("distance")))
    own = forest.score(flights, trained.model).select("eventId", F.col("prediction").alias("own"))
    plan = forest.scorer(spark, trained.model)(flights)
    both = own.join(plan.select("eventId", "prediction"), "eventId", "full").collect()
    assert len(both) == own.count() > 0
    assert all(r["own"] == r["prediction"] for r in both)


def test_trees_of_one_node_and_of_listed_categories():
    names = ["tree", "node", "prediction", "left", "right", "feature", "threshold", "categories"]
    rows = [
        (0, 0, 5.0, None, None, None, None, None),
        (1, 0, 0.0, 1, 2, "c", None, [0.0, 9.0]),
        (1, 1, 1.0, None, None, None, None, None),
        (1, 2, 0.0, 3, 4, "x", 0.5, None),
        (1, 3, 2.0, None, None, None, None, None),
        (1, 4, 3.0, None, None, None, None, None),
    ]
    trees = nodes.Forest(pa.Table.from_pylist([dict(zip(names, r)) for r in rows]), ["x", "c"])
    x = [[0.5, 0.0], [0.5, 9.0], [0.5, 1.0], [0.6, 30.0], [math.nan, 8.0]]
    assert trees.predict_lists(pa.array(x)).to_pylist() == [3.0, 3.0, 3.5, 4.0, 4.0]
    assert trees.predict_lists(pa.array([], pa.list_(pa.float64()))).to_pylist() == []
