"""The training job: clean, sample, split, fit, measure, store."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ontime_spark.ml import forest
from ontime_spark.operators.records import clean_for_training
from ontime_spark.operators.sampling import bernoulli_sample, hash_sample, hash_split, random_split
from ontime_spark.session import scratch_path
from ontime_spark.sinks import database, marts


@dataclass(frozen=True)
class Sample:
    """Training and test rows, read from the written sample, and how many rows each step kept."""

    train: DataFrame
    test: DataFrame
    counts: dict[str, int]


@dataclass(frozen=True)
class Training:
    """A fitted model and how it did."""

    model: PipelineModel
    metrics: DataFrame
    importance: DataFrame
    predictions: DataFrame
    counts: dict[str, int]


LEAST_PARTITIONS = 8
ROWS_A_PARTITION = 200_000


def laid_out(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in partitions that its rows alone decide.

    A forest draws its bags partition by partition, in order. Partitions by number of rows and by hash, each
    in order, give the same forest on any cluster and for any files.
    """
    parts = max(LEAST_PARTITIONS, -(-rows // ROWS_A_PARTITION))
    return df.repartition(parts, *df.columns).sortWithinPartitions(*df.columns)


def draw_sample(
    rows: DataFrame,
    fraction: float = 0.2,
    train_fraction: float = 0.8,
    seed: int = 42,
    key: str | None = None,
) -> Sample:
    """Clean, sample and split records, or the rows of a file read by header name.

    The sample is written to the shared folder once, as training reads it many times. Rows are drawn by
    the hash of their content, equal ones each for itself, or with ``key`` by its hash in whole percents:
    the same rows on any cluster either way.
    """
    spark = rows.sparkSession
    seen = Observation()
    keep = () if key is None else (key,)
    cleaned = clean_for_training(rows, keep=keep).observe(seen, F.count(F.lit(1)).alias("cleaned"))
    path = scratch_path(spark, "training-sample")
    if key is None:
        bernoulli_sample(cleaned, fraction, seed).write.parquet(path)
        sample = spark.read.parquet(path)
        parts = random_split(sample, (train_fraction, 1 - train_fraction), seed)
    else:
        sampled = hash_sample(cleaned, key, round(fraction * 100))
        hash_split(sampled, key, round(train_fraction * 100)).write.parquet(path)
        sample = spark.read.parquet(path)
        parts = [sample.where(F.col("split") == name).drop("split") for name in ("train", "test")]
    sampled_rows, train_rows = sample.count(), parts[0].count()
    counts = {
        "cleaned": seen.get["cleaned"],
        "sampled": sampled_rows,
        "train": train_rows,
        "test": sampled_rows - train_rows,
    }
    return Sample(parts[0], parts[1], counts)


def train(rows: DataFrame, pipeline: Pipeline | None = None, **sampling) -> Training:
    """Fit a model on a sample of ``rows`` and measure it on the part held out.

    ``sampling`` goes to :func:`draw_sample`.
    """
    sample = draw_sample(rows, **sampling)
    model = (pipeline or forest.build_pipeline()).fit(laid_out(sample.train, sample.counts["train"]))
    predictions = model.transform(sample.test)
    return Training(
        model=model,
        metrics=forest.regression_metrics(predictions),
        importance=forest.feature_importance(rows.sparkSession, model),
        predictions=predictions,
        counts=sample.counts,
    )


def result_row(training: Training) -> DataFrame:
    """The row of ``ml_results``. ``total_records`` are the cleaned rows, before sampling."""
    best = forest.top_feature(training.importance).select(
        F.col("feature_name").alias("top_feature")
    )
    return training.metrics.select(
        "r2",
        "mae",
        "rmse",
        F.lit(training.counts["cleaned"]).cast("bigint").alias("total_records"),
        F.lit(best.first()[0]).alias("top_feature"),
    )


def store_results(
    training: Training,
    model_path: str | None = None,
    root: str | None = None,
    jdbc: dict[str, str] | None = None,
    run: str | None = None,
    batch_id: int = 0,
) -> None:
    """Save the model, and append its metrics and merge its importances into the marts.

    Every training adds its own row of metrics; give ``run`` to repeat one that failed half-way.
    """
    run = run or uuid.uuid4().hex[:12]
    if model_path is not None:
        forest.save_model(training.model, model_path)
    if jdbc is not None:
        database.append(result_row(training), jdbc, "ml_results", batch_id, run)
        database.upsert(training.importance, jdbc, "ml_feature_importance", batch_id, run, unique=True)
    if root is not None:
        marts.append_batch(result_row(training), root, "ml_results", batch_id, run)
        marts.upsert(training.importance, root, "ml_feature_importance", batch_id, unique=True)
