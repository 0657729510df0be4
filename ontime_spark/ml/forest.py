"""The arrival-delay forest: features, fitting, scoring, quality."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ontime_spark.functions.numeric import round_half_up
from ontime_spark.ml.nodes import Forest
from ontime_spark.operators.records import fill_missing_delays
from ontime_spark.session import scratch_path

LABEL = "arrDelay"
# The text and number features, in vector order.
TEXT_FEATURES = ("carrier", "origin", "dest")
NUMBER_FEATURES = (
    "dayOfWeek",
    "month",
    "depDelay",
    "distance",
    "weatherDelay",
    "carrierDelay",
    "nasDelay",
)
FEATURES = TEXT_FEATURES + NUMBER_FEATURES


def feature_stages(
    text: Sequence[str] = TEXT_FEATURES, numbers: Sequence[str] = NUMBER_FEATURES
) -> list:
    """Index the text columns by frequency, unseen text last, and assemble one vector."""
    indexed = [f"{c}Idx" for c in text]
    indexer = StringIndexer(inputCols=list(text), outputCols=indexed, handleInvalid="keep")
    assembler = VectorAssembler(
        inputCols=indexed + list(numbers), outputCol="features", handleInvalid="skip"
    )
    return [indexer, assembler]


def build_pipeline(
    text: Sequence[str] = TEXT_FEATURES,
    numbers: Sequence[str] = NUMBER_FEATURES,
    trees: int = 100,
    depth: int = 10,
    bins: int = 400,
    seed: int = 42,
    memory_mb: int = 512,
    bootstrap: bool = True,
) -> Pipeline:
    """Features and a random forest. Without ``bootstrap`` every tree sees every row once.

    ``bins`` must exceed the number of values of every text feature. ``memory_mb`` is what the
    statistics of the tree nodes split together may take in a task; each pass over the training
    rows splits one such group, so more memory means fewer passes. Each pass knows the node that a
    row has reached in a tree, instead of walking the tree from its root again.
    """
    forest = RandomForestRegressor(
        labelCol=LABEL,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        seed=seed,
        maxMemoryInMB=memory_mb,
        cacheNodeIds=True,
        bootstrap=bootstrap,
    )
    return Pipeline(stages=[*feature_stages(text, numbers), forest])


def feature_columns(df: DataFrame, features: PipelineModel, *keep: str) -> DataFrame:
    """Each feature as a column of its own, from fitted feature stages."""
    values = vector_to_array("features")
    return features.transform(df).select(
        *keep, *(F.get(values, F.lit(i)).alias(name) for i, name in enumerate(feature_names(features)))
    )


def scorable(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows the model can score, missing delays zero.

    Text the model has not seen has an index of its own; a missing or NaN number makes it skip
    the row.
    """
    inputs = [
        name
        for stage in model.stages
        if isinstance(stage, VectorAssembler)
        for name in stage.getInputCols()
    ]
    numbers = [name for name in inputs if name in df.columns]
    filled = fill_missing_delays(df)
    return filled.na.drop(subset=numbers) if numbers else filled


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``prediction`` to the rows the model can score."""
    return model.transform(fill_missing_delays(df))


def scorer(spark: SparkSession, model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """What :func:`score` does, made ready once for many rows.

    A forest at the end of the model takes Arrow batches down its trees, for the same predictions in less
    time. The driver holds its nodes, as it does the model. Other models are used as they are.
    """
    last = model.stages[-1]
    assembler = next((s for s in model.stages if isinstance(s, VectorAssembler)), None)
    if not isinstance(last, RandomForestRegressionModel) or assembler is None or assembler.getOutputCol() != last.getFeaturesCol():
        return lambda df: score(df, model)
    held = Forest(node_table(spark, model, scratch_path(spark, "forest")).toArrow(), assembler.getInputCols())
    predict = F.arrow_udf(lambda features: held.predict_lists(features), "double")
    stages = PipelineModel(model.stages[:-1])

    def scored(df: DataFrame) -> DataFrame:
        rows = stages.transform(fill_missing_delays(df))
        return rows.withColumn(last.getPredictionCol(), predict(vector_to_array(last.getFeaturesCol())))

    return scored


def prediction_rows(scored: DataFrame, *keep: str) -> DataFrame:
    """Scored events as rows of the predictions table, minutes to two places."""
    return scored.select(
        "carrier",
        F.col("flightNumber").alias("flight_number"),
        "origin",
        "dest",
        round_half_up(F.col("depDelay")).alias("dep_delay"),
        round_half_up(F.col("arrDelay")).alias("actual_delay"),
        round_half_up(F.col("prediction")).alias("predicted_delay"),
        *keep,
    )


def regression_metrics(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """``rows``, ``mae``, ``rmse`` and ``r2`` in one pass."""
    error = F.col(prediction) - F.col(label)
    n = F.count(error)
    spread = F.var_pop(F.when(error.isNotNull(), F.col(label))) * n
    return df.agg(
        n.alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
    )


def feature_names(model: PipelineModel) -> list[str]:
    """The model's features in the order of its vector."""
    given: dict[str, str] = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            given.update(zip(stage.getOutputCols(), stage.getInputCols()))
    assembler = next(stage for stage in model.stages if isinstance(stage, VectorAssembler))
    return [given.get(name, name) for name in assembler.getInputCols()]


def feature_importance(
    spark: SparkSession, model: PipelineModel, names: Sequence[str] | None = None
) -> DataFrame:
    """``feature_name`` and ``importance``, one row per feature, greatest first.

    The names are those of the fitted assembler's inputs, an indexed text's that of the text.
    """
    names = feature_names(model) if names is None else names
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(names, values, strict=True)]
    return spark.createDataFrame(rows, "feature_name string, importance double").orderBy(
        F.desc("importance"), "feature_name"
    )


def top_feature(importance: DataFrame) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature_name").limit(1)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str | None, required: bool = True) -> PipelineModel | None:
    """A saved model. When it is not ``required``, None in place of one that cannot be loaded."""
    if path is None and not required:
        return None
    try:
        return PipelineModel.load(path)
    except Exception:
        if required:
            raise
        return None


def node_table(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    """The trees of a fitted forest as rows, one per node, read from the model saved at ``path``.

    An inner node sends a row left where its ``feature`` is at most ``threshold``, or where it is among
    ``categories``, and right otherwise. ``feature`` is the vector's input column. A leaf has none.
    """
    save_model(model, path)
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    last = len(model.stages) - 1
    data = spark.read.parquet(f"{path}/stages/{last}_*/data")
    node, split = "nodeData.", "nodeData.split."
    inner = F.col(f"{node}leftChild") >= 0
    listed = F.col(f"{split}numCategories") >= 0
    values = F.col(f"{split}leftCategoriesOrThreshold")
    feature = F.get(F.array(*map(F.lit, inputs)), F.col(f"{split}featureIndex"))
    return data.select(
        F.col("treeID").cast("int").alias("tree"),
        F.col(f"{node}id").cast("int").alias("node"),
        F.col(f"{node}prediction").alias("prediction"),
        F.col(f"{node}impurity").alias("impurity"),
        F.col(f"{node}gain").alias("gain"),
        F.col(f"{node}rawCount").cast("bigint").alias("rows"),
        F.when(inner, F.col(f"{node}leftChild")).cast("int").alias("left"),
        F.when(inner, F.col(f"{node}rightChild")).cast("int").alias("right"),
        F.when(inner, feature).alias("feature"),
        F.when(inner & ~listed, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & listed, values).alias("categories"),
    )


def tree_expression(nodes: Sequence[Row]) -> Column:
    """The prediction of one tree, as nested conditions on its input columns."""
    known = {n["node"]: n for n in nodes}
    made: dict[int, Column] = {}
    for number in sorted(known, reverse=True):  # children are numbered after their parents
        n = known[number]
        if n["feature"] is None:
            made[number] = F.lit(n["prediction"])
            continue
        value = F.col(n["feature"])
        goes_left = value <= n["threshold"] if n["categories"] is None else value.isin(list(n["categories"]))
        made[number] = F.when(goes_left, made[n["left"]]).otherwise(made[n["right"]])
    return made[0]


def score_by_nodes(df: DataFrame, model: PipelineModel, nodes: DataFrame) -> DataFrame:
    """As :func:`score`, by conditions that Spark compiles and pushes about like any others.

    Meant for small trees, whose nodes the driver can hold: for a hundred deep ones the model is faster.
    """
    indexed = fill_missing_delays(df)
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            indexed = stage.transform(indexed)
    trees: dict[int, list[Row]] = {}
    for node in nodes.collect():  # at most trees x 2^depth rows, bounded by the model's settings
        trees.setdefault(node["tree"], []).append(node)
    total = sum((tree_expression(trees[t]) for t in sorted(trees)), F.lit(0.0))
    return indexed.withColumn("prediction", total / float(len(trees)))


def node_means(rows: DataFrame, model: PipelineModel, nodes: DataFrame, label: str = LABEL) -> DataFrame:
    """The leaves' means from the rows themselves: (prediction, mean, rows), one row per leaf value.

    A check of what the trees hold, by one aggregate.
    """
    scored = score_by_nodes(rows, model, nodes)
    return scored.groupBy("prediction").agg(F.avg(label).alias("mean"), F.count(label).alias("rows"))
