"""Training, scoring, evaluation and persistence of the seriousness classifiers."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import alerts
from ..session import ensure_checkpoint_dir, scratch_dir
from .boosting import TASK_ROWS as BLOCK_TASK_ROWS
from .boosting import BlockGBTClassifier
from .columns import evaluated_once, named
from .features import score_features
from .ranking import with_running_sum

LABEL = "is_serious"
RANDOM_FOREST, GRADIENT_BOOSTING, LOGISTIC = "Random Forest", "Gradient Boosting", "Logistic Regression"


# Rows of a training task; of each the forest keeps some 500 bytes, with a number per tree.
TASK_ROWS = 200_000
# Ranks within a class are counted in so many parts, each a task's work.
SPLIT_PARTS = 256


def with_split(df: DataFrame, label: str = LABEL, parts: int = SPLIT_PARTS) -> DataFrame:
    """Assign every row to train, validation or test, with exact shares of every class.

    The rows of a class are ranked by a hash of all their columns, so rows without an id, or with the same one, are dealt
    out like others. The rank is the number of rows in earlier parts of the hash range plus the place within the
    part; a class thus needs no task of its own. Of n rows of a class, round(0.10 n) are for testing and
    round(0.22 (n - test)) for validation.
    """
    # The sign bit is shifted out, so parts are ranges of a number that is not negative.
    digest = F.shiftrightunsigned(F.xxhash64(*[named(c) for c in df.columns]), 1)
    hashed = evaluated_once(df, {"_hash": digest}).withColumn("_part", F.floor(F.col("_hash") / F.lit((1 << 63) / parts)).cast("int"))
    by_class = Window.partitionBy(label)
    sizes = hashed.groupBy(label, "_part").agg(F.count(F.lit(1)).alias("_n")).select(  # classes times parts rows
        F.col(label).alias("_class"), F.col("_part").alias("_of"),
        (F.sum("_n").over(by_class.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(by_class).alias("_all"))
    place = F.row_number().over(Window.partitionBy(label, "_part").orderBy("_hash"))
    ranked = hashed.withColumn("_place", place).join(
        sizes, named(label).eqNullSafe(F.col("_class")) & (F.col("_part") == F.col("_of")))
    rank, test = F.col("_before") + F.col("_place"), F.round(F.col("_all") * K.TEST_SHARE)
    validation = F.round((F.col("_all") - test) * K.VALIDATION_SHARE)
    split = F.when(rank <= test, "test").when(rank <= test + validation, "validation").otherwise("train")
    return ranked.select(*[named(c) for c in df.columns], split.alias("split"))


def feature_columns(df: DataFrame) -> list[str]:
    """The training table without its keys, dates and target."""
    return [c for c in df.columns if c not in (*K.TRAINING_KEYS, "split")]


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features")


def random_forest(features: list[str] = K.MODEL_FEATURES, trees: int = 100) -> Pipeline:
    # Kept node ids would be a number per row and tree, written anew at every level; walking the trees gives the same.
    forest = RandomForestClassifier(
        labelCol=LABEL, numTrees=trees, maxDepth=10, minInstancesPerNode=2, seed=K.SEED, cacheNodeIds=False,
    )
    return Pipeline(stages=[_assembler(features), forest])


def gradient_boosting(features: list[str] = K.MODEL_FEATURES, rounds: int = 100) -> Pipeline:
    boosting = BlockGBTClassifier(
        labelCol=LABEL, maxIter=rounds, stepSize=0.1, maxDepth=6, seed=K.SEED, checkpointInterval=10,
    )
    return Pipeline(stages=[_assembler(features), boosting])


def logistic(rows: int, features: list[str] = K.MODEL_FEATURES) -> Pipeline:
    """Scaled logistic regression; ``rows`` sets the strength of the unit L2 penalty on the mean loss."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    regression = LogisticRegression(
        labelCol=LABEL, featuresCol="scaled", maxIter=1000, regParam=1.0 / max(rows, 1), standardization=False,
    )
    return Pipeline(stages=[_assembler(features), scaler, regression])


@dataclass
class TrainedModels:
    """Fitted pipelines by name, with seconds of training each."""

    models: dict[str, PipelineModel] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def spread(rows: DataFrame, most: int = TASK_ROWS) -> DataFrame:
    """The rows in so many partitions that each has about ``most`` rows or fewer: what a learner keeps of one is a block, which
    stays in memory or goes to disk as a whole."""
    parts = -(-rows.count() // most)
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit on a stored training table; boosting checkpoints to the shared folder."""
    ensure_checkpoint_dir(train.sparkSession)
    most = BLOCK_TASK_ROWS if isinstance(pipeline.getStages()[-1], BlockGBTClassifier) else TASK_ROWS
    return pipeline.fit(spread(train.select(LABEL, *feature_columns(train)), most))


def score(model: PipelineModel, events: DataFrame) -> DataFrame:
    """Prediction, both class probabilities, label and confidence flag for every event."""
    scored = model.transform(score_features(events))
    p = vector_to_array(F.col("probability"))
    results = evaluated_once(
        scored.withColumnRenamed("prediction", "_class"),
        {
            "confidence_non_serious": p[0],
            "confidence_serious": p[1],
            "prediction": F.col("_class").cast("int"),
        },
    )
    internal = [c for c in ("features", "scaled", "rawPrediction", "probability", "_class") if c in results.columns]
    return results.drop(*internal).withColumns({
        "prediction_label": alerts.score_label(F.col("prediction")),
        "high_confidence": alerts.is_confident(F.col("confidence_serious")),
    })


def ratio(top: Column, bottom: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0)), 6)


def classification_metrics(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1, from one pass of counts; 0 where undefined."""
    y, p = named(label), named(prediction)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("hit"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        F.col("n").alias("rows"),
        ratio(F.col("hit"), F.col("n")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def roc_auc(scored: DataFrame, label: str = LABEL, probability: str = "confidence_serious") -> float:
    """Area under the ROC curve over all distinct scores, computed by Spark's distributed evaluator."""
    evaluator = BinaryClassificationEvaluator(
        labelCol="y", rawPredictionCol="p", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(scored.select(named(label).cast("double").alias("y"), named(probability).alias("p")))


def scored_by_all(models: TrainedModels, rows: DataFrame) -> DataFrame:
    """Label, and per model its order, prediction and probability of class 1: one narrow pass over the rows for all models."""
    base = score_features(rows)
    kept, out = [named(c) for c in base.columns], base
    for order, model in enumerate(models.models.values()):
        one = F.struct(F.lit(order).alias("model_order"), F.col("prediction").cast("int").alias("prediction"),
                       vector_to_array(F.col("probability"))[1].alias("confidence_serious"))
        out = model.transform(out.select(*kept, *[f"_model{i}" for i in range(order)])).withColumn(f"_model{order}", one)
    found = F.inline(F.array(*[F.col(f"_model{i}") for i in range(len(models.models))]))
    return out.select(named(LABEL).cast("int").alias(LABEL), found)


def evaluate(models: TrainedModels, test: DataFrame) -> DataFrame:
    """One row of test metrics per model, in training order.

    The rows are read and scored once, for all models, and counted by model and distinct score. Everything else follows from
    these counts: precision and the like from their sums, and the area under the ROC curve from the negatives below each
    score, pairs of equal scores counting half.
    """
    spark = test.sparkSession
    y, p = F.col(LABEL), F.col("prediction")
    path = scratch_dir(spark, "scores")
    scored_by_all(models, test).groupBy("model_order", "confidence_serious").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"), F.count_if(y == p).alias("hit"),
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn")).write.parquet(path)
    counts = spark.read.parquet(path)
    ordered = with_running_sum(counts, [F.col("model_order"), F.col("confidence_serious")], "neg", "_below")
    # Negatives of the models before are part of every running sum; each model has as many as there are.
    sums = ordered.groupBy("model_order").agg(
        *[F.sum(c).alias(c) for c in ("n", "pos", "neg", "hit", "tp", "fp", "fn")],
        F.sum(F.col("pos") * (F.col("_below") + F.col("neg") / 2)).alias("pairs"))
    tp, fp, fn, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "pos", "neg"))
    pairs = F.col("pairs") - pos * neg * F.col("model_order")
    names = spark.createDataFrame(
        [(i, name, models.seconds.get(name)) for i, name in enumerate(models.models)],
        "model_order int, model_name string, training_seconds double")
    return sums.join(F.broadcast(names), "model_order").select(  # one row per model
        "model_order", "model_name", ratio(F.col("hit"), F.col("n")).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        F.coalesce(F.try_divide(pairs, pos * neg), F.lit(0.0)).alias("roc_auc"), "training_seconds").orderBy("model_order")


def best_model(metrics: DataFrame) -> DataFrame:
    """The row with the highest F1; the model trained first wins a tie."""
    return metrics.orderBy(F.desc("f1_score"), "model_order").limit(1)


def feature_importance(model: PipelineModel, top: int | None = 10) -> DataFrame:
    """Importance per feature, highest first; no rows for models that have none."""
    spark = SparkSession.active()
    estimator, features = model.stages[-1], model.stages[0].getInputCols()
    weights = estimator.featureImportances.toArray().tolist() if hasattr(estimator, "featureImportances") else []
    table = spark.createDataFrame(list(zip(features, weights)), "feature string, importance double")
    ordered = table.orderBy(F.desc("importance"), "feature")
    return ordered if top is None else ordered.limit(top)


def model_path(root: str, name: str) -> str:
    return f"{root}/{name.lower().replace(' ', '_')}_model"


def save_models(models: TrainedModels, root: str) -> dict[str, str]:
    """Save every pipeline; a scaler is part of its pipeline."""
    paths = {name: model_path(root, name) for name in models.models}
    for name, path in paths.items():
        models.models[name].write().overwrite().save(path)
    return paths


def load_model(root: str, name: str = GRADIENT_BOOSTING) -> PipelineModel:
    return PipelineModel.load(model_path(root, name))


def importances(models: TrainedModels) -> DataFrame:
    """``model_name`` and its importances as JSON; no row for models that have none. One row per model and feature at most."""
    spark = SparkSession.active()
    found = []
    for name, model in models.models.items():
        weights = {r.feature: r.importance for r in feature_importance(model, None).collect()}
        if weights:
            found.append((name, json.dumps(weights)))
    return spark.createDataFrame(found, "model_name string, feature_importance string")


def performance_rows(metrics: DataFrame, shares: DataFrame, trained_at: Column) -> DataFrame:
    """Rows for the model performance table; ``shares`` are the importances by model name."""
    return metrics.join(F.broadcast(shares), "model_name", "left").select(
        "model_name",
        F.concat(F.lower(F.replace(F.col("model_name"), F.lit(" "), F.lit("_"))), F.lit("_v1.0"))
        .alias("model_version"),
        "accuracy",
        F.col("precision").alias("precision_score"),
        "recall",
        "f1_score",
        "roc_auc",
        trained_at.alias("training_date"),
        "feature_importance",
        F.to_json(F.struct("accuracy", "precision", "recall", "f1_score", "roc_auc")).alias("performance_data"),
    )
