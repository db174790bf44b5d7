"""Split, training, scoring, metrics and persistence on a small separable table."""

import pytest
from pyspark.sql import functions as F

from vigilspark import constants as K
from vigilspark.operators import ml
from vigilspark.schemas import STORE_TABLES
from vigilspark.operators import store


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    n = spark.range(1200)
    features = {name: ((F.col("id") * (i + 3)) % 11).cast("double") for i, name in enumerate(K.MODEL_FEATURES)}
    rows = n.select(
        F.col("id").cast("string").alias("safetyreportid"),
        (((F.col("id") * 10) % 11) + (F.col("id") * 3) % 11 > 10).cast("int").alias("is_serious"),
        F.lit("2").alias("serious"), F.lit("20240101").alias("receivedate"), F.lit("20240101").alias("transmissiondate"),
        *[c.alias(name) for name, c in features.items()])
    path = str(tmp_path_factory.mktemp("ml") / "t")
    ml.with_split(rows).write.parquet(path)
    return spark.read.parquet(path)


def part(table, name):
    return table.where(F.col("split") == name)


def test_split_shares(spark):
    rows = spark.range(40000).select(F.col("id").cast("string").alias("safetyreportid"), (F.col("id") % 3 == 0).cast("int").alias("is_serious"))
    counts = {(r.split, r.is_serious): r["count"] for r in ml.with_split(rows).groupBy("split", "is_serious").count().collect()}
    for label in (0, 1):
        total = sum(v for (s, y), v in counts.items() if y == label)
        assert counts["test", label] == round(total * 0.10)
        assert counts["validation", label] == round((total - counts["test", label]) * 0.22)


def test_split_of_rows_without_or_with_one_id(spark):
    rows = spark.range(1000).select(F.lit(None).cast("string").alias("safetyreportid"), F.lit(1).alias("is_serious"), "id")
    counts = {r.split: r["count"] for r in ml.with_split(rows.drop("id").withColumn("x", F.lit(1))).groupBy("split").count().collect()}
    assert counts == {"test": 100, "validation": 198, "train": 702}


def test_models(spark, table, tmp_path):
    train, test = part(table, "train"), part(table, "test")
    assert ml.feature_columns(train) == K.MODEL_FEATURES
    trained = ml.TrainedModels()
    trained.models[ml.RANDOM_FOREST] = ml.fit(ml.random_forest(trees=10), train)
    trained.models[ml.GRADIENT_BOOSTING] = ml.fit(ml.gradient_boosting(rounds=5), train)
    trained.models[ml.LOGISTIC] = ml.fit(ml.logistic(train.count()), train)
    metrics = ml.evaluate(trained, test)
    rows = metrics.collect()
    assert [r.model_name for r in rows] == [ml.RANDOM_FOREST, ml.GRADIENT_BOOSTING, ml.LOGISTIC]
    assert all(0 <= r.roc_auc <= 1 and r.accuracy > 0.7 for r in rows)
    for r in rows:  # one pass for all models gives what each model's own rows give
        scored = ml.score(trained.models[r.model_name], test)
        alone = ml.classification_metrics(scored).first()
        assert (r.accuracy, r.precision, r.recall, r.f1_score) == (alone.accuracy, alone.precision, alone.recall, alone.f1_score)
        assert abs(r.roc_auc - ml.roc_auc(scored)) < 1e-9
    plan = ml.scored_by_all(trained, test)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    best = ml.best_model(metrics).collect()
    assert len(best) == 1 and best[0].f1_score == max(r.f1_score for r in rows)

    importance = ml.feature_importance(trained.models[ml.RANDOM_FOREST], top=None).collect()
    assert len(importance) == 14 and abs(sum(r.importance for r in importance) - 1) < 1e-6
    assert ml.feature_importance(trained.models[ml.RANDOM_FOREST]).count() == 10
    assert ml.feature_importance(trained.models[ml.LOGISTIC]).count() == 0

    ml.save_models(trained, str(tmp_path))
    scored = ml.score(trained.models[ml.GRADIENT_BOOSTING], test)
    again = ml.score(ml.load_model(str(tmp_path)), test)
    pick = ["safetyreportid", "prediction", "confidence_serious"]
    assert sorted(scored.select(*pick).collect()) == sorted(again.select(*pick).collect())
    r = scored.first()
    assert r.prediction_label == ("SERIOUS" if r.prediction == 1 else "NON_SERIOUS")
    assert abs(r.confidence_serious + r.confidence_non_serious - 1) < 1e-9
    assert r.high_confidence == int(max(r.confidence_serious, r.confidence_non_serious) > 0.8)

    stored = store.conform(ml.performance_rows(metrics, ml.importances(trained), F.current_timestamp()), "model_performance")
    assert [f.name for f in stored.schema.fields] == [f.name for f in STORE_TABLES["model_performance"].fields]
    row = stored.where("model_name = 'Random Forest'").first()
    assert stored.where("model_name = 'Logistic Regression'").first().feature_importance is None
    assert row.model_version == "random_forest_v1.0" and "drug_count" in row.feature_importance


def test_metrics_match_brute_force(spark):
    pairs = [(1, 1)] * 5 + [(0, 1)] * 2 + [(1, 0)] * 3 + [(0, 0)] * 10
    r = ml.classification_metrics(spark.createDataFrame(pairs, "is_serious int, prediction int")).first()
    assert (r["rows"], r.accuracy, r.precision, r.recall) == (20, 0.75, round(5 / 7, 6), 0.625)
    assert r.f1_score == round(10 / 15, 6)
    none = ml.classification_metrics(spark.createDataFrame([(0, 0)], "is_serious int, prediction int")).first()
    assert (none.precision, none.recall, none.f1_score) == (0.0, 0.0, 0.0)


def test_auc_matches_brute_force(spark):
    rows = [(i % 2 if i % 5 else 1, (i * 37 % 20) / 20) for i in range(200)]
    wins = [1.0 if p > q else 0.5 if p == q else 0.0 for y, p in rows for z, q in rows if y == 1 and z == 0]
    got = ml.roc_auc(spark.createDataFrame(rows, "is_serious int, confidence_serious double"))
    assert abs(got - sum(wins) / len(wins)) < 1e-9
