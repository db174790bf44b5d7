"""Boosting over blocks next to Spark ML's own, and what the models keep in memory."""

import os
import random
import uuid

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vigilspark import constants as K
from vigilspark.operators import boosting, ml
from vigilspark.operators.boosting import BlockGBTClassifier
from vigilspark.session import compilable_code, ensure_checkpoint_dir


def jobs_of(spark, work):
    """What ``work`` returns, and how many jobs it ran."""
    context, group = spark.sparkContext, f"group-{uuid.uuid4().hex}"
    context.setJobGroup(group, "")
    try:
        return work(), len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context._jsc.clearJobGroup()


@pytest.fixture(scope="module")
def noisy(spark):
    """Rows whose class follows from the features only in part; the features are few values, many values and one value."""
    draw = random.Random(5)
    rows = []
    for _ in range(3000):
        x = [draw.gauss(0, 1), float(draw.randrange(5)), draw.random() * 200, draw.expovariate(1), 7.0]
        rows.append((*x, int(x[0] + 0.3 * x[1] + (x[2] / 50) % 2 + draw.gauss(0, 0.7) > 1.8)))
    return VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, c double, d double, e double, y int")).repartition(3).cache()


SETTINGS = {"labelCol": "y", "maxIter": 12, "stepSize": 0.1, "maxDepth": 5, "seed": 42, "checkpointInterval": 5}


def test_blocks_learn_the_trees_of_spark(spark, noisy):
    ensure_checkpoint_dir(spark)
    # In nodes of few rows two splits may have the same gain, and rounding decides which of them Spark ML takes.
    large = {**SETTINGS, "maxDepth": 4, "minInstancesPerNode": 40}
    own, theirs = BlockGBTClassifier(**large).fit(noisy), GBTClassifier(**large).fit(noisy)

    def splits(model):
        return [line for line in model.toDebugString.splitlines()[1:] if "Predict" not in line]

    assert splits(own) == splits(theirs) and list(own.treeWeights) == list(theirs.treeWeights)
    assert max(abs(own.featureImportances.toArray() - theirs.featureImportances.toArray())) < 1e-9
    pairs = own.transform(noisy).select(F.col("probability").alias("p"), "features").join(
        theirs.transform(noisy).select(F.col("probability").alias("q"), "features"), "features").collect()
    assert len(pairs) == 3000 and max(abs(r.p[1] - r.q[1]) for r in pairs) < 1e-9
    assert abs(sum(own.featureImportances.toArray()) - 1) < 1e-9 and own.featureImportances[4] == 0


def test_boosting_leaves_no_checkpoints(spark, noisy):
    ensure_checkpoint_dir(spark)
    kept = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = sorted(os.listdir(kept))
    model, jobs = jobs_of(spark, lambda: BlockGBTClassifier(**{**SETTINGS, "checkpointInterval": 2}).fit(noisy))
    assert sorted(os.listdir(kept)) == before and jobs > 12  # of every tree at least one, and the checkpoints


def test_rows_of_boosting_are_bytes(spark, noisy):
    rows = noisy.select(F.col("y").cast("double").alias("y"), vector_to_array("features").alias("x"))
    kept = boosting.blocks(rows.coalesce(1), [boosting.thresholds_of(np.arange(100.0), 32)] * 5).persist()
    assert [len(labels) for _, labels, _ in kept.collect()] == [3000]
    info = next(i for i in spark.sparkContext._jsc.sc().getRDDStorageInfo() if i.id() == kept.id())
    assert info.memSize() + info.diskSize() < 3000 * (5 + 1 + 8) + 2000  # a byte a feature and the label, and the margin
    kept.unpersist()


def test_boosting_reads_the_rows_once_a_level_with_something_to_split(spark):
    rows = spark.range(4000).select(*[((F.col("id") * (i + 3)) % 11).cast("double").alias(n) for i, n in enumerate(K.MODEL_FEATURES)])
    rows = rows.withColumn(ml.LABEL, (F.col("drug_count") > 4).cast("int")).repartition(3).cache()
    rows.count()
    model, jobs = jobs_of(spark, lambda: ml.fit(ml.gradient_boosting(rounds=20), rows))
    assert jobs < 20 + 10  # one split tells the classes; the leaves of every tree are pure
    assert model.transform(rows).where(F.col("prediction") != F.col(ml.LABEL)).count() == 0


def test_boosting_of_one_class_and_of_what_it_leaves_to_spark(spark, noisy):
    one = BlockGBTClassifier(**SETTINGS).fit(noisy.withColumn("y", F.lit(1)))
    assert one.transform(noisy).where("prediction != 1").count() == 0
    halves = {**SETTINGS, "maxIter": 2, "subsamplingRate": 0.5}
    assert BlockGBTClassifier(**halves).fit(noisy).toDebugString.splitlines()[1:] == GBTClassifier(**halves).fit(noisy).toDebugString.splitlines()[1:]
    with pytest.raises(Exception, match="(?i)label"):
        BlockGBTClassifier(**SETTINGS).fit(noisy.withColumn("y", F.lit(2)))


def test_forest_keeps_no_node_ids(spark, noisy):
    made = ml.random_forest(trees=5).getStages()[-1]
    assert not made.getCacheNodeIds()
    made = made.copy({made.labelCol: "y"})
    cached = made.copy({made.cacheNodeIds: True})
    assert made.fit(noisy).toDebugString.splitlines()[1:] == cached.fit(noisy).toDebugString.splitlines()[1:]


def test_training_rows_are_spread(spark):
    rows = spark.range(1000).coalesce(1).withColumn("x", F.col("id") % 7)
    few = ml.spread(rows, 300)
    assert few.rdd.getNumPartitions() == 4 and max(few.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()) <= 300
    assert sorted(few.collect()) == sorted(rows.collect())
    assert ml.spread(rows).rdd.getNumPartitions() == 1 and ml.spread(rows.where("id < 0")).count() == 0


def test_thresholds():
    assert boosting.thresholds_of(np.array([3.0, 1.0, 1.0, 2.0]), 32).tolist() == [1.5, 2.5]
    assert boosting.thresholds_of(np.full(5, 2.0), 32).tolist() == []
    assert boosting.thresholds_of(np.arange(100.0), 4).tolist() == [24.5, 49.5, 74.5]


def test_compilable_code_is_restored(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), compilable_code(spark):
        assert spark.conf.get(key) == "8000"
        raise ValueError
    assert spark.conf.get(key) == before
