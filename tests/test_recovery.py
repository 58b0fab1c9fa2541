"""Fits whose blocks are dropped while they run, as with a lost executor."""

import threading

import pytest
from pyspark.sql import functions as F

from latebird.operators.encoding import FEATURES
from latebird.plans import training
from latebird.plans.recipes import COMPACT
from latebird.schema import LABEL
from latebird.session import drop_staged, shared_dir, stage_table


@pytest.fixture(scope="module")
def encoded(spark, flights):
    rows, path = stage_table(training.model_rows(flights, COMPACT), "recovery-rows")
    fitted = training.fit_encoder(rows, COMPACT)
    yield fitted.transform(rows).select(LABEL, FEATURES)
    drop_staged(spark, path)


def _drop_blocks(spark, until, dropped):
    """Again and again, take the stored blocks of all RDDs away; the RDDs stay marked as stored."""
    jvm = spark.sparkContext._jvm
    storage = jvm.org.apache.spark.SparkEnv.get().blockManager()
    while not until.wait(0.3):
        for number in list(spark.sparkContext._jsc.getPersistentRDDs()):
            held = storage.getStatus(jvm.org.apache.spark.storage.RDDBlockId(number, 0)).isDefined()
            storage.master().removeRdd(number, True)
            dropped.append(held)


@pytest.mark.parametrize("make", [
    lambda: training.boosted_trees(maxIter=9, maxDepth=3),
    lambda: training.boosted_trees(maxIter=4, maxDepth=8),
    lambda: training.random_forest(numTrees=4, maxDepth=9),
], ids=["boosting", "deep boosting", "deep forest"])
def test_models_are_the_same_after_lost_blocks(spark, encoded, make):
    shared_dir(spark)
    plain = make().fit(encoded)
    done, dropped = threading.Event(), []
    dropping = threading.Thread(target=_drop_blocks, args=(spark, done, dropped))
    dropping.start()
    try:
        recovered = training.recoverable(make()).fit(encoded.persist())
    finally:
        done.set()
        dropping.join()
        encoded.unpersist()
    assert sum(dropped) > 3
    same_leaves = lambda a, b: [t.numNodes for t in a.trees] == [t.numNodes for t in b.trees]
    assert same_leaves(recovered, plain)
    both = recovered.copy({recovered.predictionCol: "again"}).transform(plain.transform(encoded))
    assert both.where("abs(again - prediction) > 1e-6 * (1 + abs(prediction))").count() == 0


def test_boosting_writes_checkpoints(spark, encoded):
    context = spark.sparkContext
    shared_dir(spark)
    folder = context._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    seen, done = set(), threading.Event()

    def watch():
        while not done.wait(0.05):
            seen.update(s.getPath().getName() for s in files.listStatus(folder) if "rdd-" in s.getPath().getName())

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        training.recoverable(training.boosted_trees(maxIter=9, maxDepth=2)).fit(encoded)
    finally:
        done.set()
        watching.join()
    assert len(seen) >= 2


def test_intervals_follow_the_longest_point(spark):
    def settings(estimator, **values):
        made = training.recoverable(estimator, training.param_grid(estimator, values) if values else [{}])
        return made.getCheckpointInterval(), made.getCacheNodeIds()

    assert settings(training.boosted_trees(), maxIter=[10, 20], maxDepth=[3, 5]) == (5, False)
    assert settings(training.boosted_trees(maxIter=1)) == (2, False)
    assert settings(training.random_forest(), maxDepth=[5, 10]) == (4, True)
    assert settings(training.decision_tree()) == (3, False)
    for candidate in training.candidates("full"):
        point = candidate.grid[0]
        assert candidate.estimator.copy(point).getMaxDepth() == point[candidate.estimator.maxDepth]
