"""Fits from histograms against Spark's own."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebird.operators.encoding import FEATURES
from latebird.plans import histograms, training
from latebird.plans.recipes import COMPACT, DETAILED, SELECTED
from latebird.schema import LABEL
from latebird.session import drop_staged


@pytest.fixture(scope="module", params=["compact", "detailed"])
def encoded(request, spark, flights):
    recipe = {"compact": COMPACT, "detailed": DETAILED}[request.param]
    rows = training.model_rows(flights, recipe)
    made = training.fit_encoder(rows, recipe).transform(rows).select(LABEL, FEATURES).cache()
    assert 1_000 < made.count() < 10_000  # Spark looks at all rows for its bins
    yield made
    made.unpersist()


def _text(model):
    return model.toDebugString.split("\n", 1)[1]


def _same_nodes(a, b):
    """Splits, gains and impurities, from the root down."""
    pairs = [(a, b)]
    while pairs:
        x, y = pairs.pop()
        assert x.prediction() == pytest.approx(y.prediction(), rel=1e-9, abs=1e-9)
        assert x.impurity() == pytest.approx(y.impurity(), rel=1e-6, abs=1e-6)
        assert x.impurityStats().count() == y.impurityStats().count()
        assert x.subtreeDepth() == y.subtreeDepth()
        if x.subtreeDepth():
            assert x.split().featureIndex() == y.split().featureIndex()
            assert x.gain() == pytest.approx(y.gain(), rel=1e-6, abs=1e-6)
            pairs += [(x.leftChild(), y.leftChild()), (x.rightChild(), y.rightChild())]


PLAIN = {"labelCol": LABEL, "featuresCol": FEATURES, "seed": 89}


@pytest.mark.parametrize("settings", [
    {"maxDepth": 5}, {"maxDepth": 9, "maxBins": 48}, {"maxDepth": 0}, {"maxDepth": 4, "minInstancesPerNode": 300},
    {"maxDepth": 6, "minInfoGain": 0.5}, {"maxDepth": 6, "minWeightFractionPerNode": 0.05, "maxBins": 4},
], ids=str)
def test_trees_are_those_of_spark(encoded, settings):
    theirs = DecisionTreeRegressor(**PLAIN, **settings).fit(encoded)
    ours = training.decision_tree(**settings).fit(encoded)
    assert type(ours) is type(theirs)
    assert _text(ours) == _text(theirs)
    _same_nodes(ours._call_java("rootNode"), theirs._call_java("rootNode"))
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)


def test_boosted_trees_are_those_of_spark(encoded):
    settings = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3}
    theirs = GBTRegressor(**PLAIN, **settings).fit(encoded)
    ours = training.boosted_trees(**settings).fit(encoded)
    assert ours.treeWeights == theirs.treeWeights
    for a, b in zip(ours.trees, theirs.trees, strict=True):
        _same_nodes(a._call_java("rootNode"), b._call_java("rootNode"))
    both = ours.copy({ours.predictionCol: "ours"}).transform(theirs.transform(encoded))
    assert both.where("abs(ours - prediction) > 1e-9 * (1 + abs(prediction))").isEmpty()


def test_a_forest_without_draws_is_that_of_spark(encoded):
    settings = {"numTrees": 2, "maxDepth": 6, "bootstrap": False, "featureSubsetStrategy": "all"}
    theirs = RandomForestRegressor(**PLAIN, **settings).fit(encoded)
    ours = training.random_forest(**settings).fit(encoded)
    assert _text(ours) == _text(theirs)


def test_a_forest_is_about_as_good_as_that_of_spark(encoded):
    settings = {"numTrees": 20, "maxDepth": 5}
    found = []
    for seed in (1, 2, 3):
        for make in (RandomForestRegressor, histograms.HistogramForest):
            model = make(**(PLAIN | settings | {"seed": seed})).fit(encoded)
            found.append(model.transform(encoded).agg(F.sqrt(F.avg((F.col(LABEL) - F.col("prediction")) ** 2))).first()[0])
    theirs, ours = np.mean(found[::2]), np.mean(found[1::2])
    assert ours == pytest.approx(theirs, rel=0.1)
    forest = training.random_forest(**settings)
    assert _text(forest.fit(encoded)) == _text(forest.fit(encoded.coalesce(1)) if encoded.rdd.getNumPartitions() == 1 else forest.fit(encoded))


def test_draws_have_the_stated_mean():
    block = histograms.Block(7, np.zeros((1, 50_000), np.uint16), np.zeros(50_000), None)
    for draw, variance in ((histograms.Draw(1, 1.0, True), 1.0), (histograms.Draw(1, 0.3, False), 0.21)):
        weights = draw(3, block)
        assert weights.mean() == pytest.approx(draw.rate, rel=0.05) and weights.var() == pytest.approx(variance, rel=0.05)
        assert (weights == draw(3, block)).all() and (weights != draw(4, block)).any()


def test_dense_sparse_and_empty_vectors(spark):
    """Negative values, zeros, constant slots, more rows than a block, and no metadata."""
    random = np.random.default_rng(5)
    x = np.round(random.normal(size=(3_000, 6)), 1) * random.integers(0, 2, (3_000, 6))
    x[:, 4], x[:, 5] = 0.0, 2.0
    y = np.round(30 * x[:, 0] - 20 * (x[:, 1] < -0.5) + 10 * x[:, 2] * x[:, 3])  # whole: sums are exact
    vectors = [Vectors.dense(r) if i % 3 else Vectors.sparse(6, [(int(j), float(r[j])) for j in np.flatnonzero(r)]) for i, r in enumerate(x)]
    schema = T.StructType([T.StructField(LABEL, T.DoubleType()), T.StructField(FEATURES, VectorUDT())])
    rows = spark.createDataFrame([(float(b), v) for b, v in zip(y, vectors)], schema).coalesce(1)
    for settings in ({"maxDepth": 5}, {"maxDepth": 8, "maxBins": 200}):
        ours = training.decision_tree(**settings).fit(rows)
        theirs = DecisionTreeRegressor(**PLAIN, **settings).fit(rows)
        assert _text(ours) == _text(theirs)


def test_rows_of_many_blocks_and_passes(encoded, monkeypatch):
    whole = training.decision_tree(maxDepth=7).fit(encoded)
    monkeypatch.setattr(histograms, "HISTOGRAM_BYTES", 40_000)
    assert _text(training.decision_tree(maxDepth=7).fit(encoded)) == _text(whole)


def test_what_is_not_covered_is_left_to_spark(encoded):
    weighted = encoded.withColumn("w", F.col(LABEL) % 3 + 3.0)
    ours = training.decision_tree(maxDepth=3, weightCol="w").fit(weighted)
    theirs = DecisionTreeRegressor(**PLAIN, maxDepth=3, weightCol="w").fit(weighted)
    assert _text(ours) == _text(theirs)
    settings = {"maxIter": 3, "maxDepth": 2, "subsamplingRate": 0.5}
    assert _text(training.boosted_trees(**settings).fit(encoded)) == _text(GBTRegressor(**PLAIN, **settings).fit(encoded))


def test_null_labels_and_no_rows_raise(encoded):
    with pytest.raises(Exception, match="label is null"):
        training.decision_tree().fit(encoded.withColumn(LABEL, F.when(F.col(LABEL) > 0, F.col(LABEL))))
    with pytest.raises(ValueError, match="no rows"):
        training.decision_tree().fit(encoded.where("1 = 0"))


def test_fits_on_one_dataset_share_its_blocks(encoded, monkeypatch):
    made, binned = [], histograms.binned
    monkeypatch.setattr(histograms, "binned", lambda *a: made.append(1) or binned(*a))
    tree = training.decision_tree()
    points = training.param_grid(tree, {"maxDepth": [2, 3], "maxBins": [16, 32]})
    models = dict(tree.fitMultiple(encoded, points))
    assert len(made) == 2 and not histograms._shared
    assert [models[i].depth for i in range(4)] == [2, 2, 3, 3]


@pytest.mark.parametrize("recipe", [COMPACT, DETAILED], ids=["compact", "detailed"])
def test_rows_give_the_bins_of_their_vectors(spark, flights, recipe):
    """Rows packed without vectors: the same slots and bins, also of unseen and null categories."""
    rows = training.model_rows(flights, recipe)
    encoder = training.fit_encoder(rows.where("Origin <> 'S3'"), recipe)
    rows = rows.withColumn("Dest", F.when(F.col("Dest") != "P4", F.col("Dest")))
    vectors = histograms.Vectors(encoder.transform(rows), LABEL, FEATURES)
    source = histograms.rows_to_encode(rows, encoder, LABEL, FEATURES)
    assert source is not None and source.slots() == vectors.slots() and source.count() == vectors.count()
    for fraction in (1.0, 0.2):
        ours, theirs = source.sample(fraction, 7), vectors.sample(fraction, 7)
        for n in source.numerics:
            assert sorted(ours[n.slot]) == sorted(theirs[n.slot])
    bins = histograms.learn_bins(source, source.count(), 32, 1)
    ours, theirs = (
        [
            (number, [tuple(sorted(c[c < bins.total])) for c in block.codes.T], list(block.label))
            for number, block in enumerate(histograms._blocks(s.packed(bins).toArrow().to_batches(), bins.code_type))
        ]
        for s in (source, vectors)
    )
    assert ours == theirs


def test_other_encoders_are_not_taken_apart(flights):
    train = flights.dropna(subset=["TaxiOut", "DepDelay", "CRSElapsedTime"])
    rows = training.model_rows(train, SELECTED)
    assert histograms.rows_to_encode(rows, training.fit_encoder(rows, SELECTED), LABEL, FEATURES) is None


def test_rows_encoded_once_give_the_same_folds(flights):
    """Folds of encoded rows, and of rows with an encoder, measure the same."""
    rows, path = training.stage_folds(flights, COMPACT, 3)
    encoder = training.fit_encoder(rows, COMPACT)
    encoded, encoded_path = training.stage_encoded(rows, encoder)
    made = []

    class Encoder:
        def transform(self, df):
            made.append(1)
            return encoder.transform(df)

    tree = training.decision_tree()
    tried = [training.Candidate("tree", tree, training.param_grid(tree, {"maxDepth": [2, 4]}))]
    try:
        assert sorted(encoded.columns) == sorted([LABEL, FEATURES, training.FOLD])
        once = training.cross_validate(encoded, COMPACT, tried, prefitted=Encoder())
        again = training.cross_validate(rows, COMPACT, tried, prefitted=encoder)
    finally:
        drop_staged(flights.sparkSession, path)
        drop_staged(flights.sparkSession, encoded_path)
    assert not made
    assert [r.rmse for r in once] == pytest.approx([r.rmse for r in again], rel=1e-9)
    assert [r.mae for r in once] == pytest.approx([r.mae for r in again], rel=1e-9)
