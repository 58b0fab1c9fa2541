"""Indexing, one-hot, assembling, scaling, filling, selection."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import functions as F

from latebird.operators import encoding


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame([(v,) for v in ["b", "a", "c", "c"]], "x string")


def _indexes(df, column="x"):
    return {r[column]: r[f"{column}_idx"] for r in df.collect()}


def test_index_by_frequency_then_value(letters):
    model = encoding.string_indexer(["x"]).fit(letters)
    assert _indexes(model.transform(letters)) == {"c": 0, "a": 1, "b": 2}


def test_unseen_and_null_become_the_zero_vector(spark, letters):
    model = Pipeline(stages=[encoding.string_indexer(["x"]), encoding.one_hot_encoder(["x"])]).fit(
        letters
    )
    scored = model.transform(spark.createDataFrame([("zz",), (None,), ("c",)], "x string"))
    assert _indexes(scored) == {"zz": 3, None: 3, "c": 0}
    vectors = {r["x"]: r["x_ohe"] for r in scored.collect()}
    assert vectors["zz"] == vectors[None] == Vectors.sparse(3, [])
    assert vectors["c"] == Vectors.sparse(3, [0], [1.0])


def test_numbers_are_indexed_as_text(spark):
    df = spark.createDataFrame([(v,) for v in [10, 2, 2, 1]], "x int")
    model = encoding.string_indexer(["x"]).fit(df)
    assert list(model.labelsArray[0]) == ["2", "1", "10"]


def test_assembler_skips_or_fails(spark):
    df = spark.createDataFrame(
        [(1.0, float("nan")), (2.0, 5.0), (3.0, None)], "x double, y double"
    )
    kept = encoding.numeric_assembler(["x", "y"]).transform(df)
    assert [r["x"] for r in kept.collect()] == [2.0]
    with pytest.raises(Exception):
        encoding.numeric_assembler(["x", "y"], "error").transform(df).collect()


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    raw = encoding.numeric_assembler(["x", "y"]).transform(df)
    scaled = encoding.numeric_scaler().fit(raw).transform(raw)
    values = [r[0] for r in scaled.select(vector_to_array(encoding.NUMERIC_SCALED)).collect()]
    assert values[0] == pytest.approx([-(2**-0.5), 0.0])
    assert values[1] == pytest.approx([2**-0.5, 0.0])


def test_median_fill_learns_from_the_fitted_rows(spark):
    train = spark.createDataFrame([(1,), (5,), (9,), (None,)], "TaxiOut int")
    other = spark.createDataFrame([(None,), (100,)], "TaxiOut int")
    filled = encoding.MedianFill(["TaxiOut"]).fit(train).transform(other)
    assert sorted(r[0] for r in filled.collect()) == [5, 100]


def test_median_fill_of_an_empty_column_is_zero(spark):
    df = spark.createDataFrame([(None,)], "TaxiOut int")
    assert encoding.MedianFill(["TaxiOut"]).fit(df).transform(df).collect() == [(0,)]


def test_median_fill_agrees_with_the_imputer(flights):
    df = flights.select("TaxiOut", "DepDelay")
    imputed = encoding.impute(["TaxiOut", "DepDelay"]).fit(df).transform(df)
    filled = encoding.MedianFill(["TaxiOut", "DepDelay"]).fit(df).transform(df)
    theirs = imputed.select("TaxiOut_filled", "DepDelay_filled")
    ours = filled.select("TaxiOut", "DepDelay")
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_selection_keeps_the_strongest_and_names_them(spark):
    rows = [
        (float(i % 7), float(i), float((i * 37) % 11), "ab"[i % 2], i * 2 + i % 3)
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "noise double, signal double, more double, c string, ArrDelay int")
    stages = [
        encoding.string_indexer(["c"]),
        encoding.one_hot_encoder(["c"]),
        encoding.numeric_assembler(["noise", "signal", "more"]),
        encoding.numeric_scaler(),
        encoding.feature_assembler(["c"], encoding.ALL_FEATURES),
    ]
    encoded = Pipeline(stages=stages).fit(df).transform(df)
    selector = encoding.top_feature_selector(2).fit(encoded)
    chosen = encoding.selected_features(selector, encoded, ["noise", "signal", "more"]).collect()
    assert len(chosen) == 2
    assert "signal" in {r["name"] for r in chosen}
    best = max(chosen, key=lambda r: r["f_value"])
    r2 = df.select(F.pow(F.corr("signal", "ArrDelay"), F.lit(2))).first()[0]
    assert best["name"] == "signal"
    assert best["f_value"] == pytest.approx(r2 / (1 - r2) * 198, rel=1e-6)


def test_selection_ranks_by_f_where_every_p_value_is_zero(spark):
    """Thirty weak slots and, last, a strong one: with these rows all p-values are 0."""
    weak = [f"w{i}" for i in range(30)]
    df = spark.range(0, 60_000, numPartitions=4).selectExpr(
        "CAST(pmod(hash(id, 1), 1000) AS INT) AS ArrDelay",
        *[f"CAST(pmod(hash(id, 1), 1000) + 6 * pmod(hash(id, {i + 2}), 1000) AS DOUBLE) AS w{i}" for i in range(30)],
        "CAST(pmod(hash(id, 1), 1000) + pmod(hash(id, 99), 10) AS DOUBLE) AS strong",
    )
    columns = [*weak, "strong"]
    stages = [
        encoding.numeric_assembler(columns),
        encoding.numeric_scaler(),
        encoding.feature_assembler([], encoding.ALL_FEATURES),
    ]
    encoded = Pipeline(stages=stages).fit(df).transform(df)
    selector = encoding.top_feature_selector(20).fit(encoded)
    assert 30 in selector.getIndices() and len(selector.getIndices()) == 20
    chosen = encoding.selected_features(selector, encoded, columns).collect()
    assert max(chosen, key=lambda r: r["f_value"])["name"] == "strong"


def test_slot_scores_of_categories(spark):
    rows = [("ab"[i % 3 == 0], "xyz"[i % 3], i % 3 * 10 + i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "c string, d string, ArrDelay int").selectExpr("*", "1.0D AS k")
    stages = [
        encoding.string_indexer(["c", "d"]),
        encoding.one_hot_encoder(["c", "d"]),
        encoding.numeric_assembler(["k"]),
        encoding.numeric_scaler(),
        encoding.feature_assembler(["c", "d"], encoding.ALL_FEATURES),
    ]
    encoded = Pipeline(stages=stages).fit(df).transform(df)
    names = encoding.feature_names(encoded, encoding.ALL_FEATURES)
    got = {names[r["slot"]]: r["f_value"] for r in encoding.slot_scores(encoded).collect()}
    for name in names[:-1]:
        column, value = name.split("_ohe_")
        flag = df.withColumn("flag", (F.col(column) == value).cast("double"))
        r2 = flag.select(F.corr("flag", "ArrDelay")).first()[0] ** 2
        assert got[name] == pytest.approx(r2 / (1 - r2) * 58, rel=1e-6)
    assert got[names[-1]] == 0


def test_selector_saves_with_a_pipeline(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorSlicer

    model = PipelineModel([VectorSlicer(inputCol="a", outputCol="b", indices=[1, 3])])
    model.write().overwrite().save(str(tmp_path / "m"))
    assert PipelineModel.load(str(tmp_path / "m")).stages[0].getIndices() == [1, 3]


def test_too_many_labels_raise(spark):
    df = spark.createDataFrame([(str(i),) for i in range(20)], "x string")
    with pytest.raises(ValueError, match="20 different values or more"):
        encoding.string_indexer(["x"], most=19).fit(df)
    assert len(encoding.string_indexer(["x"], most=20).fit(df).labelsArray[0]) == 20
