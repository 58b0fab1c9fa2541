"""Filters, projections, splits, medians, profiling."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebird.functions.bucket import BUCKETS, SPLIT_COLUMNS, bucket, fold
from latebird.operators import cleaning, median, profile
from latebird.plans import stages
from latebird.schema import FLIGHT_COLUMNS, REQUIRED_COLUMNS


def test_only_flights_known_not_cancelled_stay(make_flights):
    df = make_flights({"Cancelled": 0}, {"Cancelled": 1}, {"Cancelled": None})
    assert [r["Cancelled"] for r in cleaning.not_cancelled(df).collect()] == [0]


@pytest.mark.parametrize("column", REQUIRED_COLUMNS)
def test_each_required_column_counts(make_flights, column):
    df = make_flights({column: None}, {})
    assert cleaning.clean_flights(df).count() == 1


def test_unlabelled_flights_can_stay(make_flights):
    df = make_flights({"ArrDelay": None}, {})
    assert cleaning.clean_flights(df, require_label=False).count() == 2
    assert cleaning.labelled(df).count() == 1


def test_clean_stage_equals_operators(flights):
    staged = stages.clean_stage(REQUIRED_COLUMNS, zero_fill=("TaxiOut",)).transform(flights)
    direct = cleaning.pin_columns(cleaning.clean_flights(flights)).select(staged.columns)
    assert staged.exceptAll(direct).isEmpty() and direct.exceptAll(staged).isEmpty()


def test_pinning_turns_text_into_numbers(make_flights):
    df = make_flights({}).withColumn("TaxiOut", F.lit("x")).withColumn("Distance", F.lit("12"))
    row = cleaning.pin_columns(df).first()
    assert (row["TaxiOut"], row["Distance"]) == (0, 12)
    assert set(cleaning.pin_columns(df).columns) == set(FLIGHT_COLUMNS)


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted"
    )


def test_filter_reaches_the_scan(flights):
    text = _plan(cleaning.clean_flights(flights).select("ArrDelay"))
    assert "IsNotNull(Distance)" in text.split("PushedFilters", 1)[1]
    assert "TailNum" not in text.split("ReadSchema", 1)[1]
    assert "Exchange" not in text


def test_split_is_disjoint_and_whole(flights):
    train, test = cleaning.hash_split(flights)
    assert train.count() + test.count() == flights.count()
    assert train.intersect(test).isEmpty()
    assert abs(train.count() / flights.count() - 0.8) < 0.03


def test_split_ignores_partitioning(flights):
    train, _ = cleaning.hash_split(flights)
    again, _ = cleaning.hash_split(flights.repartition(7))
    assert train.exceptAll(again).isEmpty() and again.exceptAll(train).isEmpty()


def test_buckets_are_even_and_seeds_unrelated(flights):
    pairs = flights.selectExpr(
        f"{bucket(89)} < {BUCKETS // 2} AS a", f"{fold(90, 2, SPLIT_COLUMNS)} = 0 AS b", f"{bucket(89)} AS n"
    )
    assert pairs.where(~F.col("n").between(0, BUCKETS - 1)).isEmpty()
    total = pairs.count()
    for row in pairs.groupBy("a", "b").count().collect():
        assert abs(row["count"] / total - 0.25) < 0.03


def test_bucket_takes_extreme_values(spark):
    df = spark.sql("SELECT x AS a, x AS b FROM VALUES (-2147483648), (2147483647), (null) AS t(x)")
    numbers = [r[0] for r in df.selectExpr(bucket(999, ["a", "b"])).collect()]
    assert all(0 <= n < BUCKETS for n in numbers)


def test_random_split_covers_all_rows(flights):
    parts = cleaning.random_split(flights)
    assert sum(p.count() for p in parts) == flights.count()


@pytest.mark.parametrize(
    "values, expected",
    [
        ([5, 20, 40], 20),
        ([1, 2, 3, 4], 2),
        ([7], 7),
        ([None, None], None),
        ([], None),
        ([-100_000, -5, 0, 70_000, 2_000_000_000], 0),
        ([-2_147_483_648, 2_147_483_647], -2_147_483_648),
        ([3] * 999 + [1], 3),
    ],
)
def test_median(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    assert median.median(df, "x").collect() == [(expected,)]


def test_median_against_sorting(spark):
    draw = random.Random(3)
    for size in (10, 101, 500):
        values = [draw.randrange(-200_000, 200_000) for _ in range(size)]
        df = spark.createDataFrame([(v,) for v in values], "x int").repartition(5)
        assert median.median(df, "x").first()[0] == sorted(values)[(size + 1) // 2 - 1]


def test_median_of_other_types_raises(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (9.0,)], "x double")
    with pytest.raises(TypeError):
        median.median(df, "x")
    assert median.approx_median(df, "x").first()[0] == 2.5


def test_median_of_bigints_is_exact(spark):
    draw = random.Random(4)
    values = [draw.randrange(-(1 << 63), 1 << 63) for _ in range(301)] + [0] * 3
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(5)
    assert median.median(df, "x").first()[0] == sorted(values)[(len(values) + 1) // 2 - 1]


def test_seeds_and_shares_are_taken_whole(flights):
    assert bucket(89) != bucket(1089)
    both = flights.selectExpr(f"{bucket(89)} < 5000 AS a", f"{bucket(1089)} < 5000 AS b")
    same = both.where("a = b").count() / both.count()
    assert 0.4 < same < 0.6
    for seed in (-1, 10**6):
        with pytest.raises(ValueError):
            bucket(seed)
    with pytest.raises(ValueError):
        cleaning.hash_split(flights, train_share=0.80005)


def test_one_pass_parts_are_those_of_the_split(flights):
    marked = cleaning.with_part(flights)
    train, test = cleaning.hash_split(flights)
    assert {r["part"]: r["count"] for r in marked.groupBy("part").count().collect()} == {
        "train": train.count(),
        "test": test.count(),
    }


def test_batch_median_replaces_every_value(make_flights):
    df = make_flights(*[{"TaxiOut": t} for t in (5, 20, 40, None)])
    filled = median.fill_with_batch_median(df, "TaxiOut")
    assert [r["TaxiOut"] for r in filled.select("TaxiOut").collect()] == [5] * 4
    ignoring = median.fill_with_batch_median(df, "TaxiOut", null_as_zero=False)
    assert {r["TaxiOut"] for r in ignoring.select("TaxiOut").collect()} == {20}
    empty = median.fill_with_batch_median(make_flights({"TaxiOut": None}), "TaxiOut", False)
    assert empty.first()["TaxiOut"] == 0


def test_topk_breaks_ties_by_value_and_counts_nulls(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None, None, None]], "x string")
    rows = profile.category_topk(df, ["x"], k=3).orderBy("rank").collect()
    assert [(r["value"], r["count"]) for r in rows] == [(None, 3), ("c", 2), ("a", 1)]


def test_topk_is_cut_before_the_shuffle(flights):
    top = profile.category_topk(flights, ["Origin", "Dest"])
    assert "WindowGroupLimit" in _plan(top)


def test_describe_equals_spark_describe(flights):
    ours = {r["column"]: r for r in profile.describe_numeric(flights).collect()}
    theirs = {r["summary"]: r for r in flights.describe("DepDelay", "Distance").collect()}
    for column in ("DepDelay", "Distance"):
        for ours_name in ("count", "mean", "stddev", "min", "max"):
            assert ours[column][ours_name] == pytest.approx(float(theirs[ours_name][column]))


def test_describe_of_an_empty_table(spark):
    df = spark.createDataFrame([], T.StructType([T.StructField("x", T.IntegerType())]))
    assert profile.describe_numeric(df).collect() == [("x", 0, None, None, None, None)]
