"""Tables in the shared folder: what one task reads back of them."""

import pytest
from pyspark.sql import functions as F

from latebird.catalog import flights as flight_table
from latebird.plans import training
from latebird.plans.recipes import COMPACT
from latebird.session import drop_staged, stage_table

LINE = [
    "id AS l_orderkey",
    "id % 7 AS l_partkey",
    "id % 5 AS l_suppkey",
    "CAST(1 + id % 4 AS INT) AS l_linenumber",
    "'A' AS l_returnflag",
    "'F' AS l_linestatus",
    "date_add(DATE '1995-01-01', CAST(id % 900 AS INT)) AS l_shipdate",
]


def _rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


@pytest.fixture
def lineitem_dir(spark, tmp_path):
    spark.range(0, 1000, 1, 2).selectExpr(*LINE).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_a_task_reads_so_many_rows_and_the_session_keeps_its_settings(spark):
    before = spark.conf.getAll
    table, path = stage_table(spark.range(0, 1000, 1, 1).withColumn("p", F.col("id") % 2), "t", ["p"], 100)
    assert max(_rows_by_task(table)) == 100 and table.count() == 1000
    assert table.where("p = 1").rdd.getNumPartitions() == 5
    assert table.sparkSession is spark and spark.conf.getAll == before
    drop_staged(spark, path)


def test_flights_are_staged_as_they_are_read(spark, lineitem_dir, monkeypatch):
    written = []

    def kept(df, *args, **options):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return stage_table(df, *args, **options)

    monkeypatch.setattr(flight_table, "stage_table", kept)
    monkeypatch.setattr(flight_table, "ROWS_A_TASK", 100)
    staged = flight_table.flights(spark, lineitem_dir)
    assert "Exchange" not in written[0]
    assert max(_rows_by_task(staged)) <= 100
    derived = flight_table.derive_flights(spark, lineitem_dir)
    assert staged.exceptAll(derived).isEmpty() and staged.count() == derived.count() == 1000


def test_flights_of_an_empty_table(spark, tmp_path):
    spark.range(0).selectExpr(*LINE).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert flight_table.flights(spark, str(tmp_path)).isEmpty()


def test_a_fits_tasks_keep_so_many_rows(make_flights, monkeypatch):
    monkeypatch.setattr(training, "ROWS_A_TASK", 20)
    flights = make_flights(*[{"FlightNum": i, "DepDelay": i % 30} for i in range(100)]).coalesce(1)
    rows, path = training.stage_folds(flights, COMPACT, 2)
    assert max(_rows_by_task(rows)) <= 20 and rows.count() == 100
    drop_staged(flights.sparkSession, path)
    seen = []

    class Tree(type(training.decision_tree())):
        def fit(self, dataset, params=None):
            seen.append(max(_rows_by_task(dataset)))
            return super().fit(dataset, params)

    training.train_model(flights, Tree(labelCol="ArrDelay", maxDepth=1), COMPACT)
    assert seen == [20]
