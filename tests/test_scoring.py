"""Scoring in one pass, versions of models, narrowest types, partitions written again."""

import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebird.operators import cleaning
from latebird.plans import registry, scoring, training
from latebird.plans.registry import committed, drop_old_versions, load_published, publish_model
from latebird.plans.scoring import save_model, score_batch, score_files
from latebird.sources import merged_schema, narrowest_types, read_flights_csv, widened, write_flights_csv, write_table


@pytest.fixture(scope="module")
def parts(flights):
    return cleaning.hash_split(flights)


@pytest.fixture(scope="module")
def tree(parts):
    return training.train_model(parts[0], training.decision_tree(maxDepth=2))


def test_the_csvs_are_read_once(spark, parts, tree, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    save_model(tree, str(tmp_path / "model"))
    write_flights_csv(parts[1], str(folder))
    file = next(folder.glob("part-*"))
    lines = file.read_text().splitlines()
    distance = lines[0].split(",").index("Distance")
    cells = lines[1].split(",")
    cells[distance] = "far"
    file.write_text("\n".join([lines[0], ",".join(cells), *lines[2:]]) + "\n")
    for checksum in folder.glob(".*.crc"):
        checksum.rename(tmp_path / checksum.name)
    whole = read_flights_csv(spark, str(folder))
    expected = score_batch(tree, whole)
    wanted = {"read": whole.count(), "scored": expected.count(), "malformed": 1}
    wanted["dropped"] = wanted["read"] - wanted["scored"]

    def write_then_remove(*given, **named):
        write_table(*given, **named)
        shutil.rmtree(folder)

    monkeypatch.setattr(scoring, "write_table", write_then_remove)
    result = score_files(spark, str(folder), str(tmp_path / "model"), str(tmp_path / "out"))
    assert result.counts == wanted
    values = {r["metric"]: r["value"] for r in result.report.collect()}
    assert values["read"] == wanted["read"] and values["scored"] == result.predictions.count()
    assert 0 < values["MAE"] <= values["RMSE"]


def test_a_year_scored_again_replaces_that_year(spark, parts, tree, tmp_path):
    save_model(tree, str(tmp_path / "model"))
    years = [r[0] for r in parts[1].select("Year").distinct().orderBy("Year").collect()][:2]

    def run(year, flights):
        write_flights_csv(flights, str(tmp_path / f"in{year}"))
        return score_files(
            spark, str(tmp_path / f"in{year}"), str(tmp_path / "model"), str(tmp_path / "out"), partition_by=["Year"]
        )

    of = {y: parts[1].where(F.col("Year") == y) for y in years}
    first = {y: run(y, of[y]).counts["scored"] for y in years}
    fewer = run(years[0], of[years[0]].where("Distance > 1000"))
    assert 0 < fewer.counts["scored"] < first[years[0]]
    assert fewer.predictions.count() == fewer.counts["scored"]
    stored = spark.read.parquet(str(tmp_path / "out")).groupBy("Year").count().collect()
    assert {r["Year"]: r["count"] for r in stored} == {years[0]: fewer.counts["scored"], years[1]: first[years[1]]}


def test_replacing_partitions_needs_partitions(parts, tmp_path):
    with pytest.raises(ValueError, match="partition"):
        write_table(parts[1], str(tmp_path / "x"), replace_partitions=True)


def test_readers_see_whole_versions_only(spark, flights, parts, tree, tmp_path, monkeypatch):
    root = str(tmp_path / "models")
    assert committed(spark, root) is None
    with pytest.raises(FileNotFoundError):
        load_published(spark, root)
    publish_model(tree, root, schema=flights.schema, metrics={"RMSE": 3.5})
    other = training.train_model(parts[0], training.decision_tree(maxDepth=1))

    class Interrupted(PipelineModel):
        def write(self):
            writer = super().write()

            class Half:
                def save(self, path):
                    writer.save(path)
                    shutil.rmtree(f"{path}/stages")
                    raise OSError("the save was interrupted")

            return Half()

    with pytest.raises(OSError, match="interrupted"):
        publish_model(Interrupted(other.stages), root)
    model, commit = load_published(spark, root)
    assert commit.version == 1 and commit.metrics == {"RMSE": 3.5} and commit.schema == flights.schema
    assert score_batch(model, parts[1]).count() == score_batch(tree, parts[1]).count()
    assert publish_model(other, root).version == 2
    assert load_published(spark, root)[1].version == 2
    assert load_published(spark, root, 1)[1].version == 1
    assert drop_old_versions(spark, root, keep=1) == [1]
    assert load_published(spark, root)[0].stages[-1].depth == 1
    with pytest.raises(AnalysisException):
        load_published(spark, root, 1)


def test_scoring_checks_the_training_schema(spark, flights, parts, tree, tmp_path):
    root = str(tmp_path / "models")
    publish_model(tree, root, schema=flights.schema)
    write_flights_csv(parts[1], str(tmp_path / "in"))
    result = score_files(spark, str(tmp_path / "in"), root, str(tmp_path / "out"), published=True)
    assert result.counts["malformed"] == 0 and result.counts["read"] == parts[1].count()
    write_flights_csv(parts[1].drop("Distance"), str(tmp_path / "less"))
    with pytest.raises(ValueError, match="Distance is missing"):
        score_files(spark, str(tmp_path / "less"), root, str(tmp_path / "out"), published=True)
    # Inference takes a column of nulls for text.
    write_flights_csv(parts[1].withColumn("TaxiOut", F.lit(None).cast("int")), str(tmp_path / "null"))
    with pytest.raises(ValueError, match="TaxiOut is string, was int"):
        score_files(spark, str(tmp_path / "null"), root, str(tmp_path / "out"), published=True, infer=True)
    result = score_files(spark, str(tmp_path / "null"), root, str(tmp_path / "out"), published=True)
    assert result.counts["scored"] > 0


def test_narrowest_types_merge_over_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y,z,w,Distance\n1,NA,5,abc,NA\n2,NA,NA,1,NA\n")
    (folder / "b.csv").write_text("x,y,z,w,Distance\n3000000000,1.5,-6,NA,NA\n")
    found = {r["column_name"]: (r["type_name"], r["cells"]) for r in narrowest_types(spark, str(folder)).collect()}
    assert found == {"x": ("bigint", 3), "y": ("double", 1), "z": ("int", 2), "w": ("string", 2), "Distance": ("void", 0)}
    merged = merged_schema(spark, str(folder))
    kinds = [T.LongType(), T.DoubleType(), T.IntegerType(), T.StringType(), T.IntegerType()]
    assert [f.dataType for f in merged] == kinds and merged.names == ["x", "y", "z", "w", "Distance"]
    one, two = (merged_schema(spark, str(folder / f"{f}.csv")) for f in "ab")
    assert widened(one, two) == widened(two, one) != one
    assert {f.name: f.dataType for f in widened(one, two)}["x"] == T.LongType()
    read = read_flights_csv(spark, str(folder), types={f.name: f.dataType for f in merged})
    assert read.schema == merged and read.agg(F.max("x")).first()[0] == 3_000_000_000


def test_registry_needs_no_local_path(spark, tree, tmp_path):
    root = f"file://{tmp_path}/m"
    publish_model(tree, root)
    assert registry.commits(spark, root).count() == 1
