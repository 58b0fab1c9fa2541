"""Saved models as versions, of which readers see only whole ones.

A model is written to a folder of its own; then one row is appended to the table
of commits, with the version, the folder, the input's schema and the metrics. The
row's file appears at once or not at all, so a reader sees the version before or
the whole new one, never half a model, and a failed save leaves only a folder
that no commit names. Saving over a model in place, as `save_model` does, has a
time in which there is none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebird.session import drop_folder

_COMMIT = "version long, folder string, schema string, metrics map<string,double>, committed timestamp"


@dataclass(frozen=True)
class Commit:
    version: int
    folder: str
    schema: T.StructType | None
    metrics: Mapping[str, float]


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The table of commits, one row for each version; empty where there is none yet."""
    try:
        return spark.read.schema(_COMMIT).json(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT)


def committed(spark: SparkSession, root: str, version: int | None = None) -> Commit | None:
    """The latest commit, or that of a version. Of two saves at a time that took the
    same number, the later commit counts."""
    rows = commits(spark, root)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    row = rows.orderBy(F.desc("version"), F.desc("committed"), "folder").limit(1).collect()
    if not row:
        return None
    schema = T.StructType.fromJson(json.loads(row[0]["schema"])) if row[0]["schema"] else None
    return Commit(row[0]["version"], row[0]["folder"], schema, row[0]["metrics"] or {})


def publish_model(
    model: PipelineModel,
    root: str,
    *,
    schema: T.StructType | None = None,
    metrics: Mapping[str, float] | None = None,
) -> Commit:
    """Save a fitted pipeline as the next version under `root`, with the schema of
    the flights it was trained on, which scoring checks, and its metrics."""
    spark = SparkSession.active()
    before = committed(spark, root)
    version = before.version + 1 if before else 1
    folder = f"{root}/models/{version:06d}-{uuid.uuid4().hex}"
    model.write().save(folder)
    values = {k: float(v) for k, v in (metrics or {}).items()}
    row = spark.createDataFrame(
        [(version, folder, schema.json() if schema else None, values)],
        "version long, folder string, schema string, metrics map<string,double>",
    )
    row.withColumn("committed", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{root}/commits")
    return Commit(version, folder, schema, values)


def load_published(spark: SparkSession, root: str, version: int | None = None) -> tuple[PipelineModel, Commit]:
    """The latest whole version, or the given one, with its commit."""
    found = committed(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"no version {'' if version is None else version} of a model under {root}")
    return PipelineModel.load(found.folder), found


def drop_old_versions(spark: SparkSession, root: str, keep: int = 3) -> list[int]:
    """Delete the folders of all but the `keep` latest versions. Their commits stay
    as a record; readers that hold an older model in memory are not affected."""
    rows = commits(spark, root).orderBy(F.desc("version"), F.desc("committed"), "folder").collect()
    old = rows[max(keep, 1) :]  # one row for each save
    for row in old:
        drop_folder(spark, row["folder"])
    return sorted(r["version"] for r in old)


def check_schema(given: T.StructType, wanted: T.StructType) -> None:
    """Raise where flights lack a column of the training schema or have it with
    another type. A column without a type yet (all null) passes."""
    types = {f.name: f.dataType for f in given}
    wrong = []
    for f in wanted:
        own = types.get(f.name)
        if own is None:
            wrong.append(f"{f.name} is missing")
        elif own != f.dataType and not isinstance(own, T.NullType):
            wrong.append(f"{f.name} is {own.simpleString()}, was {f.dataType.simpleString()}")
    if wrong:
        raise ValueError("flights differ from those the model was trained on: " + "; ".join(wrong))
