"""spark-submit train.py DATA MODEL: compare the regressors on flight CSVs and save the winner."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from latebird.operators.cleaning import hash_split
from latebird.plans.recipes import RECIPES
from latebird.plans.scoring import save_model
from latebird.plans.training import GRIDS, REGRESSORS, candidates, compare_models
from latebird.sources import read_flights_csv


def train(
    spark: SparkSession,
    data_path: str,
    model_path: str,
    *,
    recipe: str = "detailed",
    grid: str = "single",
    names: tuple[str, ...] = tuple(REGRESSORS),
    folds: int = 3,
    parallelism: int = 3,
) -> DataFrame:
    """The leaderboard; the best fitted pipeline is written to `model_path`."""
    train_part, test_part = hash_split(read_flights_csv(spark, data_path))
    compared = compare_models(
        train_part,
        test_part,
        RECIPES[recipe],
        candidates(grid, names=names),
        folds=folds,
        parallelism=parallelism,
    )
    save_model(compared.best()[1], model_path)
    return compared.leaderboard


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("data", help="a flight CSV, a folder of them, or a glob")
    parser.add_argument("model", help="where the best fitted pipeline goes")
    parser.add_argument("--recipe", choices=sorted(RECIPES), default="detailed")
    parser.add_argument("--grid", choices=sorted(GRIDS), default="single")
    parser.add_argument("--folds", type=int, default=3)
    given = parser.parse_args()
    spark = SparkSession.builder.appName("latebird-train").getOrCreate()
    board = train(spark, given.data, given.model, recipe=given.recipe, grid=given.grid, folds=given.folds)
    board.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
