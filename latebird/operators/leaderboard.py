"""Scoring and choosing among measured models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_score(results: DataFrame) -> DataFrame:
    """Add `score` and `metric`: MAE where RMSE is more than twice MAE (a few
    large misses dominate), else RMSE."""
    heavy_tail = F.col("rmse") > 2 * F.col("mae")
    return results.withColumns(
        {
            "score": F.when(heavy_tail, F.col("mae")).otherwise(F.col("rmse")),
            "metric": F.when(heavy_tail, F.lit("MAE")).otherwise(F.lit("RMSE")),
        }
    )


def best_model(leaderboard: DataFrame) -> DataFrame:
    """The row with the lowest score; of equals, the one listed first."""
    return leaderboard.orderBy("score", "order_no").limit(1)
