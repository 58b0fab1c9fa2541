"""Row filters, projections and the train/test split: narrow steps, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebird.functions.bucket import SPLIT_COLUMNS, bucket, share_of_buckets
from latebird.schema import (
    FLIGHT_COLUMNS,
    LABEL,
    LEAKAGE_COLUMNS,
    REQUIRED_COLUMNS,
    TAKEOFF_COLUMNS,
    UNINFORMATIVE_COLUMNS,
)


def not_cancelled(df: DataFrame) -> DataFrame:
    """Flights known not to be cancelled; an unknown flag drops the row."""
    return df.where(F.col("Cancelled") != 1)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def clean_flights(df: DataFrame, require_label: bool = True) -> DataFrame:
    """Rows with every required column present and the flight not cancelled."""
    required = [c for c in REQUIRED_COLUMNS if require_label or c != LABEL]
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return not_cancelled(df.where(complete))


def labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col(LABEL).isNotNull())


def pin_columns(df: DataFrame, zero_fill: Sequence[str] = ("TaxiOut",)) -> DataFrame:
    """The declared flight columns with their declared types, in order.

    Text that is no number becomes null. The columns of `zero_fill` get 0 for
    null and move to the end."""
    typed = {n: F.col(n).try_cast(t) for n, t in FLIGHT_COLUMNS.items()}
    kept = [typed[n].alias(n) for n in FLIGHT_COLUMNS if n not in zero_fill]
    return df.select(*kept, *[F.coalesce(typed[n], F.lit(0)).alias(n) for n in zero_fill])


def takeoff_columns(df: DataFrame) -> DataFrame:
    """Only what is known when the plane leaves the ground."""
    return df.select(*TAKEOFF_COLUMNS, "TaxiOut")


def drop_unusable(df: DataFrame) -> DataFrame:
    """Drop the columns known too late, then those without signal."""
    return df.drop(*LEAKAGE_COLUMNS).drop(*UNINFORMATIVE_COLUMNS)


def _in_train(train_share: float, seed: int, columns: Sequence[str]) -> Column:
    return F.expr(f"{bucket(seed, columns)} < {share_of_buckets(train_share)}")


def with_part(
    df: DataFrame,
    train_share: float = 0.8,
    seed: int = 89,
    columns: Sequence[str] = SPLIT_COLUMNS,
    name: str = "part",
) -> DataFrame:
    """Add `train` or `test`, from a hash of the row, in one pass. Equal rows stay
    together, and the parts are the same whatever the partitioning, also when a
    task re-runs. A share that the buckets cannot represent raises."""
    in_train = _in_train(train_share, seed, columns)
    return df.withColumn(name, F.when(in_train, F.lit("train")).otherwise(F.lit("test")))


def hash_split(
    df: DataFrame,
    train_share: float = 0.8,
    seed: int = 89,
    columns: Sequence[str] = SPLIT_COLUMNS,
) -> tuple[DataFrame, DataFrame]:
    """The train and the test part of `with_part`. Each part that is used reads
    the source; where one pass should give both, use `with_part`. A bucket is
    never null, so the condition itself, which is shorter in generated code than
    a comparison of the parts' names, gives the same rows."""
    in_train = _in_train(train_share, seed, columns)
    return df.where(in_train), df.where(~in_train)


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 89
) -> list[DataFrame]:
    """Spark's own split: sorts every partition, and depends on the partitioning.
    Use `hash_split` where a repeatable result matters."""
    return df.randomSplit(list(weights), seed=seed)
