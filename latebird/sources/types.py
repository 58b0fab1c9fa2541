"""The narrowest type of each CSV column, as a lattice that merges over files.

Nothing, int, bigint, double and text are ordered by what they can hold; a
column has the widest type that any of its cells needs. The widest of several
files' types is the type over all of them, so that a file whose column holds no
value at all, which inference takes for text, changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebird.schema import FLIGHT_COLUMNS
from latebird.sources.flights import NULL_TOKEN

#: From narrow to wide.
LATTICE: tuple[T.DataType, ...] = (T.NullType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType())


#: How every text begins that casts to a number: blanks and control characters,
#: which casts trim, a sign, then a digit, a point, or a name of a double.
_NUMBER_BEGINS = r"^[\x00-\x20\x7F]*[+-]?([0-9.]|[nN][aA][nN]|[iI][nN][fF])"


def _place(cell: Column) -> Column:
    """The place in the lattice of the narrowest type that holds a cell. A cast that
    fails costs an exception, so text that begins as no number does is not cast."""
    width = F.when(cell.isNull(), 0).when(~cell.rlike(_NUMBER_BEGINS), len(LATTICE) - 1)
    for place, kind in list(enumerate(LATTICE))[1:-1]:
        width = width.when(cell.try_cast(kind).isNotNull(), place)
    return width.otherwise(len(LATTICE) - 1)


def narrowest_types(
    spark: SparkSession, path: str | Sequence[str], *, null_token: str = NULL_TOKEN
) -> DataFrame:
    """(column_name, type_name, cells): each column of headed CSVs with its
    narrowest type, `void` where no cell has a value, and how many have one.
    One pass over the files, each column's cells as text; one row for each task
    and column is shuffled."""
    reader = spark.read.option("header", True).option("nullValue", null_token).option("enforceSchema", False)
    cells = reader.csv(path if isinstance(path, str) else list(path))
    names = F.array(*[F.lit(t.simpleString()) for t in LATTICE])
    unfolded = cells.select(F.posexplode(F.array(*[F.col(c) for c in cells.columns])).alias("place", "cell"))
    merged = unfolded.groupBy("place").agg(F.max(_place(F.col("cell"))).alias("width"), F.count("cell").alias("cells"))
    columns = F.array(*[F.lit(c) for c in cells.columns])
    return merged.select(
        F.get(columns, F.col("place")).alias("column_name"), F.get(names, F.col("width")).alias("type_name"), "cells"
    )


def merged_schema(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    null_token: str = NULL_TOKEN,
    without_values: Mapping[str, T.DataType] = FLIGHT_COLUMNS,
) -> T.StructType:
    """One schema for all files, in the order of their header; a column without
    any value has its type in `without_values`, else text."""
    reader = spark.read.option("header", True).option("nullValue", null_token)
    order = reader.csv(path if isinstance(path, str) else list(path)).columns
    found = {r["column_name"]: r["type_name"] for r in narrowest_types(spark, path, null_token=null_token).collect()}
    by_name = {t.simpleString(): t for t in LATTICE}

    def kind(name: str) -> T.DataType:
        own = by_name[found.get(name, "void")]
        return without_values.get(name, T.StringType()) if isinstance(own, T.NullType) else own

    return T.StructType([T.StructField(name, kind(name)) for name in order])


def widened(schema: T.StructType, other: T.StructType) -> T.StructType:
    """The types that hold both schemas' columns, in the order of the first."""
    places = {t.simpleString(): i for i, t in enumerate(LATTICE)}
    others = {f.name: f.dataType for f in other}

    def widest(f: T.StructField) -> T.DataType:
        both = (f.dataType, others.get(f.name, T.NullType()))
        return LATTICE[max(places[t.simpleString()] for t in both)]

    names = {f.name for f in schema}
    own = [T.StructField(f.name, widest(f)) for f in schema]
    return T.StructType(own + [f for f in other if f.name not in names])
