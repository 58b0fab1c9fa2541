"""Narrowest types of cells."""

from pyspark.sql import functions as F

from latebird.sources import types


def test_text_that_begins_as_no_number_is_not_cast(spark):
    begins = ["", "+", "- ", "\t-", "\x00", "\x1c", "\x7f", "\u0085", " "]
    bodies = ["", "12", "3000000000", "1e5", "5.", ".", "1d", "0x1p3", "NaN", "nan", "inf", "Infinity", "N12", "A1", "9E", "infx", "١"]
    cells = spark.createDataFrame([(a + b + c,) for a in begins for b in bodies for c in ("", " ", "\x7f", "d")], "cell string")
    plain = F.lit(len(types.LATTICE) - 1)
    for place in (3, 2, 1):
        plain = F.when(F.col("cell").try_cast(types.LATTICE[place]).isNotNull(), place).otherwise(plain)
    found = cells.select("cell", types._place(F.col("cell")).alias("place"), plain.alias("plain"))
    assert found.where("place <> plain").isEmpty()
    assert "RLIKE" in found._jdf.queryExecution().toString()
