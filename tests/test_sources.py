"""CSV and Parquet."""

import pytest
from pyspark.sql import functions as F

from latebird.operators import cleaning
from latebird.plans import stages
from latebird.schema import FLIGHT_COLUMNS, FLIGHT_SCHEMA, REQUIRED_COLUMNS
from latebird.sources import (
    read_flights_csv,
    read_flights_parquet,
    write_flights_csv,
    write_table,
)


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def csv_dir(flights, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "flights")
    write_flights_csv(flights, path)
    return path


@pytest.mark.parametrize("infer", [False, True])
def test_csv_round_trip(spark, flights, csv_dir, infer):
    back = read_flights_csv(spark, csv_dir, infer=infer)
    assert back.dtypes == flights.dtypes
    assert _same(back, flights)


def test_csv_files_by_name(spark, flights, csv_dir):
    files = spark.read.text(csv_dir).inputFiles()
    assert len(files) > 1
    one = read_flights_csv(spark, files[0]).count()
    assert 0 < one < flights.count()
    assert read_flights_csv(spark, files).count() == flights.count()


def _write(tmp_path, header, *rows):
    file = tmp_path / "year.csv"
    file.write_text("\n".join([",".join(header), *[",".join(r) for r in rows]]) + "\n")
    return str(file)


def _row(**values):
    return [str(values.get(c, "1")) for c in FLIGHT_COLUMNS]


def test_column_of_nulls_keeps_its_declared_type(spark, tmp_path):
    path = _write(tmp_path, FLIGHT_COLUMNS, _row(TaxiOut="NA"), _row(TaxiOut="NA"))
    assert read_flights_csv(spark, path).schema == FLIGHT_SCHEMA
    assert dict(read_flights_csv(spark, path, infer=True).dtypes)["TaxiOut"] == "string"
    assert [r["TaxiOut"] for r in read_flights_csv(spark, path).collect()] == [None, None]


def _reordered():
    header = list(FLIGHT_COLUMNS)
    header[4], header[5] = header[5], header[4]
    return header


def test_columns_follow_the_header(spark, tmp_path):
    values = _row(DepTime="5", CRSDepTime="4")
    values[4], values[5] = values[5], values[4]
    row = read_flights_csv(spark, _write(tmp_path, _reordered(), values)).first()
    assert (row["DepTime"], row["CRSDepTime"]) == (5, 4)


def test_files_with_different_headers_fail(spark, tmp_path):
    _write(tmp_path, FLIGHT_COLUMNS, _row())
    (tmp_path / "other").mkdir()
    other = _write(tmp_path / "other", _reordered(), _row())
    with pytest.raises(Exception, match="header does not conform"):
        read_flights_csv(spark, [str(tmp_path / "year.csv"), other]).collect()


def test_parquet_by_year(spark, flights, tmp_path):
    path = str(tmp_path / "by_year")
    write_table(flights, path, partition_by=["Year"])
    back = read_flights_parquet(spark, path).select(flights.columns)
    assert _same(back, flights)
    plan = back.where("Year = 1996")._jdf.queryExecution().executedPlan().toString()
    assert "Year" in plan.split("PartitionFilters", 1)[1].split("]", 1)[0]


def test_malformed_cells_are_counted_or_fail(spark, make_flights, tmp_path):
    from latebird.sources import count_malformed

    path = str(tmp_path / "in")
    write_flights_csv(make_flights({}, {"DepDelay": 7}), path)
    assert count_malformed(spark, path) == 0
    files = [f for f in (tmp_path / "in").iterdir() if f.suffix == ".csv"]
    with_rows = next(f for f in files if len(f.read_text().splitlines()) > 1)
    lines = with_rows.read_text().splitlines()
    place = lines[0].split(",").index("DepDelay")
    cells = lines[1].split(",")
    cells[place] = "x"
    with_rows.write_text("\n".join([lines[0], ",".join(cells), *lines[2:]]) + "\n")
    copy = tmp_path / "copy"
    copy.mkdir()
    for f in files:
        (copy / f.name).write_text(f.read_text())
    assert count_malformed(spark, str(copy)) == 1
    assert read_flights_csv(spark, str(copy)).where("DepDelay IS NULL").count() == 1
    with pytest.raises(Exception):
        read_flights_csv(spark, str(copy), fail_fast=True).collect()


@pytest.mark.parametrize("name", [*REQUIRED_COLUMNS, "Cancelled"])
def test_clean_stage_on_text_drops_what_is_no_value(flights, name):
    """The stage and the direct path agree where a column comes as text, partly bad."""
    kind = dict(flights.dtypes)[name]
    text = flights.limit(400).withColumn(
        name, F.expr(f"CASE WHEN pmod(hash(*), 2) = 0 THEN 'x' ELSE CAST({name} AS STRING) END")
        if kind != "string" else F.expr(f"CASE WHEN pmod(hash(*), 2) = 0 THEN NULL ELSE {name} END"),
    ).cache()
    staged = stages.clean_stage(REQUIRED_COLUMNS).transform(text)
    direct = cleaning.clean_flights(cleaning.pin_columns(text, zero_fill=()))
    assert staged.where(" OR ".join(f"{c} IS NULL" for c in REQUIRED_COLUMNS)).isEmpty()
    assert 0 < staged.count() == direct.count() < 400
    assert staged.select(*direct.columns).exceptAll(direct).isEmpty()
    text.unpersist()


def test_clean_stage_keeps_pushdown_on_typed_input(flights):
    plan = stages.clean_stage(REQUIRED_COLUMNS).transform(flights)._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "IsNotNull(CRSDepTime)" in plan and "IsNotNull" in pushed
