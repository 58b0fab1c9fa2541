"""Every query with check SQL gives the check database's rows."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()

# Duck type of each Spark type in the results.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _sorted(rows):
    def comparable(value):
        if isinstance(value, float) and math.isfinite(value):
            return round(value, 5) + 0.0
        return value

    cleaned = [tuple(comparable(v) for v in row) for row in rows]
    return sorted(cleaned, key=lambda row: [(v is not None, str(v)) for v in row])


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_check_sql(spark, sf_dir, duck, name):
    ours = QUERIES[name](spark, sf_dir)
    theirs = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {c: TYPES[kind] for c, kind in ours.dtypes} == theirs
    columns = sorted(ours.columns)
    expected = duck.execute(
        f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({ORACLES[name]})"
    ).fetchall()
    got = [tuple(row) for row in ours.select(*columns).collect()]
    assert _sorted(got) == _sorted(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_unchecked_queries_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["ArrDelay", "prediction"]
    assert result.count() > 0
