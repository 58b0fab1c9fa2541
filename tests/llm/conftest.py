from pathlib import Path

import duckdb
import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
EXTRA = (
    "fp long, kept_id long, mix_topic string, mix_tokens long, mix_probability double, secrets string, "
    "secret_doc long, quality_verdict string, key long, node int, shard int, ids binary, found string"
)


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or longer tuples."""

    def make(*given):
        full = [(*r, *(None, "en", "s0", None)[len(r) - 1 :]) if len(r) < 5 else r for r in given]
        return spark.createDataFrame([(*r[:2], r[2], r[3], r[4]) for r in full], DOC_SCHEMA)

    return make


LONG = "alpha beta gamma delta epsilon zeta eta theta " * 30_000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with clashing names."""
    text = "one two three four five six seven eight nine ten. " * 8
    given = [
        (1, "", "en", "s0", 0),
        (2, None, None, None, None),
        (None, text, "en", "s0", 400),
        (3, text, "en", "s0", 400),
        (3, text, "en", "s0", 400),
        (4, text + " extra", None, "s1", 406),
        (5, LONG, "en", None, len(LONG)),
        (6, " \n\t ", "en", "s0", 4),
        (None, None, None, None, None),
        (7, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" <|endoftext|> a.b@x.org', "en", "s0", 80),
    ]
    frame = spark.createDataFrame(given, DOC_SCHEMA)
    for column in EXTRA.split(", "):
        name, kind = column.split()
        frame = frame.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
    return frame


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/labels.parquet")


@pytest.fixture(scope="session")
def no_labels(labels):
    return labels.limit(0)


@pytest.fixture(scope="session")
def duck_llm(small_dir):
    connection = duckdb.connect()
    for file in Path(small_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()
