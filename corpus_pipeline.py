"""The corpus pipeline: quality classifier, near-dedup, secret scan, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns
is written as Parquet in the shared folder and read again as the next one's
documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from latebird.llm.common import staged, table
from latebird.llm.mixing import Mix, sample_mix
from latebird.llm.ordinal import select_documents
from latebird.llm.packing import Limits, first_line, pack_documents
from latebird.llm.secret_scan import redact_secrets
from latebird.llm.simhash import drop_near_copies

#: Near the corpus's own mix: most documents stay, the hot source gives up some.
PIPELINE_MIX = Mix(budget=0.85)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier keeps; labels come from `sf_dir`."""
    return select_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each SimHash component."""
    return drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a placeholder."""
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the raked probabilities of their source, language and topic."""
    return sample_mix(docs, PIPELINE_MIX).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their token ids; a document's
    first line is its prompt, which bears no loss."""
    return pack_documents(docs, Limits(tokens=2048, loss_tokens=1920), prompt=first_line())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("mix", mix),
    ("pack", pack),
]

#: The classifier and the forest are fitted models: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
