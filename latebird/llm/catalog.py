"""The operators of this subpackage as named queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latebird.llm import mixing
from latebird.llm.common import scratch, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


@query("op6_vector_packing")
def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.packing import Limits, first_line, pack_documents

    # A document's first line is its prompt; the rest of it bears loss.
    limits = Limits(tokens=2048, segments=256, loss_tokens=1920)
    pieces = pack_documents(table(spark, sf_dir, "documents"), limits, prompt=first_line())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "loss_tokens",
    )


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.tokenfiles import read_token_files, write_token_files

    docs = table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, scratch(spark, "token-files"))
    return read_token_files(spark, manifest)


@query("op5_simhash_pigeonring")
def op5_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.simhash import fingerprint_hex, simhash_components

    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprint_hex().alias("fingerprint"), "component_id")


@query("op10_certified_rules")
def op10_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.quality_rules import apply_quality_rules

    return apply_quality_rules(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), risk=0.05, level=0.05
    ).drop("n_lines", "n_upper_words")


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


@query("op8_norm_sorted_topk", OP8_SQL)
def op8_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.topk import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@query("op7_kd_shards")
def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.sharding import assign_shards

    return assign_shards(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op1_raked_mix", mixing.check_sql())
def op1_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = mixing.sample_mix(table(spark, sf_dir, "documents"))
    return sampled.select(
        "doc_id",
        F.coalesce("source", F.lit(mixing.NONE)).alias("source"),
        F.coalesce("lang", F.lit(mixing.NONE)).alias("lang"),
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("tokens"),
        F.round("mix_probability", 6).alias("probability"),
    )


@query("op2_ordinal_quality")
def op2_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.ordinal import grade_documents

    return grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_forest_secrets")
def op4_forest_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.secret_scan import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"))


@query("op3_skip_chain_pii")
def op3_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.pii_crf import find_personal_data

    return find_personal_data(table(spark, sf_dir, "documents"))


@query("op12_diagonal_alignment")
def op12_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.alignment import align_tokenizers

    aligned = align_tokenizers(table(spark, sf_dir, "documents"), written="sha256")
    return aligned.withColumnRenamed("groups", "groups_sha256")


def _replaced_words(docs: DataFrame) -> DataFrame:
    """`docs` in which every tenth doc_id by checksum has a tail of repeated words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(words: Column) -> Column:
        n = F.size(words)
        first = (g % n).cast("int")
        period = (1 + F.floor((n - first) / (3 + g % 8))).cast("int")
        return F.transform(
            words,
            lambda w, i: F.when(i < first, w).otherwise(F.get(words, first + (i - first) % period)),
        )

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # An array of one holds the words while the rule reads them, so that they are made once.
    joined = F.transform(F.array(words), lambda w: F.array_join(periodic(w), " "))[0]
    planted = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select("doc_id", F.when(planted, joined).otherwise(F.col("text")).alias("text"))


@query("op13_block_convolution_runs")
def op13_block_convolution_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.periods import find_periodic_runs

    found = find_periodic_runs(_replaced_words(table(spark, sf_dir, "documents")))
    # Of the runs by start, then period, the first that no other exceeds in length / period.
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda a, b: F.when(b.length * a.period > a.length * b.period, b).otherwise(a),
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op11_rare_token_licenses")
def op11_rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latebird.llm.license_scan import scan_licenses

    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.array_distinct("base.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").cast("long").alias("first_word"),
        F.array_max("base.word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, "found.label")), ",").alias("labels"),
        F.coalesce(F.array_max("found.score"), F.lit(0.0)).alias("score"),
    )
