"""spark-submit score.py DATA MODEL OUTPUT: score flight CSVs and store predictions and report."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from latebird.plans.scoring import score_files


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("data", help="a flight CSV, a folder of them, or a glob")
    parser.add_argument("model", help="a saved pipeline")
    parser.add_argument("output", help="gets predictions/ and report/")
    parser.add_argument("--fail-fast", action="store_true", help="fail on a malformed cell")
    parser.add_argument("--published", action="store_true", help="MODEL holds versions; use the latest")
    parser.add_argument("--by", nargs="*", default=[], help="columns that part the output; only parts of the batch are replaced")
    given = parser.parse_args()
    spark = SparkSession.builder.appName("latebird-score").getOrCreate()
    result = score_files(
        spark,
        given.data,
        given.model,
        f"{given.output}/predictions",
        fail_fast=given.fail_fast,
        report_path=f"{given.output}/report",
        partition_by=given.by,
        published=given.published,
    )
    result.sample.show()
    result.report.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
