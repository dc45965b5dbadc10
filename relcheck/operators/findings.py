"""The one result contract of every check (the *findings* frame) and the
summaries over it (C12, C13).

``check_id, object_kind, object_key, field, status, expected, actual``
with status one of MISSING, UNEXPECTED, CHANGED, VIOLATION, SKIP, PASS.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FINDINGS_COLS = ["check_id", "object_kind", "object_key", "field", "status", "expected", "actual"]
FAIL_STATUSES = ["MISSING", "UNEXPECTED", "CHANGED", "VIOLATION"]


def union_findings(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [f.select(*FINDINGS_COLS) for f in frames])


def summary(findings: DataFrame) -> DataFrame:
    """Counts per check and status (passed/failed/skipped)."""
    return findings.groupBy("check_id", "status").agg(F.count(F.lit(1)).alias("n_findings"))


def outcome(findings: DataFrame) -> DataFrame:
    """Per check: passed, failed and skipped findings, and all of them."""
    return findings.groupBy("check_id").agg(
        F.count_if(F.col("status") == "PASS").alias("n_passed"),
        F.count_if(F.col("status").isin(FAIL_STATUSES)).alias("n_failed"),
        F.count_if(F.col("status") == "SKIP").alias("n_skipped"),
        F.count(F.lit(1)).alias("n_findings"))


def verdict(findings: DataFrame) -> DataFrame:
    """Per check: failing findings, failing objects, and the verdict
    (any failure -> FAILED)."""
    failed = F.col("status").isin(FAIL_STATUSES)
    return findings.groupBy("check_id").agg(
        F.count_if(failed).alias("n_failures"),
        F.count_distinct(F.when(failed, F.col("object_key"))).alias("n_failing_objects"),
        F.when(F.count_if(failed) > 0, F.lit("FAILED")).otherwise(F.lit("PASSED")).alias("verdict"))
