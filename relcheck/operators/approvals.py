"""Approval requests fanned out to release-tracking tables (L1, L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fanout(approvals: DataFrame, existing_databases: DataFrame, sep: str = ";") -> dict[str, DataFrame]:
    """L1: approved requests only; L2: three de-duplicated projections
    (database, release, stakeholder), databases not already in the target
    removed with an anti join."""
    ok = approvals.where(F.col("status") == "approved")
    databases = ok.select("database_name").distinct() \
        .join(existing_databases.select("database_name"), "database_name", "left_anti")
    releases = ok.select("database_name", "release_date").distinct()
    stakeholders = ok.select("database_name", F.explode(F.split("stakeholders", sep)).alias("stakeholder")) \
        .where(F.col("stakeholder") != "").distinct()
    return {"database": databases, "release": releases, "stakeholder": stakeholders}


def fanout_rows(approvals: DataFrame, existing_databases: DataFrame) -> DataFrame:
    """All three targets as one (target, database_name, value) frame."""
    f = fanout(approvals, existing_databases)
    d = f["database"].select(F.lit("database").alias("target"), "database_name", F.lit(None).cast("string").alias("value"))
    r = f["release"].select(F.lit("release").alias("target"), "database_name",
                            F.col("release_date").cast("string").alias("value"))
    s = f["stakeholder"].select(F.lit("stakeholder").alias("target"), "database_name", F.col("stakeholder").alias("value"))
    return d.unionByName(r).unionByName(s)
