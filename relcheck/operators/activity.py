"""Pull-request activity counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relcheck.functions.time import epoch_millis_to_ts


def activity(prs: DataFrame, reviewers: DataFrame, users: DataFrame, start: str, end: str,
             filter_reviews: bool = False) -> DataFrame:
    """PRs submitted per author inside [start, end] (end is a
    midnight, so later PRs of the end day fall out; ``created_ms`` is
    floored to whole seconds), reviews per reviewer (not date filtered
    unless ``filter_reviews``), every user of the list shown with zeros.

    ``users`` is a one-column frame (``user``); it is small config, so it
    is the left side of two left joins against per-user counts that were
    aggregated (with partial aggregation) before the join."""
    created = epoch_millis_to_ts(F.col("created_ms"))
    in_range = created.between(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end)))
    scoped = prs.join(users.select(F.col("user").alias("author")), "author", "left_semi")
    submitted = scoped.where(in_range).groupBy("author").agg(F.count(F.lit(1)).alias("submitted"))
    rv = reviewers.join(users.select(F.col("user").alias("reviewer")), "reviewer", "left_semi")
    if filter_reviews:
        rv = rv.join(prs.where(in_range).select("pr_id"), "pr_id", "left_semi")
    reviewed = rv.groupBy("reviewer").agg(F.count(F.lit(1)).alias("reviewed"))
    u = users.select(F.col("user"))
    return u.join(submitted.withColumnRenamed("author", "user"), "user", "left") \
        .join(reviewed.withColumnRenamed("reviewer", "user"), "user", "left") \
        .select("user", F.coalesce("submitted", F.lit(0)).alias("submitted"),
                F.coalesce("reviewed", F.lit(0)).alias("reviewed"))
