"""Code-to-description migration of an events table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_reference(ref: DataFrame, code_col: str = "event_type_cd",
                    desc_col: str = "event_type_description") -> DataFrame:
    """One description per code (the reference table may repeat rows); the
    lowest description wins, so the choice is deterministic."""
    return ref.groupBy(code_col).agg(F.min(desc_col).alias("_ref_desc"))


def backfill_description(events: DataFrame, ref: DataFrame, code_col: str = "event_type_cd",
                         desc_col: str = "event_type_description") -> DataFrame:
    """fill the description from the reference by code; rows already
    filled keep their value, so a second run changes nothing. The
    planner broadcasts the de-duplicated reference when its size allows."""
    r = dedup_reference(ref, code_col, desc_col)
    j = events.join(r, code_col, "left")
    return j.withColumn(desc_col, F.coalesce(F.col(desc_col), F.col("_ref_desc"))).drop("_ref_desc") \
        .select(*events.columns)


def backfill_report(backfilled: DataFrame, code_col: str = "event_type_cd",
                    desc_col: str = "event_type_description") -> DataFrame:
    """per code: rows, filled rows, unresolved rows (description null)."""
    return backfilled.groupBy(code_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(desc_col).isNotNull()).alias("n_filled"),
        F.count_if(F.col(desc_col).isNull()).alias("n_unresolved"))


def backfill_proof(before: DataFrame, after: DataFrame, desc_col: str = "event_type_description") -> DataFrame:
    """the migration's proof as (metric, value): rows before and after
    (they must agree), and rows filled before and after."""
    def counts(df: DataFrame, when: str) -> DataFrame:
        c = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(desc_col).isNotNull()).alias("filled"))
        return c.select(F.inline(F.array(*[F.struct(F.lit(f"{m}_{when}").alias("metric"), F.col(m).alias("value")) for m in ("rows", "filled")])))
    return counts(before, "before").unionByName(counts(after, "after"))


def dto_projection(events: DataFrame, id_col: str = "event_id",
                   desc_col: str = "event_type_description") -> DataFrame:
    """API shape: ``event_type_code`` kept for compatibility, always null;
    description from the events table."""
    return events.select(id_col, F.lit(None).cast("string").alias("event_type_code"), desc_col)


def sink_upsert(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """sink rows: description stored as delivered (no lookup, no code
    column); a re-delivered event (same id) is not inserted twice, also when the
    batch itself repeats it: of a repeated id the least row by its columns stays,
    whatever the order of delivery. A row with a null id has none to be told by;
    it is the same event when the whole row is."""
    cols = existing.columns
    rows = incoming.select(*cols)
    named = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in key])
    one = rows.where(named).groupBy(*[F.col(c).alias(f"_k_{c}") for c in key]).agg(F.min(F.struct(*cols)).alias("r")).select("r.*")
    new = one.join(existing.select(*key), key, "left_anti")
    nameless = rows.where(~named).distinct()
    known = existing.where(~named).select(*[F.col(c).alias(f"_e_{c}") for c in cols])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_e_{c}")) for c in cols])
    return existing.unionByName(new.select(*cols)).unionByName(nameless.join(known, same, "left_anti"))
