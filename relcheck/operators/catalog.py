"""Catalog assembly (B1-B23, of B20 kind, schema and name only): landed catalog rows of many databases into
the per-object shapes the drift checks compare. Everything is one join or
one aggregation over all tables at once.

Arrays built per object (column lists of a constraint, columns of a
table, events of a trigger) are bounded by catalog limits (a table has at
most a few thousand columns), so collecting them per group is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.functions.text import definition_hash, normalize_text

# Schemas that are never user objects.
SYSTEM_SCHEMAS = ["information_schema", "pg_catalog"]

# Catalog code -> label (function kinds, user-defined type kinds).
FUNCTION_KINDS = {"f": "function", "p": "procedure", "a": "aggregate", "w": "window"}


def ordered_list(value: Column, order: Column) -> Column:
    """``array_agg(value ORDER BY order)`` as an aggregate expression."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))),
                       lambda x: x["v"])


def discover_tables(catalog: DataFrame, include_schemas: list[str] | None = None,
                    exclude_schemas: list[str] | None = None, name_like: str | None = None,
                    schema_col="table_schema", table_col="table_name") -> DataFrame:
    """Base tables by schema include/exclude lists and LIKE."""
    df = catalog.select(schema_col, table_col).distinct() \
        .where(~F.col(schema_col).isin(SYSTEM_SCHEMAS + list(exclude_schemas or [])))
    if include_schemas:
        df = df.where(F.col(schema_col).isin(include_schemas))
    if name_like:
        df = df.where(F.col(table_col).like(name_like))
    return df


def listed(df: DataFrame, *cols: str) -> DataFrame:
    """A listing in catalog order (schema, name, position): the only
    global sort, for final output."""
    return df.orderBy(*cols)


def explicit_targets(tables: DataFrame, targets: DataFrame, default_schema: str,
                     target_col="target", schema_col="table_schema", table_col="table_name") -> DataFrame:
    """B2: ``schema.table`` targets (bare name -> default schema) override
    discovery: tables semi-joined to the parsed target list."""
    t = targets.select(
        F.when(F.col(target_col).contains("."), F.split_part(F.col(target_col), F.lit("."), F.lit(1)))
         .otherwise(F.lit(default_schema)).alias(schema_col),
        F.when(F.col(target_col).contains("."), F.split_part(F.col(target_col), F.lit("."), F.lit(2)))
         .otherwise(F.col(target_col)).alias(table_col)).distinct()
    return tables.join(t, [schema_col, table_col], "left_semi")


def column_metadata(cols: DataFrame) -> DataFrame:
    """type = first non-empty of udt_name, data_type, ''; nullability
    as boolean; absent attributes are null."""
    have = set(cols.columns)

    def opt(c, t="string"):
        return F.col(c) if c in have else F.lit(None).cast(t)
    return cols.select(
        "table_schema", "table_name", "column_name", "ordinal_position",
        F.coalesce(F.nullif(opt("udt_name"), F.lit("")), F.nullif(opt("data_type"), F.lit("")),
                   F.lit("")).alias("data_type"),
        (opt("is_nullable") == "YES").alias("is_nullable"),
        opt("char_max", "int").alias("char_max"), opt("num_precision", "int").alias("num_precision"),
        opt("num_scale", "int").alias("num_scale"), opt("datetime_precision", "int").alias("datetime_precision"),
        opt("column_default").alias("column_default"),
        (F.coalesce(opt("is_identity"), F.lit("NO")) == "YES").alias("is_identity"))


def kind_label(code: Column, labels: dict[str, str]) -> Column:
    """Catalog code -> label, else 'unknown'."""
    expr = None
    for k, v in labels.items():
        expr = F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v))
    return expr.otherwise(F.lit("unknown"))


def privileges(grants: DataFrame) -> DataFrame:
    """Grant rows with the grantable flag as boolean and as lower text."""
    flag = F.col("is_grantable") == "YES"
    return grants.select("table_name", "grantee", "privilege_type", flag.alias("is_grantable"),
                         F.lower(flag.cast("string")).alias("is_grantable_text"))


def key_usage(constraints: DataFrame, key_columns: DataFrame, ref_columns: DataFrame) -> DataFrame:
    """B8/B9 assembly: constraint x its key columns, and for a foreign key the
    referenced column of the same position (left join, so a PK or UNIQUE column
    has none). One row a constraint column; a constraint without columns has one
    row with null column."""
    c = ["table_schema", "table_name", "constraint_name"]
    return constraints.join(key_columns, c, "left").join(ref_columns, [*c, "pos"], "left").select(
        *c, "constraint_type", "column_name", "pos", "ref_table", "ref_column")


def keys(key_usage: DataFrame, types=("PRIMARY KEY", "UNIQUE")) -> DataFrame:
    """One row per PK/UNIQUE constraint with its ordered columns."""
    return key_usage.where(F.col("constraint_type").isin(list(types))) \
        .groupBy("table_schema", "table_name", "constraint_name", "constraint_type") \
        .agg(ordered_list(F.col("column_name"), F.col("pos")).alias("columns"))


def foreign_keys(key_usage: DataFrame) -> DataFrame:
    """One row per FK with (local, remote) pairs paired by position
    (not the n x n pairing by constraint name alone)."""
    fk = key_usage.where(F.col("constraint_type") == "FOREIGN KEY")
    return fk.groupBy("table_schema", "table_name", "constraint_name") \
        .agg(F.first("ref_table", ignorenulls=True).alias("ref_table"),
             ordered_list(F.struct(F.col("column_name").alias("local"), F.col("ref_column").alias("remote")),
                          F.col("pos")).alias("pairs"))


def tables_nested(columns: DataFrame, key_usage: DataFrame) -> DataFrame:
    """Tables with nested, ordered columns and the distinct set of
    their constraints. Columns and constraints are aggregated separately
    and then joined per table, so the join never multiplies rows (the
    duplicates the left-join chain would create are never made)."""
    t = ["table_schema", "table_name"]
    # collecting does not shrink data: shuffle rows on the table key first
    cols = columns.repartition(*t).groupBy(*t).agg(ordered_list(
        F.struct("column_name", "data_type", "is_nullable"), F.col("ordinal_position")).alias("columns"))
    cons = key_usage.groupBy(*t).agg(F.array_sort(F.collect_set(
        F.struct("constraint_name", "constraint_type"))).alias("constraints"))
    return cols.join(cons, t, "left")


def views_nested(views: DataFrame, view_columns: DataFrame) -> DataFrame:
    """Views left-joined to their own columns, nested in order."""
    agg = view_columns.groupBy("view_schema", "view_name").agg(
        ordered_list(F.col("column_name"), F.col("ordinal_position")).alias("columns"))
    return views.select("view_schema", "view_name").join(agg, ["view_schema", "view_name"], "left")


def constraint_details(constraints: DataFrame, key_columns: DataFrame, ref_columns: DataFrame, ref_rules: DataFrame) -> DataFrame:
    """Constraint x key column x referenced side x update/delete rule, left
    joins all the way: what a constraint lacks is null."""
    used = key_usage(constraints, key_columns, ref_columns)
    return used.join(ref_rules, ["table_schema", "table_name", "constraint_name"], "left")


def sequence_owners(sequences: DataFrame, owners: DataFrame) -> DataFrame:
    """Every sequence with its owning column; unowned -> ''."""
    k = ["sequence_schema", "sequence_name"]
    j = sequences.select(*k).join(owners, k, "left")
    return j.select(*k, *[F.coalesce(F.col(c), F.lit("")).alias(c)
                          for c in ("table_schema", "table_name", "column_name")])


def role_members(links: DataFrame, roles: DataFrame) -> DataFrame:
    """The link table joined twice to the role table."""
    r1 = roles.select(F.col("oid").alias("roleid"), F.col("rolname").alias("role"))
    r2 = roles.select(F.col("oid").alias("member"), F.col("rolname").alias("member_name"))
    return links.join(r1, "roleid").join(r2, "member").select("role", F.col("member_name").alias("member"))


#: Relation kinds that are tables.
TABLE_RELKINDS = ["r", "p"]


def table_owners(classes: DataFrame, namespaces: DataFrame, roles: DataFrame) -> DataFrame:
    """Owner of each table: object x schema x role, tables only."""
    n = namespaces.select(F.col("oid").alias("relnamespace"), F.col("nspname").alias("table_schema"))
    r = roles.select(F.col("oid").alias("relowner"), F.col("rolname").alias("owner"))
    return classes.where(F.col("relkind").isin(TABLE_RELKINDS)).join(n, "relnamespace").join(r, "relowner") \
        .select("table_schema", F.col("relname").alias("table_name"), "owner")


def triggers(trigger_rows: DataFrame) -> DataFrame:
    """One record per (schema, table, trigger) with sorted distinct events."""
    return trigger_rows.groupBy("table_schema", "table_name", "trigger_name").agg(
        F.min("action_timing").alias("action_timing"),
        F.sort_array(F.collect_set("event_manipulation")).alias("events"))


def definitions(views: DataFrame, functions: DataFrame) -> DataFrame:
    """Views with normalised text, functions with the hash of it."""
    v = views.select(F.lit("view").alias("kind"), F.col("view_schema").alias("object_schema"),
                     F.col("view_name").alias("object_name"), F.lit("").alias("args"),
                     normalize_text("definition").alias("definition_norm"),
                     definition_hash("definition").alias("definition_hash"))
    f = functions.select(F.lit("function").alias("kind"), F.col("schema_name").alias("object_schema"),
                         F.col("name").alias("object_name"), F.coalesce("args", F.lit("")).alias("args"),
                         normalize_text("definition").alias("definition_norm"),
                         definition_hash("definition").alias("definition_hash"))
    return v.unionByName(f)


def long_form(frames: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Every kind as (kind, object_key, field, value) rows: the whole
    snapshot tree as one frame. ``frames``: kind -> (frame, key columns)."""
    out = None
    for kind, (df, key) in frames.items():
        vals = [c for c in df.columns if c not in key]
        okey = F.concat_ws(".", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
        part = df.select(F.lit(kind).alias("kind"), okey.alias("object_key"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in vals])).alias("x")) \
            .select("kind", "object_key", "x.field", "x.value")
        out = part if out is None else out.unionByName(part)
    return out
