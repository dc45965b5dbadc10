"""Catalog listings with their own columns (B20), functions with return type and
language (B21): one projection or join a kind over the catalogs of many databases,
system schemas left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.functions.text import definition_hash
from relcheck.operators.catalog import SYSTEM_SCHEMAS, kind_label

# Categories of user types by code; those that are listed.
TYPE_KINDS = {"b": "base", "c": "composite", "d": "domain", "e": "enum", "p": "pseudo", "r": "range"}
LISTED_TYPES = ["b", "c", "d", "e", "r"]
# The columns of each plain listing, its key first.
COLUMN_PRIVILEGES = ["table_schema", "table_name", "column_name", "privilege_type", "grantee", "grantor", "is_grantable"]
TABLE_PRIVILEGES = ["table_schema", "table_name", "privilege_type", "grantee", "grantor", "is_grantable"]
INDEXES = ["schemaname", "tablename", "indexname", "indexdef"]
SEQUENCES = ["sequence_schema", "sequence_name", "data_type", "start_value", "minimum_value", "maximum_value", "increment", "cycle_option"]
TRIGGERS = ["trigger_schema", "trigger_name", "event_manipulation", "event_object_schema", "event_object_table", "action_orientation",
            "action_timing", "action_condition", "action_statement"]


def _user(schema: str) -> Column:
    """A schema of users; an unknown one is none."""
    return F.coalesce(~F.col(schema).isin(SYSTEM_SCHEMAS), F.lit(False))


def plain(df: DataFrame, columns: list[str]) -> DataFrame:
    """Privileges, indexes, sequences, triggers: their columns, the first of
    which is the schema."""
    return df.where(_user(columns[0])).select(*columns)


def schemas(namespaces: DataFrame, roles: DataFrame) -> DataFrame:
    """(schema_name, schema_owner) of namespaces (oid, nspname, nspowner) and
    roles (oid, rolname); a schema whose owner is gone has none."""
    owner = roles.select(F.col("oid").alias("_oid"), F.col("rolname").alias("schema_owner"))
    return namespaces.where(_user("nspname")).join(owner, F.col("nspowner") == F.col("_oid"), "left").select(F.col("nspname").alias("schema_name"), "schema_owner")


def user_types(types: DataFrame, namespaces: DataFrame) -> DataFrame:
    """(schema_name, type_name, type_category, formatted_type, default_value)
    of types (typname, typnamespace, typtype, typdefault)."""
    named = namespaces.select(F.col("oid").alias("_oid"), F.col("nspname").alias("schema_name"))
    j = types.where(F.col("typtype").isin(LISTED_TYPES)).join(named, F.col("typnamespace") == F.col("_oid"), "left").where(_user("schema_name"))
    return j.select("schema_name", F.col("typname").alias("type_name"), kind_label(F.col("typtype"), TYPE_KINDS).alias("type_category"),
                    F.concat_ws(".", "schema_name", "typname").alias("formatted_type"), F.col("typdefault").alias("default_value"))


def functions(procs: DataFrame, namespaces: DataFrame, languages: DataFrame, keep_unknown_language: bool = False) -> DataFrame:
    """(schema_name, name, args, returns, language, definition_hash) of procs
    (proname, pronamespace, prolang, args, returns, source), each in its schema and
    language; with ``keep_unknown_language`` those of no known language stay."""
    n = namespaces.select(F.col("oid").alias("_n"), F.col("nspname").alias("schema_name"))
    lang = languages.select(F.col("oid").alias("_l"), F.col("lanname").alias("language"))
    j = procs.join(n, F.col("pronamespace") == F.col("_n")).join(lang, F.col("prolang") == F.col("_l"), "left" if keep_unknown_language else "inner")
    return j.where(_user("schema_name")).select("schema_name", F.col("proname").alias("name"), F.coalesce("args", F.lit("")).alias("args"), "returns", "language",
                                                definition_hash("source").alias("definition_hash"))


def as_rows(kind: str, df: DataFrame, key: list[str]) -> DataFrame:
    """A listing as (kind, object_key, field, value), nulls kept."""
    rest = [c for c in df.columns if c not in key]
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in rest or key[:1]])
    return df.select(F.lit(kind).alias("kind"), F.concat_ws(".", *key).alias("object_key"), F.explode(cells).alias("c")).select("kind", "object_key", "c.field", "c.value")
