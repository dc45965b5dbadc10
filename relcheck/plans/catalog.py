"""Registered queries: catalog assembly (B), catalog drift (C1-C10, C14),
scalar functions S1-S3 and the findings summaries (C12, C13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from relcheck.functions.text import as_list, definition_hash, glob_match, normalize_text
from relcheck.operators import catalog as cat
from relcheck.operators import drift as dr
from relcheck.operators import ignore_rules as ir
from relcheck.operators import listings as ls
from relcheck.operators import findings as fnd
from relcheck.operators import tablediff as td
from relcheck.sources.fixtures import cte, fixture, written

T = ["table_schema", "table_name"]
COL_ATTRS = {"ordinal_position": "number", "data_type": "string", "is_nullable": "string",
             "num_precision": "number", "num_scale": "number"}
IGNORE_GRANTEES = ["role_P"]
IGNORE_PRIVILEGES = ["1-URGENT"]
IGNORE_GLOBS = ["db1.*", "db?.t1*"]
IGNORE_COLUMNS = {"t100": ["c1", "c2"]}
IGNORE_ATTRS = ["num_precision"]


def fx(spark, d, name, have=None):
    return fixture(spark, d, name, have)


def _join_list(c, sep=","):
    return F.array_join(c, sep)


# ------------------------------------------------------------- assembly
def q_discover(spark, d):
    found = cat.discover_tables(fx(spark, d, "cat_columns"), exclude_schemas=["db0"], name_like="t1%")
    return cat.listed(found, "table_schema", "table_name")


def q_explicit_targets(spark, d):
    tables = cat.discover_tables(fx(spark, d, "cat_columns"))
    return cat.explicit_targets(tables, fx(spark, d, "cat_targets"), default_schema="db0")


def _columns_input(spark, d):
    c = fx(spark, d, "cat_columns")
    return c.withColumn("udt_name", F.when(F.col("ordinal_position") % 2 == 1, F.col("data_type"))
                        .otherwise(F.lit("")))


def q_catalog_columns(spark, d):
    return cat.column_metadata(_columns_input(spark, d))


def _kind_code():
    k = F.substring("name", 2, 1 << 20).cast("bigint") % 5
    return F.element_at(F.array(*[F.lit(x) for x in ["f", "p", "a", "w", "x"]]), (k + 1).cast("int"))


def q_kind_labels(spark, d):
    f = fx(spark, d, "cat_functions").select("schema_name", "name", _kind_code().alias("kind_code"))
    return f.withColumn("kind_label", cat.kind_label(F.col("kind_code"), cat.FUNCTION_KINDS))


def q_privileges(spark, d):
    return cat.privileges(fx(spark, d, "cat_grants"))


def _usage_parts(spark, d, dev: bool = False, have=None):
    return [fx(spark, d, n + ("_dev" if dev else ""), have) for n in ("cat_constraints", "cat_key_columns", "cat_ref_columns")]


def _usage(spark, d, dev: bool = False, have=None):
    return cat.key_usage(*_usage_parts(spark, d, dev, have))


def _objects(spark, d, dev: bool, have=None):
    s = "_dev" if dev else ""
    cols = fx(spark, d, "cat_columns" + s, have)
    ku = _usage(spark, d, dev, have)
    parts = [
        cols.select(F.lit("table").alias("kind"), F.col("table_schema").alias("object_schema"),
                    F.col("table_name").alias("object_name")),
        fx(spark, d, "cat_views" + s, have).select(F.lit("view"), "view_schema", "view_name"),
        fx(spark, d, "cat_functions" + s, have).select(F.lit("function"), "schema_name", "name"),
        fx(spark, d, "cat_sequences" + s, have).select(F.lit("sequence"), "sequence_schema", "sequence_name"),
        # constraints, and the indexes behind PK/UNIQUE, from one pass
        ku.select(F.explode(F.array(
            F.struct(F.lit("constraint").alias("k"), F.col("table_schema").alias("s"),
                     F.col("constraint_name").alias("n")),
            F.when(F.col("constraint_type").isin("PRIMARY KEY", "UNIQUE"), F.struct(
                F.lit("index").alias("k"), F.col("table_schema").alias("s"),
                F.col("constraint_name").alias("n"))))).alias("x"))
          .where(F.col("x").isNotNull()).select("x.k", "x.s", "x.n"),
        fx(spark, d, "cat_triggers" + s, have).select(F.lit("trigger"), "table_schema",
                                                F.concat_ws(".", "table_name", "trigger_name")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def q_listing(spark, d):
    return _objects(spark, d, dev=False).where(~F.col("object_schema").isin(cat.SYSTEM_SCHEMAS))


def q_definitions(spark, d):
    return cat.definitions(fx(spark, d, "cat_views"), fx(spark, d, "cat_functions"))


def q_keys(spark, d):
    return cat.keys(_usage(spark, d)).withColumn("columns", _join_list(F.col("columns")))


def _fk_text(df):
    return df.withColumn("pairs", _join_list(F.transform("pairs", lambda p: F.concat(p["local"], F.lit("->"),
                                                                                     p["remote"]))))


def q_foreign_keys(spark, d):
    return _fk_text(cat.foreign_keys(_usage(spark, d)))


def q_tables_nested(spark, d):
    n = cat.tables_nested(fx(spark, d, "cat_columns"), _usage(spark, d))
    return n.select(*T, F.size("columns").alias("n_columns"),
                    _join_list(F.transform("columns", lambda c: F.concat_ws(":", c["column_name"], c["data_type"],
                                                                            c["is_nullable"]))).alias("columns"),
                    _join_list(F.transform("constraints", lambda c: F.concat_ws(
                        ":", c["constraint_name"], c["constraint_type"]))).alias("constraints"))


def q_views_nested(spark, d):
    n = cat.views_nested(fx(spark, d, "cat_views"), fx(spark, d, "cat_view_columns"))
    return n.select("view_schema", "view_name", F.coalesce(F.size("columns"), F.lit(0)).alias("n_columns"),
                    _join_list(F.col("columns")).alias("columns"))


def q_constraint_details(spark, d):
    return cat.constraint_details(*_usage_parts(spark, d), fx(spark, d, "cat_ref_rules"))


def q_sequence_owners(spark, d):
    return cat.sequence_owners(fx(spark, d, "cat_sequences"), fx(spark, d, "cat_seq_owners"))


def q_role_members(spark, d):
    return cat.role_members(fx(spark, d, "cat_role_links"), fx(spark, d, "cat_roles"))


def _owners(spark, d, dev: bool = False):
    return cat.table_owners(fx(spark, d, "cat_classes" + ("_dev" if dev else "")), fx(spark, d, "cat_namespaces"), fx(spark, d, "cat_roles"))


def q_table_owners(spark, d):
    return _owners(spark, d)


def q_triggers(spark, d):
    return cat.triggers(fx(spark, d, "cat_triggers")).withColumn("events", _join_list(F.col("events")))


def q_long(spark, d):
    frames = {
        "column": (fx(spark, d, "cat_columns"), T + ["column_name"]),
        "view": (fx(spark, d, "cat_views"), ["view_schema", "view_name"]),
        "trigger": (q_triggers(spark, d), ["table_schema", "table_name", "trigger_name"]),
        "privilege": (fx(spark, d, "cat_grants"), ["table_name", "grantee", "privilege_type"]),
        "sequence": (fx(spark, d, "cat_sequences"), ["sequence_schema", "sequence_name"]),
        "role": (fx(spark, d, "cat_roles"), ["rolname"]),
        "constraint": (fx(spark, d, "cat_constraints"), T + ["constraint_name"]),
        "function": (fx(spark, d, "cat_functions"), ["schema_name", "name", "args"]),
    }
    return cat.long_form(frames)


# ------------------------------------------------------------- drift
def q_drift_set(spark, d):
    return dr.drift_set(fx(spark, d, "cat_columns").select(*T), fx(spark, d, "cat_columns_dev").select(*T),
                        T, "table", "C1", policy="equal")


def q_drift_columns_lenient(spark, d):
    return dr.drift_columns(fx(spark, d, "cat_columns"), fx(spark, d, "cat_columns_dev"), COL_ATTRS,
                            mode="lenient")


def q_drift_columns_strict(spark, d):
    return dr.drift_columns(fx(spark, d, "cat_columns"), fx(spark, d, "cat_columns_dev"), COL_ATTRS,
                            mode="strict")


def q_drift_columns_basic(spark, d):
    return dr.drift_columns(fx(spark, d, "cat_columns"), fx(spark, d, "cat_columns_dev"),
                            {"data_type": "string", "is_nullable": "string"}, mode="strict",
                            policy="subset", check_id="C10c")


def q_drift_with_ignores(spark, d):
    def prep(df):
        return dr.ignore_columns(dr.ignore_tables(df, IGNORE_GLOBS), IGNORE_COLUMNS)
    attrs = {k: v for k, v in COL_ATTRS.items() if k not in IGNORE_ATTRS}
    return dr.drift_columns(prep(fx(spark, d, "cat_columns")), prep(fx(spark, d, "cat_columns_dev")), attrs,
                            mode="strict", check_id="B5")


def q_drift_columns_repeated(spark, d):
    return dr.drift_columns(fx(spark, d, "cat_columns"), fx(spark, d, "cat_columns_twice"),
                            {"data_type": "string", "is_nullable": "string"}, mode="strict")


def q_drift_privileges_ignored(spark, d):
    def prep(df):
        return dr.ignore_privileges(df, IGNORE_GRANTEES, IGNORE_PRIVILEGES)
    return dr.drift_set(prep(fx(spark, d, "cat_grants")), prep(fx(spark, d, "cat_grants_dev")),
                        ["table_name", "grantee", "privilege_type", "is_grantable"], "privilege", "B5")


def q_glob_match(spark, d):
    t = fx(spark, d, "cat_columns").select(*T).distinct()
    return t.withColumn("matched", glob_match(F.concat_ws(".", *T), IGNORE_GLOBS))


def q_existence(spark, d):
    have = written(spark, d, "cat_columns")
    e, a = _objects(spark, d, False, have), _objects(spark, d, True, have)
    k = ["kind", "object_schema", "object_name"]
    missing = e.join(a, k, "left_anti")
    return missing.select(F.lit("C10").alias("check_id"), F.col("kind").alias("object_kind"),
                          F.concat_ws(".", "object_schema", "object_name").alias("object_key"),
                          F.lit(None).cast("string").alias("field"), F.lit("MISSING").alias("status"),
                          F.lit(None).cast("string").alias("expected"), F.lit(None).cast("string").alias("actual"))


def _pk_lists(df):
    return cat.keys(df, ("PRIMARY KEY",)).select(*T, _join_list(F.col("columns")).alias("columns"))


def q_drift_pk(spark, d):
    return dr.key_list_drift(_pk_lists(_usage(spark, d)), _pk_lists(_usage(spark, d, True)),
                             T, "columns", "primary_key", "C3")


def _unique_lists(df):
    return cat.keys(df, ("UNIQUE",)).select(*T, _join_list(F.col("columns")).alias("columns"))


def q_drift_unique(spark, d):
    return dr.multiset_drift(_unique_lists(_usage(spark, d)),
                             _unique_lists(_usage(spark, d, True)), T + ["columns"], "unique", "C4")


def q_drift_fk(spark, d):
    k = T + ["constraint_name", "ref_table", "pairs"]
    return dr.drift_set(_fk_text(cat.foreign_keys(_usage(spark, d))),
                        _fk_text(cat.foreign_keys(_usage(spark, d, True))), k, "foreign_key", "C5")


def q_drift_views(spark, d):
    def norm(df):
        return df.select("view_schema", "view_name", normalize_text("definition").alias("definition_norm"))
    return dr.definitions_drift(norm(fx(spark, d, "cat_views")), norm(fx(spark, d, "cat_views_dev")),
                                ["view_schema", "view_name"], "definition_norm", "view", "C6")


def q_drift_functions(spark, d):
    def h(df):
        return df.select("schema_name", "name", "args", definition_hash("definition").alias("definition_hash"))
    return dr.definitions_drift(h(fx(spark, d, "cat_functions")), h(fx(spark, d, "cat_functions_dev")),
                                ["schema_name", "name", "args"], "definition_hash", "function", "C7")


def q_as_list(spark, d):
    """Scalars, nulls and lists of names, all as lists."""
    src = fx(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("one"),
                                        F.when(F.col("o_orderkey") % 2 == 0, F.array("o_orderstatus", "o_orderpriority")).alias("many"))
    return src.select("o_orderkey", *[F.array_join(as_list(src, c), "|").alias(c) for c in ("one", "many")], *[F.size(as_list(src, c)).alias(f"n_{c}") for c in ("one", "many")])


_LISTED = {
    "column_privilege": ("cat_column_grants", ls.COLUMN_PRIVILEGES, 5), "index": ("cat_index_rows", ls.INDEXES, 3),
    "sequence": ("cat_sequences", ls.SEQUENCES, 2), "trigger": ("cat_trigger_rows", ls.TRIGGERS, 5)}


def q_listing_details(spark, d):
    """Schemas, user types, privileges of columns and tables, indexes, sequences
    and triggers, each with its own columns."""
    spaces = fx(spark, d, "cat_spaces")
    parts = [ls.as_rows("schema", ls.schemas(spaces, fx(spark, d, "cat_owner_roles")), ["schema_name"]),
             ls.as_rows("type", ls.user_types(fx(spark, d, "cat_types"), spaces), ["schema_name", "type_name"]),
             ls.as_rows("table_privilege", ls.plain(fx(spark, d, "cat_column_grants"), ls.TABLE_PRIVILEGES).distinct(), ls.TABLE_PRIVILEGES[:4])]
    parts += [ls.as_rows(kind, ls.plain(fx(spark, d, name), cols), cols[:n]) for kind, (name, cols, n) in _LISTED.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_function_details(spark, d):
    args = [fx(spark, d, n) for n in ("cat_procs", "cat_spaces", "cat_languages")]
    both = [ls.functions(*args, keep_unknown_language=k).withColumn("unknown_kept", F.lit(k)) for k in (False, True)]
    return both[0].unionByName(both[1])


def q_ignore_rule_table(spark, d):
    tables = fx(spark, d, "cat_columns").select("table_schema", "table_name").distinct()
    return ir.without_ignored(tables, fx(spark, d, "ignore_globs"))


def q_drift_functions_no_args(spark, d):
    def h(df):
        return df.select("function_schema", "function_name", "args", definition_hash("body").alias("definition_hash"))
    found = dr.definitions_drift(h(fx(spark, d, "plain_functions")), h(fx(spark, d, "plain_functions_dev")),
                                 ["function_schema", "function_name", "args"], "definition_hash", "function", "C7")
    return found.select("object_key", "status")


def q_drift_roles(spark, d):
    return dr.drift_set(fx(spark, d, "cat_roles"), fx(spark, d, "cat_roles_dev"), ["rolname"], "role", "C8",
                        policy="subset")


def q_drift_sequences(spark, d):
    return dr.drift_set(fx(spark, d, "cat_sequences"), fx(spark, d, "cat_sequences_dev"),
                        ["sequence_schema", "sequence_name"], "sequence", "C8", policy="subset")


def q_drift_memberships(spark, d):
    links = fx(spark, d, "cat_role_links")
    return dr.drift_set(cat.role_members(links, fx(spark, d, "cat_roles")),
                        cat.role_members(links, fx(spark, d, "cat_roles_dev")), ["role", "member"],
                        "membership", "C9")


def q_drift_seq_owners(spark, d):
    e = cat.sequence_owners(fx(spark, d, "cat_sequences"), fx(spark, d, "cat_seq_owners"))
    a = cat.sequence_owners(fx(spark, d, "cat_sequences_dev"), fx(spark, d, "cat_seq_owners_dev"))
    return dr.drift_set(e, a, e.columns, "sequence_owner", "C9")


def _indexes(df):
    k = cat.keys(df)
    return k.select(F.col("table_schema").alias("index_schema"), F.col("constraint_name").alias("index_name"),
                    F.concat(F.lit("("), _join_list(F.col("columns")), F.lit(")")).alias("definition"))


def q_drift_indexes(spark, d):
    return dr.drift_set(_indexes(_usage(spark, d)), _indexes(_usage(spark, d, True)),
                        ["index_schema", "index_name", "definition"], "index", "C9")


def _trig(df):
    return cat.triggers(df).withColumn("events", _join_list(F.col("events")))


def q_drift_triggers(spark, d):
    return dr.drift_set(_trig(fx(spark, d, "cat_triggers")), _trig(fx(spark, d, "cat_triggers_dev")),
                        ["table_schema", "table_name", "trigger_name", "action_timing", "events"], "trigger", "C9")


def q_drift_owners(spark, d):
    return dr.drift_set(_owners(spark, d), _owners(spark, d, True), ["table_schema", "table_name", "owner"], "owner", "C9")


def q_drift_privileges(spark, d):
    return dr.drift_set(fx(spark, d, "cat_grants"), fx(spark, d, "cat_grants_dev"),
                        ["table_name", "grantee", "privilege_type", "is_grantable"], "privilege", "C9")


def _fingerprints(df):
    return td.table_fingerprints(df, T, "ordinal_position",
                                 ["column_name", "data_type", "is_nullable", "num_precision", "num_scale"])


def q_snapshot_hash(spark, d):
    return td.fingerprint_diff(_fingerprints(fx(spark, d, "cat_columns")),
                               _fingerprints(fx(spark, d, "cat_columns_dev")), T)


def q_snapshot_hash_null_shift(spark, d):
    f = td.fingerprint_diff(_fingerprints(fx(spark, d, "cat_columns")), _fingerprints(fx(spark, d, "cat_columns_shift")), T)
    return f.select("object_key", "status")


def q_normalize_text(spark, d):
    return fx(spark, d, "cat_functions").select("name", normalize_text("definition").alias("definition_norm"))


def q_definition_hash(spark, d):
    return fx(spark, d, "cat_functions").select("name", definition_hash("definition").alias("definition_hash"))


def _sample_findings(spark, d):
    from relcheck.plans.data import q_table_diff_keyed
    return fnd.union_findings(q_drift_columns_strict(spark, d), q_table_diff_keyed(spark, d))


def q_findings_summary(spark, d):
    return fnd.summary(_sample_findings(spark, d))


def q_findings_outcome(spark, d):
    from relcheck.operators.constraints import check_not_null
    return fnd.outcome(fnd.union_findings(_sample_findings(spark, d), check_not_null(fx(spark, d, "orders_actual"), "orders_actual")))


def q_run_verdict(spark, d):
    return fnd.verdict(_sample_findings(spark, d))


QUERIES = {
    "catalog_discover_tables": q_discover,
    "catalog_explicit_targets": q_explicit_targets,
    "catalog_columns": q_catalog_columns,
    "catalog_kind_labels": q_kind_labels,
    "catalog_privileges": q_privileges,
    "catalog_listing": q_listing,
    "catalog_definitions": q_definitions,
    "catalog_keys": q_keys,
    "catalog_foreign_keys": q_foreign_keys,
    "catalog_tables_nested": q_tables_nested,
    "catalog_views_nested": q_views_nested,
    "catalog_constraint_details": q_constraint_details,
    "catalog_sequence_owners": q_sequence_owners,
    "catalog_role_members": q_role_members,
    "catalog_table_owners": q_table_owners,
    "catalog_triggers": q_triggers,
    "catalog_long": q_long,
    "drift_set": q_drift_set,
    "drift_columns_lenient": q_drift_columns_lenient,
    "drift_columns_strict": q_drift_columns_strict,
    "drift_columns_basic": q_drift_columns_basic,
    "drift_columns_repeated": q_drift_columns_repeated,
    "drift_privileges_ignored": q_drift_privileges_ignored,
    "drift_with_ignores": q_drift_with_ignores,
    "glob_match": q_glob_match,
    "existence_all_kinds": q_existence,
    "drift_pk": q_drift_pk,
    "drift_unique": q_drift_unique,
    "drift_fk": q_drift_fk,
    "drift_views": q_drift_views,
    "drift_functions": q_drift_functions,
    "catalog_listing_details": q_listing_details,
    "catalog_function_details": q_function_details,
    "ignore_rule_table": q_ignore_rule_table,
    "as_name_list": q_as_list,
    "drift_functions_no_args": q_drift_functions_no_args,
    "drift_roles": q_drift_roles,
    "drift_sequences": q_drift_sequences,
    "drift_memberships": q_drift_memberships,
    "drift_seq_owners": q_drift_seq_owners,
    "drift_indexes": q_drift_indexes,
    "drift_triggers": q_drift_triggers,
    "drift_owners": q_drift_owners,
    "drift_privileges": q_drift_privileges,
    "snapshot_hash_compare": q_snapshot_hash,
    "snapshot_hash_null_shift": q_snapshot_hash_null_shift,
    "normalize_text": q_normalize_text,
    "definition_hash": q_definition_hash,
    "findings_summary": q_findings_summary,
    "findings_outcome": q_findings_outcome,
    "run_verdict": q_run_verdict,
}

# ================================================================ oracle
N = "CAST(NULL AS VARCHAR)"
NORM = "trim(regexp_replace(coalesce({c}, ''), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))"
ALL_CAT = ("cat_columns", "cat_columns_dev", "cat_key_usage", "cat_key_usage_dev")


def _set_sql(e: str, a: str, key: list[str], kind: str, check_id: str, policy: str = "equal") -> str:
    ktxt = "concat_ws('.', " + ", ".join(f"coalesce(CAST(x.{k} AS VARCHAR), '')" for k in key) + ")"
    on = " AND ".join(f"x.{k} IS NOT DISTINCT FROM y.{k}" for k in key)
    cols = ", ".join(key)
    sql = f"""SELECT '{check_id}' AS check_id, '{kind}' AS object_kind, {ktxt} AS object_key, {N} AS field, 'MISSING' AS status,
 {N} AS expected, {N} AS actual FROM (SELECT DISTINCT {cols} FROM {e}) x WHERE NOT EXISTS (SELECT 1 FROM {a} y WHERE {on})"""
    if policy == "equal":
        sql += f"""
UNION ALL SELECT '{check_id}', '{kind}', {ktxt}, {N}, 'UNEXPECTED', {N}, {N}
 FROM (SELECT DISTINCT {cols} FROM {a}) x WHERE NOT EXISTS (SELECT 1 FROM {e} y WHERE {on})"""
    return sql


def _columns_sql(attrs: dict[str, str], lenient: bool, policy: str, check_id: str,
                 e: str = "cat_columns", a: str = "cat_columns_dev") -> str:
    def cmpv(side, c):
        v = f"{side}.{c}"
        if not lenient:
            return v
        return f"nullif({v}, '')" if attrs[c] == "string" else f"nullif({v}, 0)"
    cells = ", ".join(
        f"('{c}', CAST(e.{c} AS VARCHAR), CAST(a.{c} AS VARCHAR), {cmpv('e', c)} IS DISTINCT FROM {cmpv('a', c)})"
        for c in attrs)
    k3 = "e.table_schema || '.' || e.table_name || '.' || e.column_name"
    sql = f"""SELECT '{check_id}' AS check_id, 'table' AS object_kind, x.table_schema || '.' || x.table_name AS object_key,
 {N} AS field, 'MISSING' AS status, {N} AS expected, {N} AS actual
 FROM (SELECT DISTINCT table_schema, table_name FROM {e}) x
 WHERE NOT EXISTS (SELECT 1 FROM {a} y WHERE y.table_schema = x.table_schema AND y.table_name = x.table_name)
UNION ALL SELECT '{check_id}', 'column', {k3}, {N}, 'MISSING', {N}, {N} FROM {e} e
 WHERE EXISTS (SELECT 1 FROM {a} y WHERE y.table_schema = e.table_schema AND y.table_name = e.table_name)
   AND NOT EXISTS (SELECT 1 FROM {a} y WHERE y.table_schema = e.table_schema AND y.table_name = e.table_name AND y.column_name = e.column_name)
UNION ALL SELECT '{check_id}', 'column', {k3}, f.field, 'CHANGED', f.ev, f.av
 FROM {e} e JOIN {a} a ON e.table_schema = a.table_schema AND e.table_name = a.table_name AND e.column_name = a.column_name,
 LATERAL (VALUES {cells}) AS f(field, ev, av, differ) WHERE f.differ"""
    if policy == "equal":
        sql += f"""
UNION ALL SELECT '{check_id}', 'column', a.table_schema || '.' || a.table_name || '.' || a.column_name, {N}, 'UNEXPECTED', {N}, {N}
 FROM {a} a WHERE NOT EXISTS (SELECT 1 FROM {e} y WHERE y.table_schema = a.table_schema AND y.table_name = a.table_name AND y.column_name = a.column_name)
   AND EXISTS (SELECT 1 FROM {e} y WHERE y.table_schema = a.table_schema AND y.table_name = a.table_name)"""
    return sql


def _defs_sql(e: str, a: str, key: list[str], val: str, kind: str, check_id: str) -> str:
    on = " AND ".join(f"e.{k} = a.{k}" for k in key)
    ktxt = "concat_ws('.', " + ", ".join(f"coalesce(CAST(e.{k} AS VARCHAR), '')" for k in key) + ")"
    return f"""SELECT '{check_id}' AS check_id, '{kind}' AS object_kind, {ktxt} AS object_key, '{val}' AS field,
 CASE WHEN a.{key[0]} IS NULL THEN 'MISSING' ELSE 'CHANGED' END AS status, e.{val} AS expected, a.{val} AS actual
 FROM {e} e LEFT JOIN {a} a ON {on} WHERE a.{key[0]} IS NULL OR e.{val} IS DISTINCT FROM a.{val}"""


def _objects_sql(s: str) -> str:
    return f"""SELECT DISTINCT * FROM (
 SELECT 'table' AS kind, table_schema AS object_schema, table_name AS object_name FROM cat_columns{s}
 UNION ALL SELECT 'view', view_schema, view_name FROM cat_views{s}
 UNION ALL SELECT 'function', schema_name, name FROM cat_functions{s}
 UNION ALL SELECT 'sequence', sequence_schema, sequence_name FROM cat_sequences{s}
 UNION ALL SELECT 'index', table_schema, constraint_name FROM cat_key_usage{s} WHERE constraint_type IN ('PRIMARY KEY', 'UNIQUE')
 UNION ALL SELECT 'constraint', table_schema, constraint_name FROM cat_key_usage{s}
 UNION ALL SELECT 'trigger', table_schema, table_name || '.' || trigger_name FROM cat_triggers{s})"""


OBJ_FIXTURES = ("cat_columns", "cat_columns_dev", "cat_views", "cat_views_dev", "cat_functions",
                "cat_functions_dev", "cat_sequences", "cat_sequences_dev", "cat_key_usage", "cat_key_usage_dev",
                "cat_triggers", "cat_triggers_dev")

KEYS_CTE = """, keys AS (SELECT table_schema, table_name, constraint_name, constraint_type,
 string_agg(column_name, ',' ORDER BY pos) AS columns FROM cat_key_usage WHERE constraint_type IN ('PRIMARY KEY', 'UNIQUE')
 GROUP BY ALL), keys_dev AS (SELECT table_schema, table_name, constraint_name, constraint_type,
 string_agg(column_name, ',' ORDER BY pos) AS columns FROM cat_key_usage_dev WHERE constraint_type IN ('PRIMARY KEY', 'UNIQUE')
 GROUP BY ALL)"""

FK_CTE = """, fks AS (SELECT table_schema, table_name, constraint_name, first(ref_table) AS ref_table,
 string_agg(column_name || '->' || ref_column, ',' ORDER BY pos) AS pairs FROM cat_key_usage WHERE constraint_type = 'FOREIGN KEY' GROUP BY ALL),
fks_dev AS (SELECT table_schema, table_name, constraint_name, first(ref_table) AS ref_table,
 string_agg(column_name || '->' || ref_column, ',' ORDER BY pos) AS pairs FROM cat_key_usage_dev WHERE constraint_type = 'FOREIGN KEY' GROUP BY ALL)"""

TRIG_CTE = """, trig AS (SELECT table_schema, table_name, trigger_name, min(action_timing) AS action_timing,
 string_agg(DISTINCT event_manipulation, ',' ORDER BY event_manipulation) AS events FROM cat_triggers GROUP BY ALL),
trig_dev AS (SELECT table_schema, table_name, trigger_name, min(action_timing) AS action_timing,
 string_agg(DISTINCT event_manipulation, ',' ORDER BY event_manipulation) AS events FROM cat_triggers_dev GROUP BY ALL)"""

SEQOWN_CTE = """, so AS (SELECT s.sequence_schema, s.sequence_name, coalesce(o.table_schema, '') AS table_schema,
 coalesce(o.table_name, '') AS table_name, coalesce(o.column_name, '') AS column_name FROM cat_sequences s
 LEFT JOIN cat_seq_owners o ON s.sequence_schema = o.sequence_schema AND s.sequence_name = o.sequence_name),
so_dev AS (SELECT s.sequence_schema, s.sequence_name, coalesce(o.table_schema, '') AS table_schema,
 coalesce(o.table_name, '') AS table_name, coalesce(o.column_name, '') AS column_name FROM cat_sequences_dev s
 LEFT JOIN cat_seq_owners_dev o ON s.sequence_schema = o.sequence_schema AND s.sequence_name = o.sequence_name)"""

MEMBERS = """SELECT r1.rolname AS role, r2.rolname AS member FROM cat_role_links l
 JOIN {roles} r1 ON l.roleid = r1.oid JOIN {roles} r2 ON l.member = r2.oid"""

# Owners told from the table names, not from the joined catalog rows.
_OWNERS = """SELECT DISTINCT c.table_schema, c.table_name, 'role' || CAST(1 + (tk + CASE WHEN {dev} AND tk % 29 = 0 THEN 1 ELSE 0 END) % 7 AS VARCHAR) AS owner
FROM (SELECT *, CAST(substr(table_name, 2) AS BIGINT) AS tk FROM cat_columns) c WHERE tk % 11 <> 0"""

FP = """SELECT table_schema, table_name, sha256(string_agg(CAST(to_json({{'column_name': column_name, 'data_type': data_type, 'is_nullable': is_nullable,
 'num_precision': CAST(num_precision AS VARCHAR), 'num_scale': CAST(num_scale AS VARCHAR)}}) AS VARCHAR), ',' ORDER BY ordinal_position)) AS fingerprint FROM {t} GROUP BY ALL"""

GLOB = "((table_schema || '.' || table_name) GLOB 'db1.*' OR (table_schema || '.' || table_name) GLOB 'db?.t1*')"
STRICT = _columns_sql(COL_ATTRS, False, "equal", "C2")

def _listed_sql(kind, src, cols, n):
    key = "concat_ws('.', " + ", ".join(cols[:n]) + ")"
    cells = ", ".join(f"('{c}', CAST({c} AS VARCHAR))" for c in cols[n:])
    return f"SELECT '{kind}' AS kind, {key} AS object_key, f.field, f.value FROM {src}, LATERAL (VALUES {cells}) AS f(field, value)"


_USERS = "NOT IN ('information_schema', 'pg_catalog')"
ORACLE = {
    "catalog_listing_details": cte("cat_spaces", "cat_owner_roles", "cat_types", "cat_column_grants", "cat_index_rows", "cat_sequences", "cat_trigger_rows") + f""",
s AS (SELECT nspname AS schema_name, rolname AS schema_owner FROM cat_spaces n LEFT JOIN cat_owner_roles r ON n.nspowner = r.oid WHERE nspname {_USERS}),
t AS (SELECT nspname AS schema_name, typname AS type_name, CASE typtype WHEN 'b' THEN 'base' WHEN 'c' THEN 'composite' WHEN 'd' THEN 'domain' WHEN 'e' THEN 'enum' WHEN 'r' THEN 'range' END AS type_category,
 nspname || '.' || typname AS formatted_type, typdefault AS default_value FROM cat_types JOIN cat_spaces ON typnamespace = oid WHERE nspname {_USERS} AND typtype IN ('b', 'c', 'd', 'e', 'r')),
p AS (SELECT DISTINCT table_schema, table_name, privilege_type, grantee, grantor, is_grantable FROM cat_column_grants WHERE table_schema {_USERS}) """ + " UNION ALL ".join(
        [_listed_sql("schema", "s", ["schema_name", "schema_owner"], 1), _listed_sql("type", "t", ["schema_name", "type_name", "type_category", "formatted_type", "default_value"], 2),
         _listed_sql("table_privilege", "p", ls.TABLE_PRIVILEGES, 4)]
        + [_listed_sql(kind, f"(SELECT * FROM {name} WHERE {cols[0]} {_USERS})", cols, n) for kind, (name, cols, n) in _LISTED.items()]),
    "catalog_function_details": cte("cat_procs", "cat_spaces", "cat_languages") + f""", f AS (
 SELECT nspname AS schema_name, proname AS name, coalesce(args, '') AS args, returns, lanname AS language, sha256({NORM.format(c='source')}) AS definition_hash
 FROM cat_procs JOIN cat_spaces n ON pronamespace = n.oid LEFT JOIN cat_languages l ON prolang = l.oid WHERE nspname {_USERS})
SELECT *, FALSE AS unknown_kept FROM f WHERE language IS NOT NULL UNION ALL SELECT *, TRUE FROM f""",
    "catalog_discover_tables": cte("cat_columns") + """SELECT DISTINCT table_schema, table_name FROM cat_columns
 WHERE table_schema NOT IN ('information_schema', 'pg_catalog', 'db0') AND table_name LIKE 't1%'""",
    "catalog_explicit_targets": cte("cat_columns", "cat_targets") + """, t AS (SELECT DISTINCT
 CASE WHEN contains(target, '.') THEN split_part(target, '.', 1) ELSE 'db0' END AS table_schema,
 CASE WHEN contains(target, '.') THEN split_part(target, '.', 2) ELSE target END AS table_name FROM cat_targets)
SELECT DISTINCT c.table_schema, c.table_name FROM cat_columns c
 WHERE c.table_schema NOT IN ('information_schema', 'pg_catalog')
   AND EXISTS (SELECT 1 FROM t WHERE t.table_schema = c.table_schema AND t.table_name = c.table_name)""",
    "catalog_columns": cte("cat_columns") + """SELECT table_schema, table_name, column_name, ordinal_position,
 coalesce(nullif(CASE WHEN ordinal_position % 2 = 1 THEN data_type ELSE '' END, ''), nullif(data_type, ''), '') AS data_type,
 is_nullable = 'YES' AS is_nullable, CAST(NULL AS INTEGER) AS char_max, num_precision, num_scale,
 CAST(NULL AS INTEGER) AS datetime_precision, CAST(NULL AS VARCHAR) AS column_default, false AS is_identity FROM cat_columns""",
    "catalog_kind_labels": cte("cat_functions") + """SELECT schema_name, name, kind_code,
 CASE kind_code WHEN 'f' THEN 'function' WHEN 'p' THEN 'procedure' WHEN 'a' THEN 'aggregate' WHEN 'w' THEN 'window' ELSE 'unknown' END AS kind_label
FROM (SELECT schema_name, name, (['f', 'p', 'a', 'w', 'x'])[CAST(substr(name, 2) AS BIGINT) % 5 + 1] AS kind_code FROM cat_functions)""",
    "catalog_privileges": cte("cat_grants") + """SELECT table_name, grantee, privilege_type, is_grantable = 'YES' AS is_grantable,
 lower(CAST(is_grantable = 'YES' AS VARCHAR)) AS is_grantable_text FROM cat_grants""",
    "catalog_listing": cte(*OBJ_FIXTURES) + "SELECT * FROM (" + _objects_sql("") + ") WHERE object_schema NOT IN ('information_schema', 'pg_catalog')",
    "catalog_definitions": cte("cat_views", "cat_functions") + f"""SELECT 'view' AS kind, view_schema AS object_schema, view_name AS object_name,
 '' AS args, {NORM.format(c='definition')} AS definition_norm, sha256({NORM.format(c='definition')}) AS definition_hash FROM cat_views
UNION ALL SELECT 'function', schema_name, name, coalesce(args, ''), {NORM.format(c='definition')}, sha256({NORM.format(c='definition')}) FROM cat_functions""",
    "catalog_keys": cte("cat_key_usage", "cat_key_usage_dev") + KEYS_CTE + " SELECT * FROM keys",
    "catalog_foreign_keys": cte("cat_key_usage", "cat_key_usage_dev") + FK_CTE + " SELECT * FROM fks",
    "catalog_tables_nested": cte("cat_columns", "cat_key_usage") + """, c AS (SELECT table_schema, table_name, count(*) AS n_columns,
 string_agg(concat_ws(':', column_name, data_type, is_nullable), ',' ORDER BY ordinal_position) AS columns FROM cat_columns GROUP BY ALL),
k AS (SELECT table_schema, table_name, string_agg(constraint_name || ':' || constraint_type, ',' ORDER BY constraint_name, constraint_type) AS constraints
 FROM (SELECT DISTINCT table_schema, table_name, constraint_name, constraint_type FROM cat_key_usage) GROUP BY ALL)
SELECT c.table_schema, c.table_name, CAST(c.n_columns AS INTEGER) AS n_columns, c.columns, k.constraints FROM c LEFT JOIN k
 ON c.table_schema = k.table_schema AND c.table_name = k.table_name""",
    "catalog_views_nested": cte("cat_views", "cat_columns") + """, vc AS (SELECT table_schema AS view_schema, 'v' || substr(table_name, 2) AS view_name,
 count(*) AS n, string_agg(column_name || '_v', ',' ORDER BY ordinal_position) AS columns FROM cat_columns WHERE ordinal_position <> 2 GROUP BY ALL)
SELECT v.view_schema, v.view_name, CAST(coalesce(vc.n, 0) AS INTEGER) AS n_columns, vc.columns FROM cat_views v
 LEFT JOIN vc ON v.view_schema = vc.view_schema AND v.view_name = vc.view_name""",
    "catalog_constraint_details": cte("cat_key_usage") + """SELECT table_schema, table_name, constraint_name, constraint_type, column_name, pos,
 ref_table, ref_column, CASE WHEN f THEN CASE WHEN k % 3 = 0 THEN 'CASCADE' ELSE 'NO ACTION' END END AS update_rule,
 CASE WHEN f THEN CASE WHEN k % 5 = 0 THEN 'SET NULL' WHEN k % 2 = 0 THEN 'RESTRICT' ELSE 'NO ACTION' END END AS delete_rule
FROM (SELECT *, constraint_type = 'FOREIGN KEY' AS f, CAST(substr(table_name, 2) AS BIGINT) AS k FROM cat_key_usage)""",
    "catalog_sequence_owners": cte("cat_sequences", "cat_seq_owners", "cat_sequences_dev", "cat_seq_owners_dev")
        + SEQOWN_CTE + " SELECT * FROM so",
    "catalog_role_members": cte("cat_role_links", "cat_roles") + MEMBERS.format(roles="cat_roles"),
    "catalog_table_owners": cte("cat_columns", "cat_roles") + _OWNERS.format(dev="false"),
    "catalog_triggers": cte("cat_triggers", "cat_triggers_dev") + TRIG_CTE + " SELECT * FROM trig",
    "catalog_long": cte("cat_columns", "cat_views", "cat_triggers", "cat_triggers_dev", "cat_grants", "cat_sequences", "cat_roles", "cat_constraints", "cat_functions") + TRIG_CTE + """
SELECT 'column' AS kind, table_schema || '.' || table_name || '.' || column_name AS object_key, f.field, f.value FROM cat_columns,
 LATERAL (VALUES ('ordinal_position', CAST(ordinal_position AS VARCHAR)), ('data_type', data_type), ('is_nullable', is_nullable),
  ('num_precision', CAST(num_precision AS VARCHAR)), ('num_scale', CAST(num_scale AS VARCHAR))) AS f(field, value)
UNION ALL SELECT 'view', view_schema || '.' || view_name, 'definition', definition FROM cat_views
UNION ALL SELECT 'sequence', sequence_schema || '.' || sequence_name, f.field, f.value FROM cat_sequences, LATERAL (VALUES ('data_type', data_type),
  ('start_value', start_value), ('minimum_value', minimum_value), ('maximum_value', maximum_value), ('increment', increment), ('cycle_option', cycle_option)) AS f(field, value)
UNION ALL SELECT 'role', rolname, f.field, f.value FROM cat_roles, LATERAL (VALUES ('oid', CAST(oid AS VARCHAR)), ('rolsuper', CAST(rolsuper AS VARCHAR))) AS f(field, value)
UNION ALL SELECT 'constraint', table_schema || '.' || table_name || '.' || constraint_name, 'constraint_type', constraint_type FROM cat_constraints
UNION ALL SELECT 'function', schema_name || '.' || name || '.' || args, 'definition', definition FROM cat_functions
UNION ALL SELECT 'trigger', table_schema || '.' || table_name || '.' || trigger_name, f.field, f.value FROM trig,
 LATERAL (VALUES ('action_timing', action_timing), ('events', events)) AS f(field, value)
UNION ALL SELECT 'privilege', table_name || '.' || grantee || '.' || privilege_type, 'is_grantable', is_grantable FROM cat_grants""",
    "drift_set": cte("cat_columns", "cat_columns_dev") + _set_sql("cat_columns", "cat_columns_dev", T, "table", "C1"),
    "drift_columns_lenient": cte("cat_columns", "cat_columns_dev") + _columns_sql(COL_ATTRS, True, "equal", "C2"),
    "drift_columns_strict": cte("cat_columns", "cat_columns_dev") + STRICT,
    "drift_columns_repeated": cte("cat_columns", "cat_columns_twice") + """, n AS (SELECT table_schema || '.' || table_name || '.' || column_name AS k, count(*) AS n,
 min([data_type, is_nullable])[1] AS t FROM cat_columns_twice GROUP BY ALL),
o AS (SELECT table_schema || '.' || table_name || '.' || column_name AS k, data_type AS t FROM cat_columns)
SELECT 'C2' AS check_id, 'column' AS object_kind, k AS object_key, '<listed>' AS field, 'CHANGED' AS status, '1' AS expected, CAST(n AS VARCHAR) AS actual
 FROM n WHERE n > 1
UNION ALL SELECT 'C2', 'column', k, 'data_type', 'CHANGED', o.t, n.t FROM n JOIN o USING (k) WHERE n.t <> o.t""",
    "drift_privileges_ignored": cte("cat_grants", "cat_grants_dev") + """, ke AS (SELECT * FROM cat_grants WHERE grantee NOT IN ('role_P') AND privilege_type NOT IN ('1-URGENT')),
ka AS (SELECT * FROM cat_grants_dev WHERE grantee NOT IN ('role_P') AND privilege_type NOT IN ('1-URGENT'))
""" + _set_sql("ke", "ka", ["table_name", "grantee", "privilege_type", "is_grantable"], "privilege", "B5"),
    "drift_columns_basic": cte("cat_columns", "cat_columns_dev") + _columns_sql(
        {"data_type": "string", "is_nullable": "string"}, False, "subset", "C10c"),
    "drift_with_ignores": cte("cat_columns", "cat_columns_dev") + f""", ie AS (SELECT * FROM cat_columns WHERE NOT {GLOB}
 AND NOT (table_name = 't100' AND column_name IN ('c1', 'c2'))),
ia AS (SELECT * FROM cat_columns_dev WHERE NOT {GLOB} AND NOT (table_name = 't100' AND column_name IN ('c1', 'c2')))
""" + _columns_sql({k: v for k, v in COL_ATTRS.items() if k not in IGNORE_ATTRS}, False, "equal", "B5", "ie", "ia"),
    "glob_match": cte("cat_columns") + f"SELECT DISTINCT table_schema, table_name, {GLOB} AS matched FROM cat_columns",
    "existence_all_kinds": cte(*OBJ_FIXTURES) + f""", e AS ({_objects_sql('')}), a AS ({_objects_sql('_dev')})
SELECT 'C10' AS check_id, kind AS object_kind, object_schema || '.' || object_name AS object_key, {N} AS field,
 'MISSING' AS status, {N} AS expected, {N} AS actual FROM e
 WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.kind = e.kind AND a.object_schema = e.object_schema AND a.object_name = e.object_name)""",
    "drift_pk": cte("cat_key_usage", "cat_key_usage_dev") + KEYS_CTE + f""", p AS (SELECT table_schema, table_name, columns FROM keys WHERE constraint_type = 'PRIMARY KEY'),
pd AS (SELECT table_schema, table_name, columns FROM keys_dev WHERE constraint_type = 'PRIMARY KEY')
SELECT 'C3' AS check_id, 'primary_key' AS object_kind, coalesce(p.table_schema, pd.table_schema) || '.' || coalesce(p.table_name, pd.table_name) AS object_key,
 'columns' AS field, CASE WHEN pd.columns IS NULL THEN 'MISSING' WHEN p.columns IS NULL THEN 'UNEXPECTED' ELSE 'CHANGED' END AS status,
 p.columns AS expected, pd.columns AS actual
FROM p FULL OUTER JOIN pd ON p.table_schema = pd.table_schema AND p.table_name = pd.table_name
WHERE p.columns IS DISTINCT FROM pd.columns""",
    "drift_unique": cte("cat_key_usage", "cat_key_usage_dev") + KEYS_CTE + """, u AS (SELECT table_schema, table_name, columns, count(*) AS n FROM keys WHERE constraint_type = 'UNIQUE' GROUP BY ALL),
ud AS (SELECT table_schema, table_name, columns, count(*) AS n FROM keys_dev WHERE constraint_type = 'UNIQUE' GROUP BY ALL),
j AS (SELECT coalesce(u.table_schema, ud.table_schema) AS s, coalesce(u.table_name, ud.table_name) AS t, coalesce(u.columns, ud.columns) AS c,
 coalesce(u.n, 0) AS ne, coalesce(ud.n, 0) AS na FROM u FULL OUTER JOIN ud
 ON u.table_schema = ud.table_schema AND u.table_name = ud.table_name AND u.columns = ud.columns)
SELECT 'C4' AS check_id, 'unique' AS object_kind, concat_ws('.', s, t, c) AS object_key, 'count' AS field,
 CASE WHEN ne > na THEN 'MISSING' ELSE 'UNEXPECTED' END AS status, CAST(ne AS VARCHAR) AS expected, CAST(na AS VARCHAR) AS actual
FROM j WHERE ne <> na""",
    "drift_fk": cte("cat_key_usage", "cat_key_usage_dev") + FK_CTE + " " + _set_sql(
        "fks", "fks_dev", T + ["constraint_name", "ref_table", "pairs"], "foreign_key", "C5"),
    "drift_views": cte("cat_views", "cat_views_dev") + f""", ve AS (SELECT view_schema, view_name, {NORM.format(c='definition')} AS definition_norm FROM cat_views),
va AS (SELECT view_schema, view_name, {NORM.format(c='definition')} AS definition_norm FROM cat_views_dev)
""" + _defs_sql("ve", "va", ["view_schema", "view_name"], "definition_norm", "view", "C6"),
    "drift_functions": cte("cat_functions", "cat_functions_dev") + f""", fe AS (SELECT schema_name, name, args, sha256({NORM.format(c='definition')}) AS definition_hash FROM cat_functions),
fa AS (SELECT schema_name, name, args, sha256({NORM.format(c='definition')}) AS definition_hash FROM cat_functions_dev)
""" + _defs_sql("fe", "fa", ["schema_name", "name", "args"], "definition_hash", "function", "C7"),
    "as_name_list": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus ELSE '' END AS one, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus || '|' || o_orderpriority ELSE '' END AS many,
 CASE WHEN o_orderkey % 3 <> 0 THEN 1 ELSE 0 END AS n_one, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 0 END AS n_many FROM orders""",
    "ignore_rule_table": cte("cat_columns", "ignore_globs") + """, n AS (SELECT DISTINCT table_schema, table_name, table_schema || '.' || table_name AS name FROM cat_columns)
SELECT table_schema, table_name FROM n WHERE NOT EXISTS (SELECT 1 FROM ignore_globs r WHERE n.name GLOB r.pattern)""",
    "drift_functions_no_args": """SELECT 'db' || (p_partkey % 5) || '.f' || p_partkey || '.' || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'integer' END AS object_key,
 CASE WHEN p_partkey % 10 = 6 THEN 'MISSING' ELSE 'CHANGED' END AS status FROM part
 WHERE p_partkey % 10 = 6 OR (p_partkey % 4 = 0 AND p_type <> p_brand)""",
    "drift_roles": cte("cat_roles", "cat_roles_dev") + _set_sql("cat_roles", "cat_roles_dev", ["rolname"], "role", "C8", "subset"),
    "drift_sequences": cte("cat_sequences", "cat_sequences_dev") + _set_sql(
        "cat_sequences", "cat_sequences_dev", ["sequence_schema", "sequence_name"], "sequence", "C8", "subset"),
    "drift_memberships": cte("cat_role_links", "cat_roles", "cat_roles_dev") + f""", m AS ({MEMBERS.format(roles='cat_roles')}),
md AS ({MEMBERS.format(roles='cat_roles_dev')}) """ + _set_sql("m", "md", ["role", "member"], "membership", "C9"),
    "drift_seq_owners": cte("cat_sequences", "cat_seq_owners", "cat_sequences_dev", "cat_seq_owners_dev") + SEQOWN_CTE + " " + _set_sql(
        "so", "so_dev", ["sequence_schema", "sequence_name", "table_schema", "table_name", "column_name"], "sequence_owner", "C9"),
    "drift_indexes": cte("cat_key_usage", "cat_key_usage_dev") + KEYS_CTE + """, ix AS (SELECT table_schema AS index_schema, constraint_name AS index_name,
 '(' || columns || ')' AS definition FROM keys), ixd AS (SELECT table_schema AS index_schema, constraint_name AS index_name, '(' || columns || ')' AS definition FROM keys_dev)
""" + _set_sql("ix", "ixd", ["index_schema", "index_name", "definition"], "index", "C9"),
    "drift_triggers": cte("cat_triggers", "cat_triggers_dev") + TRIG_CTE + " " + _set_sql(
        "trig", "trig_dev", ["table_schema", "table_name", "trigger_name", "action_timing", "events"], "trigger", "C9"),
    "drift_owners": cte("cat_columns", "cat_roles") + ", o AS (" + _OWNERS.format(dev="false") + "), od AS (" + _OWNERS.format(dev="true") + ") " + _set_sql(
        "o", "od", ["table_schema", "table_name", "owner"], "owner", "C9"),
    "drift_privileges": cte("cat_grants", "cat_grants_dev") + _set_sql(
        "cat_grants", "cat_grants_dev", ["table_name", "grantee", "privilege_type", "is_grantable"], "privilege", "C9"),
    "snapshot_hash_compare": cte("cat_columns", "cat_columns_dev") + f""", fe AS ({FP.format(t='cat_columns')}), fa AS ({FP.format(t='cat_columns_dev')})
SELECT 'C14' AS check_id, 'table' AS object_kind, coalesce(fe.table_schema, fa.table_schema) || '.' || coalesce(fe.table_name, fa.table_name) AS object_key,
 'fingerprint' AS field, CASE WHEN fa.fingerprint IS NULL THEN 'MISSING' WHEN fe.fingerprint IS NULL THEN 'UNEXPECTED' ELSE 'CHANGED' END AS status,
 fe.fingerprint AS expected, fa.fingerprint AS actual
FROM fe FULL OUTER JOIN fa ON fe.table_schema = fa.table_schema AND fe.table_name = fa.table_name
WHERE fe.fingerprint IS DISTINCT FROM fa.fingerprint""",
    "snapshot_hash_null_shift": cte("cat_columns", "cat_columns_shift") + """, x AS (SELECT 1 AS side, * FROM cat_columns UNION ALL SELECT 2, * FROM cat_columns_shift),
g AS (SELECT side, table_schema || '.' || table_name AS object_key,
 list([column_name, data_type, is_nullable, CAST(num_precision AS VARCHAR), CAST(num_scale AS VARCHAR)] ORDER BY ordinal_position) AS cols FROM x GROUP BY ALL)
SELECT object_key, 'CHANGED' AS status FROM g e JOIN g a USING (object_key) WHERE e.side = 1 AND a.side = 2 AND e.cols IS DISTINCT FROM a.cols""",
    "normalize_text": cte("cat_functions") + f"SELECT name, {NORM.format(c='definition')} AS definition_norm FROM cat_functions",
    "definition_hash": cte("cat_functions") + f"SELECT name, sha256({NORM.format(c='definition')}) AS definition_hash FROM cat_functions",
}


def _findings_cte() -> str:
    from relcheck.plans.data import ORDER_COLS, _keyed_sql
    return cte("cat_columns", "cat_columns_dev", "orders_actual") + ", f AS (" + STRICT + "\nUNION ALL " + \
        _keyed_sql("orders", "orders_actual", ORDER_COLS) + ")\n"


ORACLE["findings_summary"] = _findings_cte() + "SELECT check_id, status, count(*) AS n_findings FROM f GROUP BY ALL"
def _outcome_sql() -> str:
    from relcheck.plans.data import ORACLE as DATA
    failed = "status IN ('MISSING', 'UNEXPECTED', 'CHANGED', 'VIOLATION')"
    return f"""SELECT check_id, count(*) FILTER (WHERE status = 'PASS') AS n_passed, count(*) FILTER (WHERE {failed}) AS n_failed,
 count(*) FILTER (WHERE status = 'SKIP') AS n_skipped, count(*) AS n_findings
FROM (SELECT check_id, status FROM ({_findings_cte()} SELECT * FROM f) UNION ALL SELECT check_id, status FROM ({DATA["check_not_null"]})) GROUP BY check_id"""


ORACLE["findings_outcome"] = _outcome_sql()
ORACLE["run_verdict"] = _findings_cte() + """SELECT check_id,
 count(*) FILTER (WHERE status IN ('MISSING', 'UNEXPECTED', 'CHANGED', 'VIOLATION')) AS n_failures,
 count(DISTINCT CASE WHEN status IN ('MISSING', 'UNEXPECTED', 'CHANGED', 'VIOLATION') THEN object_key END) AS n_failing_objects,
 CASE WHEN count(*) FILTER (WHERE status IN ('MISSING', 'UNEXPECTED', 'CHANGED', 'VIOLATION')) > 0 THEN 'FAILED' ELSE 'PASSED' END AS verdict
FROM f GROUP BY check_id"""
