"""Registered queries: table data comparison (C11, C14, C17), data
constraints (D1-D7), de-duplication (H1-H4) and findings summaries
(C12, C13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from relcheck.operators import constraints as con
from relcheck.operators import dedup
from relcheck.operators import profile as prof
from relcheck.operators import release as rel
from relcheck.operators import tablediff as td
from relcheck.sources.fixtures import cte, fixture
from relcheck.sources.tables import table

ORDER_KEY = ["o_orderkey"]
LI_KEY = ["l_orderkey", "l_linenumber"]
LI_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
            "l_returnflag", "l_linestatus"]


def q_table_diff_keyed(spark, d):
    return td.diff_keyed(table(spark, d, "orders"), fixture(spark, d, "orders_actual"), ORDER_KEY)


def q_table_diff_ignore_cols(spark, d):
    return td.diff_keyed(table(spark, d, "orders"), fixture(spark, d, "orders_actual"), ORDER_KEY,
                         ignore_cols=["o_totalprice"])


def q_table_diff_multiset(spark, d):
    r = td.diff_multiset(table(spark, d, "orders"), fixture(spark, d, "orders_actual"))
    return r.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def q_table_diff_counts(spark, d):
    return td.diff_counts(table(spark, d, "orders"), fixture(spark, d, "orders_actual"), ORDER_KEY)


def q_rollback_check(spark, d):
    orders = table(spark, d, "orders")
    return td.rollback_check(before=orders, forward=fixture(spark, d, "orders_actual"),
                             after_rollback=fixture(spark, d, "orders_after"),
                             expected_forward=orders, key=ORDER_KEY, table="orders")


def _release(spark, d, environment):
    """Tables with a key, without one, equal ones, and one whose columns changed."""
    t = {n: table(spark, d, n) for n in ("orders", "customer", "part", "lineitem", "supplier")}
    return rel.release_check([
        rel.ReleaseTable("orders", t["orders"], fixture(spark, d, "orders_actual"), t["orders"], fixture(spark, d, "orders_after"), tuple(ORDER_KEY)),
        rel.ReleaseTable("customer", t["customer"], t["customer"], t["customer"], t["customer"], ("c_custkey",)),
        rel.ReleaseTable("part", t["part"], t["part"].withColumn("p_size", F.col("p_size").cast("string")), t["part"], None, ("p_partkey",)),
        rel.ReleaseTable("lineitem", t["lineitem"], fixture(spark, d, "lineitem_forward"), t["lineitem"], t["lineitem"]),
        rel.ReleaseTable("supplier", t["supplier"], t["supplier"].drop("s_acctbal"), t["supplier"], t["supplier"], ("s_suppkey",))], environment)


def q_release_verdicts(spark, d):
    return _release(spark, d, "sandbox").verdicts


def q_release_verdicts_dev(spark, d):
    """Outside the sandbox nothing is rolled back."""
    return _release(spark, d, "dev").verdicts.where("comparison = 'rollback'").select("table_name", "verdict")


def q_release_findings(spark, d):
    return _release(spark, d, "sandbox").findings.where("object_kind <> 'lineitem'")


def q_table_diff_null_shift(spark, d):
    return td.diff_keyed(fixture(spark, d, "shift_expected"), fixture(spark, d, "shift_actual"), ORDER_KEY)


def q_table_diff_null_keys(spark, d):
    return td.diff_keyed(fixture(spark, d, "nullkey_expected"), fixture(spark, d, "nullkey_actual"), ["k1", "k2"])


def q_table_diff_column_set(spark, d):
    return td.diff_keyed(table(spark, d, "orders"), fixture(spark, d, "orders_other_columns"), ORDER_KEY)


def q_table_diff_repeated(spark, d):
    return td.diff_keyed(fixture(spark, d, "lines_expected"), fixture(spark, d, "lines_actual"), ["l_orderkey"])


def q_check_not_null(spark, d):
    return con.check_not_null(fixture(spark, d, "orders_actual"), "orders_actual")


def q_check_length_precision(spark, d):
    rules = [{"column": "o_orderpriority", "char_max": 8},
             {"column": "o_orderstatus", "char_max": 1},
             {"column": "o_totalprice", "num_precision": 7, "num_scale": 2}]
    return con.check_length_precision(fixture(spark, d, "orders_actual"), "orders_actual", rules)


def q_profile_merged(spark, d):
    """Orders profiled by year, the years merged; estimates told by whether they
    are near the exact counts."""
    orders = table(spark, d, "orders")
    kept = prof.day_profiles(orders, "orders", F.year("o_orderdate"))
    exact = con.observed_profile(orders, "orders").select(F.col("column_name").alias("_c"), F.col("n_distinct").alias("_exact"))
    near = F.abs(F.col("n_distinct") - F.col("_exact")) <= F.greatest(F.lit(1.0), F.col("_exact") * 2.5 / 2 ** (prof.LG_K / 2))
    return prof.merged_profile(kept).join(exact, F.col("column_name") == F.col("_c")).select(
        "column_name", "n_rows", "n_nulls", "max_length", "min_number", "min_text", "max_number", "max_text", near.alias("near"))


def q_check_decimal_edges(spark, d):
    rules = [{"column": "top", "num_precision": 19, "num_scale": 2}, {"column": "tiny", "num_precision": 19, "num_scale": 2},
             {"column": "over", "num_precision": 19, "num_scale": 2}, {"column": "l_orderkey", "num_precision": 3, "num_scale": 0}]
    return con.check_length_precision(fixture(spark, d, "edge_numbers"), "edge_numbers", rules)


def q_table_diff_retyped(spark, d):
    """Whole numbers of other types: cells by key, and the counts."""
    e, a = fixture(spark, d, "orders_narrow"), fixture(spark, d, "orders_retyped")
    cells = td.diff_keyed(e, a, ORDER_KEY).select("object_key", "field", "status", "expected", "actual")
    counts = td.diff_counts(e, a, ORDER_KEY).select(F.lit("*").alias("object_key"), F.col("metric").alias("field"), F.lit("COUNT").alias("status"),
                                                    F.lit(None).cast("string").alias("expected"), F.col("value").cast("string").alias("actual"))
    return cells.unionByName(counts)


def q_check_pk(spark, d):
    return con.check_pk(table(spark, d, "lineitem"), "lineitem", LI_KEY)


def q_check_unique(spark, d):
    return con.check_unique(fixture(spark, d, "orders_actual"), "orders_actual",
                            ["o_orderstatus", "o_custkey", "o_orderdate"])


def q_check_fk(spark, d):
    return con.check_fk(fixture(spark, d, "orders_actual"), fixture(spark, d, "customer_pruned"), ["o_custkey"], ["c_custkey"],
                        "orders_actual_o_custkey_fkey")


def q_observed_profile(spark, d):
    return con.observed_profile(table(spark, d, "part"), "part")


def q_check_sequence_headroom(spark, d):
    return con.check_sequence_headroom(fixture(spark, d, "cat_sequences"), fixture(spark, d, "cat_seq_owners"),
                                       table(spark, d, "lineitem"), "public", "lineitem")


def q_dedup_row_number(spark, d):
    r = dedup.keep_first(table(spark, d, "lineitem"), LI_KEY, LI_ORDER)
    return r.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


def q_dedup_distinct(spark, d):
    li = table(spark, d, "lineitem").select(*LI_KEY, "l_returnflag", "l_linestatus")
    return dedup.distinct_rows(li)


def q_dup_keys_report(spark, d):
    return dedup.duplicate_report(table(spark, d, "lineitem"), LI_KEY)


def q_lookup_join_dedup(spark, d):
    # every order line of the lookup is asked for, and one that it lacks
    lines = F.explode(F.sequence(F.lit(1), F.lit(8))).alias("line_no")
    facts = table(spark, d, "orders").select("o_orderkey", "o_custkey", lines)
    lookup = table(spark, d, "lineitem").select(*LI_KEY, *LI_ORDER)
    j = dedup.join_deduplicated(facts, lookup, ["o_orderkey", "line_no"], LI_KEY, LI_ORDER)
    return j.select("o_orderkey", "o_custkey", "line_no", "l_partkey", "l_suppkey", "l_quantity")


QUERIES = {
    "table_diff_keyed": q_table_diff_keyed,
    "table_diff_ignore_cols": q_table_diff_ignore_cols,
    "table_diff_multiset": q_table_diff_multiset,
    "table_diff_counts": q_table_diff_counts,
    "rollback_check": q_rollback_check,
    "release_verdicts": q_release_verdicts,
    "release_verdicts_dev": q_release_verdicts_dev,
    "release_findings": q_release_findings,
    "table_diff_null_shift": q_table_diff_null_shift,
    "table_diff_null_keys": q_table_diff_null_keys,
    "table_diff_column_set": q_table_diff_column_set,
    "table_diff_repeated": q_table_diff_repeated,
    "check_not_null": q_check_not_null,
    "check_length_precision": q_check_length_precision,
    "profile_merged": q_profile_merged,
    "check_decimal_edges": q_check_decimal_edges,
    "table_diff_retyped": q_table_diff_retyped,
    "check_pk": q_check_pk,
    "check_unique": q_check_unique,
    "check_fk": q_check_fk,
    "observed_profile": q_observed_profile,
    "check_sequence_headroom": q_check_sequence_headroom,
    "dedup_row_number": q_dedup_row_number,
    "dedup_distinct": q_dedup_distinct,
    "dup_keys_report": q_dup_keys_report,
    "lookup_join_dedup": q_lookup_join_dedup,
}

# ---------------------------------------------------------------- oracle
NULLS = "CAST(NULL AS VARCHAR)"
ORDER_COLS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _keyed_sql(exp: str, act: str, cols: list[str], check_id: str = "C11", kind: str = "row") -> str:
    cells = ", ".join(f"('{c}', CAST(e.{c} AS VARCHAR), CAST(a.{c} AS VARCHAR))" for c in cols)
    return f"""SELECT '{check_id}' AS check_id, '{kind}' AS object_kind, CAST(e.o_orderkey AS VARCHAR) AS object_key, {NULLS} AS field,
 'MISSING' AS status, {NULLS} AS expected, {NULLS} AS actual FROM {exp} e WHERE e.o_orderkey NOT IN (SELECT o_orderkey FROM {act})
UNION ALL SELECT '{check_id}', '{kind}', CAST(a.o_orderkey AS VARCHAR), {NULLS}, 'UNEXPECTED', {NULLS}, {NULLS}
 FROM {act} a WHERE a.o_orderkey NOT IN (SELECT o_orderkey FROM {exp})
UNION ALL SELECT '{check_id}', '{kind}', CAST(e.o_orderkey AS VARCHAR), f.field, 'CHANGED', f.ev, f.av
 FROM {exp} e JOIN {act} a ON e.o_orderkey = a.o_orderkey, LATERAL (VALUES {cells}) AS f(field, ev, av)
 WHERE f.ev IS DISTINCT FROM f.av"""


LI_ALL = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
KEYED = cte("orders_actual") + _keyed_sql("orders", "orders_actual", ORDER_COLS)


_FOUND = f"'C11' AS check_id, 'row' AS object_kind"
_K12 = "coalesce({t}.k1, '<null>') || '|' || CAST({t}.k2 AS VARCHAR)"
_SAME12 = "e.k1 IS NOT DISTINCT FROM a.k1 AND e.k2 = a.k2"

ORACLE = {
    "table_diff_null_shift": cte("shift_expected", "shift_actual") + f"""SELECT {_FOUND}, CAST(e.o_orderkey AS VARCHAR) AS object_key, f.field AS field,
 'CHANGED' AS status, f.ev AS expected, f.av AS actual FROM shift_expected e JOIN shift_actual a USING (o_orderkey),
 LATERAL (VALUES ('a', e.a, a.a), ('b', e.b, a.b)) AS f(field, ev, av) WHERE f.ev IS DISTINCT FROM f.av""",
    "table_diff_null_keys": cte("nullkey_expected", "nullkey_actual") + f"""SELECT {_FOUND}, {_K12.format(t='e')} AS object_key, {NULLS} AS field,
 'MISSING' AS status, {NULLS} AS expected, {NULLS} AS actual FROM nullkey_expected e WHERE NOT EXISTS (SELECT 1 FROM nullkey_actual a WHERE {_SAME12})
UNION ALL SELECT {_FOUND}, {_K12.format(t='a')}, {NULLS}, 'UNEXPECTED', {NULLS}, {NULLS} FROM nullkey_actual a
 WHERE NOT EXISTS (SELECT 1 FROM nullkey_expected e WHERE {_SAME12})
UNION ALL SELECT {_FOUND}, {_K12.format(t='e')}, 'v', 'CHANGED', e.v, a.v FROM nullkey_expected e JOIN nullkey_actual a ON {_SAME12}
 WHERE e.v IS DISTINCT FROM a.v""",
    "table_diff_column_set": cte("orders_actual", "orders_other_columns") + _keyed_sql(
        "orders", "orders_other_columns", [c for c in ORDER_COLS if c != "o_orderpriority"]) + f"""
UNION ALL SELECT 'C11', 'column', 'o_orderpriority', {NULLS}, 'MISSING', {NULLS}, {NULLS}
UNION ALL SELECT 'C11', 'column', 'o_priority', {NULLS}, 'UNEXPECTED', {NULLS}, {NULLS}""",
    "table_diff_repeated": cte("lines_expected", "lines_actual") + f""", u AS (
 SELECT l_orderkey AS k, l_returnflag AS f, l_linestatus AS s, 1 AS side FROM lines_expected UNION ALL SELECT l_orderkey, l_returnflag, l_linestatus, -1 FROM lines_actual),
r AS (SELECT k, f, s, sum(side) AS more FROM u GROUP BY ALL),
n AS (SELECT k, count(*) FILTER (side = 1) AS ne, count(*) FILTER (side = -1) AS na FROM u GROUP BY k),
odd AS (SELECT n.* FROM n WHERE k IN (SELECT k FROM r WHERE more <> 0)),
j AS (SELECT *, '{{"l_returnflag":"' || f || '","l_linestatus":"' || s || '"}}' AS txt FROM r JOIN odd USING (k) WHERE more <> 0)
SELECT {_FOUND}, CAST(k AS VARCHAR) AS object_key, {NULLS} AS field, CASE WHEN na = 0 THEN 'MISSING' ELSE 'UNEXPECTED' END AS status,
 {NULLS} AS expected, {NULLS} AS actual FROM odd WHERE ne = 0 OR na = 0
UNION ALL SELECT {_FOUND}, CAST(k AS VARCHAR), '<rows>', 'CHANGED', CAST(ne AS VARCHAR), CAST(na AS VARCHAR) FROM odd WHERE ne > 0 AND na > 0 AND (ne > 1 OR na > 1)
UNION ALL SELECT {_FOUND}, CAST(k AS VARCHAR), '<row>', 'CHANGED', CASE WHEN more > 0 THEN txt END, CASE WHEN more < 0 THEN txt END FROM j
 WHERE ne > 0 AND na > 0 AND (ne > 1 OR na > 1)
UNION ALL SELECT {_FOUND}, CAST(k AS VARCHAR), c.field, 'CHANGED', c.ev, c.av FROM odd JOIN lines_expected e ON e.l_orderkey = k JOIN lines_actual a ON a.l_orderkey = k,
 LATERAL (VALUES ('l_returnflag', e.l_returnflag, a.l_returnflag), ('l_linestatus', e.l_linestatus, a.l_linestatus)) AS c(field, ev, av)
 WHERE ne = 1 AND na = 1 AND c.ev IS DISTINCT FROM c.av""",
    "table_diff_keyed": KEYED,
    "table_diff_ignore_cols": cte("orders_actual") + _keyed_sql(
        "orders", "orders_actual", [c for c in ORDER_COLS if c != "o_totalprice"]),
    "table_diff_multiset": cte("orders_actual") + """, u AS (
 SELECT *, 1 AS _e, 0 AS _a FROM orders UNION ALL SELECT *, 0, 1 FROM orders_actual)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority,
 CAST(sum(_e) AS BIGINT) AS n_expected, CAST(sum(_a) AS BIGINT) AS n_actual,
 CASE WHEN sum(_e) > sum(_a) THEN 'MISSING' ELSE 'UNEXPECTED' END AS status
FROM u GROUP BY ALL HAVING sum(_e) <> sum(_a)""",
    "table_diff_counts": cte("orders_actual") + ", f AS (" + _keyed_sql("orders", "orders_actual", ORDER_COLS) + """)
SELECT 'rows_expected' AS metric, (SELECT count(*) FROM orders) AS value
UNION ALL SELECT 'rows_actual', (SELECT count(*) FROM orders_actual)
UNION ALL SELECT 'missing_rows', (SELECT count(*) FROM f WHERE status = 'MISSING')
UNION ALL SELECT 'unexpected_rows', (SELECT count(*) FROM f WHERE status = 'UNEXPECTED')
UNION ALL SELECT 'changed_rows', (SELECT count(DISTINCT object_key) FROM f WHERE status = 'CHANGED')
UNION ALL SELECT 'changed_cells', (SELECT count(*) FROM f WHERE status = 'CHANGED')""",
    "release_verdicts": cte("orders_actual", "orders_after", "lineitem_forward") + f""", f AS ({_keyed_sql("orders", "orders_actual", ORDER_COLS)}),
u AS (SELECT *, 1 AS e, 0 AS a FROM lineitem UNION ALL SELECT *, 0, 1 FROM lineitem_forward), l AS (SELECT sum(e) AS e, sum(a) AS a FROM (SELECT * FROM u) GROUP BY {{lines}} HAVING sum(e) <> sum(a)),
n AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM part) AS p, (SELECT count(*) FROM lineitem) AS li, (SELECT count(*) FROM supplier) AS s)
SELECT 'forward' AS comparison, 'orders' AS table_name, o AS rows_expected, (SELECT count(*) FROM orders_actual) AS rows_actual,
 (SELECT count(DISTINCT object_key) FROM f WHERE status = 'MISSING') AS missing, (SELECT count(DISTINCT object_key) FROM f WHERE status = 'UNEXPECTED') AS unexpected,
 (SELECT count(DISTINCT object_key) FROM f WHERE status = 'CHANGED') AS changed, 0 AS columns, 'FAIL' AS verdict FROM n
UNION ALL SELECT 'rollback', 'orders', o, (SELECT count(*) FROM orders_after), o - (SELECT count(*) FROM orders_after), 0, 0, 0, CASE WHEN o = (SELECT count(*) FROM orders_after) THEN 'PASS' ELSE 'FAIL' END FROM n
UNION ALL SELECT 'forward', 'customer', c, c, 0, 0, 0, 0, 'PASS' FROM n UNION ALL SELECT 'rollback', 'customer', c, c, 0, 0, 0, 0, 'PASS' FROM n
UNION ALL SELECT 'forward', 'part', p, p, 0, 0, 0, 0, 'PASS' FROM n UNION ALL SELECT 'rollback', 'part', 0, 0, 0, 0, 0, 0, 'SKIP' FROM n
UNION ALL SELECT 'forward', 'lineitem', li, (SELECT count(*) FROM lineitem_forward), (SELECT count(*) FROM l WHERE e > a), (SELECT count(*) FROM l WHERE e < a), 0, 0, 'FAIL' FROM n
UNION ALL SELECT 'rollback', 'lineitem', li, li, 0, 0, 0, 0, 'PASS' FROM n
UNION ALL SELECT 'forward', 'supplier', s, s, 0, 0, 0, 1, 'FAIL' FROM n UNION ALL SELECT 'rollback', 'supplier', s, s, 0, 0, 0, 0, 'PASS' FROM n""".replace("{lines}", LI_ALL),
    "release_verdicts_dev": "SELECT * FROM (VALUES ('orders', 'SKIP'), ('customer', 'SKIP'), ('part', 'SKIP'), ('lineitem', 'SKIP'), ('supplier', 'SKIP')) AS t(table_name, verdict)",
    "release_findings": cte("orders_actual", "orders_after") + f"""SELECT 'forward' AS comparison, * FROM ({_keyed_sql("orders", "orders_actual", ORDER_COLS, kind="orders")})
UNION ALL SELECT 'rollback', * FROM ({_keyed_sql("orders", "orders_after", ORDER_COLS, kind="orders")})
UNION ALL SELECT 'forward', 'C11', 'supplier', 's_acctbal', '<column>', 'MISSING', {NULLS}, {NULLS}""",
    "rollback_check": cte("orders_actual", "orders_after")
        + _keyed_sql("orders", "orders_after", ORDER_COLS, "C17.rollback", "orders")
        + "\nUNION ALL " + _keyed_sql("orders", "orders_actual", ORDER_COLS, "C17.forward", "orders"),
    "check_not_null": cte("orders_actual") + """SELECT 'D1' AS check_id, 'column' AS object_kind, 'orders_actual.' || c AS object_key,
 'null_count' AS field, CASE WHEN n > 0 THEN 'VIOLATION' ELSE 'PASS' END AS status, '0' AS expected, CAST(n AS VARCHAR) AS actual
FROM (SELECT 'o_orderkey' AS c, count(*) FILTER (WHERE o_orderkey IS NULL) AS n FROM orders_actual
 UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders_actual
 UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders_actual
 UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders_actual
 UNION ALL SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders_actual
 UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM orders_actual) x""",
    "check_length_precision": cte("orders_actual") + """SELECT 'D2' AS check_id, 'column' AS object_kind, 'orders_actual.' || c AS object_key,
 field, CASE WHEN n > 0 THEN 'VIOLATION' ELSE 'PASS' END AS status, '0' AS expected, CAST(n AS VARCHAR) AS actual
FROM (SELECT 'o_orderpriority' AS c, 'char_max=8' AS field, count(*) FILTER (WHERE length(o_orderpriority) > 8) AS n FROM orders_actual
 UNION ALL SELECT 'o_orderstatus', 'char_max=1', count(*) FILTER (WHERE length(o_orderstatus) > 1) FROM orders_actual
 UNION ALL SELECT 'o_totalprice', 'num_precision=7,num_scale=2', count(*) FILTER (WHERE abs(o_totalprice) >= 100000.0) FROM orders_actual
 UNION ALL SELECT 'o_totalprice', 'num_scale=2', count(*) FILTER (WHERE abs(o_totalprice * 100.0 - round(o_totalprice * 100.0)) > 1e-6) FROM orders_actual) x""",
    "profile_merged": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, {'max(length(' + c + '))' if kind == 's' else 'NULL::BIGINT'} AS max_length, "
        + ", ".join(f"{f'{f}({c})::DOUBLE' if kind == 'n' else 'NULL::DOUBLE'} AS {f}_number, {f'{f}({c})::VARCHAR' if kind != 'n' else 'NULL::VARCHAR'} AS {f}_text" for f in ("min", "max"))
        + ", TRUE AS near FROM orders"
        for c, kind in (("o_orderkey", "n"), ("o_custkey", "n"), ("o_orderstatus", "s"), ("o_totalprice", "n"), ("o_orderdate", "d"), ("o_orderpriority", "s"))),
    "check_decimal_edges": """SELECT 'D2' AS check_id, 'column' AS object_kind, 'edge_numbers.' || c AS object_key, field,
 CASE WHEN n > 0 THEN 'VIOLATION' ELSE 'PASS' END AS status, '0' AS expected, CAST(n AS VARCHAR) AS actual
FROM (VALUES ('top', 'num_precision=19,num_scale=2', 0), ('top', 'num_scale=2', 0), ('tiny', 'num_precision=19,num_scale=2', 0),
 ('tiny', 'num_scale=2', (SELECT count(*) FROM lineitem WHERE l_linenumber <> 1)), ('over', 'num_precision=19,num_scale=2', (SELECT count(*) FROM lineitem WHERE l_linenumber = 2)),
 ('over', 'num_scale=2', 0), ('l_orderkey', 'num_precision=3,num_scale=0', (SELECT count(*) FROM lineitem WHERE abs(l_orderkey) > 999)), ('l_orderkey', 'num_scale=0', 0)) AS t(c, field, n)""",
    "table_diff_retyped": """WITH moved AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 97 = 0)
SELECT CAST(o_orderkey AS VARCHAR) AS object_key, 'o_custkey' AS field, 'CHANGED' AS status, CAST(o_custkey AS VARCHAR) AS expected, CAST(o_custkey + 1 AS VARCHAR) AS actual FROM moved
UNION ALL SELECT '*', m, 'COUNT', NULL, CAST(n AS VARCHAR) FROM (VALUES ('rows_expected', (SELECT count(*) FROM orders)), ('rows_actual', (SELECT count(*) FROM orders)),
 ('missing_rows', 0), ('unexpected_rows', 0), ('changed_rows', (SELECT count(*) FROM moved)), ('changed_cells', (SELECT count(*) FROM moved))) AS t(m, n)""",
    "check_pk": """SELECT 'D3' AS check_id, 'table' AS object_kind, 'lineitem' AS object_key, 'null_key_rows' AS field,
 CASE WHEN count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) > 0 THEN 'VIOLATION' ELSE 'PASS' END AS status,
 '0' AS expected, CAST(count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS VARCHAR) AS actual FROM lineitem
UNION ALL SELECT 'D3', 'key', 'lineitem:' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), 'duplicate_rows',
 'VIOLATION', '1', CAST(count(*) AS VARCHAR) FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
 GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "check_unique": cte("orders_actual") + """SELECT 'D4' AS check_id, 'key' AS object_kind,
 'orders_actual:' || o_orderstatus || '|' || CAST(o_custkey AS VARCHAR) || '|' || CAST(o_orderdate AS VARCHAR) AS object_key,
 'duplicate_rows' AS field, 'VIOLATION' AS status, '1' AS expected, CAST(count(*) AS VARCHAR) AS actual
FROM orders_actual WHERE o_orderstatus IS NOT NULL AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
GROUP BY o_orderstatus, o_custkey, o_orderdate HAVING count(*) > 1""",
    "check_fk": cte("orders_actual") + """SELECT 'D5' AS check_id, 'foreign_key' AS object_kind,
 'orders_actual_o_custkey_fkey:' || CAST(o_custkey AS VARCHAR) AS object_key, 'orphan_rows' AS field, 'VIOLATION' AS status,
 '0' AS expected, CAST(count(*) AS VARCHAR) AS actual
FROM orders_actual WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 100 <> 0)
GROUP BY o_custkey""",
    "observed_profile": """SELECT 'part' AS table_name, column_name, n_rows, n_nulls, n_distinct, max_length, min_value, max_value FROM (
 SELECT 'p_partkey' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE p_partkey IS NULL) AS n_nulls, count(DISTINCT p_partkey) AS n_distinct,
  CAST(NULL AS INTEGER) AS max_length, CAST(min(p_partkey) AS VARCHAR) AS min_value, CAST(max(p_partkey) AS VARCHAR) AS max_value FROM part
 UNION ALL SELECT 'p_name', count(*), count(*) FILTER (WHERE p_name IS NULL), count(DISTINCT p_name), CAST(max(length(p_name)) AS INTEGER), min(p_name), max(p_name) FROM part
 UNION ALL SELECT 'p_brand', count(*), count(*) FILTER (WHERE p_brand IS NULL), count(DISTINCT p_brand), CAST(max(length(p_brand)) AS INTEGER), min(p_brand), max(p_brand) FROM part
 UNION ALL SELECT 'p_type', count(*), count(*) FILTER (WHERE p_type IS NULL), count(DISTINCT p_type), CAST(max(length(p_type)) AS INTEGER), min(p_type), max(p_type) FROM part
 UNION ALL SELECT 'p_size', count(*), count(*) FILTER (WHERE p_size IS NULL), count(DISTINCT p_size), NULL, CAST(min(p_size) AS VARCHAR), CAST(max(p_size) AS VARCHAR) FROM part
 UNION ALL SELECT 'p_retailprice', count(*), count(*) FILTER (WHERE p_retailprice IS NULL), count(DISTINCT p_retailprice), NULL, CAST(min(p_retailprice) AS VARCHAR), CAST(max(p_retailprice) AS VARCHAR) FROM part) x""",
    "check_sequence_headroom": cte("cat_sequences", "cat_seq_owners") + """, used AS (
 SELECT 'l_orderkey' AS column_name, max(l_orderkey) AS max_used FROM lineitem
 UNION ALL SELECT 'l_partkey', max(l_partkey) FROM lineitem UNION ALL SELECT 'l_suppkey', max(l_suppkey) FROM lineitem
 UNION ALL SELECT 'l_linenumber', max(l_linenumber) FROM lineitem)
SELECT 'D7' AS check_id, 'sequence' AS object_kind, s.sequence_schema || '.' || s.sequence_name AS object_key,
 o.table_name || '.' || o.column_name AS field,
 CASE WHEN u.max_used > CAST(s.maximum_value AS BIGINT) THEN 'VIOLATION' ELSE 'PASS' END AS status,
 s.maximum_value AS expected, CAST(u.max_used AS VARCHAR) AS actual
FROM cat_seq_owners o JOIN cat_sequences s ON o.sequence_schema = s.sequence_schema AND o.sequence_name = s.sequence_name
JOIN used u ON u.column_name = o.column_name WHERE o.table_schema = 'public' AND o.table_name = 'lineitem'""",
    "dedup_row_number": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
 l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM (
 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity,
  l_shipdate, l_returnflag, l_linestatus, l_discount, l_tax) AS rn FROM lineitem) x WHERE rn = 1""",
    "dedup_distinct": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
    "dup_keys_report": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
 GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "lookup_join_dedup": """SELECT o.o_orderkey, o.o_custkey, CAST(n.line_no AS INTEGER) AS line_no, l.l_partkey, l.l_suppkey, l.l_quantity
 FROM orders o CROSS JOIN range(1, 9) n(line_no) LEFT JOIN (
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice,
  l_quantity, l_shipdate, l_returnflag, l_linestatus) AS rn FROM lineitem) x WHERE rn = 1) l
 ON o.o_orderkey = l.l_orderkey AND l.l_linenumber = n.line_no""",
}
