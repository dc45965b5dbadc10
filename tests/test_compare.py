from relcheck.operators import constraints as con
from relcheck.operators import dedup
from relcheck.operators import drift as dr
from relcheck.operators import tablediff as td
from relcheck.sources.fixtures import fixture, written
from tests.conftest import SF

SCHEMA = "k long, a string, b double"


def test_keyed_diff(spark):
    e = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (3, "z", 3.0)], SCHEMA)
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (4, "w", 4.0)], SCHEMA)
    f = {(r.object_key, r.status, r.field) for r in td.diff_keyed(e, a, ["k"]).collect()}
    assert f == {("3", "MISSING", None), ("4", "UNEXPECTED", None), ("2", "CHANGED", "b")}
    assert td.diff_keyed(e, e, ["k"]).count() == 0            # diff(x, x) is empty
    assert td.diff_keyed(e, a, ["k"], ignore_cols=["b"]).where("status = 'CHANGED'").count() == 0


def test_diff_mirrors(spark):
    e = spark.createDataFrame([(1, "x", 1.0), (3, "z", 3.0)], SCHEMA)
    a = spark.createDataFrame([(1, "q", 1.0), (4, "w", 4.0)], SCHEMA)
    ab = {(r.object_key, r.status, r.expected, r.actual) for r in td.diff_keyed(e, a, ["k"]).collect()}
    ba = {(r.object_key, r.status, r.expected, r.actual) for r in td.diff_keyed(a, e, ["k"]).collect()}
    flip = {"MISSING": "UNEXPECTED", "UNEXPECTED": "MISSING", "CHANGED": "CHANGED"}
    assert ab == {(k, flip[s], y, x) for k, s, x, y in ba}


def test_multiset_diff_counts_duplicates(spark):
    e = spark.createDataFrame([(1, "x", 1.0), (1, "x", 1.0)], SCHEMA)
    a = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    r = td.diff_multiset(e, a).collect()
    assert [(x.n_expected, x.n_actual, x.status) for x in r] == [(2, 1, "MISSING")]


def test_column_drift_lenient_vs_strict(spark):
    cols = "table_schema string, table_name string, column_name string, data_type string, num_scale int"
    e = spark.createDataFrame([("s", "t", "c1", "int", 0), ("s", "t", "c2", "text", None),
                               ("s", "gone", "c1", "int", None)], cols)
    a = spark.createDataFrame([("s", "t", "c1", "int", None), ("s", "t", "c3", "text", None)], cols)
    attrs = {"data_type": "string", "num_scale": "number"}
    strict = {(r.object_key, r.status, r.field) for r in dr.drift_columns(e, a, attrs, "strict").collect()}
    lenient = {(r.object_key, r.status, r.field) for r in dr.drift_columns(e, a, attrs, "lenient").collect()}
    assert ("s.t.c1", "CHANGED", "num_scale") in strict and ("s.t.c1", "CHANGED", "num_scale") not in lenient
    assert ("s.gone", "MISSING", None) in strict and ("s.t.c2", "MISSING", None) in strict
    assert ("s.t.c3", "UNEXPECTED", None) in strict
    sub = dr.drift_columns(e, a, attrs, "strict", policy="subset").collect()
    assert not [r for r in sub if r.status == "UNEXPECTED"]


def test_set_policies(spark):
    e = spark.createDataFrame([("r1",), ("r2",)], "rolname string")
    a = spark.createDataFrame([("r2",), ("r3",)], "rolname string")
    assert {r.status for r in dr.drift_set(e, a, ["rolname"], "role", "C8", "subset").collect()} == {"MISSING"}
    assert {r.status for r in dr.drift_set(e, a, ["rolname"], "role", "C9").collect()} == {"MISSING", "UNEXPECTED"}


def test_constraints(spark):
    df = spark.createDataFrame([(1, 1, "abc"), (1, 1, "x"), (2, None, None), (3, 1, "toolong")],
                               "a long, b long, s string")
    pk = {(r.field, r.actual) for r in con.check_pk(df, "t", ["a", "b"]).collect()}
    assert ("null_key_rows", "1") in pk and ("duplicate_rows", "2") in pk
    assert con.check_unique(df, "t", ["a", "b"]).count() == 1  # null key part exempt
    nn = {r.object_key: r.actual for r in con.check_not_null(df, "t").collect()}
    assert nn == {"t.a": "0", "t.b": "1", "t.s": "1"}
    lp = con.check_length_precision(df, "t", [{"column": "s", "char_max": 3}]).first()
    assert lp.actual == "1" and lp.status == "VIOLATION"
    parent = spark.createDataFrame([(1,)], "id long")
    fk = con.check_fk(df, parent, ["a"], ["id"], "fk").collect()
    assert sorted(r.object_key for r in fk) == ["fk:2", "fk:3"]


def test_keep_first_matches_row_number(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, 9, "q")], "k long, o long, v string")
    r = {x.k: (x.o, x.v) for x in dedup.keep_first(df, ["k"], ["o"]).collect()}
    assert r == {1: (3, "a"), 2: (9, "q")}
    facts = spark.createDataFrame([(1,), (1,), (3,)], "k long")
    j = dedup.join_deduplicated(facts, df, ["k"], ["k"], ["o"])
    assert j.count() == facts.count()


def test_keyed_diff_duplicate_keys_do_not_pair(spark):
    e = spark.createDataFrame([(1, "x", 1.0), (1, "y", 1.0), (2, "z", 2.0)], SCHEMA)
    a = spark.createDataFrame([(1, "x", 1.0), (1, "y", 1.0), (1, "q", 1.0), (2, "z", 2.0)], SCHEMA)
    f = [(r.object_key, r.field, r.status, r.expected, r.actual) for r in td.diff_keyed(e, a, ["k"]).collect()]
    assert sorted(f, key=str) == [("1", "<row>", "CHANGED", None, '{"a":"q","b":1.0}'), ("1", "<rows>", "CHANGED", "2", "3")]
    same = spark.createDataFrame([(1, "y", 1.0), (1, "x", 1.0), (2, "z", 2.0)], SCHEMA)
    assert td.diff_keyed(e, same, ["k"]).count() == 0   # same multiset per key, any order


def test_skip_extra_tables_and_empty_expected(spark):
    cols = "table_schema string, table_name string, column_name string, data_type string"
    e = spark.createDataFrame([("s", "t", "c1", "int")], cols)
    a = spark.createDataFrame([("s", "t", "c1", "int"), ("s", "extra", "c1", "int")], cols)
    attrs = {"data_type": "string"}
    assert dr.drift_columns(e, a, attrs).count() == 0
    r = dr.drift_columns(e, a, attrs, report_extra_tables=True).collect()
    assert [(x.object_kind, x.object_key, x.status) for x in r] == [("table", "s.extra", "UNEXPECTED")]
    empty = spark.createDataFrame([], "rolname string")
    roles = spark.createDataFrame([("r1",)], "rolname string")
    f = dr.drift_set(empty, roles, ["rolname"], "role", "C8", "subset", skip_when_empty=True).collect()
    assert [(x.status, x.object_key) for x in f] == [("SKIP", "*")]


def test_drift_columns_reads_both_sides_once(spark):
    """One shuffle by table and no join; tables of one side, also of a null name,
    give one finding whatever they hold."""
    e = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x"), ("b", 2, "x"), (None, 1, "x"), (None, None, "x")], "t string, c int, v string")
    a = spark.createDataFrame([("a", 1, "y"), ("z", 1, "x"), ("z", None, "x")], "t string, c int, v string")
    got = dr.drift_columns(e, a, {"v": "string"}, table_key=("t",), column="c", report_extra_tables=True)
    assert sorted((r.object_kind, r.object_key, r.field or "", r.status, r.expected, r.actual) for r in got.collect()) == [
        ("column", "a.1", "v", "CHANGED", "x", "y"), ("column", "a.2", "", "MISSING", None, None),
        ("table", "", "", "MISSING", None, None), ("table", "b", "", "MISSING", None, None), ("table", "z", "", "UNEXPECTED", None, None)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_written_input_is_derived_once(spark):
    """What reads a written input reads its rows, and derives nothing of it again."""
    have = written(spark, SF, "cat_columns")
    for name in ("cat_key_usage", "cat_views_dev"):
        one, own = fixture(spark, SF, name, have), fixture(spark, SF, name)
        assert one.exceptAll(own).count() == own.exceptAll(one).count() == 0
        assert "Window" in own._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in one._jdf.queryExecution().optimizedPlan().toString()
