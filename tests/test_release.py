"""All tables of a release in one comparison."""

import pytest

from relcheck.operators import release as rel


def frame(spark, rows, schema="k long, v string, w double"):
    return spark.createDataFrame(rows, schema)


def verdicts(made):
    return {(r.comparison, r.table_name): tuple(r)[2:] for r in made.verdicts.collect()}


def found(made):
    return sorted((r.comparison, r.object_kind, r.object_key, r.field, r.status, r.expected, r.actual) for r in made.findings.collect())



@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_tables_of_all_kinds(spark, buckets):
    a = frame(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (None, "n", None), (7, "r", 1.0), (7, "r", 2.0), (8, "s", 1.0), (8, "s", 1.0)])
    b = frame(spark, [(1, "a", 1.0), (2, None, 2.5), (4, "d", 4.0), (None, "m", None), (7, "r", 2.0), (7, "x", 2.0), (8, "s", 1.0), (8, "s", 1.0)])
    bag, bag2 = frame(spark, [(1, "a", 1.0)] * 3 + [(2, None, 2.0)]), frame(spark, [(1, "a", 1.0)] * 2 + [(2, None, 2.0), (None, None, None)])
    typed = frame(spark, [(1, "a", "1"), (2, "b", "2")], "k int, v string, w string")
    wide = frame(spark, [(1, "a", 1.0, 5)], "k long, v string, w double, x int")
    pairs = [rel.TablePair("t", a, b, ("k",)), rel.TablePair("same", a, a, ("k",)), rel.TablePair("bag", bag, bag2),
             rel.TablePair("typed", typed, typed.selectExpr("cast(k as bigint) k", "v", "cast(w as int) w"), ("k",)),
             rel.TablePair("wide", wide, wide.drop("x"), ("k",)), rel.TablePair("ignored", a, a.withColumn("w", a.w + 1), ("k",), ("w",)),
             rel.TablePair("empty", a.limit(0), a.limit(0), ("k",))]
    made = rel.compare_tables(pairs, buckets)
    assert verdicts(made) == {
        ("data", "t"): (8, 8, 1, 1, 3, 0, "FAIL"), ("data", "same"): (8, 8, 0, 0, 0, 0, "PASS"), ("data", "bag"): (4, 4, 1, 1, 0, 0, "FAIL"),
        ("data", "typed"): (2, 2, 0, 0, 0, 0, "PASS"), ("data", "wide"): (1, 1, 0, 0, 0, 1, "FAIL"), ("data", "ignored"): (8, 8, 0, 0, 0, 0, "PASS"),
        ("data", "empty"): (0, 0, 0, 0, 0, 0, "PASS")}
    got = {(r.object_kind, r.object_key, r.field, r.status, r.expected, r.actual) for r in made.findings.collect()}
    assert got == {("t", "2", "v", "CHANGED", "b", None), ("t", "2", "w", "CHANGED", "2.0", "2.5"), ("t", "3", None, "MISSING", None, None),
                   ("t", "4", None, "UNEXPECTED", None, None), ("t", "<null>", "v", "CHANGED", "n", "m"), ("t", "7", "<rows>", "CHANGED", "2", "2"),
                   ("bag", "1|a|1.0", "<count>", "MISSING", "3", "2"), ("bag", "<null>|<null>|<null>", "<count>", "UNEXPECTED", "0", "1"),
                   ("wide", "x", "<column>", "MISSING", None, None)}


def test_equal_tables_move_a_row_a_task(spark):
    """No bucket and no row of an equal table goes on."""
    big = spark.range(0, 200_000, 1, 4).selectExpr("id k", "cast(id % 7 as string) v", "id / 3 w")
    pairs = [rel.TablePair("a", big, big, ("k",)), rel.TablePair("b", big, big.where("k <> 5"), ("k",))]
    assert {k[1]: r.differs for k, r in rel.table_digests(pairs).items()} == {"a": False, "b": True}
    assert [r.table_name for r in rel.differing_buckets(pairs).collect()] == ["b"]
    plan = rel.digests(rel.long_rows(pairs), rel.NAME)
    assert plan.count() == 2
    text = plan._jdf.queryExecution().executedPlan().toString()
    before = text[text.index("Exchange"):]
    assert "partial_sum" in before  # summed before the exchange
    assert [(r.object_key, r.status) for r in rel.row_findings(pairs).collect()] == [("5", "MISSING")]


def test_only_differing_keys_of_a_bucket_go_on(spark):
    """However many rows share their bucket; zeros of two signs are two keys, as
    their texts are, and columns may have any names."""
    big = spark.range(0, 50_000, 1, 4).selectExpr("id k", "id / 3 `w.x`", "timestamp_seconds(id) side")
    for key in (("k",), ()):
        pair = rel.TablePair("b", big, big.where("k not in (5, 77)"), key)
        assert rel.differing_keys(pair, 3).count() == 2
        got = rel.row_findings([pair], 3).collect()
        assert sorted(r.object_key.split("|")[0] for r in got) == ["5", "77"]
    e, a = frame(spark, [(0.0, 1), (1.0, 1)], "k double, v int"), frame(spark, [(-0.0, 2), (1.0, 1)], "k double, v int")
    assert found(rel.compare_tables([rel.TablePair("z", e, a, ("k",))])) == [
        ("data", "z", "-0.0", None, "UNEXPECTED", None, None), ("data", "z", "0.0", None, "MISSING", None, None)]


def test_a_third_of_the_rows_have_one_key(spark):
    e = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) k", "id % 5 v")
    a = e.where("not (k = 0 and v = 1)").union(spark.range(10).selectExpr("0L k", "9L v"))
    made = rel.compare_tables([rel.TablePair("t", e, a, ("k",))])
    assert [(r.object_key, r.field) for r in made.findings.collect()] == [("0", "<rows>")]


def test_rollback_only_in_the_sandbox(spark):
    a, b = frame(spark, [(1, "a", 1.0)]), frame(spark, [(1, "b", 1.0)])
    tables = [rel.ReleaseTable("t", a, b, b, b, ("k",)), rel.ReleaseTable("u", a, b, b, None, ("k",))]
    assert {k: v[-1] for k, v in verdicts(rel.release_check(tables, "sandbox")).items()} == {
        ("forward", "t"): "PASS", ("rollback", "t"): "FAIL", ("forward", "u"): "PASS", ("rollback", "u"): "SKIP"}
    made = rel.release_check(tables, "dev")
    assert {k: v[-1] for k, v in verdicts(made).items()} == {
        ("forward", "t"): "PASS", ("rollback", "t"): "SKIP", ("forward", "u"): "PASS", ("rollback", "u"): "SKIP"}
    assert found(made) == []
