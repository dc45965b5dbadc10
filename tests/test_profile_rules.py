"""Profiles kept by day and merged; ignore rules as a table."""

import fnmatch
import random

from pyspark.sql import functions as F

from relcheck.operators import ignore_rules as ig
from relcheck.operators import profile as pr
from relcheck.operators.constraints import observed_profile


def sample(spark, n):
    return spark.range(n).selectExpr("id k", "id % 9 d", "if(id % 5 = 0, null, concat('name', id % 700)) s", "cast(id % 13 / 4 as double) r",
                                     "cast(id - 4000000000000000000 as decimal(22,2)) big", "date_add(date'2024-01-01', cast(id % 40 as int)) t")


def test_merged_days_equal_one_exact_pass(spark):
    df = sample(spark, 20_000)
    kept = pr.day_profiles(df, "t", F.col("d"))
    assert kept.count() == 9 * 6 and kept.select("day").distinct().count() == 9
    plan = pr.merged_profile(kept)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    got = {r.column_name: r for r in pr.merged_profile(kept).collect()}
    for e in observed_profile(df, "t").collect():
        g = got[e.column_name]
        assert (g.n_rows, g.n_nulls, g.max_length) == (e.n_rows, e.n_nulls, e.max_length)
        assert abs(g.n_distinct - e.n_distinct) <= max(1, e.n_distinct * 2.5 / 2 ** (pr.LG_K / 2))
        if g.min_text is None:
            assert (g.min_number, g.max_number) == (float(e.min_value), float(e.max_value))
        else:
            assert (g.min_text, g.max_text) == (e.min_value, e.max_value)


def test_a_new_day_replaces_only_itself(spark):
    df = sample(spark, 900)
    kept = pr.day_profiles(df.where("d < 8"), "t", F.col("d")).unionByName(pr.day_profiles(df.where("d = 3").limit(5), "t", F.lit(8).cast("long")))
    new = pr.day_profiles(df.where("d = 8"), "t", F.col("d"))
    got = sorted(map(str, pr.merged_profile(pr.refreshed(kept, new)).drop("n_distinct").collect()))
    assert got == sorted(map(str, pr.merged_profile(pr.day_profiles(df, "t", F.col("d"))).drop("n_distinct").collect()))
    assert pr.merged_profile(pr.day_profiles(df.limit(0), "t", F.col("d"))).count() == 0


def test_exact_profile_holds_one_column_at_a_time(spark):
    df = spark.createDataFrame([(1, "a", -0.0, None), (1, None, 2.5, None), (3, "ccc", float("nan"), None), (3, "ccc", 2.5, None)], "k long, s string, r double, none int")
    got = observed_profile(df, "t")
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [("t", "k", 4, 0, 2, None, "1", "3"), ("t", "none", 4, 4, 0, None, None, None),
                                                 ("t", "r", 4, 0, 3, None, "-0.0", "NaN"), ("t", "s", 4, 1, 2, 3, "a", "ccc")]
    assert {tuple(r)[2:] for r in observed_profile(df.limit(0), "t").collect()} == {(0, 0, 0, None, None, None)}


def globs(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abct_1") for _ in range(r.randrange(1, 6)))
    kinds = [lambda: f"{word()}.{word()}", lambda: f"{word()}*", lambda: f"*{word()}", lambda: f"*{word()}*{word()}", lambda: f"{word()}?{word()}", lambda: f"?{word()}.[ab!]*",
             lambda: f"[!a-c]{word()}*", lambda: f"{word()}[", lambda: f"*{word()}[a-t]*"]
    return [r.choice(kinds)() for _ in range(n)], [f"{word()}.{word()}{r.randrange(30)}" for _ in range(400)]


def test_ten_thousand_rules(spark):
    patterns, names = globs(1, 10_000)
    names += [p for p in patterns[:200] if "*" not in p]
    rules = spark.createDataFrame([(p,) for p in patterns + [None, "a.b"]], "pattern string")
    found = ig.matches(spark.createDataFrame([(n,) for n in names + [None]], "name string"), rules)
    want = {(n, p) for n in set(names) for p in set(patterns) | {"a.b"} if fnmatch.fnmatchcase(n, p)}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_rules_without_letters_and_no_rules(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "yy"), (None, "z")], "table_schema string, table_name string")
    kept = lambda *p: sorted(r.table_name for r in ig.without_ignored(df, spark.createDataFrame([(x,) for x in p], "pattern string")).collect())
    assert kept() == ["x", "yy", "z"] and kept("*") == [] and kept("???") == ["yy", "z"] and kept("z") == ["x", "yy"] and kept("?.*[y]", "none") == ["x", "z"]


def test_rules_that_begin_alike_meet_few_names(spark):
    """Thousands of rules whose pieces share their first letters: a name meets
    those whose whole piece it holds."""
    ks = range(10_000, 12_000)
    rules = [f"*.t{k}?" for k in ks] + [f"*3.t{k}*1" for k in ks] + [f"??.t{k}*" for k in ks] + [f"db?.*{k}" for k in ks]
    names = [f"db{k % 7}.t{k}{k % 3}" for k in ks] + [f"db1.x{k}" for k in ks]
    df = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(p,) for p in rules], "pattern string")
    assert ig.candidates(*df).count() < 10 * len(names)
    want = {(n, p) for k in ks for p in (f"*.t{k}?", f"*3.t{k}*1", f"??.t{k}*", f"db?.*{k}") for n in (f"db{k % 7}.t{k}{k % 3}", f"db1.x{k}") if fnmatch.fnmatchcase(n, p)}
    got = {tuple(r) for r in ig.matches(*df).collect()}
    assert want <= got and all(fnmatch.fnmatchcase(*x) for x in got)
