"""Listings of catalogs with gaps."""

from relcheck.functions.text import as_list
from relcheck.operators import listings as ls


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_listings_with_gaps(spark):
    spaces = spark.createDataFrame([(1, "app", 7), (2, "old", 8), (3, "pg_catalog", 7), (4, None, 7)], "oid int, nspname string, nspowner int")
    roles = spark.createDataFrame([(7, "owner")], "oid int, rolname string")
    assert rows(ls.schemas(spaces, roles)) == [("app", "owner"), ("old", None)]
    types = spark.createDataFrame([("a", 1, "e", None), ("b", 1, "p", None), ("c", 9, "b", "x"), ("d", 3, "b", None), ("e", 2, "r", "1"), ("f", 1, None, None)],
                                  "typname string, typnamespace int, typtype string, typdefault string")
    assert rows(ls.user_types(types, spaces)) == [("app", "a", "enum", "app.a", None), ("old", "e", "range", "old.e", "1")]
    procs = spark.createDataFrame([("f", 1, 5, None, "void", " x  y "), ("g", 1, 6, "int", None, None), ("h", 3, 5, None, None, None)],
                                  "proname string, pronamespace int, prolang int, args string, returns string, source string")
    lang = spark.createDataFrame([(5, "sql")], "oid int, lanname string")
    assert [r[:5] for r in rows(ls.functions(procs, spaces, lang))] == [("app", "f", "", "void", "sql")]
    assert [r[:5] for r in rows(ls.functions(procs, spaces, lang, keep_unknown_language=True))] == [("app", "f", "", "void", "sql"), ("app", "g", "int", None, None)]
    grants = spark.createDataFrame([("app", "t", "SELECT", "r", None, "NO"), ("information_schema", "t", "SELECT", "r", None, "NO"), (None, "t", "SELECT", "r", None, "NO")],
                                   ", ".join(f"{c} string" for c in ls.TABLE_PRIVILEGES))
    listed = ls.as_rows("p", ls.plain(grants, ls.TABLE_PRIVILEGES), ls.TABLE_PRIVILEGES[:4])
    assert rows(listed) == [("p", "app.t.SELECT.r", "grantor", None), ("p", "app.t.SELECT.r", "is_grantable", "NO")]


def test_as_list(spark):
    df = spark.createDataFrame([("a", ["x", None]), (None, None)], "one string, many array<string>")
    assert [tuple(r) for r in df.select(as_list(df, "one"), as_list(df, "many")).collect()] == [(["a"], ["x", None]), ([], [])]
