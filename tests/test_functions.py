import pytest
from pyspark.sql import functions as F

from relcheck.functions.text import (definition_hash, glob_match, glob_to_regex, lenient,
                                     normalize_text, session_key)
from relcheck.functions.time import epoch_millis_to_ts, iso8601_utc


@pytest.mark.parametrize("pattern,text,ok", [
    ("db1.*", "db1.t5", True), ("db1.*", "db10.t5", False), ("db?.t1*", "db3.t15", True),
    ("db?.t1*", "db33.t15", False), ("a[!b]c", "axc", True), ("a[!b]c", "abc", False),
    ("*", "x.y.z", True), ("T*", "t1", False), ("a[[]b", "a[b", True), ("a[]]b", "a]b", True), ("[!]", "[!]", True),
    ("a[b", "a[b", True), ("[a&&b]", "&", True), ("[z-a]", "m", False), ("[^a]", "^", True), ("[a-c^]x", "bx", True),
    ("a*b", "a\n.b", True), ("a", "a\n", False), ("a.b", "axb", False), ("[!-]x", "-x", False), ("{a}", "{a}", True),
])
def test_glob(spark, pattern, text, ok):
    import fnmatch
    assert fnmatch.fnmatchcase(text, pattern) == ok
    got = spark.createDataFrame([(text,)], "t string").select(glob_match(F.col("t"), [pattern]).alias("m")).first().m
    assert got == ok and glob_to_regex(pattern).startswith("(?s)")


def test_scalar_functions(spark):
    df = spark.createDataFrame([("  a \t b\n c  ", "1", "23", 1_700_000_123_456),
                                (None, "12", "3", 0)], "s string, c string, k string, ms long")
    r = df.select(normalize_text("s").alias("n"), definition_hash("s").alias("h"),
                  session_key("c", "k").alias("key"),
                  F.date_format(epoch_millis_to_ts("ms"), "yyyy-MM-dd HH:mm:ss").alias("ts"),
                  glob_match(F.col("c"), ["1*"]).alias("g")).collect()
    assert r[0]["n"] == "a b c" and r[1]["n"] == ""
    import hashlib
    assert r[0]["h"] == hashlib.sha256(b"a b c").hexdigest()
    # the display key is ambiguous, which is why grouping uses the pair
    assert r[0]["key"] == r[1]["key"] == "123"
    assert r[0]["ts"] == "2023-11-14 22:15:23"
    assert [x["g"] for x in r] == [True, True]


def test_lenient_and_iso(spark):
    df = spark.createDataFrame([(0, "", "2024-01-01 00:00:07.179575")], "n int, s string, t string")
    r = df.select(lenient("n", "number").alias("n"), lenient("s", "string").alias("s"),
                  iso8601_utc(F.to_timestamp("t")).alias("iso")).first()
    assert r["n"] is None and r["s"] is None
    assert r["iso"] == "2024-01-01T00:00:07.179+0000"
