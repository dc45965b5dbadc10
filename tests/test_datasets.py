"""Flat XML datasets of several tables, no column given."""

import pytest

from relcheck.sources import datasets as ds

TEXT = """<?xml version="1.0"?>
<!-- three tables -->
<dataset>
  <app.a id="1"/> <app.b
     x="a &gt; b" y=""/><app.a id="2" name="n &amp; &quot;m&quot;"
 late='it'/>
  <app.c k="1 > 0" />
  <app.b z="3"></app.b>
  <app.none/>
</dataset>
"""


@pytest.mark.parametrize("size", ["128m", "24"])
def test_three_tables_whose_first_rows_lack_columns(spark, tmp_path, size):
    (tmp_path / "d.xml").write_text(TEXT)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = ds.read_dataset(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {t: df.columns for t, df in got.items()} == {"app.a": ["id", "name", "late"], "app.b": ["x", "y", "z"], "app.c": ["k"], "app.none": []}
    rows = {t: sorted((tuple(r) for r in df.collect()), key=str) for t, df in got.items()}
    assert rows["app.a"] == [("1", None, None), ("2", 'n & "m"', "it")] and rows["app.c"] == [("1 > 0",)]
    assert rows["app.b"] == sorted([("a > b", "", None), (None, None, "3")], key=str) and got["app.none"].count() == 1


def test_round_trip(spark, tmp_path):
    a = spark.createDataFrame([(1, None, "x<y>&\"'"), (2, "", " spaced "), (3, "line", None)], "id int, v string, w string")
    b = spark.range(5).selectExpr("id", "if(id > 2, cast(id / 2 as double), null) half")
    ds.write_dataset({"s.a": a, "s.b": b, "t.c": a.select("id")}, str(tmp_path / "out"))
    got = ds.read_dataset(spark, str(tmp_path / "out"))
    assert sorted(got) == ["s.a", "s.b", "t.c"]
    assert sorted(map(tuple, got["s.a"].select("id", "v", "w").collect())) == [("1", None, "x<y>&\"'"), ("2", "", " spaced "), ("3", "line", None)]
    assert sorted(map(tuple, got["s.b"].select("id", "half").collect()), key=str) == [("0", None), ("1", None), ("2", None), ("3", "1.5"), ("4", "2.0")]
    assert got["t.c"].count() == 3
