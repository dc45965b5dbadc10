"""Records over several lines, numbered in file order, over many input splits."""

import csv
import io
import json
import random

import pytest

from relcheck.sources import records as rec


@pytest.fixture()
def many_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def rows_of(seed, n):
    r = random.Random(seed)
    pieces = ["a", 'b"c', "line\nbreak", ",", '""', "", "x" * 300, "\n\n", "é,東", 'say "hi"\nthen', "#", "\\"]
    return [[str(i), "".join(r.choice(pieces) for _ in range(r.randrange(4))), r.choice(["plain", "two words", "3"])] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_rows_of_many_splits(spark, tmp_path, many_splits, end):
    want = {}
    for f in range(3):
        rows = rows_of(f, 120)
        out = io.StringIO()
        w = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL if f else csv.QUOTE_MINIMAL)
        w.writerow(["id", "note", "kind"])
        w.writerows(rows)
        text = out.getvalue()
        (tmp_path / f"f{f}.csv").write_text(text if f < 2 else text.rstrip("\r\n") + end + end, newline="")
        want[f"f{f}.csv"] = rows
    got = rec.read_csv_records(spark, str(tmp_path), ["id", "note", "kind"], pattern="*.csv")
    lines = rec.read_lines(spark, str(tmp_path), "*.csv")
    assert lines.select("file_path", "split").distinct().count() > 20
    by = {}
    for x in got.collect():
        by.setdefault(x.file_path.rsplit("/", 1)[-1], []).append((x.row_no, [x.id, x.note or "", x.kind]))
    assert {f: [r for _, r in sorted(x)] for f, x in by.items()} == want
    assert all(sorted(n for n, _ in x) == list(range(1, 121)) for x in by.values())


def test_json_documents_of_many_splits(spark, tmp_path, many_splits):
    r = random.Random(2)
    docs = [{"i": i, "s": r.choice(['} "quoted" {', "[", "back\\slash\\", "plain"]), "l": [1, {"x": "]"}] * r.randrange(4)} for i in range(150)]
    texts = [json.dumps(x, indent=r.choice([None, 1, 4])) for x in docs]
    (tmp_path / "a.json").write_text("\n".join(texts) + "\n")
    (tmp_path / "b.json").write_text("\n\n".join(texts[::-1]))
    got = {}
    for x in rec.read_json_records(spark, str(tmp_path), "*.json").collect():
        got.setdefault(x.file_path.rsplit("/", 1)[-1], []).append((x.row_no, x.payload))
    assert {f: [p for _, p in sorted(x)] for f, x in got.items()} == {"a.json": texts, "b.json": texts[::-1]}
    assert [n for n, _ in sorted(got["a.json"])] == list(range(1, 151))


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,note\n")
    assert rec.read_csv_records(spark, str(tmp_path), ["id", "note"]).count() == 0
    (tmp_path / "c.csv").write_text('\n\nid,note\n\n1,"a\n\nb"\n\n')
    got = [(r.row_no, r.id, r.note) for r in rec.read_csv_records(spark, str(tmp_path), ["id", "note"]).collect()]
    assert got == [(1, "1", "a\n\nb")]
