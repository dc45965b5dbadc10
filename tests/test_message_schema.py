"""Messages of several source systems, each by its own schema."""

import json

from relcheck.operators import message_schema as ms

RULES = [
    ("A", 1, "id", "string", True, None), ("A", 2, "kind", "string", False, "none"), ("A", 3, "day", "date", False, None), ("A", 4, "tags", "array<string>", False, None),
    ("B", 1, "id", "long", True, None), ("B", 2, "rate", "double", False, "1.5"), ("B", 3, "on", "boolean", True, None),
    ("C", 1, "who.name", "string", True, None), ("C", 2, "who.age", "long", False, None), ("C", 3, "sizes", "array<long>", False, None), ("C", 4, "any", "object", False, None)]
TOPICS = {"A": "t-a", "B": "t-b", "C": "t-c"}


def schema(spark):
    return spark.createDataFrame(RULES, ms.SCHEMA)


def test_csv_records_by_their_system(spark):
    rows = [("A", "7", "", "2024-02-29", '["x", "y"]', None), ("A", " \t", "k", "2024-02-30", "[1]", None), ("B", " 12 ", None, None, "", "TRUE"), ("B", "1.5", "x", None, None, ""),
            ("Z", "1", None, None, None, None), (None, "1", None, None, None, None), ("A", 'say "hi"\n\\', None, None, "[]", None), ("B", "3", "NaN", None, None, "false")]
    df = spark.createDataFrame([("f", i, r[0], r[1], r[2], r[3], r[4], r[5], r[2]) for i, r in enumerate(rows)],
                               "file_name string, row_no int, source_system string, id string, kind string, day string, tags string, on string, rate string")
    out = ms.csv_messages(df, schema(spark), ["id", "kind", "day", "tags", "on", "rate"], TOPICS).orderBy("row_no").collect()
    assert [r.reasons for r in out] == [
        [], ["id is required", "day is not a valid date", "tags is not a valid array<string>"], [], ["id is not a valid long", "rate is not a valid double", "on is required"],
        ["unknown source system"], ["unknown source system"], [], ["rate is not a valid double"]]
    assert [json.loads(r.value) if r.value else None for r in out] == [
        {"id": "7", "kind": "none", "day": "2024-02-29", "tags": ["x", "y"]}, None, {"id": 12, "rate": 1.5, "on": True}, None, None, None,
        {"id": 'say "hi"\n\\', "kind": "none", "day": None, "tags": []}, None]
    assert list(json.loads(out[0].value)) == ["id", "kind", "day", "tags"] and out[0].topic == "t-a"


def checked(spark, rows, **options):
    df = spark.createDataFrame([("f", i, s, p) for i, (s, p) in enumerate(rows)], "file_name string, row_no int, source_system string, body string")
    return ms.json_messages(df, schema(spark), "body", **options)


def test_json_payloads_strict_and_raw(spark):
    rows = [("C", '{"who": {"name": "x", "age": 3}, "sizes": [1, 2], "any": {"deep": {"er": 1}}}'), ("C", '{"who": {"age": "3"}, "sizes": [1, "2"], "more": 1}'),
            ("C", '{"who": null}'), ("C", "[1]"), ("C", "{bad"), (None, "{}"), ("A", '{"id": "1", "kind": null, "day": "2024-01-01", "tags": []}'),
            ("A", '{"id": 1, "day": "soon", "tags": "x"}'), ("C", None), ("B", '{"id": 5, "rate": 2, "on": false}'), ("C", '{"who": {"name": "x", "extra": {"y": 1}}}')]
    out = checked(spark, rows).orderBy("row_no").collect()
    assert [r.reasons for r in out] == [
        [], ["who.name is required", "who.age is not a valid long", "sizes is not a valid array<long>", "more is not in the schema"],
        ["who.name is required"], ["payload is not a JSON object"], ["payload is not a JSON object"], ["unknown source system"], [],
        ["id is not a valid string", "day is not a valid date", "tags is not a valid array<string>"], ["payload is not a JSON object"], [],
        ["who.extra is not in the schema", "who.extra.y is not in the schema"]]
    assert [r.payload for r in out] == [p for _, p in rows]
    assert all(r.reasons == [] for r in checked(spark, rows, strict=False).collect())


def test_summary_tells_reasons(spark):
    rows = [("C", "{bad"), ("C", "[1]"), ("C", '{"who": {"name": "x"}}'), ("C", '{"who": {"age": 1}}'), (None, "{}"), ("B", '{"id": 5, "on": true}')]
    got = {r.source_system: tuple(r)[2:] for r in ms.run_summary(checked(spark, rows)).collect()}
    assert got == {"C": (4, 1, 3, "payload is not a JSON object: 2; who.name is required: 1"), None: (1, 0, 1, "unknown source system: 1"), "B": (1, 1, 0, "")}
