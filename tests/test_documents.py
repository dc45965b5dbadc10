from relcheck.operators import documents as doc


def test_canonical_leaves_ignore_order_and_keys(spark):
    a = spark.createDataFrame([(1, '{"info":{"h":1},"t":[{"n":"a","remarks":"x"},{"n":"b"}],"d":"select  1"}')],
                              "doc_id long, doc string")
    b = spark.createDataFrame([(1, '{"info":{"h":2},"t":[{"n":"b"},{"n":"a","remarks":"y"}],"d":"select 1"}')],
                              "doc_id long, doc string")
    la = doc.leaves(a, "doc_id", "doc", ["remarks"], ["info"], (), ["d"])
    lb = doc.leaves(b, "doc_id", "doc", ["remarks"], ["info"], (), ["d"])
    assert doc.leaf_diff(la, lb).count() == 0
    paths = sorted(r.path for r in la.collect())
    assert paths == ["$.d", "$.t[]", "$.t[]"]


def test_rules_hold_at_any_depth(spark):
    deep = ['{"a":' * 400 + f'{{"remarks":"{x}","l":[{y}]}}' + '}' * 400 for x, y in (("x", "1,2"), ("y", "2,1"), ("x", "1,3"))]
    df = spark.createDataFrame([(1, t) for t in deep], "doc_id long, doc string")
    one = [doc.leaves(df.where(df.doc == t), "doc_id", "doc", ["remarks"]) for t in deep]
    assert doc.leaf_diff(one[0], one[1]).count() == 0 and doc.leaf_diff(one[0], one[2]).count() == 2


def test_elements_are_wholes_and_nothing_vanishes(spark):
    def diff(x, y, **rules):
        e, a = (spark.createDataFrame([(1, t)], "doc_id long, doc string") for t in (x, y))
        return sorted((r.status, r.field, r.expected or r.actual) for r in doc.document_diff(e, a, "doc_id", "doc", **rules).collect())

    assert len(diff('[{"a":1,"b":2},{"a":3,"b":4}]', '[{"a":1,"b":4},{"a":3,"b":2}]')) == 4
    assert diff('[{"a":1,"b":[2,1]},3]', '[3,{"b":[1,2],"a":1}]') == []
    assert diff('{"x":{}}', "{}") == [("MISSING", "$.x", "{}"), ("UNEXPECTED", "$", "{}")]
    assert diff("{bad", "{worse") == [("MISSING", "$", "{bad"), ("UNEXPECTED", "$", "{worse")]
    assert diff(None, "null") == [("MISSING", "$", "<null>"), ("UNEXPECTED", "$", "null")]
    for x, y in (("1.0", "1"), ("10e-1", "1"), ("-0.0", "0"), ("1.50", "15e-1"), ("1" + "0" * 60, "1e60")):
        assert diff(f'{{"n":{x}}}', f'{{"n":{y}}}') == []
    assert diff('{"n":1.5}', '{"n":-1.05}') == [("MISSING", "$.n", "1.5"), ("UNEXPECTED", "$.n", "-1.05")]
    assert len(diff('{"n":100000000000000000001}', '{"n":100000000000000000002}')) == 2
    # names are no paths, and every member of a repeated key counts
    assert diff('{"a.b":1}', '{"a":{"b":1}}') == [("MISSING", "$.a\\.b", "1"), ("UNEXPECTED", "$.a.b", "1")]
    assert diff('{"a[]":1}', '{"a":[1]}') == [("MISSING", "$.a\\[\\]", "1"), ("UNEXPECTED", "$.a[]", "1")]
    assert diff('{"a\\\\":{"b":1}}', '{"a\\\\.b":1}') != [] and diff('{"k":1,"k":2}', '{"k":2}') == [("MISSING", "$.k", "1")]
    assert diff('{"k":2,"k":1}', '{"k":1,"k":2.0}') == []
    # nothing but the shape differs
    ((status, field, _),) = diff('{"a":[1],"a":[2]}', '{"a":[1,2]}')
    assert (status, field) == ("CHANGED", "$")
    assert diff('{"d":"a  b"}', '{"d":"a b "}', normalize_keys=["d"]) == []


def test_root_filter(spark):
    df = spark.createDataFrame([(1, '{"x":1,"y":2,"z":3}')], "doc_id long, doc string")
    keys = sorted(r.root_key for r in doc.root_keys(df, "doc_id", "doc", ["x", "y"], ["y"]).collect())
    assert keys == ["x"]
