"""Sink rows of repeated deliveries."""

from relcheck.operators import migrate as mg


def test_deliveries_in_any_order_give_the_same_sink(spark):
    schema = "event_id long, customer_id string, event_type_description string"
    have = spark.createDataFrame([(1, "a", "old"), (None, "n", "x")], schema)
    rows = [(1, "a", "new"), (2, "b", "z"), (2, "b", "y"), (2, "b", None), (None, "n", "x"), (None, "n", "w"), (None, "n", "w"), (3, None, None)]
    want = {(1, "a", "old"), (None, "n", "x"), (2, "b", None), (None, "n", "w"), (3, None, None)}
    once = None
    for order in (rows, rows[::-1]):
        once = mg.sink_upsert(have, spark.createDataFrame(order, schema).repartition(3), ["event_id"])
        got = [tuple(r) for r in once.collect()]
        assert len(got) == len(want) and set(got) == want
    again = mg.sink_upsert(once, spark.createDataFrame(rows, schema), ["event_id"])
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
