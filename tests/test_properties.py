"""Property tests: the keyed diff against a brute-force reference on random
small tables (unique keys, nulls, changed cells, missing/extra keys)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from relcheck.operators import tablediff as td

TEXT = st.one_of(st.none(), st.sampled_from(["a", "b"]))
ROW = st.tuples(TEXT, TEXT, st.one_of(st.none(), st.integers(min_value=-3, max_value=3)))  # two nullable columns of one type
TABLE = st.dictionaries(st.one_of(st.none(), st.integers(min_value=0, max_value=8)), ROW, max_size=9)


def brute(e: dict, a: dict) -> set:
    def text(k):
        return "<null>" if k is None else str(k)

    out = {(text(k), None, "MISSING") for k in e.keys() - a.keys()}
    out |= {(text(k), None, "UNEXPECTED") for k in a.keys() - e.keys()}
    for k in e.keys() & a.keys():
        for name, x, y in zip(("s", "t", "n"), e[k], a[k]):
            if x != y:
                out.add((text(k), name, "CHANGED"))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(e=TABLE, a=TABLE)
def test_keyed_diff_matches_brute_force(spark, e, a):
    schema = "k long, s string, t string, n int"
    de = spark.createDataFrame([(k, *v) for k, v in e.items()], schema)
    da = spark.createDataFrame([(k, *v) for k, v in a.items()], schema)
    got = {(r.object_key, r.field, r.status) for r in td.diff_keyed(de, da, ["k"]).collect()}
    assert got == brute(e, a)
