import datetime as dt

from pyspark.sql import functions as F

from relcheck.operators import events as ev

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def rows(spark, data):
    return spark.createDataFrame(
        [(i, app, T0 + dt.timedelta(minutes=m) if m is not None else None, c, cl, code, txt, s)
         for i, app, m, c, cl, code, txt, s in data], ev.SOURCE_SCHEMA)


def test_filter_trim_validate(spark):
    src = rows(spark, [
        (1, "mra-web", 0, " 7 ", None, "view", None, "s1"),      # view-only: dropped silently
        (2, "mra-web", 1, "   ", "C1", "click", None, "s1"),     # blank customer -> dead letter
        (3, "mra-web", None, "7", "C1", None, None, "s1"),       # null time and code -> 2 reasons
        (4, "x", 2, " 7", "C1", "click", " ok ", "s1"),          # valid, trimmed
    ])
    kept = ev.filter_view_only(src, ["view"])
    assert sorted(r.event_id for r in kept.collect()) == [2, 3, 4]
    valid, invalid = ev.split_valid(ev.trim_strings(ev.keep_original(kept)))
    v = valid.collect()
    assert [(r.event_id, r.customer_id, r.event_response_txt) for r in v] == [(4, "7", "ok")]
    dl = {r.event_id: r for r in ev.dead_letter(invalid, F.lit("t"), "topic").collect()}
    assert set(dl) == {2, 3}
    assert dl[3].reason == f"{ev.REASON_TS}; {ev.REASON_CODE}"
    assert '"customer_id":"   "' in dl[2].payload  # original payload, untrimmed
    assert '"client_id":null' in dl[3].payload or '"event_type_cd":null' in dl[3].payload


def test_sessions_first_end_wins_and_later_ignored(spark):
    src = rows(spark, [
        (1, "mra-web", 5, "7", "C1", "click", "a", "s1"),
        (2, "mra-ivr", 1, "7", "C2", "signup", "b", "s1"),       # earliest time, before the end
        (3, "mra-mobile", 9, "7", "C3", "purchase", "end", "s1"),  # first end -> closes
        (4, "mra-web", 0, "7", "C4", "purchase", "dup", "s1"),   # after close: ignored
        (5, "mra-web", 3, "8", "C1", "click", "open", "s1"),     # never closes
        (6, "mra-web", 3, "7", "C1", "purchase", "other", "s2"),  # other session
    ])
    cfg = ev.AclConfig()
    s = {r.session_id: r for r in ev.session_interactions(src, cfg).collect() if r.customer_id == "7"}
    assert set(s) == {"s1", "s2"}
    r = s["s1"]
    assert r.interaction_start_ts == "2024-01-01T10:01:00.000+0000"
    assert (r.event.client_id, r.event.event_type_cd, r.event.event_response_text) == ("C3", "purchase", "end")
    assert r.event_type == "MOBILE"
    o = ev.open_sessions(src, cfg.end_codes).collect()
    assert [(x.customer_id, x.n_events) for x in o] == [("8", 1)]


def test_enum_map_dict_and_frame(spark):
    src = spark.createDataFrame([("mra-web",), ("zzz",), (None,)], "application_software string")
    a = ev.map_event_type(src, {"mra-web": "WEB"}).collect()
    lk = spark.createDataFrame([("mra-web", "WEB")], "k string, v string")
    b = ev.map_event_type(src, lk).collect()
    assert sorted((r[0] or "", r[1]) for r in a) == sorted((r[0] or "", r[1]) for r in b)
    assert sorted(r.event_type for r in a) == ["UNKNOWN", "UNKNOWN", "WEB"]
    un = ev.unmapped_values(src, {"mra-web": "WEB"}).collect()
    assert sorted((r[0] or "") for r in un) == ["", "zzz"]


def test_view_only_list_as_frame(spark):
    src = rows(spark, [(1, "a", 0, "1", None, "view", None, "s"), (2, "a", 0, "1", None, None, None, "s")])
    lst = spark.createDataFrame([("view",)], "c string")
    assert [r.event_id for r in ev.filter_view_only(src, lst).collect()] == [2]


def test_metrics_add_up(spark):
    from relcheck.sources.fixtures import fixture
    from tests.conftest import SF
    src = fixture(spark, SF, "acl_source")
    m = {r.metric: r.value for r in ev.metrics(src, ev.AclConfig()).collect()}
    assert m["received"] == m["filtered_view_only"] + m["dead_lettered"] + m["transformed"]


def test_publish_order(spark):
    src = rows(spark, [(i, "a", i, str(i % 3), None, "click", None, "s") for i in range(30)])
    pub = ev.order_for_publish(src, ["customer_id"], "event_id", 4)
    inv = ev.order_inversions(pub, ["customer_id"], "event_id").collect()
    assert all(r.inversions == 0 and r.n_partitions == 1 for r in inv)


def test_sessions_chunked_equals_single_chunk(spark):
    from relcheck.sources.fixtures import fixture
    from tests.conftest import SF
    src = fixture(spark, SF, "acl_source")
    valid, _ = ev.split_valid(ev.trim_strings(ev.filter_view_only(src, ["view"])))
    a = {tuple(r) for r in ev.sessions(valid, ["purchase"], chunk_size=1 << 40).collect()}
    b = {tuple(r) for r in ev.sessions(valid, ["purchase"], chunk_size=7).collect()}
    assert a == b and len(a) > 0


def test_publish_order_detects_inversions(spark):
    src = rows(spark, [(i, "a", i, str(i % 3), None, "click", None, "s") for i in range(30)])
    bad = src.orderBy(F.desc("event_id")).coalesce(1)
    inv = {r.customer_id: r.inversions for r in ev.order_inversions(bad, ["customer_id"], "event_id").collect()}
    assert inv == {"0": 9, "1": 9, "2": 9}
