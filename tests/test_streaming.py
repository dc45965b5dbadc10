"""The streaming ACL gives the batch result, for any split into
micro-batches and across a restart from the checkpoint."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from relcheck.operators import events as ev
from relcheck.plans.acl import CFG
from relcheck.sources.files import new_scratch
from relcheck.sources.fixtures import fixture
from relcheck.streaming import acl as st
from relcheck.streaming import sessions as ss
from relcheck.streaming.counters import CounterListener, counter_table
from tests.conftest import SF


def _batch_sessions(spark):
    src = fixture(spark, SF, "acl_source")
    valid, _ = ev.split_valid(ev.trim_strings(ev.filter_view_only(src, CFG.view_only)))
    return {tuple(r) for r in ev.flatten(ev.session_interactions(valid, CFG)).drop("event_id").collect()}


def test_sessions_stream_with_restart(spark):
    src = fixture(spark, SF, "acl_source")
    path, out, ck = (new_scratch(spark, n) for n in ("src", "out", "ckpt"))
    mid = src.agg(F.max("event_id")).first()[0] // 2
    lo = src.where(F.col("event_id") < mid)
    hi = src.where(F.col("event_id") >= mid)
    st.stage_source_files(lo, path, "event_id", n_files=3)
    st.run_available_now(st.sessions_stream(st.read_events(spark, path, 1), CFG), out, ck)
    first = spark.read.parquet(out).count()
    st.stage_source_files(hi, path, "event_id", n_files=2)   # new files arrive; query restarts
    st.run_available_now(st.sessions_stream(st.read_events(spark, path, 1), CFG), out, ck)
    got = st.session_interactions(spark.read.parquet(out), CFG)
    rows = {tuple(r[c] for c in got.columns) for r in got.collect()}
    exp = _batch_sessions(spark)
    assert first > 0 and len(rows) == len(exp)
    assert {r[:2] for r in rows} == {r[:2] for r in exp}


NARROW = ("event_id long, application_software string, event_ts timestamp_ntz, customer_id string, client_id string, "
          "event_type_cd string, event_response_txt string, session_id string")
HOUR = dt.timedelta(hours=1)
DAY = dt.datetime(2024, 1, 1)
DAY_US, HOUR_US = int(DAY.replace(tzinfo=dt.UTC).timestamp()) * 1_000_000, 3_600_000_000


def _events(spark, rows):
    """rows: (offset, hour, customer, code)"""
    return spark.createDataFrame([(i, "mra-web", DAY + h * HOUR, c, None, code, None, "s") for i, h, c, code in rows], NARROW)


def _sessions_of(spark, batches, cfg=CFG, restart=False, **options):
    """(customer, closed_by, hour of start, offset of the end) of a stream that
    gets one file a micro-batch; with ``restart`` each by a new run."""
    path, out, ck = (new_scratch(spark, n) for n in ("src", "out", "ckpt"))
    for i, rows in enumerate(batches):
        st.stage_source_files(_events(spark, rows), path, "event_id", n_files=1)
        if restart or i == len(batches) - 1:
            st.run_available_now(st.sessions_stream(st.read_events(spark, path, 1), cfg, **options), out, ck)
    return sorted(((r.customer_id, r.closed_by, (r.interaction_start - DAY) / HOUR, r.event_id) for r in spark.read.parquet(out).collect()), key=repr)


def test_idle_sessions_close_and_stay_closed(spark):
    batches = [[(1, 0, "a", "click"), (2, 0, "b", "click")],
               [(3, 2, "b", "click")],             # b goes on in time, a is idle for two hours
               [(4, 10, "c", "click")],            # time passes: a and b are idle
               [(5, 10, "a", "purchase"), (6, 10, "b", "purchase"), (7, 10, "c", "purchase")]]
    want = [("a", "idle", 0.0, None), ("b", "idle", 0.0, None), ("c", "end", 10.0, 7)]
    assert _sessions_of(spark, batches, idle="3 hours", late="1 hour") == want
    # a restart keeps timers and tombstones; without a limit nothing is ever idle
    assert _sessions_of(spark, batches, restart=True, idle="3 hours", late="1 hour") == want
    assert _sessions_of(spark, batches) == [("a", "end", 0.0, 5), ("b", "end", 0.0, 6), ("c", "end", 10.0, 7)]


def test_rows_of_a_batch_in_any_order(spark):
    batches = [[(5, 5, "a", "purchase"), (2, 2, "a", "click"), (9, 0, "a", "click"), (4, 4, "a", "purchase"), (3, 1, "a", "click")], [(10, 0, "a", "purchase")]]
    assert _sessions_of(spark, batches) == [("a", "end", 1.0, 4)]


def test_start_from_a_table_of_open_sessions(spark):
    before = _events(spark, [(1, 3, "a", "click"), (2, 1, "a", "click"), (3, 1, "b", "click"), (4, 2, "b", "purchase")])
    table = st.open_state(before, CFG.end_codes)
    assert [tuple(r)[:2] for r in table.collect()] == [("a", "s")]
    got = _sessions_of(spark, [[(5, 8, "a", "purchase"), (6, 9, "c", "purchase")]], start_from=table)
    assert got == [("a", "end", 1.0, 5), ("c", "end", 9.0, 6)]


@pytest.mark.parametrize("idle", [None, "3 hours"])
def test_sessions_that_share_a_slot_stay_apart(spark, idle):
    """One slot for all keys, as one key a slot: ends, tombstones, timers that
    fall together and a start table."""
    batches = [[(1, 0, "a", "click"), (2, 0, "b", "click"), (3, 1, "c", "purchase")], [(4, 2, "b", "click"), (5, 2, "c", "purchase")],
               [(6, 12, "d", "click")], [(7, 12, "a", "purchase"), (8, 12, "b", "purchase"), (9, 12, "d", "purchase"), (10, 12, "e", "purchase"), (11, 12, "z", "purchase")]]
    table = st.open_state(_events(spark, [(-2, -1, "e", "click"), (-1, -1, "z", "click")]), CFG.end_codes)
    got = []
    for slots in (1, ss.SLOTS):
        path, out, ck = (new_scratch(spark, n) for n in ("src", "out", "ckpt"))
        for rows in batches:
            st.stage_source_files(_events(spark, rows), path, "event_id", n_files=1)
        valid = st.valid_events(st.read_events(spark, path, 1), CFG)
        st.run_available_now(ss.sessions(ev.flag_in(valid, "event_type_cd", CFG.end_codes, "is_end"), idle, "1 hour", table, slots), out, ck)
        got.append(sorted((r.customer_id, r.closed_by, (r.interaction_start_us - DAY_US) // HOUR_US, r.n_events, r.event_id or 0) for r in spark.read.parquet(out).collect()))
    assert got[0] == got[1]
    if idle:
        assert got[0] == [("a", "idle", 0, 1, 0), ("b", "idle", 0, 2, 0), ("c", "end", 1, 1, 3), ("d", "end", 12, 2, 9), ("e", "idle", -1, 1, 0), ("z", "idle", -1, 1, 0)]
    else:
        assert got[0] == [("a", "end", 0, 2, 7), ("b", "end", 0, 3, 8), ("c", "end", 1, 1, 3), ("d", "end", 12, 2, 9), ("e", "end", -1, 2, 10), ("z", "end", -1, 2, 11)]


def test_files_of_a_delivery_grow_with_its_rows(spark):
    """No single file or task takes all events of a delivery."""
    path = new_scratch(spark, "src")
    st.stage_source_files(spark.range(2_000_000).selectExpr("id AS event_id", "uuid() AS text").repartition(8), path, "event_id", n_files=None)
    files = spark.read.parquet(path).select("event_id", F.input_file_name().alias("f")).groupBy("f").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).collect()
    spans = sorted((r.lo, r.hi) for r in files)
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_end_codes_change_in_a_running_stream(spark):
    """By offset: a change holds for events at or after its offset, whatever
    batch they come in, and for those processed after it arrived."""
    lst = new_scratch(spark, "changes")
    for rows in ([(0, "purchase", True)], [(10, "purchase", False), (10, "click", True), (20, "click", False)]):
        spark.createDataFrame(rows, st.CHANGES_SCHEMA).coalesce(1).write.mode("append").parquet(lst)
    batches = [[(1, 0, "a", "click"), (2, 1, "a", "purchase"), (3, 2, "b", "click")],
               [(9, 3, "c", "purchase"), (11, 4, "d", "purchase"), (12, 5, "b", "click"), (21, 6, "d", "click"), (22, 7, "e", "purchase")]]
    got = _sessions_of(spark, batches, changes=st.read_changes(spark, lst, 1))
    assert got == [("a", "end", 0.0, 2), ("b", "end", 2.0, 12), ("c", "end", 3.0, 9)]


def test_end_codes_from_a_table_of_any_size(spark):
    src = fixture(spark, SF, "acl_source")
    path, out, ck = (new_scratch(spark, n) for n in ("src", "out", "ckpt"))
    st.stage_source_files(src, path, "event_id")
    codes = spark.range(20_000).selectExpr("concat('code', id) AS c").union(spark.sql("SELECT 'purchase'"))
    cfg = ev.AclConfig(end_codes=codes)
    st.run_available_now(st.sessions_stream(st.read_events(spark, path), cfg), out, ck)
    got = st.session_interactions(spark.read.parquet(out), CFG)
    assert {tuple(r[:2]) for r in got.collect()} == {r[:2] for r in _batch_sessions(spark)}


def test_foreach_batch_outputs_add_up(spark):
    src = fixture(spark, SF, "acl_source")
    path = new_scratch(spark, "src")
    st.stage_source_files(src, path, "event_id", n_files=3)
    p = {k: new_scratch(spark, k) for k in ("valid", "dead", "metrics", "ck")}
    fn = st.dead_letter_writer(p["valid"], p["dead"], p["metrics"], CFG, F.lit("t"))
    st.run_foreach_batch(st.read_events(spark, path), fn, p["ck"])
    m = {r.metric: r.value for r in spark.read.parquet(p["metrics"]).groupBy("metric")
         .agg(F.sum("value").alias("value")).collect()}
    assert m["received"] == src.count()
    assert m["received"] == m["filtered_view_only"] + m["dead_lettered"] + m["transformed"]
    assert spark.read.parquet(p["valid"]).count() == m["transformed"]
    assert spark.read.parquet(p["dead"]).count() == m["dead_lettered"]


def test_view_only_list_reloaded_per_batch(spark):
    """The list is read from a table by every micro-batch, so a change
    made between batches is used without code change."""
    src = fixture(spark, SF, "acl_source")
    mid = src.agg(F.max("event_id")).first()[0] // 2
    path, lst = new_scratch(spark, "src"), new_scratch(spark, "list")
    p = {k: new_scratch(spark, k) for k in ("valid", "dead", "metrics", "ck")}
    spark.createDataFrame([("view",)], "c string").write.parquet(lst)
    fn = st.dead_letter_writer(p["valid"], p["dead"], p["metrics"], CFG, F.lit("t"), view_only_path=lst)
    st.stage_source_files(src.where(F.col("event_id") < mid), path, "event_id", n_files=1)
    st.run_foreach_batch(st.read_events(spark, path), fn, p["ck"])
    spark.createDataFrame([("view",), ("click",)], "c string").write.mode("overwrite").parquet(lst)
    st.stage_source_files(src.where(F.col("event_id") >= mid), path, "event_id", n_files=1)
    st.run_foreach_batch(st.read_events(spark, path), fn, p["ck"])
    out = spark.read.parquet(p["valid"])
    early = out.where(F.col("event_id") < mid).where("event_event_type_cd = 'click'").count()
    late = out.where(F.col("event_id") >= mid).where("event_event_type_cd = 'click'").count()
    assert early > 0 and late == 0


def test_observed_counters(spark):
    src = fixture(spark, SF, "acl_source")
    path, out, ck = (new_scratch(spark, n) for n in ("src", "out", "ckpt"))
    st.stage_source_files(src, path, "event_id", n_files=2)
    q = (st.stateless(st.read_events(spark, path), CFG, observe_name="acl").writeStream.format("parquet")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination(600)
    got = {"received": 0, "filtered_view_only": 0}
    for p in q.recentProgress:
        m = p.observedMetrics.get("acl") if hasattr(p, "observedMetrics") else None
        if m is not None:
            got["received"] += m["received"]
            got["filtered_view_only"] += m["filtered_view_only"]
    assert got["received"] == src.count()
    assert got["filtered_view_only"] == src.where("event_type_cd = 'view'").count()


@pytest.mark.parametrize("sink", ["foreach", "files"])
def test_six_counters_by_a_listener(spark, sink):
    """Lists given as tables; a batch that is replayed counts once, whether the
    sink runs it again or knows that it has it."""
    import glob
    import os
    src = fixture(spark, SF, "acl_source")
    path, out, ck, kept = (new_scratch(spark, n) for n in ("src", "out", "ckpt", "counters"))
    cfg = ev.AclConfig(view_only=spark.sql("SELECT 'view' AS c"), end_codes=spark.sql("SELECT 'purchase' AS c"))
    st.stage_source_files(src, path, "event_id", n_files=3)
    want = {r.metric: r.value for r in ev.metrics(src, CFG).collect()}

    def run():
        listener = CounterListener(spark, kept)
        spark.streams.addListener(listener)
        try:
            closed = st.sessions_stream(st.read_events(spark, path, 2), cfg, observe_name="acl")
            if sink == "files":
                st.run_available_now(closed, out, ck)
            else:
                st.run_foreach_batch(closed, lambda batch, _: batch.write.format("noop").mode("overwrite").save(), ck)
            time.sleep(5)  # progress events come a little later
        finally:
            spark.streams.removeListener(listener)
        return listener

    first = run()
    assert first.totals() == want and len({b for _, b, _ in first.seen}) == 2
    last = max(glob.glob(f"{ck}/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    for f in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):  # as if the run had ended before the commit
        os.remove(f)
    again = run()
    assert again.seen if sink == "foreach" else not again.seen
    assert set(again.seen) < set(first.seen)
    assert {r.metric: r.value for r in counter_table(spark, kept).collect()} == want
