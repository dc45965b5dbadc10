"""Registered queries: the event ACL as streams (E15-E19). Each query lands
``acl_source`` as files of offset ranges in a fresh folder, runs the stream with
``availableNow``, and returns what the sink holds, which must equal the batch
result (same oracle SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from relcheck.operators import events as ev
from relcheck.plans.acl import CFG, ORACLE as ACL_ORACLE, RUN_TS
from relcheck.sources.files import new_scratch
from relcheck.sources.fixtures import fixture
from relcheck.streaming import acl as st


def _staged(spark, d):
    path = new_scratch(spark, "acl-source")
    st.stage_source_files(fixture(spark, d, "acl_source"), path, "event_id", n_files=None)
    return path


def q_stream_stateless(spark, d):
    src = _staged(spark, d)
    out, ck = new_scratch(spark, "stateless-out"), new_scratch(spark, "stateless-ckpt")
    st.run_available_now(st.stateless(st.read_events(spark, src), CFG), out, ck)
    return spark.read.parquet(out)


def q_stream_sessions(spark, d):
    src = _staged(spark, d)
    out, ck = new_scratch(spark, "sessions-out"), new_scratch(spark, "sessions-ckpt")
    st.run_available_now(st.sessions_stream(st.read_events(spark, src), CFG), out, ck)
    return st.session_interactions(spark.read.parquet(out), CFG)


def _foreach(spark, d):
    src = _staged(spark, d)
    paths = {k: new_scratch(spark, k) for k in ("valid", "dead", "metrics", "fb-ckpt")}
    fn = st.dead_letter_writer(paths["valid"], paths["dead"], paths["metrics"], CFG, F.lit(RUN_TS))
    st.run_foreach_batch(st.read_events(spark, src), fn, paths["fb-ckpt"])
    return paths


def q_stream_dead_letter(spark, d):
    p = _foreach(spark, d)
    return spark.read.parquet(p["dead"]).drop("batch_id")


def q_stream_metrics(spark, d):
    """The batch counters of all micro-batches, and the sessions published."""
    p = _foreach(spark, d)
    counts = spark.read.parquet(p["metrics"]).groupBy("metric").agg(F.sum("value").alias("value"))
    closed = q_stream_sessions(spark, d).agg(F.count("*").alias("value")).select(F.lit("published").alias("metric"), "value")
    return counts.unionByName(closed)


def q_stream_reload(spark, d):
    """The view-only list is a table, read anew by every micro-batch, and
    changes while the query runs: 'click' joins it after the first batch. Even
    events are delivered first, odd ones second, a delivery a batch."""
    src, lst = new_scratch(spark, "acl-source"), new_scratch(spark, "view-only")
    events = fixture(spark, d, "acl_source")
    for rest in (0, 1):  # two deliveries
        st.stage_source_files(events.where(F.col("event_id") % 2 == rest), src, "event_id", n_files=2)
    spark.createDataFrame([(c,) for c in CFG.view_only], "event_type_cd string").write.parquet(lst)
    p = {k: new_scratch(spark, k) for k in ("valid", "dead", "metrics", "fb-ckpt")}
    write = st.dead_letter_writer(p["valid"], p["dead"], p["metrics"], CFG, F.lit(RUN_TS), view_only_path=lst)

    def then_change(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 0:
            changed = batch.sparkSession.createDataFrame([(c,) for c in [*CFG.view_only, "click"]], "event_type_cd string")
            changed.write.mode("overwrite").parquet(lst)

    st.run_foreach_batch(st.read_events(spark, src, max_files_per_trigger=2), then_change, p["fb-ckpt"])
    return spark.read.parquet(p["valid"]).select("event_id", "event_event_type_cd")


def q_stream_end_codes(spark, d):
    """The end-code list changes while the query runs: up to the middle offset
    'purchase' ends a session, from there on 'click' does. Events and changes are
    each delivered in two parts, a part a micro-batch."""
    src, lst = new_scratch(spark, "acl-source"), new_scratch(spark, "end-codes")
    events = fixture(spark, d, "acl_source")
    middle = events.agg(F.max("event_id")).first()[0] // 2
    versions = [[(0, "purchase", True)], [(middle, "purchase", False), (middle, "click", True)]]
    files = []
    for rows, part in zip(versions, (F.col("event_id") < middle, F.col("event_id") >= middle), strict=True):
        spark.createDataFrame(rows, st.CHANGES_SCHEMA).coalesce(1).write.mode("append").parquet(lst)
        st.stage_source_files(events.where(part), src, "event_id", n_files=None)
        files.append(len(spark.read.schema(ev.SOURCE_SCHEMA).parquet(src).inputFiles()))
    out, ck = new_scratch(spark, "end-codes-out"), new_scratch(spark, "end-codes-ckpt")
    # the first micro-batch is the first delivery's files, whatever their number
    closed = st.sessions_stream(st.read_events(spark, src, files[0]), CFG, changes=st.read_changes(spark, lst, 1))
    st.run_available_now(closed, out, ck)
    return st.session_interactions(spark.read.parquet(out), CFG)


QUERIES = {
    "acl_stream_end_codes": q_stream_end_codes,
    "acl_stream_stateless": q_stream_stateless,
    "acl_stream_sessions": q_stream_sessions,
    "acl_stream_dead_letter": q_stream_dead_letter,
    "acl_stream_metrics": q_stream_metrics,
    "acl_stream_reload": q_stream_reload,
}

ORACLE = {
    "acl_stream_end_codes": ACL_ORACLE["acl_sessions"].replace("event_type_cd IN ('purchase') GROUP", """
  event_type_cd = CASE WHEN event_id < (SELECT max(event_id) // 2 FROM acl_source) THEN 'purchase' ELSE 'click' END GROUP"""),
    "acl_stream_stateless": ACL_ORACLE["acl_map_v1"],
    "acl_stream_sessions": ACL_ORACLE["acl_sessions"],
    "acl_stream_dead_letter": ACL_ORACLE["acl_dead_letter"],
    "acl_stream_metrics": ACL_ORACLE["acl_metrics"],
    "acl_stream_reload": f"""SELECT event_id, event_event_type_cd FROM ({ACL_ORACLE["acl_map_v1"]})
WHERE event_id % 2 = 0 OR event_event_type_cd IS DISTINCT FROM 'click'""",
}
