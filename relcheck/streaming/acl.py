"""The event ACL as Structured Streaming jobs.

* stateless stages: the batch functions of ``relcheck.operators.events``
  applied to a streaming DataFrame (E15);
* sessions on the state processor, the state in RocksDB (E16; see
  ``relcheck.streaming.sessions``);
* valid + dead-letter outputs from one read with ``foreachBatch``, writes
  keyed by ``batch_id`` so a replayed batch overwrites itself (E17);
* the view-only list re-read from a path inside every micro-batch, the
  end-code list as a stream of changes that meets the events (E18);
* per-batch counters written to a metrics table, one partition per batch, or
  reported by the queries themselves (E19; see ``relcheck.streaming.counters``).

State growth: groups close only on an end code, so never-ending sessions keep
one small entry a key, and closed ones a tombstone, as the spec asks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relcheck.operators import events as ev
from relcheck.streaming import sessions as ss

CHANGES_SCHEMA = "from_event_id long, event_type_cd string, active boolean"


# ---------------------------------------------------------------- sources
def stage_source_files(df: DataFrame, path: str, order_col: str, n_files: int | None = 4) -> None:
    """Land a frame as files of offset ranges, in one write (used by tests and
    the registered stream queries; a second call is a later delivery). Without
    ``n_files`` their number grows with the rows."""
    ranged = df.repartitionByRange(order_col) if n_files is None else df.repartitionByRange(n_files, order_col)
    ranged.write.mode("append").parquet(path)


def read_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A micro-batch takes whatever has arrived, unless a number of files is given."""
    reader = spark.readStream.schema(ev.SOURCE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      output_mode: str = "append") -> None:
    """Process everything available, then stop (restartable from the
    checkpoint)."""
    q = (df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
    if q.exception():
        raise q.exception()


# ---------------------------------------------------------------- E15
def valid_events(stream: DataFrame, cfg: ev.AclConfig, observe_name: str | None = None) -> DataFrame:
    """View-only events dropped, strings trimmed, invalid events dropped. With
    ``observe_name`` the counters of these stages are reported through
    ``observe()`` in the query's progress (E19; no extra job), however the lists
    are given."""
    if not observe_name:
        return ev.split_valid(ev.trim_strings(ev.filter_view_only(stream, cfg.view_only)))[0]
    flagged = ev.flag_in(stream, "event_type_cd", cfg.view_only, "_view_only")
    judged = ev.trim_strings(flagged).withColumn("_bad", F.size(ev.validation_reasons()) > 0)
    view, bad = F.col("_view_only"), F.col("_bad")
    counted = judged.observe(observe_name, F.count(F.lit(1)).alias("received"), F.count_if(view).alias("filtered_view_only"),
                             F.count_if(~view & bad).alias("validation_failures"), F.count_if(~view & bad).alias("dead_lettered"),
                             F.count_if(~view & ~bad).alias("transformed"))
    return counted.where(~view & ~bad).drop("_view_only", "_bad")


def stateless(stream: DataFrame, cfg: ev.AclConfig, observe_name: str | None = None) -> DataFrame:
    """Valid events as interactions."""
    return ev.flatten(ev.to_interaction_v1(valid_events(stream, cfg, observe_name), cfg.enum_map, cfg.default_event_type))


# ---------------------------------------------------------------- E16
def sessions_stream(stream: DataFrame, cfg: ev.AclConfig, changes: DataFrame | None = None, idle: str | None = None,
                    late: str = "0 seconds", start_from: DataFrame | None = None, observe_name: str | None = None) -> DataFrame:
    """Closed sessions, one row per (customer, session), as a stream.
    Stateless validation first (same functions as batch); whether an event ends
    a session is a column before the state step: by the configured list (literal,
    or a join with a table of any size), or by a stream of list ``changes``
    (E18). ``idle``, ``late``, ``start_from``: see ``sessions.sessions``. With
    ``observe_name`` all six counters are reported, the published ones under
    ``<name>_published``."""
    valid = valid_events(stream, cfg, observe_name)
    flagged = ev.flag_in(valid, "event_type_cd", cfg.end_codes, "is_end") if changes is None else ss.flag_by_changes(valid, changes)
    out = ss.sessions(flagged, idle, late, start_from)
    if observe_name:
        out = out.observe(f"{observe_name}_published", F.count_if(F.col("closed_by") == ss.BY_END).alias("published"))
    return out.select("customer_id", "session_id", "closed_by", "n_events",
                      F.timestamp_micros("interaction_start_us").alias("interaction_start"),
                      "event_id", "application_software", F.timestamp_micros("event_ts_us").alias("event_ts"),
                      "client_id", "event_type_cd", "event_response_txt")


def open_state(valid: DataFrame, end_codes) -> DataFrame:
    """Open sessions of a batch of events as a table that a stream may start
    from, so that a job can go on where a batch backfill ended."""
    at = F.unix_micros(F.col("event_ts").cast("timestamp"))
    flagged = ev.flag_in(valid, "event_type_cd", end_codes, "is_end")
    return (flagged.groupBy(*ev.KEY)
            .agg(F.min(at).alias("start_us"), F.max(at).alias("last_us"), F.count("*").alias("n_events"), F.max("is_end").alias("ended"))
            .where("not ended").drop("ended"))


def read_changes(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The end-code list's changes: from which offset on a code is on the list
    (``active``) or off it."""
    reader = spark.readStream.schema(CHANGES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def session_interactions(closed: DataFrame, cfg: ev.AclConfig) -> DataFrame:
    """Sessions that an end event closed, as interactions."""
    closed = closed.where(F.col("closed_by") == ss.BY_END)
    return ev.flatten(ev.to_interaction_v1(closed, cfg.enum_map, cfg.default_event_type,
                                           start_col="interaction_start")).drop("event_id")


# ---------------------------------------------------------------- E17-E19
def dead_letter_writer(valid_path: str, dead_path: str, metrics_path: str, cfg: ev.AclConfig,
                       error_ts, view_only_path: str | None = None):
    """foreachBatch body: one read, two outputs (valid interactions and dead
    letters) plus the batch counters. Every write goes to a ``batch_id``
    partition with dynamic overwrite, so a replayed batch replaces its own
    output instead of duplicating it. With ``view_only_path`` the view-only
    list is re-read for every batch (E18: changeable without restart)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        view_only = spark.read.parquet(view_only_path) if view_only_path else cfg.view_only
        local = ev.AclConfig(view_only=view_only, end_codes=cfg.end_codes, enum_map=cfg.enum_map,
                             default_event_type=cfg.default_event_type, source_topic=cfg.source_topic)
        src = batch.persist()
        kept = ev.filter_view_only(src, local.view_only)
        trimmed = ev.trim_strings(ev.keep_original(kept))
        valid, invalid = ev.split_valid(trimmed)
        bid = F.lit(batch_id).alias("batch_id")
        mode = {"partitionOverwriteMode": "dynamic"}
        (ev.flatten(ev.to_interaction_v1(valid, local.enum_map, local.default_event_type))
         .select("*", bid).write.mode("overwrite").options(**mode).partitionBy("batch_id").parquet(valid_path))
        (ev.dead_letter(invalid, error_ts, local.source_topic).select("*", bid)
         .write.mode("overwrite").options(**mode).partitionBy("batch_id").parquet(dead_path))
        counts = ev.event_counts(src, local)
        names = counts.columns
        (counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"))
                                           for n in names])).alias("m")).select("m.*", bid)
         .write.mode("overwrite").options(**mode).partitionBy("batch_id").parquet(metrics_path))
        src.unpersist()
    return write


def run_foreach_batch(stream: DataFrame, fn, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
