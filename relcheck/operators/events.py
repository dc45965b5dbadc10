"""Event anti-corruption layer, batch form (E1-E14). Every stateless step
is a plain DataFrame -> DataFrame function, so the same code runs on a
streaming DataFrame (see ``relcheck.streaming.acl``).

Source columns (snake case of the source topic, plus the session id the
grouping rule needs and ``event_id`` as the arrival offset):
``event_id, application_software, event_ts, customer_id, client_id,
event_type_cd, event_response_txt, session_id``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcheck.functions.text import trim_ws
from relcheck.functions.time import iso8601_utc

# Fixed values from the interaction spec.
SOURCE_TOPIC = "MyRetirement"
DEFAULT_EVENT_TYPE = "UNKNOWN"
REASON_TS = "EventTS is required"
REASON_CUSTOMER = "CustomerID is required and must not be blank"
REASON_CODE = "EventTypeCd is required"

KEY = ["customer_id", "session_id"]

SOURCE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("application_software", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("event_type_cd", T.StringType()),
    T.StructField("event_response_txt", T.StringType()),
    T.StructField("session_id", T.StringType()),
])

# Destination interaction (v1); nullability is the compliance contract.
DESTINATION_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType(), False),
    T.StructField("interaction_start_ts", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("event", T.StructType([
        T.StructField("client_id", T.StringType(), True),
        T.StructField("event_type_cd", T.StringType(), False),
        T.StructField("event_response_text", T.StringType(), True),
    ]), False),
])


@dataclass
class AclConfig:
    """Config lists may be Python lists (become IN literals) or DataFrames
    read from a config table (joined; the planner broadcasts it when its size allows)."""
    view_only: object = field(default_factory=lambda: ["view"])
    end_codes: object = field(default_factory=lambda: ["purchase"])
    enum_map: object = field(default_factory=lambda: {
        "mra-web": "WEB", "mra-mobile": "MOBILE", "mra-ivr": "IVR"})
    default_event_type: str = DEFAULT_EVENT_TYPE
    source_topic: str = SOURCE_TOPIC


def flag_in(df: DataFrame, col: str, values, flag: str) -> DataFrame:
    """Add boolean ``flag`` = df[col] is in the config list (null -> False)."""
    if isinstance(values, DataFrame):
        lst = values.select(F.col(values.columns[0]).alias("_v")).distinct() \
            .withColumn(flag, F.lit(True))
        out = df.join(lst, df[col] == lst["_v"], "left").drop("_v")
        return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return df.withColumn(flag, F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def filter_view_only(df: DataFrame, view_only, col: str = "event_type_cd") -> DataFrame:
    """Silently drop events whose code is on the view-only list. A null
    code never matches, so it reaches validation and the dead letters."""
    if isinstance(view_only, DataFrame):
        lst = view_only.select(F.col(view_only.columns[0]).alias("_v")).distinct()
        return df.join(lst, df[col] == lst["_v"], "left_anti")
    return df.where(~F.coalesce(F.col(col).isin(list(view_only)), F.lit(False)))


def keep_original(df: DataFrame) -> DataFrame:
    """Carry the untouched source record as a struct, so the dead letter can
    hold the original payload after trimming (serialised only for the
    invalid rows)."""
    return df.withColumn("_orig", F.struct(*[F.col(c) for c in df.columns]))


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip leading/trailing whitespace of every string column."""
    return df.select([trim_ws(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
                      else F.col(f.name) for f in df.schema.fields])


def validation_reasons() -> Column:
    """All failed rules as an array (empty when valid)."""
    return F.filter(F.array(
        F.when(F.col("event_ts").isNull(), F.lit(REASON_TS)),
        F.when(F.col("customer_id").isNull() | (F.col("customer_id") == ""), F.lit(REASON_CUSTOMER)),
        F.when(F.col("event_type_cd").isNull(), F.lit(REASON_CODE)),
    ), lambda x: x.isNotNull())


def validate(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", validation_reasons()) \
             .withColumn("is_valid", F.size("reasons") == 0)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    v = validate(df)
    valid = v.where("is_valid").drop("reasons", "is_valid")
    if "_orig" in valid.columns:
        valid = valid.drop("_orig")
    return valid, v.where(~F.col("is_valid"))


def dead_letter(invalid: DataFrame, error_ts: Column, source_topic: str = SOURCE_TOPIC,
                payload_cols: list[str] | None = None) -> DataFrame:
    """One dead-letter record per invalid event: original payload as
    JSON (null fields kept), error time, reasons, source topic."""
    if "_orig" in invalid.columns and payload_cols is None:
        record = F.col("_orig")
    else:
        cols = payload_cols or [c for c in invalid.columns if c not in ("reasons", "is_valid")]
        record = F.struct(*cols)
    return invalid.select(
        *[c for c in ("event_id",) if c in invalid.columns],
        F.to_json(record, {"ignoreNullFields": "false",
                                    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}).alias("payload"),
        error_ts.alias("error_ts"),
        F.array_join("reasons", "; ").alias("reason"),
        F.lit(source_topic).alias("source_topic"))


def map_event_type(df: DataFrame, enum_map, default: str = DEFAULT_EVENT_TYPE,
                   col: str = "application_software", out: str = "event_type",
                   keep_flag: bool = False) -> DataFrame:
    """E5: enum by lookup with default. A dict becomes a literal map (no
    join); a DataFrame (code, value) is a left join, broadcast by the planner
    when its size allows."""
    if isinstance(enum_map, DataFrame):
        k, v = enum_map.columns[:2]
        lk = enum_map.groupBy(F.col(k).alias("_k")).agg(F.min(v).alias("_mapped"))  # one value per code
        res = df.join(lk, df[col] == lk["_k"], "left").drop("_k")
    else:
        m = F.create_map(*[F.lit(x) for kv in enum_map.items() for x in kv]) if enum_map else \
            F.create_map().cast("map<string,string>")
        res = df.withColumn("_mapped", F.element_at(m, F.col(col)))
    res = res.withColumn(out, F.coalesce(F.col("_mapped"), F.lit(default)))
    if keep_flag:
        res = res.withColumn("is_unmapped", F.col("_mapped").isNull())
    return res.drop("_mapped")


def unmapped_values(df: DataFrame, enum_map, col: str = "application_software") -> DataFrame:
    """E5 side output: values that fell to the default, with counts."""
    m = map_event_type(df.select(col), enum_map, col=col, keep_flag=True)
    return m.where("is_unmapped").groupBy(col).agg(F.count(F.lit(1)).alias("n_events"))


def to_interaction_v1(df: DataFrame, enum_map, default: str = DEFAULT_EVENT_TYPE,
                      start_col: str = "event_ts") -> DataFrame:
    """Destination interaction; time renamed and ISO-8601 formatted,
    client/code/response nested in ``event`` (Txt -> Text)."""
    m = map_event_type(df, enum_map, default)
    extra = [c for c in ("event_id", "session_id") if c in df.columns]
    return m.select(
        *extra,
        F.col("event_type"),
        iso8601_utc(start_col).alias("interaction_start_ts"),
        F.col("customer_id"),
        F.struct(F.col("client_id"), F.col("event_type_cd"),
                 F.col("event_response_txt").alias("event_response_text")).alias("event"))


def to_interaction_v2(df: DataFrame, description_col: str = "event_type_description") -> DataFrame:
    """v2 mapping: description copied as is (null allowed), the incoming
    code ignored, ``event_type_code`` kept in the schema but always null."""
    desc = F.col(description_col) if description_col in df.columns else F.lit(None).cast("string")
    return df.select(
        *[c for c in ("event_id",) if c in df.columns],
        F.col("customer_id"),
        iso8601_utc("event_ts").alias("interaction_start_ts"),
        F.lit(None).cast("string").alias("event_type_code"),
        desc.alias("event_type_description"))


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs to top-level columns (``event.client_id`` -> ``event_client_id``)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"{f.name}.{s.name}").alias(f"{f.name}{sep}{s.name}") for s in f.dataType.fields]
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


def schema_compliance(df: DataFrame, schema: T.StructType, key_col: str,
                      enum_domains: dict[str, list[str]] | None = None,
                      check_id: str = "E9") -> DataFrame:
    """Every non-nullable destination field present, enums in domain.
    Findings rows, one per (record, field) breach; generated from the
    StructType, so the schema is the only input."""
    from relcheck.operators.findings import FINDINGS_COLS

    checks = []

    def walk(st: T.StructType, prefix: str, parent_ok: Column | None):
        for f in st.fields:
            path = f"{prefix}{f.name}"
            c = F.col(path)
            if not f.nullable:
                cond = c.isNull() if parent_ok is None else (parent_ok & c.isNull())
                checks.append((path, cond, "not null"))
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, path + ".", c.isNotNull())
    walk(schema, "", None)
    for path, domain in (enum_domains or {}).items():
        checks.append((path, F.col(path).isNotNull() & ~F.col(path).isin(domain),
                       "in (" + ",".join(domain) + ")"))
    breaches = F.filter(F.array(*[
        F.when(cond, F.struct(F.lit(p).alias("field"), F.lit(exp).alias("expected"),
                              F.col(p).cast("string").alias("actual")))
        for p, cond, exp in checks]), lambda x: x.isNotNull())
    return (df.select(F.col(key_col).cast("string").alias("object_key"),
                      F.explode(breaches).alias("b"))
              .select(F.lit(check_id).alias("check_id"), F.lit("interaction").alias("object_kind"),
                      "object_key", F.col("b.field").alias("field"), F.lit("VIOLATION").alias("status"),
                      F.col("b.expected").alias("expected"), F.col("b.actual").alias("actual"))
              .select(*FINDINGS_COLS))


def _end_flag(df: DataFrame, end_codes) -> DataFrame:
    return flag_in(df, "event_type_cd", end_codes, "is_end")


# Offsets per chunk in the skew-safe session plan: a (key, chunk) group
# never holds more than this many events.
SESSION_CHUNK = 1 << 20


def sessions(valid: DataFrame, end_codes, order_col: str = "event_id",
             chunk_size: int = SESSION_CHUNK) -> DataFrame:
    """One record per closed (customer, session) group.

    The group closes at its first end event in arrival order; later events
    of that key are ignored. Start = earliest event time among events up to
    and including the close; all other fields come from the end event.

    Skew-safe plan (a key may hold a third of all events):
    1. events are grouped by (key, offset chunk): a group holds at most
       ``chunk_size`` events, so a hot key is spread over many tasks. Per
       group: the first end offset (window over the bounded group), the
       earliest time overall and up to that end, and the end event itself;
    2. the chunk summaries of a key (few rows: events / chunk_size) are
       scanned in chunk order: the closing chunk is the first one with an
       end; start = min(earliest time of all earlier chunks, earliest time
       up to the end inside the closing chunk).
    """
    end_fields = [c for c in valid.columns if c not in KEY]
    g = KEY + ["_chunk"]
    x = _end_flag(valid, end_codes).withColumn("_chunk", F.floor(F.col(order_col) / F.lit(chunk_size)))
    x = x.withColumn("_fe", F.min(F.when(F.col("is_end"), F.col(order_col))).over(Window.partitionBy(*g)))
    upto = F.col("_fe").isNull() | (F.col(order_col) <= F.col("_fe"))
    summ = x.groupBy(*g).agg(
        F.min("_fe").alias("_fe"),
        F.min("event_ts").alias("_min_all"),
        F.min(F.when(upto, F.col("event_ts"))).alias("_min_upto"),
        F.first(F.when(F.col(order_col) == F.col("_fe"), F.struct(*end_fields)), ignorenulls=True).alias("end"))
    by_key = Window.partitionBy(*KEY)
    s2 = summ.withColumn("_close_chunk", F.min(F.when(F.col("_fe").isNotNull(), F.col("_chunk"))).over(by_key)) \
        .withColumn("_prev_min", F.min("_min_all").over(
            by_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)))
    closed = s2.where(F.col("_chunk") == F.col("_close_chunk"))
    return closed.select(*KEY, F.least("_prev_min", "_min_upto").alias("interaction_start"),
                         *[F.col(f"end.{c}").alias(c) for c in end_fields])


def session_interactions(valid: DataFrame, cfg: AclConfig) -> DataFrame:
    """Closed sessions mapped to the destination interaction (v1)."""
    s = sessions(valid, cfg.end_codes)
    return to_interaction_v1(s, cfg.enum_map, cfg.default_event_type, start_col="interaction_start")


def open_sessions(valid: DataFrame, end_codes) -> DataFrame:
    """Groups with no end event yet: size, first arrival and time."""
    flagged = _end_flag(valid, end_codes)
    return (flagged.groupBy(*KEY)
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.min("event_id").alias("first_event_id"),
                 F.min("event_ts").alias("first_event_ts"),
                 F.max(F.col("is_end").cast("int")).alias("_has_end"))
            .where(F.col("_has_end") == 0).drop("_has_end"))


def event_counts(source: DataFrame, cfg: AclConfig) -> DataFrame:
    """E12 (event part): received, filtered view-only, validation failures,
    dead-lettered, transformed, in one pass over the source."""
    f = flag_in(source, "event_type_cd", cfg.view_only, "is_view_only")
    t = trim_strings(f)
    v = t.withColumn("_bad", F.size(validation_reasons()) > 0)
    kept = ~F.col("is_view_only")
    return v.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("is_view_only")).alias("filtered_view_only"),
        F.count_if(kept & F.col("_bad")).alias("validation_failures"),
        F.count_if(kept & F.col("_bad")).alias("dead_lettered"),
        F.count_if(kept & ~F.col("_bad")).alias("transformed"))


def metrics(source: DataFrame, cfg: AclConfig) -> DataFrame:
    """E12 as (metric, value) rows; ``published`` = closed sessions."""
    counts = event_counts(source, cfg)
    names = ["received", "filtered_view_only", "validation_failures", "dead_lettered", "transformed"]
    long = counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])).alias("m")) \
        .select("m.metric", "m.value")
    valid, _ = split_valid(trim_strings(filter_view_only(source, cfg.view_only)))
    published = sessions(valid, cfg.end_codes).agg(F.count(F.lit(1)).alias("value")) \
        .select(F.lit("published").alias("metric"), "value")
    return long.unionByName(published)


def order_for_publish(df: DataFrame, key_cols: list[str], offset_col: str,
                      num_partitions: int | None = None) -> DataFrame:
    """All events of a key in one output partition, in offset order
    (the Kafka guarantee). One hash shuffle + a local sort; no global sort."""
    parts = [num_partitions] if num_partitions else []
    return df.repartition(*parts, *key_cols).sortWithinPartitions(*key_cols, offset_col)


def order_inversions(published: DataFrame, key_cols: list[str], offset_col: str) -> DataFrame:
    """E14 check: per key, how often an event follows (in published
    position) an earlier-published event of the same key with a higher
    offset, and over how many output partitions the key is spread (must be
    1). The previous event of the key is taken inside its output partition
    (the unit a producer writes in order): the window is (partition, key),
    so it is never larger than what the publish task itself wrote."""
    from pyspark.sql import Window
    pos = published.withColumn("_pos", F.monotonically_increasing_id()) \
        .withColumn("_part", F.spark_partition_id())
    w = Window.partitionBy("_part", *key_cols).orderBy("_pos")
    flagged = pos.withColumn("_inv", F.lag(offset_col).over(w) > F.col(offset_col))
    return flagged.groupBy(*key_cols).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.coalesce(F.col("_inv"), F.lit(False))).alias("inversions"),
        F.count_distinct("_part").alias("n_partitions"))
