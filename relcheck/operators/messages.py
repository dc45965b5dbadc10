"""Typed, keyed, validated messages from CSV/JSON rows.

Input rows are all-string records (as read from CSV with an explicit
all-string schema) with ``file_name`` and ``row_no``. Each field has a
rule: required (blank -> error), default (blank -> default value) or
nullable (blank -> null); typed fields are parsed with ``try_`` casts so a
bad value becomes a listed reason instead of a failed job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relcheck.functions.text import trim_ws


@dataclass
class FieldRule:
    name: str
    kind: str = "string"          # string | date | array
    required: bool = False
    default: str | None = None     # used when blank (and not required)


@dataclass
class MessageSpec:
    # Fixed values of the message job: source system -> topic.
    topics: dict = field(default_factory=lambda: {
        "myRetirementApp": "topic-a", "SourceSystemB": "topic-b", "SourceSystemC": "topic-c"})
    fields: list = field(default_factory=lambda: [
        FieldRule("customer_id", required=True),
        FieldRule("event_type", default="UNKNOWN"),
        FieldRule("event_date", kind="date"),
        FieldRule("tags", kind="array"),
    ])
    key_column: str | None = "customer_id"
    key_json_path: tuple[str, str] | None = None   # (payload column, JSON path)
    key_default: str | None = None
    strict: bool = True


def _blank(c: Column) -> Column:
    """Null or nothing but white space of any kind, as in the event checks."""
    return c.isNull() | (trim_ws(c) == "")


def typed_fields(df: DataFrame, spec: MessageSpec) -> DataFrame:
    """I1 + I2 + I3: topic routing, typed fill of missing values and the
    array field, with all reasons collected in one array per row."""
    topics = F.create_map(*[F.lit(x) for kv in spec.topics.items() for x in kv])
    cols, reasons = [], [F.when(F.element_at(topics, F.col("source_system")).isNull(),
                                F.lit("unknown source system"))]
    for r in spec.fields:
        raw = F.col(r.name)
        blank = _blank(raw)
        if r.kind == "date":
            parsed = F.try_to_date(raw, "yyyy-MM-dd")
            bad = ~blank & parsed.isNull()
            reasons.append(F.when(bad, F.lit(f"{r.name} is not a valid date")))
        elif r.kind == "array":
            parsed = F.from_json(raw, "array<string>")
            bad = ~blank & parsed.isNull()
            reasons.append(F.when(bad, F.lit(f"{r.name} is not a JSON array")))
        else:
            parsed = raw
        if r.required:
            reasons.append(F.when(blank, F.lit(f"{r.name} is required")))
            value = F.when(~blank, parsed)
        elif r.default is not None:
            value = F.when(blank, F.lit(r.default)).otherwise(parsed)
        else:
            value = F.when(~blank, parsed)
        cols.append(value.alias(r.name))
    return df.select("file_name", "row_no", "source_system",
                     F.element_at(topics, F.col("source_system")).alias("topic"), *cols,
                     F.filter(F.array(*reasons), lambda x: x.isNotNull()).alias("reasons"))


def message_key(spec: MessageSpec) -> Column:
    """Key from a column, else a payload field, else a parameter, else a
    deterministic key from (source, file, row): retries give the same key,
    unlike a UUID."""
    parts = []
    if spec.key_column:
        parts.append(F.when(~_blank(F.col(spec.key_column)), F.col(spec.key_column).cast("string")))
    if spec.key_json_path:
        col, path = spec.key_json_path
        v = F.get_json_object(F.col(col), path)
        parts.append(F.when(~_blank(v), v))
    if spec.key_default:
        parts.append(F.lit(spec.key_default))
    parts.append(F.sha2(F.concat_ws("|", "source_system", "file_name", F.col("row_no").cast("string")), 256))
    return F.coalesce(*parts)


def to_messages(typed: DataFrame, spec: MessageSpec) -> DataFrame:
    """(key, value, topic) frame for any sink; STRICT publishes only
    valid rows, RAW publishes every routed row."""
    ok = F.size("reasons") == 0 if spec.strict else F.col("topic").isNotNull()
    payload = [r.name for r in spec.fields]
    return typed.where(ok).select(
        "file_name", "row_no", message_key(spec).alias("key"),
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("value"), "topic")


def failures(typed: DataFrame, run_ts: Column) -> DataFrame:
    """One failure row per reason: row number, source, message, time."""
    return typed.where(F.size("reasons") > 0).select(
        "file_name", "row_no", "source_system", F.explode("reasons").alias("message"),
        run_ts.alias("failed_at"))


def run_summary(typed: DataFrame) -> DataFrame:
    """I8: per source system and file: total, ok and failed records."""
    bad = F.size("reasons") > 0
    return typed.groupBy("source_system", "file_name").agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(~bad).alias("n_ok"), F.count_if(bad).alias("n_failed"))


def raw_passthrough(df: DataFrame, payload_col: str, strict: bool) -> DataFrame:
    """I4: RAW publishes the payload untouched; STRICT publishes it only
    when it parses as JSON."""
    ok = F.lit(True) if not strict else F.try_parse_json(F.col(payload_col)).isNotNull()
    return df.select("file_name", "row_no", F.col(payload_col).alias("payload"), ok.alias("published"))


# Offsets per chunk in ``sequence_within``: no window ever sees more rows.
SEQUENCE_CHUNK = 1 << 20


def sequence_within(df: DataFrame, group: list[str], order: str, out: str = "seq",
                    chunk_size: int = SEQUENCE_CHUNK) -> DataFrame:
    """1-based position of each row inside its group, by the integer
    column ``order`` (unique inside a group: a row number, an offset, or a
    packed composite key).

    A plain ``row_number()`` over the group puts a whole group in one task.
    Here rows are cut into (group, chunk = order // chunk_size) pieces, so
    no piece holds more than ``chunk_size`` rows: the rank inside a piece is
    a bounded window, and the piece's offset is a running sum over the
    per-piece counts (a small table: rows / chunk_size per group). Every
    step is deterministic, so a task retried after an executor loss gives
    the same numbers, with no extra copy of the data."""
    g = group + ["_chunk"]
    x = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk_size)))
    x = x.withColumn("_in", F.row_number().over(Window.partitionBy(*g).orderBy(order)))
    counts = x.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_off", F.sum("_n").over(
        Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))) \
        .select(*g, F.coalesce(F.col("_off"), F.lit(0)).alias("_off"))
    return x.join(offsets, g).withColumn(out, (F.col("_off") + F.col("_in")).cast("int")) \
        .drop("_chunk", "_in", "_off")
