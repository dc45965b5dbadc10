"""Registered queries: file sources/sinks (A), messages (I), pull-request
activity (J), DDL scripts (K) and approval fan-out (L)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcheck.functions.time import epoch_millis_to_ts
from relcheck.operators import activity as act
from relcheck.operators import approvals as ap
from relcheck.operators import catalog as cat
from relcheck.operators import ddl
from relcheck.operators import message_schema as ms
from relcheck.operators import messages as msg
from relcheck.sources import datasets, files
from relcheck.sources import records as rec
from relcheck.sources.fixtures import cte, fixture
from relcheck.sources.tables import table

SPEC = msg.MessageSpec()
RUN_TS = "2026-01-02T00:00:00.000+0000"
MSG_COLS = ["file_name", "row_no", "source_system", "customer_id", "event_type", "event_date", "tags"]
# Fixed values of the activity report: users in scope and the date range.
USERS = [f"u{i}" for i in range(60)] + ["u900"]
PR_START, PR_END = "1997-01-01 00:00:00", "1997-12-31 00:00:00"
PR_START_S, PR_END_S = 852076800, 883526400  # the same two instants as epoch seconds (UTC)
EXISTING_DBS = [f"db{i}" for i in range(10)]


def _typed(spark, d):
    return msg.typed_fields(fixture(spark, d, "messages_csv"), SPEC)


def _typed_out(df):
    return df.select("file_name", "row_no", "source_system", "topic", "customer_id", "event_type",
                     F.col("event_date").cast("string").alias("event_date"),
                     F.array_join("tags", ",").alias("tags"),
                     F.array_join("reasons", "; ").alias("reason"), (F.size("reasons") == 0).alias("is_valid"))


def q_csv_to_messages(spark, d):
    path = files.new_scratch(spark, "messages-csv")
    src = fixture(spark, d, "messages_csv").withColumn("row_no", F.col("row_no").cast("string"))
    files.write_csv(src, path)
    back = files.read_csv_strings(spark, path, MSG_COLS).withColumn("row_no", F.col("row_no").cast("int"))
    return msg.to_messages(msg.typed_fields(back, SPEC), SPEC)


# The fields of each source system (place, path, type, required, default).
SYSTEM_RULES = [
    ("myRetirementApp", 1, "customer_id", "string", True, None), ("myRetirementApp", 2, "event_type", "string", False, "UNKNOWN"),
    ("myRetirementApp", 3, "event_date", "date", False, None), ("myRetirementApp", 4, "tags", "array<string>", False, None),
    ("SourceSystemB", 1, "customer_id", "long", True, None), ("SourceSystemB", 2, "event_date", "date", True, None),
    ("SourceSystemC", 1, "event_type", "string", True, None), ("SourceSystemC", 2, "tags", "array<string>", False, None)]


def _rules(spark):
    return spark.createDataFrame(SYSTEM_RULES, ms.SCHEMA)


def _by_schema(spark, d):
    return ms.csv_messages(fixture(spark, d, "messages_csv"), _rules(spark), ["customer_id", "event_type", "event_date", "tags"], SPEC.topics)


def q_messages_by_schema(spark, d):
    return _by_schema(spark, d).withColumn("reasons", F.array_join("reasons", "; "))


def q_json_by_schema(spark, d):
    src = fixture(spark, d, "json_messages")
    both = [ms.json_messages(src, _rules(spark), "payload", strict).withColumn("mode", F.lit("STRICT" if strict else "RAW")) for strict in (True, False)]
    return both[0].unionByName(both[1]).withColumn("reasons", F.array_join("reasons", "; "))


def q_run_reasons(spark, d):
    return ms.run_summary(_by_schema(spark, d))


def q_flatxml_dataset(spark, d):
    """Three tables in one dataset, read back without a column list; in one, most
    rows lack most columns."""
    path = files.new_scratch(spark, "xml-dataset")
    sparse = table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 7 == 6, F.col("s_name")).alias("s_name"),
                                                F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("s_nationkey"))
    datasets.write_dataset({"app.region": table(spark, d, "region"), "app.nation": table(spark, d, "nation"), "app.supplier": sparse}, path)
    out = None
    for name, rows in sorted(datasets.read_dataset(spark, path).items()):
        cols = sorted(rows.columns)
        text = F.concat_ws(",", *[F.concat(F.lit(c + "="), F.col(c)) for c in cols])
        one = rows.select(F.lit(name).alias("table_name"), F.lit(",".join(cols)).alias("columns"), text.alias("cells"))
        out = one if out is None else out.unionByName(one)
    return out


def q_csv_records(spark, d):
    """Row numbers of CSV files whose fields hold line breaks and quotes."""
    path = files.new_scratch(spark, "csv-records")
    src = fixture(spark, d, "notes_csv").repartition("file_name").sortWithinPartitions("file_name", "row_no")
    src.write.partitionBy("file_name").option("header", True).option("escape", '"').csv(path)
    back = rec.read_csv_records(spark, path, ["row_no_written", "note", "tags"], pattern="*.csv")
    return back.select(F.regexp_extract("file_path", "file_name=([^/]+)/", 1).alias("file_name"), "row_no", F.col("row_no_written").alias("written"),
                       F.sha2("note", 256).alias("note_hash"), "tags")


def q_json_records(spark, d):
    """Row numbers of JSON files whose documents are written over many lines."""
    path = files.new_scratch(spark, "json-records")
    src = fixture(spark, d, "notes_csv").repartition("file_name").sortWithinPartitions("file_name", "row_no")
    text = F.concat(F.lit('{\n  "row": '), F.col("row_no").cast("string"), F.lit(',\n  "list": [\n    "]}{", "a \\" [",\n    {}\n  ]\n}'))
    src.select("file_name", text.alias("value")).write.partitionBy("file_name").text(path)
    back = rec.read_json_records(spark, path, pattern="*.txt")
    return back.select(F.regexp_extract("file_path", "file_name=([^/]+)/", 1).alias("file_name"), "row_no",
                       F.get_json_object("payload", "$.row").alias("written"), F.sha2("payload", 256).alias("payload_hash"))


def q_fill_missing(spark, d):
    return _typed_out(_typed(spark, d))


def q_fill_missing_tabs(spark, d):
    """Customers of white space other than spaces are missing as well."""
    return _typed_out(msg.typed_fields(fixture(spark, d, "messages_tabs"), SPEC)).select("file_name", "row_no", "customer_id", "reason")


def q_array_field(spark, d):
    t = _typed(spark, d)
    raw = fixture(spark, d, "messages_csv").select("file_name", "row_no", F.col("tags").alias("tags_raw"))
    return t.join(raw, ["file_name", "row_no"]).select(
        "file_name", "row_no", "tags_raw", F.array_join("tags", ",").alias("tags"),
        (~F.array_contains("reasons", "tags is not a JSON array")).alias("tags_valid"))


def q_keys(spark, d):
    src = fixture(spark, d, "messages_csv")
    return src.select("file_name", "row_no", msg.message_key(SPEC).alias("message_key"))


def q_sequence(spark, d):
    ok = _typed(spark, d).where(F.size("reasons") == 0).select("file_name", "row_no")
    return msg.sequence_within(ok, ["file_name"], "row_no")


def q_failures(spark, d):
    return msg.failures(_typed(spark, d), F.lit(RUN_TS))


def q_run_summary(spark, d):
    return msg.run_summary(_typed(spark, d))


def q_raw_passthrough(spark, d):
    src = fixture(spark, d, "messages_csv")
    strict = msg.raw_passthrough(src, "tags", strict=True).withColumn("mode", F.lit("STRICT"))
    raw = msg.raw_passthrough(src, "tags", strict=False).withColumn("mode", F.lit("RAW"))
    return strict.unionByName(raw)


def _prs(spark, d):
    return fixture(spark, d, "prs").withColumn("created_ms", F.unix_millis(F.col("created_at").cast("timestamp")))


def q_pr_activity(spark, d):
    users = spark.createDataFrame([(u,) for u in USERS], "user string")
    a = act.activity(_prs(spark, d), fixture(spark, d, "pr_reviewers"), users, PR_START, PR_END)
    return a.withColumnRenamed("user", "user_name")


def q_epoch_millis(spark, d):
    return _prs(spark, d).select("pr_id", "created_ms",
                                 F.date_format(epoch_millis_to_ts(F.col("created_ms")),
                                               "yyyy-MM-dd HH:mm:ss").alias("created_ts"))


def _stmts(spark, d):
    return ddl.statements(fixture(spark, d, "ddl_scripts"))


def q_ddl_statements(spark, d):
    return _stmts(spark, d)


def q_ddl_split(spark, d):
    return ddl.split_alters(_stmts(spark, d))


def q_ddl_ordered(spark, d):
    return ddl.ordered_new_tables(_stmts(spark, d))


def q_approval_fanout(spark, d):
    existing = spark.createDataFrame([(x,) for x in EXISTING_DBS], "database_name string")
    return ap.fanout_rows(fixture(spark, d, "approvals"), existing)


def _xml_input(spark, d):
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment",
                    F.when(F.col("c_custkey") % 3 == 0, F.lit(None))
                     .when(F.col("c_custkey") % 3 == 1, F.lit(""))
                     .otherwise(F.col("c_name")).alias("c_note"))


def q_flatxml_roundtrip(spark, d):
    src = _xml_input(spark, d)
    path = files.new_scratch(spark, "flatxml")
    files.write_flat_xml(src, path, "public", "customer")
    return files.read_flat_xml(spark, path, "public", "customer", src.columns)


SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("table_schema", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StructType([
        T.StructField("column_name", T.StringType()), T.StructField("data_type", T.StringType()),
        T.StructField("is_nullable", T.StringType())]))),
    T.StructField("constraints", T.ArrayType(T.StructType([
        T.StructField("constraint_name", T.StringType()), T.StructField("constraint_type", T.StringType())]))),
])


def q_snapshot_json_roundtrip(spark, d):
    nested = cat.tables_nested(fixture(spark, d, "cat_columns"), cat.key_usage(*(fixture(spark, d, n) for n in ("cat_constraints", "cat_key_columns", "cat_ref_columns"))))
    path = files.new_scratch(spark, "snapshots")
    files.write_snapshots(nested, path)
    n = files.read_snapshots(spark, path, SNAPSHOT_SCHEMA)
    return n.select("table_schema", "table_name", F.size("columns").alias("n_columns"),
                    F.array_join(F.transform("columns", lambda c: F.concat_ws(
                        ":", c["column_name"], c["data_type"], c["is_nullable"])), ",").alias("columns"),
                    F.array_join(F.transform("constraints", lambda c: F.concat_ws(
                        ":", c["constraint_name"], c["constraint_type"])), ",").alias("constraints"))


def q_export_limited(spark, d):
    return files.export_limited(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"],
                                ["o_orderkey"], 100)


QUERIES = {
    "csv_to_messages": q_csv_to_messages,
    "messages_by_schema": q_messages_by_schema,
    "json_by_schema": q_json_by_schema,
    "message_run_reasons": q_run_reasons,
    "flatxml_dataset": q_flatxml_dataset,
    "csv_records": q_csv_records,
    "json_records": q_json_records,
    "message_fill_missing": q_fill_missing,
    "message_fill_missing_tabs": q_fill_missing_tabs,
    "message_array_field": q_array_field,
    "message_keys": q_keys,
    "message_sequence": q_sequence,
    "message_failures": q_failures,
    "message_run_summary": q_run_summary,
    "json_raw_passthrough": q_raw_passthrough,
    "pr_activity": q_pr_activity,
    "epoch_millis": q_epoch_millis,
    "ddl_statements": q_ddl_statements,
    "ddl_split": q_ddl_split,
    "ddl_ordered": q_ddl_ordered,
    "approval_fanout": q_approval_fanout,
    "flatxml_roundtrip": q_flatxml_roundtrip,
    "snapshot_json_roundtrip": q_snapshot_json_roundtrip,
    "export_limited": q_export_limited,
}

# ---------------------------------------------------------------- oracle
BLANK = "({c} IS NULL OR trim({c}) = '')"
TYPED = cte("messages_csv") + f""", t0 AS (SELECT file_name, row_no, source_system,
 CASE source_system WHEN 'myRetirementApp' THEN 'topic-a' WHEN 'SourceSystemB' THEN 'topic-b' WHEN 'SourceSystemC' THEN 'topic-c' END AS topic,
 CASE WHEN {BLANK.format(c='customer_id')} THEN NULL ELSE customer_id END AS customer_id,
 CASE WHEN {BLANK.format(c='event_type')} THEN 'UNKNOWN' ELSE event_type END AS event_type,
 CASE WHEN {BLANK.format(c='event_date')} THEN NULL ELSE CAST(try_strptime(event_date, '%Y-%m-%d') AS DATE) END AS event_date,
 CASE WHEN {BLANK.format(c='tags')} THEN NULL WHEN json_valid(tags) THEN from_json(tags, '["VARCHAR"]') END AS tags,
 {BLANK.format(c='customer_id')} AS cust_blank,
 NOT {BLANK.format(c='event_date')} AND try_strptime(event_date, '%Y-%m-%d') IS NULL AS date_bad,
 NOT {BLANK.format(c='tags')} AND NOT json_valid(tags) AS tags_bad, tags AS tags_raw
 FROM messages_csv),
t AS (SELECT *, concat_ws('; ', CASE WHEN topic IS NULL THEN 'unknown source system' END,
 CASE WHEN cust_blank THEN 'customer_id is required' END, CASE WHEN date_bad THEN 'event_date is not a valid date' END,
 CASE WHEN tags_bad THEN 'tags is not a JSON array' END) AS reason FROM t0)
"""

MSG_KEY = "coalesce(CASE WHEN NOT {b} THEN customer_id END, sha256(concat_ws('|', source_system, file_name, CAST(row_no AS VARCHAR))))"

SCHEMAS = cte("messages_csv") + f""", w AS (SELECT *, {BLANK.format(c='customer_id')} AS no_cust, {BLANK.format(c='event_type')} AS no_type, {BLANK.format(c='event_date')} AS no_date,
  {BLANK.format(c='tags')} AS no_tags, try_strptime(event_date, '%Y-%m-%d') IS NULL AS bad_date, NOT json_valid(tags) AS bad_tags FROM messages_csv),
checked AS (SELECT file_name, row_no, source_system, CASE source_system WHEN 'myRetirementApp' THEN 'topic-a' WHEN 'SourceSystemB' THEN 'topic-b' WHEN 'SourceSystemC' THEN 'topic-c' END AS topic,
 CASE source_system
  WHEN 'myRetirementApp' THEN '{{"customer_id":"' || customer_id || '","event_type":"' || CASE WHEN no_type THEN 'UNKNOWN' ELSE event_type END || '","event_date":' || CASE WHEN no_date THEN 'null' ELSE '"' || event_date || '"' END
    || ',"tags":' || CASE WHEN no_tags THEN 'null' ELSE tags END || '}}'
  WHEN 'SourceSystemB' THEN '{{"customer_id":' || customer_id || ',"event_date":"' || event_date || '"}}'
  WHEN 'SourceSystemC' THEN '{{"event_type":"' || event_type || '","tags":' || CASE WHEN no_tags THEN 'null' ELSE tags END || '}}' END AS value,
 list_filter(CASE source_system
  WHEN 'myRetirementApp' THEN [CASE WHEN no_cust THEN 'customer_id is required' END, CASE WHEN NOT no_date AND bad_date THEN 'event_date is not a valid date' END, CASE WHEN NOT no_tags AND bad_tags THEN 'tags is not a valid array<string>' END]
  WHEN 'SourceSystemB' THEN [CASE WHEN no_cust THEN 'customer_id is required' END, CASE WHEN no_date THEN 'event_date is required' WHEN bad_date THEN 'event_date is not a valid date' END]
  WHEN 'SourceSystemC' THEN [CASE WHEN no_type THEN 'event_type is required' END, CASE WHEN NOT no_tags AND bad_tags THEN 'tags is not a valid array<string>' END]
  ELSE ['unknown source system'] END, lambda x: x IS NOT NULL) AS reasons FROM w)
"""

ORACLE = {
    "messages_by_schema": SCHEMAS + "SELECT file_name, row_no, source_system, topic, CASE WHEN len(reasons) = 0 THEN value END AS value, array_to_string(reasons, '; ') AS reasons FROM checked",
    "message_run_reasons": SCHEMAS + """, each AS (SELECT source_system, file_name, reason, count(*) AS n FROM (SELECT source_system, file_name, unnest(reasons) AS reason FROM checked) GROUP BY ALL)
SELECT c.source_system, c.file_name, count(*) AS n_total, count(*) FILTER (len(reasons) = 0) AS n_ok, count(*) FILTER (len(reasons) > 0) AS n_failed,
 coalesce((SELECT string_agg(reason || ': ' || n, '; ' ORDER BY reason) FROM each e WHERE e.source_system = c.source_system AND e.file_name = c.file_name), '') AS failure_reasons
FROM checked c GROUP BY c.source_system, c.file_name""",
    "json_by_schema": cte("json_messages") + """, told(source_system, kind, reasons) AS (VALUES
 ('myRetirementApp', 0, ''), ('myRetirementApp', 1, 'customer_id is not a valid string'), ('myRetirementApp', 2, 'customer_id is required; more is not in the schema; more.y is not in the schema'),
 ('myRetirementApp', 3, 'payload is not a JSON object'), ('myRetirementApp', 4, 'event_date is not a valid date'),
 ('SourceSystemB', 0, 'customer_id is not a valid long; event_date is required; tags is not in the schema'), ('SourceSystemB', 1, ''),
 ('SourceSystemB', 2, 'customer_id is required; event_date is required; event_type is not in the schema; more is not in the schema; more.y is not in the schema'), ('SourceSystemB', 3, 'payload is not a JSON object'),
 ('SourceSystemB', 4, 'customer_id is not a valid long; event_date is not a valid date; event_type is not in the schema'),
 ('SourceSystemC', 0, 'event_type is required; customer_id is not in the schema'), ('SourceSystemC', 1, 'event_type is required; customer_id is not in the schema; event_date is not in the schema'),
 ('SourceSystemC', 2, 'more is not in the schema; more.y is not in the schema'), ('SourceSystemC', 3, 'payload is not a JSON object'),
 ('SourceSystemC', 4, 'event_type is required; customer_id is not in the schema; event_date is not in the schema'))
SELECT file_name, row_no, m.source_system, payload, coalesce(t.reasons, 'unknown source system') AS reasons, 'STRICT' AS mode
FROM json_messages m LEFT JOIN told t ON m.source_system = t.source_system AND row_no % 5 = t.kind
UNION ALL SELECT file_name, row_no, source_system, payload, '', 'RAW' FROM json_messages""",
    "csv_to_messages": TYPED + f"""SELECT file_name, row_no, {MSG_KEY.format(b='cust_blank')} AS key,
 CAST(json_object('customer_id', customer_id, 'event_type', event_type, 'event_date', event_date, 'tags', tags) AS VARCHAR) AS value, topic
FROM t WHERE reason = ''""",
    "flatxml_dataset": """SELECT 'app.region' AS table_name, 'r_name,r_regionkey' AS columns, concat_ws(',', 'r_name=' || r_name, 'r_regionkey=' || r_regionkey) AS cells FROM region
UNION ALL SELECT 'app.nation', 'n_name,n_nationkey,n_regionkey', concat_ws(',', 'n_name=' || n_name, 'n_nationkey=' || n_nationkey, 'n_regionkey=' || n_regionkey) FROM nation
UNION ALL SELECT 'app.supplier', 's_name,s_nationkey,s_suppkey', concat_ws(',', CASE WHEN s_suppkey % 7 = 6 THEN 's_name=' || s_name END, CASE WHEN s_suppkey % 2 = 0 THEN 's_nationkey=' || s_nationkey END, 's_suppkey=' || s_suppkey) FROM supplier""",
    "csv_records": cte("notes_csv") + """SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY row_no) AS row_no, CAST(row_no AS VARCHAR) AS written,
 sha256(note) AS note_hash, CASE WHEN tags <> '' THEN tags END AS tags FROM notes_csv""",
    "json_records": cte("notes_csv") + """SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY row_no) AS row_no, CAST(row_no AS VARCHAR) AS written,
 sha256('{' || chr(10) || '  "row": ' || row_no || ',' || chr(10) || '  "list": [' || chr(10) || '    "]}{", "a \\" [",' || chr(10) || '    {}' || chr(10) || '  ]' || chr(10) || '}') AS payload_hash FROM notes_csv""",
    "message_fill_missing": TYPED + """SELECT file_name, row_no, source_system, topic, customer_id, event_type,
 CAST(event_date AS VARCHAR) AS event_date, array_to_string(tags, ',') AS tags, reason, reason = '' AS is_valid FROM t""",
    "message_fill_missing_tabs": TYPED + """SELECT file_name, row_no, CASE WHEN row_no % 3 = 2 THEN customer_id END AS customer_id,
 CASE WHEN row_no % 3 = 2 OR cust_blank THEN reason ELSE concat_ws('; ', CASE WHEN topic IS NULL THEN 'unknown source system' END, 'customer_id is required',
  CASE WHEN date_bad THEN 'event_date is not a valid date' END, CASE WHEN tags_bad THEN 'tags is not a JSON array' END) END AS reason FROM t""",
    "message_array_field": TYPED + """SELECT file_name, row_no, tags_raw, array_to_string(tags, ',') AS tags,
 NOT tags_bad AS tags_valid FROM t""",
    "message_keys": cte("messages_csv") + f"""SELECT file_name, row_no,
 {MSG_KEY.format(b=BLANK.format(c='customer_id'))} AS message_key FROM messages_csv""",
    "message_sequence": TYPED + """SELECT file_name, row_no, CAST(row_number() OVER (PARTITION BY file_name ORDER BY row_no) AS INTEGER) AS seq
 FROM t WHERE reason = ''""",
    "message_failures": TYPED + f"""SELECT file_name, row_no, source_system, unnest(string_split(reason, '; ')) AS message,
 '{RUN_TS}' AS failed_at FROM t WHERE reason <> ''""",
    "message_run_summary": TYPED + """SELECT source_system, file_name, count(*) AS n_total, count(*) FILTER (WHERE reason = '') AS n_ok,
 count(*) FILTER (WHERE reason <> '') AS n_failed FROM t GROUP BY ALL""",
    "json_raw_passthrough": cte("messages_csv") + """SELECT file_name, row_no, tags AS payload, json_valid(tags) AS published, 'STRICT' AS mode FROM messages_csv
UNION ALL SELECT file_name, row_no, tags, true, 'RAW' FROM messages_csv""",
    "pr_activity": cte("prs", "pr_reviewers") + f""", users AS (SELECT 'u' || CAST(i AS VARCHAR) AS user_name FROM range(60) t(i) UNION ALL SELECT 'u900'),
s AS (SELECT author, count(*) AS n FROM prs WHERE floor(epoch_ms(created_at) / 1000) BETWEEN {PR_START_S} AND {PR_END_S} GROUP BY author),
r AS (SELECT reviewer, count(*) AS n FROM pr_reviewers GROUP BY reviewer)
SELECT u.user_name, coalesce(s.n, 0) AS submitted, coalesce(r.n, 0) AS reviewed FROM users u
 LEFT JOIN s ON s.author = u.user_name LEFT JOIN r ON r.reviewer = u.user_name""",
    "epoch_millis": cte("prs") + """SELECT pr_id, epoch_ms(created_at) AS created_ms,
 strftime(make_timestamp(CAST(floor(epoch_ms(created_at) / 1000) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS created_ts FROM prs""",
}

# Statements from the script text: cut, trimmed, then read word by word (the
# words before the table's name are taken off; no pattern of the operator).
STMTS = cte("ddl_scripts") + r""", cut AS (SELECT script_id, string_split_regex(script, ';[ \t]*\n') AS parts FROM ddl_scripts),
piece AS (SELECT script_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS raw FROM cut),
s1 AS (SELECT script_id, CAST(pos AS INTEGER) AS pos, rtrim(ltrim(raw, E' \t\r\n'), E'; \t\r\n') AS stmt FROM piece),
s2 AS (SELECT *, list_filter(string_split(stmt, ' '), lambda w: upper(w) NOT IN ('UNLOGGED', 'TEMPORARY', 'TEMP', 'IF', 'NOT', 'EXISTS', 'ONLY')) AS ws FROM s1 WHERE stmt <> ''),
s AS (SELECT script_id, pos, stmt, CASE WHEN upper(ws[1]) IN ('CREATE', 'ALTER') AND upper(ws[2]) = 'TABLE' THEN upper(ws[1]) ELSE 'OTHER' END AS command,
 CASE WHEN upper(ws[1]) IN ('CREATE', 'ALTER') AND upper(ws[2]) = 'TABLE' THEN replace(ws[3], '"', '') END AS table_name,
 CASE WHEN contains(upper(stmt), 'PRIMARY KEY') THEN 'primary_key' WHEN contains(upper(stmt), 'FOREIGN KEY') THEN 'foreign_key' ELSE 'other' END AS key_class FROM s2),
cr AS (SELECT DISTINCT script_id, table_name FROM s WHERE command = 'CREATE'),
sp AS (SELECT s.script_id, s.pos, s.stmt, s.table_name, s.key_class,
 CASE WHEN cr.table_name IS NOT NULL THEN 'new' ELSE 'existing' END AS target FROM s
 LEFT JOIN cr ON s.script_id = cr.script_id AND s.table_name = cr.table_name WHERE s.command <> 'CREATE')
"""

ORACLE.update({
    "ddl_statements": STMTS + "SELECT script_id, pos, stmt, command, table_name, key_class FROM s",
    "ddl_split": STMTS + "SELECT script_id, pos, stmt, table_name, target FROM sp",
    "ddl_ordered": STMTS + """, c AS (SELECT script_id, table_name, min(pos) AS create_pos, arg_max(stmt, pos) AS stmt FROM s
 WHERE command = 'CREATE' GROUP BY ALL),
u AS (SELECT script_id, table_name, create_pos, 0 AS rnk, 0 AS pos, stmt FROM c
 UNION ALL SELECT sp.script_id, sp.table_name, c.create_pos,
  CASE sp.key_class WHEN 'primary_key' THEN 1 WHEN 'foreign_key' THEN 2 ELSE 3 END, sp.pos, sp.stmt
 FROM sp JOIN c ON sp.script_id = c.script_id AND sp.table_name = c.table_name WHERE sp.target = 'new')
SELECT script_id, create_pos, rnk AS class_rank, pos, table_name, stmt || ';' AS stmt FROM u""",
    "approval_fanout": cte("approvals") + """, ok AS (SELECT * FROM approvals WHERE status = 'approved')
SELECT DISTINCT 'database' AS target, database_name, CAST(NULL AS VARCHAR) AS value FROM ok
 WHERE database_name NOT IN ('db0', 'db1', 'db2', 'db3', 'db4', 'db5', 'db6', 'db7', 'db8', 'db9')
UNION ALL SELECT DISTINCT 'release', database_name, CAST(release_date AS VARCHAR) FROM ok
UNION ALL SELECT DISTINCT 'stakeholder', database_name, s FROM (SELECT database_name, unnest(string_split(stakeholders, ';')) AS s FROM ok)
 WHERE s <> ''""",
    "flatxml_roundtrip": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment,
 CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '' ELSE c_name END AS c_note FROM customer""",
    "export_limited": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100",
})


def _snapshot_oracle():
    from relcheck.plans.catalog import ORACLE as C
    return C["catalog_tables_nested"]


ORACLE["snapshot_json_roundtrip"] = _snapshot_oracle()
