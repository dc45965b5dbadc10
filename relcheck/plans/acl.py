"""Registered queries for the event ACL (E1-E14, S4) over ``acl_source``,
with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from relcheck.functions.text import session_key
from relcheck.functions.time import ts_text
from relcheck.operators import events as ev
from relcheck.operators.messages import sequence_within
from relcheck.sources.fixtures import cte, fixture

CFG = ev.AclConfig()
# Fixed run time for dead letters so results are reproducible.
RUN_TS = "2024-02-01T00:00:00.000+0000"


def _stages(spark, sf_dir):
    src = fixture(spark, sf_dir, "acl_source")
    kept = ev.filter_view_only(src, CFG.view_only)
    trimmed = ev.trim_strings(ev.keep_original(kept))
    valid, invalid = ev.split_valid(trimmed)
    return src, kept, trimmed, valid, invalid


def q_view_only_filter(spark, sf_dir):
    _, kept, *_ = _stages(spark, sf_dir)
    return kept.withColumn("event_ts", ts_text("event_ts"))


def q_trim(spark, sf_dir):
    _, _, trimmed, *_ = _stages(spark, sf_dir)
    return trimmed.drop("_orig").withColumn("event_ts", ts_text("event_ts"))


def q_validate(spark, sf_dir):
    _, _, trimmed, *_ = _stages(spark, sf_dir)
    return ev.validate(trimmed).select("event_id", "is_valid",
                                       F.array_join("reasons", "; ").alias("reason"))


def q_dead_letter(spark, sf_dir):
    *_, invalid = _stages(spark, sf_dir)
    return ev.dead_letter(invalid, F.lit(RUN_TS), CFG.source_topic)


def q_enum_map(spark, sf_dir):
    *_, valid, _ = _stages(spark, sf_dir)
    return ev.map_event_type(valid, CFG.enum_map, CFG.default_event_type) \
        .select("event_id", "application_software", "event_type")


def q_unmapped_values(spark, sf_dir):
    *_, valid, _ = _stages(spark, sf_dir)
    return ev.unmapped_values(valid, CFG.enum_map)


def q_map_v1(spark, sf_dir):
    *_, valid, _ = _stages(spark, sf_dir)
    return ev.flatten(ev.to_interaction_v1(valid, CFG.enum_map, CFG.default_event_type))


def q_schema_compliance(spark, sf_dir):
    _, _, trimmed, *_ = _stages(spark, sf_dir)
    mapped = ev.to_interaction_v1(trimmed.drop("_orig"), CFG.enum_map, CFG.default_event_type)
    domain = sorted(set(CFG.enum_map.values()) | {CFG.default_event_type})
    return ev.schema_compliance(mapped, ev.DESTINATION_SCHEMA, "event_id",
                                {"event_type": domain})


def q_sessions(spark, sf_dir):
    *_, valid, _ = _stages(spark, sf_dir)
    return ev.flatten(ev.session_interactions(valid, CFG)).drop("event_id")


def q_open_sessions(spark, sf_dir):
    *_, valid, _ = _stages(spark, sf_dir)
    return ev.open_sessions(valid, CFG.end_codes).withColumn("first_event_ts", ts_text("first_event_ts"))


def q_metrics(spark, sf_dir):
    return ev.metrics(fixture(spark, sf_dir, "acl_source"), CFG)


def q_partition_order(spark, sf_dir):
    """The order in which a customer's interactions are published, as data: the
    place of each offset among its customer's."""
    *_, valid, _ = _stages(spark, sf_dir)
    published = ev.to_interaction_v1(valid, CFG.enum_map).select("customer_id", "event_id")
    return sequence_within(published, ["customer_id"], "event_id", out="position")


def q_session_key(spark, sf_dir):
    *_, valid, _ = _stages(spark, sf_dir)
    return valid.groupBy("customer_id", "session_id").agg(F.count(F.lit(1)).alias("n_events")) \
        .withColumn("session_key", session_key("customer_id", "session_id"))


QUERIES = {
    "acl_view_only_filter": q_view_only_filter,
    "acl_trim": q_trim,
    "acl_validate": q_validate,
    "acl_dead_letter": q_dead_letter,
    "acl_enum_map": q_enum_map,
    "acl_unmapped_values": q_unmapped_values,
    "acl_map_v1": q_map_v1,
    "acl_schema_compliance": q_schema_compliance,
    "acl_sessions": q_sessions,
    "acl_open_sessions": q_open_sessions,
    "acl_metrics": q_metrics,
    "acl_partition_order": q_partition_order,
    "session_key": q_session_key,
}

# ---------------------------------------------------------------- oracle
TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%g+0000')"
ENUM = ("CASE {c} WHEN 'mra-web' THEN 'WEB' WHEN 'mra-mobile' THEN 'MOBILE' "
        "WHEN 'mra-ivr' THEN 'IVR' ELSE 'UNKNOWN' END")


def _trim(c):
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g') AS {c}"


ACL_CHAIN = """,
kept AS (SELECT * FROM acl_source WHERE event_type_cd IS NULL OR event_type_cd NOT IN ('view')),
trimmed AS (SELECT event_id, """ + ", ".join(_trim(c) for c in ["application_software"]) + """, event_ts, """ + \
    ", ".join(_trim(c) for c in ["customer_id", "client_id", "event_type_cd", "event_response_txt", "session_id"]) + """ FROM kept),
checked AS (SELECT *, concat_ws('; ',
   CASE WHEN event_ts IS NULL THEN 'EventTS is required' END,
   CASE WHEN customer_id IS NULL OR customer_id = '' THEN 'CustomerID is required and must not be blank' END,
   CASE WHEN event_type_cd IS NULL THEN 'EventTypeCd is required' END) AS reason FROM trimmed),
valid AS (SELECT * EXCLUDE (reason) FROM checked WHERE reason = ''),
ends AS (SELECT customer_id, session_id, min(event_id) AS close_id FROM valid WHERE event_type_cd IN ('purchase') GROUP BY customer_id, session_id),
starts AS (SELECT v.customer_id, v.session_id, min(v.event_ts) AS start_ts FROM valid v JOIN ends e ON v.customer_id = e.customer_id AND v.session_id = e.session_id WHERE v.event_id <= e.close_id GROUP BY v.customer_id, v.session_id)
"""
ACL_CTE = cte("acl_source") + ACL_CHAIN

ORACLE = {
    "acl_view_only_filter": ACL_CTE + f"""SELECT event_id, application_software, {TS_TEXT.format(c='event_ts')} AS event_ts,
 customer_id, client_id, event_type_cd, event_response_txt, session_id FROM kept""",
    "acl_trim": ACL_CTE + f"""SELECT event_id, application_software, {TS_TEXT.format(c='event_ts')} AS event_ts,
 customer_id, client_id, event_type_cd, event_response_txt, session_id FROM trimmed""",
    "acl_validate": ACL_CTE + "SELECT event_id, reason = '' AS is_valid, reason FROM checked",
    "acl_dead_letter": ACL_CTE + f"""SELECT c.event_id,
 CAST(json_object('event_id', k.event_id, 'application_software', k.application_software,
  'event_ts', {TS_TEXT.format(c='k.event_ts')}, 'customer_id', k.customer_id, 'client_id', k.client_id,
  'event_type_cd', k.event_type_cd, 'event_response_txt', k.event_response_txt, 'session_id', k.session_id) AS VARCHAR) AS payload,
 '{RUN_TS}' AS error_ts, c.reason, 'MyRetirement' AS source_topic
FROM checked c JOIN kept k ON c.event_id = k.event_id WHERE c.reason <> ''""",
    "acl_enum_map": ACL_CTE + f"SELECT event_id, application_software, {ENUM.format(c='application_software')} AS event_type FROM valid",
    "acl_unmapped_values": ACL_CTE + """SELECT application_software, count(*) AS n_events FROM valid
 WHERE application_software IS NULL OR application_software NOT IN ('mra-web', 'mra-mobile', 'mra-ivr') GROUP BY application_software""",
    "acl_map_v1": ACL_CTE + f"""SELECT event_id, session_id, {ENUM.format(c='application_software')} AS event_type,
 {ISO.format(c='event_ts')} AS interaction_start_ts, customer_id, client_id AS event_client_id,
 event_type_cd AS event_event_type_cd, event_response_txt AS event_event_response_text FROM valid""",
    "acl_schema_compliance": ACL_CTE + """SELECT 'E9' AS check_id, 'interaction' AS object_kind, CAST(event_id AS VARCHAR) AS object_key,
 f.field, 'VIOLATION' AS status, 'not null' AS expected, CAST(NULL AS VARCHAR) AS actual
FROM trimmed, (VALUES ('interaction_start_ts'), ('customer_id'), ('event.event_type_cd')) AS f(field)
WHERE (f.field = 'interaction_start_ts' AND event_ts IS NULL) OR (f.field = 'customer_id' AND customer_id IS NULL)
   OR (f.field = 'event.event_type_cd' AND event_type_cd IS NULL)""",
    "acl_sessions": ACL_CTE + f"""SELECT e.customer_id, e.session_id, {ENUM.format(c='v.application_software')} AS event_type,
 {ISO.format(c='s.start_ts')} AS interaction_start_ts, v.client_id AS event_client_id,
 v.event_type_cd AS event_event_type_cd, v.event_response_txt AS event_event_response_text
FROM ends e JOIN starts s ON e.customer_id = s.customer_id AND e.session_id = s.session_id JOIN valid v ON v.event_id = e.close_id""",
    "acl_open_sessions": ACL_CTE + f"""SELECT customer_id, session_id, count(*) AS n_events, min(event_id) AS first_event_id,
 {TS_TEXT.format(c='min(event_ts)')} AS first_event_ts FROM valid GROUP BY customer_id, session_id
 HAVING count(*) FILTER (WHERE event_type_cd IN ('purchase')) = 0""",
    "acl_metrics": ACL_CTE + """SELECT 'received' AS metric, (SELECT count(*) FROM acl_source) AS value
UNION ALL SELECT 'filtered_view_only', (SELECT count(*) FROM acl_source WHERE event_type_cd IN ('view'))
UNION ALL SELECT 'validation_failures', (SELECT count(*) FROM checked WHERE reason <> '')
UNION ALL SELECT 'dead_lettered', (SELECT count(*) FROM checked WHERE reason <> '')
UNION ALL SELECT 'transformed', (SELECT count(*) FROM valid)
UNION ALL SELECT 'published', (SELECT count(*) FROM ends)""",
    "acl_partition_order": ACL_CTE + """SELECT customer_id, event_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY event_id) AS INTEGER) AS position FROM valid""",
    "session_key": ACL_CTE + """SELECT customer_id, session_id, count(*) AS n_events, concat(customer_id, session_id) AS session_key
 FROM valid GROUP BY customer_id, session_id""",
}
