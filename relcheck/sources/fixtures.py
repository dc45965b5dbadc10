"""Derived inputs (FIXTURES.md §3 plus the dev sides listed in §4).

Each input is one SQL statement over the driver tables or other derived
inputs. Table references are ``{name}`` placeholders, so the *same text*
is run by Spark (``spark.sql(text, name=DataFrame)``) and inlined as a CTE
in the DuckDB oracle queries. Literal braces are doubled.

These are test inputs, derived by Spark from the given tables so that
their size grows with the scale factor; the library operators never
depend on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from relcheck.sources.files import new_scratch
from relcheck.sources.tables import TABLES, table

FIXTURE_SQL: dict[str, str] = {}
FIXTURE_DUCKDB: dict[str, str] = {}

FIXTURE_SQL["acl_source"] = """
SELECT event_id,
 CASE event_id % 5 WHEN 0 THEN 'mra-web' WHEN 1 THEN 'mra-mobile' WHEN 2 THEN 'mra-ivr' WHEN 3 THEN 'mra-web' ELSE 'legacy-x' END AS application_software,
 CASE WHEN event_id % 211 = 0 THEN NULL ELSE ts END AS event_ts,
 CASE WHEN event_id % 101 = 0 THEN '   ' WHEN event_id % 11 = 0 THEN concat('  ', cast(user_id AS string), ' ') ELSE cast(user_id AS string) END AS customer_id,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('C', cast(user_id % 10 AS string)) END AS client_id,
 CASE WHEN event_id % 53 = 0 THEN NULL ELSE event_type END AS event_type_cd,
 props AS event_response_txt,
 cast(cast(ts AS date) AS string) AS session_id
FROM {events}
"""

FIXTURE_SQL["event_type_ref"] = """
SELECT * FROM (VALUES ('view', 'Viewed a page'), ('click', 'Clicked'), ('signup', 'Signed up'), ('purchase', 'Completed purchase'), ('purchase', 'Completed purchase')) AS t(event_type_cd, event_type_description)
"""

FIXTURE_SQL["requests"] = """
SELECT c_custkey AS request_id, CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE cast(c_custkey % 170 AS string) END AS customer_id,
 CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE concat('C', cast(c_custkey % 10 AS string)) END AS client_id,
 TIMESTAMP '2024-01-05 00:00:00' AS start_dt, TIMESTAMP '2024-01-20 00:00:00' AS end_dt,
 CASE WHEN c_custkey % 4 = 0 THEN 'mra-web;mra-ivr' ELSE '' END AS exclude_app,
 concat('BT', cast(c_custkey AS string)) AS biz_id, concat('TX', cast(c_custkey AS string)) AS transaction_id FROM {customer}
"""

# A third of all events come from client C7; ranges from hours to the whole month.
FIXTURE_SQL["contact_source"] = """
SELECT event_id, application_software, event_ts, customer_id, CASE WHEN event_id % 3 = 0 THEN 'C7' ELSE client_id END AS client_id, event_type_cd, event_response_txt, session_id,
 CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('T', cast(event_id % 4 AS string)) END AS contact_id FROM {acl_source}
"""
FIXTURE_SQL["contact_requests"] = """
SELECT request_id, customer_id, client_id, CASE WHEN request_id % 3 = 0 THEN NULL ELSE concat('T', cast(request_id % 5 AS string)) END AS contact_id,
 CASE request_id % 4 WHEN 0 THEN TIMESTAMP '2024-01-03 10:30:00' WHEN 1 THEN TIMESTAMP '2024-01-07 00:00:00' WHEN 2 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE TIMESTAMP '2024-01-09 00:00:00' END AS start_dt,
 CASE request_id % 4 WHEN 0 THEN TIMESTAMP '2024-01-05 09:15:00' WHEN 1 THEN TIMESTAMP '2024-01-07 12:00:00' WHEN 2 THEN TIMESTAMP '2099-01-01 00:00:00' ELSE TIMESTAMP '2024-01-08 00:00:00' END AS end_dt
FROM {requests}
"""

FIXTURE_SQL["cat_columns"] = """
SELECT concat('db', cast(l_orderkey % 20 AS string)) AS table_schema, concat('t', cast(l_orderkey AS string)) AS table_name,
 concat('c', cast(l_linenumber AS string)) AS column_name, l_linenumber AS ordinal_position,
 CASE l_returnflag WHEN 'A' THEN 'int4' WHEN 'N' THEN 'text' ELSE 'numeric' END AS data_type,
 CASE l_linestatus WHEN 'O' THEN 'YES' ELSE 'NO' END AS is_nullable,
 CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE cast(l_quantity AS int) END AS num_precision,
 CASE WHEN l_partkey % 4 = 0 THEN 0 ELSE cast(l_partkey % 6 AS int) END AS num_scale
FROM (SELECT l.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_returnflag, l_linestatus) AS rn FROM {lineitem} l) x WHERE rn = 1
"""

FIXTURE_SQL["cat_columns_dev"] = """
SELECT table_schema, table_name, column_name, ordinal_position,
 CASE WHEN k % 89 = 0 THEN 'varchar' ELSE data_type END AS data_type,
 CASE WHEN k % 83 = 0 THEN CASE is_nullable WHEN 'YES' THEN 'NO' ELSE 'YES' END ELSE is_nullable END AS is_nullable,
 num_precision, CASE WHEN k % 79 = 0 AND num_scale = 0 THEN NULL ELSE num_scale END AS num_scale
FROM (SELECT c.*, cast(substr(table_name, 2) AS bigint) * 31 + ordinal_position AS k, cast(substr(table_name, 2) AS bigint) AS tk FROM {cat_columns} c) y
WHERE k % 97 <> 0 AND tk % 67 <> 0
UNION ALL SELECT table_schema, table_name, 'x_new', 99, 'text', 'YES', NULL, NULL FROM {cat_columns} WHERE ordinal_position = 1 AND cast(substr(table_name, 2) AS bigint) % 71 = 0
"""

# Precision moved into the scale's null: the texts of both rows agree once
# nulls are left out.
FIXTURE_SQL["cat_columns_shift"] = """
SELECT table_schema, table_name, column_name, ordinal_position, data_type, is_nullable,
 CASE WHEN moved THEN num_scale ELSE num_precision END AS num_precision, CASE WHEN moved THEN num_precision ELSE num_scale END AS num_scale
FROM (SELECT c.*, cast(substr(table_name, 2) AS bigint) % 5 = 0 AND num_precision IS NULL AS moved FROM {cat_columns} c) y
"""

FIXTURE_SQL["cat_key_usage"] = """
SELECT table_schema, table_name, concat(table_name, '_pkey') AS constraint_name, 'PRIMARY KEY' AS constraint_type, column_name, ordinal_position AS pos, NULL AS ref_table, NULL AS ref_column FROM {cat_columns} WHERE ordinal_position <= 2
UNION ALL SELECT table_schema, table_name, concat(table_name, '_key'), 'UNIQUE', column_name, ordinal_position - 1, NULL, NULL FROM {cat_columns} WHERE ordinal_position BETWEEN 2 AND 3
UNION ALL SELECT table_schema, table_name, concat(table_name, '_fkey'), 'FOREIGN KEY', column_name, ordinal_position - 2, concat('t', cast(cast(substr(table_name, 2) AS bigint) + 1 AS string)), concat('c', cast(5 - ordinal_position AS string)) FROM {cat_columns} WHERE ordinal_position BETWEEN 3 AND 4
"""

FIXTURE_SQL["cat_key_usage_dev"] = """
SELECT table_schema, table_name, constraint_name, constraint_type, column_name,
 CASE WHEN cast(substr(table_name, 2) AS bigint) % 59 = 0 THEN 3 - pos ELSE pos END AS pos, ref_table, ref_column
FROM {cat_key_usage} WHERE NOT (cast(substr(table_name, 2) AS bigint) % 73 = 0 AND constraint_type <> 'UNIQUE')
"""

# The catalog's own tables behind key usage, one a kind: constraints, their
# columns, the referenced columns by position, and the rules.
for _dev in ("", "_dev"):
    FIXTURE_SQL["cat_constraints" + _dev] = f"""
SELECT DISTINCT table_schema, table_name, constraint_name, constraint_type FROM {{cat_key_usage{_dev}}}
"""
    FIXTURE_SQL["cat_key_columns" + _dev] = f"""
SELECT table_schema, table_name, constraint_name, column_name, pos FROM {{cat_key_usage{_dev}}}
"""
    FIXTURE_SQL["cat_ref_columns" + _dev] = f"""
SELECT table_schema, table_name, constraint_name, pos, ref_table, ref_column FROM {{cat_key_usage{_dev}}} WHERE constraint_type = 'FOREIGN KEY'
"""
FIXTURE_SQL["cat_ref_rules"] = """
SELECT table_schema, table_name, constraint_name, CASE WHEN k % 3 = 0 THEN 'CASCADE' ELSE 'NO ACTION' END AS update_rule,
 CASE WHEN k % 5 = 0 THEN 'SET NULL' WHEN k % 2 = 0 THEN 'RESTRICT' ELSE 'NO ACTION' END AS delete_rule
FROM (SELECT DISTINCT table_schema, table_name, constraint_name, cast(substr(table_name, 2) AS bigint) AS k FROM {cat_key_usage} WHERE constraint_type = 'FOREIGN KEY') x
"""
FIXTURE_SQL["cat_view_columns"] = """
SELECT table_schema AS view_schema, concat('v', substr(table_name, 2)) AS view_name, concat(column_name, '_v') AS column_name, ordinal_position
FROM {cat_columns} WHERE ordinal_position <> 2
"""
# Relations of every kind with schema and owner by id; every eleventh is no table.
FIXTURE_SQL["cat_classes"] = """
SELECT DISTINCT cast(substr(table_name, 2) AS bigint) AS oid, table_name AS relname, cast(substr(table_schema, 3) AS bigint) AS relnamespace,
 1 + cast(substr(table_name, 2) AS bigint) % 7 AS relowner, CASE WHEN cast(substr(table_name, 2) AS bigint) % 11 = 0 THEN 'S' ELSE 'r' END AS relkind FROM {cat_columns}
"""
FIXTURE_SQL["cat_classes_dev"] = """
SELECT oid, relname, relnamespace, CASE WHEN oid % 29 = 0 THEN 1 + (oid + 1) % 7 ELSE relowner END AS relowner, relkind FROM {cat_classes}
"""
FIXTURE_SQL["cat_namespaces"] = """
SELECT DISTINCT cast(substr(table_schema, 3) AS bigint) AS oid, table_schema AS nspname FROM {cat_columns}
"""

# A catalog that lists some columns twice, one of them with another type that
# sorts first.
FIXTURE_SQL["cat_columns_twice"] = """
SELECT * FROM {cat_columns}
UNION ALL SELECT table_schema, table_name, column_name, ordinal_position, CASE WHEN ordinal_position = 1 THEN 'bigint' ELSE data_type END, is_nullable, num_precision, num_scale
FROM {cat_columns} WHERE cast(substr(table_name, 2) AS bigint) % 61 = 0
"""

FIXTURE_SQL["cat_triggers"] = """
SELECT concat('db', cast(user_id % 20 AS string)) AS table_schema, concat('t', cast(user_id AS string)) AS table_name, concat('trg', cast(event_id % 6 AS string)) AS trigger_name,
 CASE WHEN user_id % 2 = 0 THEN 'BEFORE' ELSE 'AFTER' END AS action_timing,
 CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'UPDATE' WHEN 'error' THEN 'DELETE' ELSE 'TRUNCATE' END AS event_manipulation FROM {events}
"""

# Catalog tables behind the listings: a system schema, types of every kind and of
# no schema, functions of no known language.
FIXTURE_SQL["cat_spaces"] = """
SELECT oid, nspname, 1 + oid % 9 AS nspowner FROM {cat_namespaces} UNION ALL SELECT 900, 'pg_catalog', 1
"""
FIXTURE_SQL["cat_owner_roles"] = "SELECT DISTINCT 1 + n_nationkey % 7 AS oid, concat('role', cast(n_nationkey % 7 AS string)) AS rolname FROM {nation}"
FIXTURE_SQL["cat_types"] = """
SELECT concat('ty', cast(p_partkey AS string)) AS typname, CASE WHEN p_partkey % 13 = 0 THEN 900 ELSE p_partkey % 22 END AS typnamespace,
 substr('bcdeprx', cast(p_partkey % 7 + 1 AS int), 1) AS typtype, CASE WHEN p_size > 25 THEN cast(p_size AS string) END AS typdefault FROM {part}
"""
FIXTURE_SQL["cat_procs"] = """
SELECT concat('f', cast(p_partkey AS string)) AS proname, CASE WHEN p_partkey % 17 = 0 THEN 900 ELSE p_partkey % 20 END AS pronamespace, p_partkey % 4 AS prolang,
 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'integer, text' END AS args, CASE WHEN p_partkey % 2 = 0 THEN 'void' ELSE 'boolean' END AS returns, concat('  begin ', p_name, '  end ') AS source FROM {part}
"""
FIXTURE_SQL["cat_languages"] = "SELECT * FROM (VALUES (0, 'sql'), (1, 'plpgsql'), (2, 'c')) AS t(oid, lanname)"
FIXTURE_SQL["cat_column_grants"] = """
SELECT CASE WHEN l_orderkey % 31 = 0 THEN 'information_schema' ELSE concat('db', cast(l_orderkey % 20 AS string)) END AS table_schema, concat('t', cast(l_orderkey AS string)) AS table_name,
 concat('c', cast(l_linenumber AS string)) AS column_name, CASE WHEN l_linestatus = 'O' THEN 'SELECT' ELSE 'UPDATE' END AS privilege_type, concat('role', cast(l_suppkey % 5 AS string)) AS grantee,
 CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE 'postgres' END AS grantor, CASE WHEN l_partkey % 2 = 0 THEN 'YES' ELSE 'NO' END AS is_grantable FROM {lineitem}
"""
FIXTURE_SQL["cat_index_rows"] = """
SELECT table_schema AS schemaname, table_name AS tablename, constraint_name AS indexname, concat('CREATE UNIQUE INDEX ', constraint_name, ' ON ', table_schema, '.', table_name) AS indexdef
FROM {cat_constraints} WHERE constraint_type <> 'FOREIGN KEY'
"""
FIXTURE_SQL["cat_trigger_rows"] = """
SELECT table_schema AS trigger_schema, trigger_name, event_manipulation, table_schema AS event_object_schema, table_name AS event_object_table, 'ROW' AS action_orientation, action_timing,
 CASE WHEN trigger_name = 'trg1' THEN 'new.id > 0' END AS action_condition, concat('EXECUTE FUNCTION ', trigger_name, '()') AS action_statement FROM {cat_triggers}
"""

FIXTURE_SQL["cat_triggers_dev"] = """
SELECT * FROM {cat_triggers} WHERE trigger_name <> 'trg3'
"""

FIXTURE_SQL["cat_grants"] = """
SELECT DISTINCT concat('t', cast(o_custkey AS string)) AS table_name, concat('role_', o_orderstatus) AS grantee, o_orderpriority AS privilege_type,
 CASE WHEN o_custkey % 3 = 0 THEN 'YES' ELSE 'NO' END AS is_grantable FROM {orders}
"""

FIXTURE_SQL["cat_grants_dev"] = """
SELECT * FROM {cat_grants} WHERE privilege_type <> '5-LOW'
"""

FIXTURE_SQL["cat_roles"] = """
SELECT s_suppkey AS oid, concat('role', cast(s_suppkey AS string)) AS rolname, s_suppkey % 10 = 0 AS rolsuper FROM {supplier}
"""

FIXTURE_SQL["cat_roles_dev"] = """
SELECT * FROM {cat_roles} WHERE oid % 11 <> 0
"""

FIXTURE_SQL["cat_role_links"] = """
SELECT s_suppkey AS roleid, s_suppkey * 7 % 100 AS member FROM {supplier} WHERE s_suppkey % 3 <> 0
"""

# Sequences: one per part row, declared max 2500 (FIXTURES.md §4). The
# owning column is a lineitem key column chosen by p_partkey % 4; 0 = none.
FIXTURE_SQL["cat_sequences"] = """
SELECT concat('db', cast(p_partkey % 20 AS string)) AS sequence_schema, concat('seq', cast(p_partkey AS string)) AS sequence_name,
 'bigint' AS data_type, '1' AS start_value, '1' AS minimum_value, '2500' AS maximum_value, '1' AS increment, 'NO' AS cycle_option
FROM {part}
"""

FIXTURE_SQL["cat_sequences_dev"] = """
SELECT * FROM {cat_sequences} WHERE cast(substr(sequence_name, 4) AS bigint) % 13 <> 0
"""

FIXTURE_SQL["cat_seq_owners"] = """
SELECT concat('db', cast(p_partkey % 20 AS string)) AS sequence_schema, concat('seq', cast(p_partkey AS string)) AS sequence_name,
 'public' AS table_schema, 'lineitem' AS table_name,
 CASE p_partkey % 4 WHEN 1 THEN 'l_orderkey' WHEN 2 THEN 'l_partkey' ELSE 'l_suppkey' END AS column_name
FROM {part} WHERE p_partkey % 4 <> 0
"""

FIXTURE_SQL["cat_seq_owners_dev"] = """
SELECT sequence_schema, sequence_name, table_schema, table_name,
 CASE WHEN cast(substr(sequence_name, 4) AS bigint) % 19 = 0 THEN 'l_linenumber' ELSE column_name END AS column_name
FROM {cat_seq_owners} WHERE cast(substr(sequence_name, 4) AS bigint) % 17 <> 0
"""

FIXTURE_SQL["cat_functions"] = """
SELECT concat('s', source) AS schema_name, concat('f', cast(doc_id AS string)) AS name, lang AS args, text AS definition FROM {documents}
"""

# Dev functions: a word appended when doc_id % 17 = 0, dropped when
# doc_id % 19 = 0, and (whitespace only, so equal after normalising)
# newlines doubled when doc_id % 3 = 0.
FIXTURE_SQL["cat_functions_dev"] = """
SELECT schema_name, name, args,
 CASE WHEN cast(substr(name, 2) AS bigint) % 17 = 0 THEN concat(definition, ' changed')
      WHEN cast(substr(name, 2) AS bigint) % 3 = 0 THEN replace(definition, chr(10), concat(chr(10), '  ', chr(10)))
      ELSE definition END AS definition
FROM {cat_functions} WHERE cast(substr(name, 2) AS bigint) % 19 <> 0
"""

# Views: one per catalog table whose key % 10 = 0.
FIXTURE_SQL["cat_views"] = """
SELECT DISTINCT table_schema AS view_schema, concat('v', substr(table_name, 2)) AS view_name,
 concat('SELECT  *', chr(10), ' FROM ', table_schema, '.', table_name, '  WHERE c1 = ', cast(cast(substr(table_name, 2) AS bigint) % 7 AS string)) AS definition
FROM {cat_columns} WHERE cast(substr(table_name, 2) AS bigint) % 10 = 0
"""

FIXTURE_SQL["cat_views_dev"] = """
SELECT DISTINCT table_schema AS view_schema, concat('v', substr(table_name, 2)) AS view_name,
 CASE WHEN cast(substr(table_name, 2) AS bigint) % 30 = 0
      THEN concat('SELECT * FROM ', table_schema, '.', table_name, ' WHERE c1 = 99')
      ELSE concat('SELECT * FROM ', table_schema, '.', table_name, ' WHERE c1 = ', cast(cast(substr(table_name, 2) AS bigint) % 7 AS string)) END AS definition
FROM {cat_columns_dev} WHERE cast(substr(table_name, 2) AS bigint) % 10 = 0
"""

FIXTURE_SQL["orders_actual"] = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
 CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM {orders} WHERE o_orderkey % 97 <> 0
UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM {orders} WHERE o_orderkey % 101 = 0
"""

FIXTURE_SQL["orders_after"] = """
SELECT * FROM {orders} WHERE o_orderkey % 5003 <> 0
"""

# Some lines gone, some there twice.
FIXTURE_SQL["lineitem_forward"] = """
SELECT * FROM {lineitem} WHERE NOT (l_orderkey % 50 = 0 AND l_linenumber = 1) UNION ALL SELECT * FROM {lineitem} WHERE l_orderkey % 77 = 0
"""

# Two nullable columns of one type; the dev side shifts a value into its
# neighbour's null.
FIXTURE_SQL["shift_expected"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS a, o_orderstatus AS b FROM {orders}
"""
FIXTURE_SQL["shift_actual"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN b ELSE a END AS a, CASE WHEN o_orderkey % 6 = 0 THEN a ELSE b END AS b FROM {shift_expected}
"""

# A composite key with nulls in its first part.
FIXTURE_SQL["nullkey_expected"] = """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderstatus END AS k1, o_orderkey AS k2, o_orderpriority AS v FROM {orders}
"""
FIXTURE_SQL["nullkey_actual"] = """
SELECT k1, k2, CASE WHEN k2 % 7 = 0 THEN NULL ELSE v END AS v FROM {nullkey_expected} WHERE k2 % 10 <> 0
UNION ALL SELECT NULL, k2 + 10000000, v FROM {nullkey_expected} WHERE k2 % 11 = 0
"""

# A column renamed on the dev side.
FIXTURE_SQL["orders_other_columns"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority AS o_priority FROM {orders_actual}
"""

# Repeated keys: one row a line of an order; the dev side drops and changes some.
FIXTURE_SQL["lines_expected"] = """
SELECT l_orderkey, l_returnflag, l_linestatus FROM {lineitem}
"""
FIXTURE_SQL["lines_actual"] = """
SELECT l_orderkey, CASE WHEN l_orderkey % 31 = 0 AND l_linenumber = 1 THEN 'X' ELSE l_returnflag END AS l_returnflag, l_linestatus
FROM {lineitem} WHERE NOT (l_orderkey % 37 = 0 AND l_linenumber = 2)
"""

# A parent table that has lost some rows.
FIXTURE_SQL["customer_pruned"] = """
SELECT * FROM {customer} WHERE c_custkey % 100 <> 0
"""
# What the sink holds and what is delivered next: together all events, some of
# them delivered again.
FIXTURE_SQL["sink_existing"] = """
SELECT event_id, customer_id, event_type_description FROM {acl_source_v2} WHERE event_id % 2 = 0
"""
FIXTURE_SQL["sink_incoming"] = """
SELECT event_id, customer_id, event_type_description FROM {acl_source_v2} WHERE event_id % 2 <> 0 OR event_id % 3 = 0
"""

FIXTURE_SQL["ddl_stmts"] = """
SELECT o_custkey AS script_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos,
 concat(CASE WHEN o_orderkey % 6 = 0 THEN chr(10) WHEN o_orderkey % 11 = 0 THEN '  ' ELSE '' END,
 CASE WHEN o_orderkey % 23 = 0 THEN concat('GRANT SELECT ON app.t TO r', cast(o_orderkey AS string))
      WHEN o_orderstatus = 'F' THEN concat('CREATE ', CASE o_orderkey % 3 WHEN 0 THEN 'UNLOGGED ' WHEN 1 THEN '' ELSE 'TEMPORARY ' END, 'TABLE ',
        CASE WHEN o_orderkey % 2 = 0 THEN '"app"."t' ELSE 'app.t' END, cast(o_orderkey % 7 AS string), CASE WHEN o_orderkey % 2 = 0 THEN '"' ELSE '' END, ' (id int)')
      WHEN o_orderstatus = 'O' THEN concat('ALTER TABLE ONLY app.t', cast(o_orderkey % 7 AS string), ' ADD CONSTRAINT k PRIMARY KEY (id)')
      WHEN o_orderkey % 2 = 0 THEN concat('ALTER TABLE IF EXISTS "app".t', cast(o_orderkey % 7 AS string), ' ADD FOREIGN KEY (id) REFERENCES z(id)')
      ELSE concat('ALTER TABLE app.t', cast(o_orderkey % 7 AS string), ' ADD COLUMN v int') END) AS stmt FROM {orders}
"""

FIXTURE_SQL["messages_csv"] = """
SELECT concat('file', cast(c_nationkey % 4 AS string), '.csv') AS file_name, cast(c_custkey AS int) AS row_no,
 CASE c_custkey % 5 WHEN 0 THEN 'SourceSystemB' WHEN 1 THEN 'SourceSystemC' WHEN 2 THEN 'unknownApp' ELSE 'myRetirementApp' END AS source_system,
 CASE WHEN c_custkey % 13 = 0 THEN '' ELSE cast(c_custkey AS string) END AS customer_id,
 CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS event_type,
 CASE WHEN c_custkey % 17 = 0 THEN 'not-a-date' WHEN c_custkey % 11 = 0 THEN '' ELSE '2026-01-01' END AS event_date,
 CASE WHEN c_custkey % 19 = 0 THEN '["a",' WHEN c_custkey % 2 = 0 THEN '["a","b"]' ELSE '' END AS tags FROM {customer}
"""

# JSON payloads of five kinds, whatever the system wants.
FIXTURE_SQL["json_messages"] = """
SELECT file_name, row_no, source_system, CASE row_no % 5 WHEN 0 THEN '{{"customer_id":"c","tags":["a"]}}' WHEN 1 THEN '{{"customer_id":5,"event_date":"2026-01-01"}}'
 WHEN 2 THEN '{{"event_type":"x","more":{{"y":1}}}}' WHEN 3 THEN '{{broken' ELSE '{{"customer_id":"c","event_type":null,"event_date":"soon"}}' END AS payload FROM {messages_csv}
"""
# Messages with a note of several lines, some with quotes and commas in it.
FIXTURE_SQL["notes_csv"] = """
SELECT file_name, row_no, concat('first, line', chr(10), CASE WHEN row_no % 3 = 0 THEN '"quoted"' ELSE '' END, chr(10), CASE WHEN row_no % 5 = 0 THEN concat('say "', chr(10), '"') ELSE 'end' END) AS note, tags FROM {messages_csv}
"""

FIXTURE_SQL["prs"] = """
SELECT o_orderkey AS pr_id, concat('u', cast(o_custkey % 200 AS string)) AS author, o_orderdate AS created_at FROM {orders}
"""

FIXTURE_SQL["pr_reviewers"] = """
SELECT DISTINCT l_orderkey AS pr_id, concat('u', cast(l_suppkey AS string)) AS reviewer FROM {lineitem}
"""

FIXTURE_SQL["approvals"] = """
SELECT o_orderkey AS approval_id, CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending' ELSE 'rejected' END AS status,
 concat('db', cast(o_custkey % 50 AS string)) AS database_name, cast(o_orderdate AS date) AS release_date,
 concat(o_orderpriority, ';', concat('owner', cast(o_custkey % 9 AS string))) AS stakeholders FROM {orders}
"""

FIXTURE_SQL["json_docs"] = """
SELECT event_id AS doc_id, concat('{{"databaseInfo":{{"host":"h', cast(event_id % 3 AS string), '"}},"tables":[{{"name":"a","remarks":"x', cast(event_id AS string), '"}},{{"name":"b"}}],"views":{{"definitionX":"select  ', cast(user_id AS string), '"}},"props":', props, '}}') AS doc FROM {events}
"""

# Dev documents: double spaces collapsed (normalised away), `remarks`
# changed (ignored key), host changed (ignored section) and, when
# doc_id % 41 = 0, props.k changed (a real difference).
FIXTURE_SQL["json_docs_dev"] = """
SELECT event_id AS doc_id, concat('{{"databaseInfo":{{"host":"z', cast(event_id % 5 AS string), '"}},"tables":[{{"name":"b"}},{{"name":"a","remarks":"y', cast(event_id AS string), '"}}],"views":{{"definitionX":"select ', cast(user_id AS string), '"}},"props":',
 CASE WHEN event_id % 41 = 0 THEN '{{"k": -1}}' ELSE props END, '}}') AS doc FROM {events}
"""

# Lists of objects: the dev side swaps members between elements (a real
# difference) or only turns the list round (none).
FIXTURE_SQL["json_pairs"] = """
SELECT event_id AS doc_id, concat('{{"m":[{{"a":', cast(event_id % 7 AS string), ',"b":', cast(event_id % 5 AS string), '}},{{"b":', cast(event_id % 5 + 10 AS string), ',"a":', cast(event_id % 7 + 10 AS string), '}}]}}') AS doc FROM {events}
"""
FIXTURE_SQL["json_pairs_dev"] = """
SELECT event_id AS doc_id, CASE WHEN event_id % 3 = 0
  THEN concat('{{"m":[{{"a":', cast(event_id % 7 AS string), ',"b":', cast(event_id % 5 + 10 AS string), '}},{{"a":', cast(event_id % 7 + 10 AS string), ',"b":', cast(event_id % 5 AS string), '}}]}}')
  ELSE concat('{{"m":[{{"a":', cast(event_id % 7 + 10 AS string), ',"b":', cast(event_id % 5 + 10 AS string), '}},{{"a":', cast(event_id % 7 AS string), ',"b":', cast(event_id % 5 AS string), '}}]}}') END AS doc FROM {events}
"""
FIXTURE_SQL["json_empty"] = """
SELECT event_id AS doc_id, '{{"x":{{}},"y":[],"z":1}}' AS doc FROM {events}
"""
FIXTURE_SQL["json_empty_dev"] = """
SELECT event_id AS doc_id, CASE WHEN event_id % 2 = 0 THEN '{{"z":1}}' ELSE '{{"z":1,"y":[],"x":{{}}}}' END AS doc FROM {events}
"""
FIXTURE_SQL["json_broken"] = """
SELECT event_id AS doc_id, CASE WHEN event_id % 10 = 0 THEN concat('{{bad', cast(event_id AS string)) ELSE '{{"ok":1}}' END AS doc FROM {events}
"""
FIXTURE_SQL["json_broken_dev"] = """
SELECT event_id AS doc_id, CASE WHEN event_id % 10 = 0 THEN concat('{{worse', cast(event_id AS string)) ELSE '{{"ok":1}}' END AS doc FROM {events}
"""
# By event_id modulo 6: a dot in a name, brackets in a name, a repeated key, a
# shape that no leaf shows, one number written in two ways, equal.
FIXTURE_SQL["json_hard"] = """
SELECT event_id AS doc_id, CASE event_id % 6 WHEN 0 THEN concat('{{"a.b":', cast(event_id AS string), '}}') WHEN 1 THEN concat('{{"a[]":', cast(event_id AS string), '}}')
 WHEN 2 THEN concat('{{"k":1,"k":', cast(event_id AS string), '}}') WHEN 3 THEN '{{"a":[1],"a":[2]}}' WHEN 4 THEN concat('{{"n":', cast(event_id AS string), '.50}}') ELSE '{{"a":[1,2]}}' END AS doc FROM {events}
"""
FIXTURE_SQL["json_hard_dev"] = """
SELECT event_id AS doc_id, CASE event_id % 6 WHEN 0 THEN concat('{{"a":{{"b":', cast(event_id AS string), '}}}}') WHEN 1 THEN concat('{{"a":[', cast(event_id AS string), ']}}')
 WHEN 2 THEN concat('{{"k":', cast(event_id AS string), '}}') WHEN 3 THEN '{{"a":[1,2]}}' WHEN 4 THEN concat('{{"n":', cast(event_id AS string), '5e-1}}') ELSE '{{"a":[2.0,1]}}' END AS doc FROM {events}
"""
# Twenty levels; the innermost list is turned round, and one value differs.
FIXTURE_SQL["json_deep"] = """
SELECT event_id AS doc_id, concat(repeat('{{"a":', 20), '[1,2,', cast(event_id + 100 AS string), ']', repeat('}}', 20)) AS doc FROM {events}
"""
FIXTURE_SQL["json_deep_dev"] = """
SELECT event_id AS doc_id, concat(repeat('{{"a":', 20), '[', cast(event_id + 100 AS string), ',2,', CASE WHEN event_id % 13 = 0 THEN '9' ELSE '1' END, ']', repeat('}}', 20)) AS doc FROM {events}
"""

# v2 producer payload: the upstream now sends the description itself
# (null for codes it cannot describe).
FIXTURE_SQL["acl_source_v2"] = """
SELECT s.*, r.event_type_description FROM {acl_source} s
LEFT JOIN (SELECT event_type_cd, min(event_type_description) AS event_type_description FROM {event_type_ref} GROUP BY event_type_cd) r
 ON s.event_type_cd = r.event_type_cd
"""

# Sink events table before migration: code column, description column
# already filled for some rows.
FIXTURE_SQL["sink_events"] = """
SELECT event_id, user_id, event_type AS event_type_cd,
 CASE WHEN event_id % 13 = 0 THEN 'Legacy description' END AS event_type_description FROM {events}
"""

# Decimals at the edge of a declaration, doubles with few and many decimals.
FIXTURE_SQL["edge_numbers"] = """
SELECT l_orderkey, CAST('99999999999999999.99' AS DECIMAL(19,2)) - CAST(l_linenumber - 1 AS DECIMAL(19,2)) AS top,
 CAST(CAST(l_linenumber - 1 AS DECIMAL(4,0)) * CAST('0.0000000004' AS DECIMAL(12,10)) AS DECIMAL(20,10)) AS tiny,
 CASE WHEN l_linenumber = 2 THEN CAST('100000000000000000.00' AS DECIMAL(20,2)) ELSE CAST(l_quantity AS DECIMAL(20,2)) END AS over FROM {lineitem}
"""
# The same orders, with keys and whole numbers of other types.
FIXTURE_SQL["orders_retyped"] = """
SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS o_orderkey, CAST(o_custkey AS BIGINT) + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS o_custkey, o_orderstatus FROM {orders}
"""
FIXTURE_SQL["orders_narrow"] = """
SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS o_orderkey, CAST(o_custkey AS INT) AS o_custkey, o_orderstatus FROM {orders}
"""
# Functions without arguments have none; every fourth differs.
FIXTURE_SQL["plain_functions"] = """
SELECT concat('db', cast(p_partkey % 5 AS string)) AS function_schema, concat('f', cast(p_partkey AS string)) AS function_name,
 CASE WHEN p_partkey % 2 = 0 THEN CAST(NULL AS string) ELSE 'integer' END AS args, p_brand AS body FROM {part}
"""
FIXTURE_SQL["plain_functions_dev"] = """
SELECT concat('db', cast(p_partkey % 5 AS string)) AS function_schema, concat('f', cast(p_partkey AS string)) AS function_name,
 CASE WHEN p_partkey % 2 = 0 THEN CAST(NULL AS string) ELSE 'integer' END AS args, CASE WHEN p_partkey % 4 = 0 THEN p_type ELSE p_brand END AS body
FROM {part} WHERE p_partkey % 10 <> 6
"""
# Messages whose customer is nothing but a tab, line feed or no-break-less space.
FIXTURE_SQL["messages_tabs"] = """
SELECT file_name, row_no, source_system, CASE row_no % 3 WHEN 0 THEN chr(9) WHEN 1 THEN concat(' ', chr(10), ' ') ELSE customer_id END AS customer_id, event_type, event_date, tags FROM {messages_csv}
"""

# Ignore rules: whole names, beginnings, ends, single letters, pieces.
FIXTURE_SQL["ignore_globs"] = """
SELECT CASE c_custkey % 5 WHEN 0 THEN concat('db', cast(c_custkey % 20 AS string), '.t', cast(c_custkey AS string)) WHEN 1 THEN concat('db2.t', cast(c_custkey AS string), '*')
 WHEN 2 THEN concat('*.t', cast(c_custkey AS string), '?') WHEN 3 THEN concat('db?.*', cast(c_custkey % 100 + 100 AS string)) ELSE concat('*3.t', cast(c_custkey AS string), '*1') END AS pattern FROM {customer}
"""

# Explicit target list for table discovery: some qualified, some bare.
FIXTURE_SQL["cat_targets"] = """
SELECT CASE WHEN o_orderkey % 100 = 0 THEN concat('db', cast(o_orderkey % 20 AS string), '.t', cast(o_orderkey AS string))
 ELSE concat('t', cast(o_orderkey AS string)) END AS target FROM {orders} WHERE o_orderkey % 50 = 0
"""

# DDL scripts: the statements of a script joined with ';' + newline in
# position order (Spark and DuckDB spell the ordered string aggregate
# differently, so the DuckDB text is given separately).
FIXTURE_SQL["ddl_scripts"] = """
SELECT script_id, listagg(stmt, concat(';', chr(10))) WITHIN GROUP (ORDER BY pos) AS script FROM {ddl_stmts} GROUP BY script_id
"""
FIXTURE_DUCKDB["ddl_scripts"] = """
SELECT script_id, string_agg(stmt, concat(';', chr(10)) ORDER BY pos) AS script FROM {ddl_stmts} GROUP BY script_id
"""

FIXTURE_SQL["view_only_codes"] = "SELECT * FROM (VALUES ('view')) AS t(event_type_cd)"
FIXTURE_SQL["end_codes"] = "SELECT * FROM (VALUES ('purchase')) AS t(event_type_cd)"
FIXTURE_SQL["app_enum"] = """
SELECT * FROM (VALUES ('mra-web', 'WEB'), ('mra-mobile', 'MOBILE'), ('mra-ivr', 'IVR')) AS t(application_software, event_type)
"""
FIXTURE_SQL["topic_map"] = """
SELECT * FROM (VALUES ('myRetirementApp', 'topic-a'), ('SourceSystemB', 'topic-b'), ('SourceSystemC', 'topic-c')) AS t(source_system, topic)
"""


def _deps(sql: str) -> list[str]:
    import re
    return list(dict.fromkeys(re.findall(r"(?<!\{)\{([a-z_0-9]+)\}(?!\})", sql)))


def fixture(spark: SparkSession, sf_dir: str, name: str, have: dict[str, DataFrame] | None = None) -> DataFrame:
    """Build a derived input as a Spark DataFrame (lazy; nothing runs). Inputs in
    ``have`` are taken from there."""
    if have and name in have:
        return have[name]
    if name in TABLES:
        return table(spark, sf_dir, name)
    sql = FIXTURE_SQL[name]
    args = {d: fixture(spark, sf_dir, d, have) for d in _deps(sql)}
    return spark.sql(sql, **args) if args else spark.sql(sql.replace("{{", "{").replace("}}", "}"))


def written(spark: SparkSession, sf_dir: str, name: str) -> dict[str, DataFrame]:
    """One derived input, derived once and written, as ``have`` for others that
    read it: a query that reads it in several places would derive it in each."""
    path = new_scratch(spark, name)
    made = fixture(spark, sf_dir, name)
    made.write.parquet(path)
    return {name: spark.read.schema(made.schema).parquet(path)}


def cte(*names: str) -> str:
    """``WITH`` clause that defines the given derived inputs (and what they
    read) for DuckDB, where the driver tables are views of the same name."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in TABLES or n in order:
            return
        for d in _deps(FIXTURE_SQL[n]):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        sql = FIXTURE_DUCKDB.get(n, FIXTURE_SQL[n])
        body = sql.format(**{d: d for d in _deps(sql)}).strip()
        parts.append(f"{n} AS (\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
