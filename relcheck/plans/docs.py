"""Registered queries: canonical document comparison (C15) and root
section filtering (C16) over ``json_docs``."""

from __future__ import annotations

from pyspark.sql import functions as F

from relcheck.operators import documents as doc
from relcheck.sources.fixtures import cte, fixture

# Fixed values of the comparison config.
IGNORE_KEYS = ["remarks"]
IGNORE_SECTIONS = ["databaseInfo"]
NORMALIZE_KEYS = ["definitionX"]
INCLUDE_ROOT = ["tables", "props", "databaseInfo", "views"]


def _diff(spark, d, expected, actual):
    return doc.document_diff(fixture(spark, d, expected), fixture(spark, d, actual), "doc_id", "doc", ignore_keys=IGNORE_KEYS,
                             ignore_sections=IGNORE_SECTIONS, normalize_keys=NORMALIZE_KEYS)


def q_json_canonical_diff(spark, d):
    return _diff(spark, d, "json_docs", "json_docs_dev")


def q_json_element_pairing(spark, d):
    return _diff(spark, d, "json_pairs", "json_pairs_dev")


def q_json_empty_containers(spark, d):
    return _diff(spark, d, "json_empty", "json_empty_dev")


def q_json_unparsable(spark, d):
    return _diff(spark, d, "json_broken", "json_broken_dev")


def q_json_deep(spark, d):
    return _diff(spark, d, "json_deep", "json_deep_dev")


def q_json_hard(spark, d):
    """Documents that must not pass for equal, and some that must."""
    found = _diff(spark, d, "json_hard", "json_hard_dev")
    whole = F.col("status") == "CHANGED"  # of these the hashes are left out
    return found.withColumns({c: F.when(~whole, F.col(c)) for c in ("expected", "actual")})


def q_json_root_filter(spark, d):
    return doc.root_keys(fixture(spark, d, "json_docs"), "doc_id", "doc", INCLUDE_ROOT, IGNORE_SECTIONS)


QUERIES = {
    "json_canonical_diff": q_json_canonical_diff,
    "json_root_filter": q_json_root_filter,
    "json_element_pairing": q_json_element_pairing,
    "json_empty_containers": q_json_empty_containers,
    "json_unparsable": q_json_unparsable,
    "json_deep": q_json_deep,
    "json_hard": q_json_hard,
}

LEAVES = """SELECT d.doc_id, regexp_replace(j.fullkey, '\\[[0-9]+\\]', '[]', 'g') AS path,
 CASE WHEN j.type = 'VARCHAR' AND j.key IN ('definitionX')
  THEN CAST(to_json(trim(regexp_replace(j.atom->>'$', '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))) AS VARCHAR)
  ELSE CAST(j.atom AS VARCHAR) END AS value
FROM {t} d, json_tree(d.doc) j
WHERE j.type NOT IN ('OBJECT', 'ARRAY') AND NOT regexp_matches(j.fullkey, '\\.(remarks)(\\.|\\[|$)')
  AND regexp_extract(j.fullkey, '^\\$\\.([^.\\[]+)', 1) NOT IN ('databaseInfo')"""

# The hard cases are told from the values the documents were made of, not
# from their JSON.
_DOC = "'C15' AS check_id, 'document' AS object_kind, CAST(event_id AS VARCHAR) AS object_key"
_PAIR = """'{{"a":' || {a} || ',"b":' || {b} || '}}'"""
_A, _B = "(event_id % 7)", "(event_id % 5)"


def _one(status, field, value, where):
    e, a = (value, "CAST(NULL AS VARCHAR)") if status == "MISSING" else ("CAST(NULL AS VARCHAR)", value)
    return f"SELECT {_DOC}, {field} AS field, '{status}' AS status, {e} AS expected, {a} AS actual FROM events WHERE {where}"


ORACLE = {
    "json_hard": " UNION ALL ".join([
        _one("MISSING", r"'$.a\.b'", "CAST(event_id AS VARCHAR)", "event_id % 6 = 0"), _one("UNEXPECTED", "'$.a.b'", "CAST(event_id AS VARCHAR)", "event_id % 6 = 0"),
        _one("MISSING", r"'$.a\[\]'", "CAST(event_id AS VARCHAR)", "event_id % 6 = 1"), _one("UNEXPECTED", "'$.a[]'", "CAST(event_id AS VARCHAR)", "event_id % 6 = 1"),
        _one("MISSING", "'$.k'", "'1'", "event_id % 6 = 2"),
        f"SELECT {_DOC}, '$' AS field, 'CHANGED' AS status, CAST(NULL AS VARCHAR) AS expected, CAST(NULL AS VARCHAR) AS actual FROM events WHERE event_id % 6 = 3"]),
    "json_element_pairing": " UNION ALL ".join([
        _one("MISSING", "'$.m[]'", _PAIR.format(a=_A, b=_B), "event_id % 3 = 0"),
        _one("MISSING", "'$.m[]'", _PAIR.format(a="(" + _A + " + 10)", b="(" + _B + " + 10)"), "event_id % 3 = 0"),
        _one("UNEXPECTED", "'$.m[]'", _PAIR.format(a=_A, b="(" + _B + " + 10)"), "event_id % 3 = 0"),
        _one("UNEXPECTED", "'$.m[]'", _PAIR.format(a="(" + _A + " + 10)", b=_B), "event_id % 3 = 0")]),
    "json_empty_containers": " UNION ALL ".join([
        _one("MISSING", "'$.x'", "'{}'", "event_id % 2 = 0"), _one("MISSING", "'$.y'", "'[]'", "event_id % 2 = 0")]),
    "json_unparsable": " UNION ALL ".join([
        _one("MISSING", "'$'", "'{bad' || event_id", "event_id % 10 = 0"), _one("UNEXPECTED", "'$'", "'{worse' || event_id", "event_id % 10 = 0")]),
    "json_deep": " UNION ALL ".join([
        _one("MISSING", "'$' || repeat('.a', 20) || '[]'", "'1'", "event_id % 13 = 0"),
        _one("UNEXPECTED", "'$' || repeat('.a', 20) || '[]'", "'9'", "event_id % 13 = 0")]),
    "json_canonical_diff": cte("json_docs", "json_docs_dev") + f""", le AS ({LEAVES.format(t='json_docs')}),
la AS ({LEAVES.format(t='json_docs_dev')}),
u AS (SELECT doc_id, path, value, 1 AS e, 0 AS a FROM le UNION ALL SELECT doc_id, path, value, 0, 1 FROM la),
g AS (SELECT doc_id, path, value, sum(e) AS ne, sum(a) AS na FROM u GROUP BY ALL HAVING sum(e) <> sum(a))
SELECT 'C15' AS check_id, 'document' AS object_kind, CAST(doc_id AS VARCHAR) AS object_key, path AS field,
 CASE WHEN ne > na THEN 'MISSING' ELSE 'UNEXPECTED' END AS status,
 CASE WHEN ne > na THEN value END AS expected, CASE WHEN ne <= na THEN value END AS actual FROM g""",
    "json_root_filter": cte("json_docs") + """SELECT doc_id, root_key FROM (SELECT doc_id, unnest(json_keys(doc)) AS root_key FROM json_docs)
 WHERE root_key NOT IN ('databaseInfo') AND root_key IN ('tables', 'props', 'databaseInfo', 'views')""",
}
