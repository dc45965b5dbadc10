"""The registered query of each operator, over whole tables, and its DuckDB
SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relcheck.llm import (conversation_repair, decontaminate, license_scan, mixing, near_dedup, periodic_runs, pii, quality, sharding, simhash,
                          substring_dedup, token_counts, toxicity)
from relcheck.sources.tables import table

DOC_ID = "row.doc_id"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select(DOC_ID, F.size("removed").cast("long").alias("n_removed"), "n_words_removed",
                      F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed_units"), F.col("clean").alias("clean_text"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), carry=["doc_id"])
    return out.select(DOC_ID, "n_bytes", "n_tokens", "over_limit")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.license_scan(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select(DOC_ID, "n_sentences", "sentence_ids", F.concat_ws(",", "rules").alias("rules"),
                      F.concat_ws(",", "licenses").alias("licenses"), "n_matches")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.personal_data(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select(DOC_ID, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return out.select(DOC_ID, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      decontaminate.items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("crc", crc)
    out = sharding.shard_by_bytes(docs, 24, carry=["doc_id", "crc"])
    return out.select(DOC_ID, "size", F.col("row.crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(table(spark, sf_dir, "documents"))
    return out.select(F.col("key.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "host_rejected", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select(DOC_ID, "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return out.select(DOC_ID, "held_out", "score", "predicted")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), carry=["doc_id"], mark=F.crc32(F.col("doc_id").cast("string").cast("binary")),
                                      rewrite=periodic_runs.repeated_tail)
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS back, -r.period AS less)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return out.withColumn("best", best).select(
        DOC_ID, F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"), F.expr("1000 * best.length div -best.less").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations")
    made = conversation_repair.repair(conversation_repair.damaged(convs))
    texts = conversation_repair.digests(made.rows).select(F.col("conv").alias("hashed"), F.col("sha256").alias("hash"))
    out = convs.select("conv_id").distinct().join(made.verdict, F.col("conv_id").eqNullSafe(F.col("conv")), "left") \
               .join(texts, F.col("conv_id").eqNullSafe(F.col("hashed")), "left")
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *sums, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("hash", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_token_counts, op3_license_scan, op4_personal_data, op5_near_dedup,
                                   op6_decontaminate, op7_sharding, op8_quality, op9_mixing, op10_toxicity, op11_periodic_runs,
                                   op12_conversation_repair, op13_simhash)}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLE: dict[str, str] = {}

_IDS = "CASE " + " ".join(
    f"WHEN contains(' ' || s || ' ', ' {license_scan.SENTENCES[k]} ') THEN '{k}'"
    for k in sorted(license_scan.SENTENCES, key=lambda k: (-len(license_scan.SENTENCES[k]), k))) + " ELSE '-' END"
_RULES = [(name, lic, license_scan.rule_pattern(ids, gap).replace("(?<= )", " ").replace("(?= )", "")) for name, lic, ids, gap in license_scan.RULES]
ORACLE["op3_license_scan"] = f"""
WITH parts AS (
  SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(
           regexp_replace(lower(coalesce(text, '')), '[.!?]+(\\s|$)', chr(1) || '\\1', 'g'), '[\\n\\r]+', chr(1), 'g'),
           '[^\\p{{L}}\\p{{N}}\\x01]+', ' ', 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS ss
  FROM documents),
ids AS (SELECT doc_id, len(ss) AS n_sentences, list_transform(ss, lambda s: {_IDS}) AS ids FROM parts),
lines AS (SELECT *, ' ' || array_to_string(ids, ' ') || ' ' AS line FROM ids),
n AS (SELECT doc_id, n_sentences, ids, {", ".join(f"len(regexp_extract_all(line, '{p}(?: |$)')) AS r_{name}" for name, _, p in _RULES)} FROM lines)
SELECT doc_id, n_sentences,
  array_to_string(list_filter(list_transform(ids, lambda x, i: CASE WHEN x <> '-' THEN (i - 1)::VARCHAR || ':' || x END), lambda x: x IS NOT NULL), ',') AS sentence_ids,
  concat_ws(',', {", ".join(f"CASE WHEN r_{name} > 0 THEN '{name}' END" for name, _, _ in _RULES)}) AS rules,
  array_to_string(list_sort(list_distinct(list_filter([{", ".join(f"CASE WHEN r_{name} > 0 THEN '{lic}' END" for name, lic, _ in _RULES)}], lambda x: x IS NOT NULL))), ',') AS licenses,
  ({" + ".join(f"r_{name}" for name, _, _ in _RULES)})::BIGINT AS n_matches
FROM n"""

ORACLE["op5_near_dedup"] = f"""
WITH RECURSIVE words AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWER}, {WORDS}) AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
sym AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT r.node, s.b FROM reach r JOIN sym s ON r.other = s.a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) c ON d.doc_id = c.node
LEFT JOIN sizes z ON z.doc_id = d.doc_id"""

_FOLDED = r"regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE["op6_decontaminate"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_FOLDED} AS w FROM documents),
b AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item_id::VARCHAR AS item, len(x) AS k, array_to_string(x, ' ') AS s FROM (
    SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
      ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS x FROM b)),
ks AS (SELECT DISTINCT k FROM win),
cand AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hits AS MATERIALIZED (SELECT c.doc_id, c.i, c.k, win.item FROM cand c JOIN win ON c.k = win.k AND c.s = win.s),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

KEY = ("('0x' || substr(md5(coalesce(length(doc_id::VARCHAR)::VARCHAR || '.' || doc_id::VARCHAR, 'null') || ':' || "
       "coalesce(length(text)::VARCHAR || '.' || text, 'null')), 1, 15))::BIGINT")
CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(coalesce(text, '')))),
    lambda i: ('0x' || substr(hex(encode(coalesce(text, ''))), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, (SELECT t FROM crc_table)[(xor(c, b) & 255) + 1]))"""

SHARDED = """
keyed AS MATERIALIZED (SELECT *, {key} AS k, (coalesce(strlen(text), 0) + 8)::BIGINT AS size FROM {docs}),
grouped AS (SELECT *, count(*) OVER (PARTITION BY k) AS n, sum(size) OVER (PARTITION BY k) AS group_size, (SELECT sum(size) FROM keyed)::BIGINT AS total,
               sum(size) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) - size AS by_row, coalesce(sum(size) OVER (ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS by_key FROM keyed),
run AS (SELECT * EXCLUDE (n), (CASE WHEN n > 1 AND (n > 4096 OR group_size * 24 * 256 > total) THEN by_row ELSE by_key END)::BIGINT AS before FROM grouped),
placed AS (SELECT *, (SELECT count(*) FROM range(1, 24) t(i) WHERE (total * i + 23) // 24 <= before)::INT AS shard FROM run),
sharded AS (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY k) - 1)::BIGINT AS slot FROM placed)"""

ORACLE["op7_sharding"] = f"""
WITH bytes_of AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
crc_table AS MATERIALIZED (
  SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n::BIGINT, range(0, 8)),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(0, 256) r(n))),
{SHARDED.format(key=KEY, docs="documents")}
SELECT s.doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
  'bytes' AS law, shard, slot, NULL::INT AS grown_shard
FROM sharded s JOIN bytes_of o ON s.doc_id = o.doc_id, crc_table"""

_HOST_RULES = {
    "word_length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "repeats": "100 * n_repeat_words > 30 * n_words",
}


def quality_sql(docs: str) -> str:
    """CTEs up to ``judged``: documents with counts and verdicts."""
    rules = list(_HOST_RULES)
    return rf"""
w AS MATERIALIZED (SELECT *, regexp_extract_all(coalesce(text, ''), {WORDS}) AS ws FROM {docs}),
grams AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
often AS (SELECT doc_id, g FROM grams GROUP BY ALL HAVING count(*) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM grams JOIN often USING (doc_id, g), range(0, 3) t(j) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup
          FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l FROM w) WHERE regexp_matches(l, {WORDS}) GROUP BY doc_id),
counted AS MATERIALIZED (
  SELECT w.* EXCLUDE (ws), len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(lines.n, 0)::BIGINT AS n_lines, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
failures AS MATERIALIZED (SELECT *, {", ".join(f"({c}) AS fails_{r}" for r, c in _HOST_RULES.items())} FROM counted),
hosts AS MATERIALIZED (SELECT source AS host, count(*)::DOUBLE AS n, {", ".join(f"count(*) FILTER (fails_{r})::DOUBLE AS {r}" for r in rules)} FROM failures GROUP BY source),
sums AS (SELECT count(*)::DOUBLE AS h, sum(n) AS n, {", ".join(f"sum({r}) / sum(n) AS m_{r}, sum({r} * {r} / n) AS sq_{r}" for r in rules)} FROM hosts),
spread AS (SELECT *, {", ".join(f"CASE WHEN m_{r} > 0 AND m_{r} < 1 AND h >= 2 THEN (sq_{r} - n * m_{r} * m_{r}) / (h - 1) / (m_{r} * (1 - m_{r})) END AS v_{r}" for r in rules)} FROM sums),
prior AS (SELECT *, {", ".join(f"CASE WHEN v_{r} IS NULL THEN {quality.PRIOR_LEAST} WHEN v_{r} > 1 THEN least(greatest((n / h - 1) / (v_{r} - 1) - 1, {quality.PRIOR_LEAST}), {quality.PRIOR_MOST}) ELSE {quality.PRIOR_MOST} END AS s_{r}" for r in rules)} FROM spread),
habits AS (SELECT host, {", ".join(f"(hosts.{r} + m_{r} * s_{r}) / (hosts.n + s_{r}) >= {quality.HABIT} AS habit_{r}" for r in rules)} FROM hosts, prior),
judged AS MATERIALIZED (
  SELECT failures.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {" OR ".join(f"(fails_{r} AND habit_{r})" for r in rules)} AS host_rejected
  FROM failures JOIN habits ON source IS NOT DISTINCT FROM host)"""


ORACLE["op8_quality"] = f"""WITH {quality_sql("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected,
  NOT (base_failed OR host_rejected) AS kept FROM judged"""

ORACLE["op9_mixing"] = f"""
WITH RECURSIVE sized AS MATERIALIZED (SELECT doc_id, source, {KEY} AS k, len(regexp_extract_all(coalesce(text, ''), {WORDS}))::BIGINT AS size FROM documents),
sources AS MATERIALIZED (
  SELECT source, own, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS own FROM sized GROUP BY source)),
fill AS (
  SELECT 0 AS round, source, own, weight, FALSE AS is_full, (SELECT sum(own) FROM sources)::BIGINT AS remains, (SELECT sum(weight) FROM sources)::BIGINT AS open_weight FROM sources
  UNION ALL
  SELECT round + 1, source, own, weight, now_full,
    ((SELECT sum(own) FROM sources) - sum(CASE WHEN now_full THEN 3 * own ELSE 0 END) OVER ())::BIGINT,
    (sum(CASE WHEN now_full THEN 0 ELSE weight END) OVER ())::BIGINT
  FROM (SELECT *, weight::HUGEINT * remains > 3::HUGEINT * own * open_weight AS now_full FROM fill WHERE round < 20)),
goal AS MATERIALIZED (
  SELECT source, own, CASE WHEN is_full THEN (3 * own)::DOUBLE ELSE (weight * remains) / open_weight::DOUBLE END AS target FROM fill WHERE round = 20),
budget AS MATERIALIZED (
  SELECT *, CASE WHEN own = 0 THEN 0 ELSE least(floor(target / own), 3)::BIGINT END AS whole_times, target - whole_times * own AS budget FROM goal),
groups AS (SELECT source, k, sum(size)::BIGINT AS words FROM sized GROUP BY source, k),
upto AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY k)::BIGINT AS upto FROM groups),
edge AS (SELECT u.source, min(u.k) AS k FROM upto u JOIN budget b ON u.source IS NOT DISTINCT FROM b.source WHERE b.budget > 0 AND u.upto > b.budget GROUP BY u.source),
below AS (
  SELECT e.source, CASE WHEN 2 * (b.budget - (u.upto - u.words)) >= u.words THEN e.k + 1 ELSE e.k END AS below
  FROM edge e JOIN upto u ON u.source IS NOT DISTINCT FROM e.source AND u.k = e.k JOIN budget b ON b.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, own AS source_size, target, (size * (whole_times + CASE WHEN k < coalesce(below, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source LEFT JOIN below t ON s.source IS NOT DISTINCT FROM t.source"""

#: Costs and letters of a conversation's rest as one text, the cost in seven
#: digits: the least text is the cheapest, then the first in ASCII.
def _with(rest: str, cost: str, letter: str) -> str:
    return f"lpad((left({rest}, 7)::INT + {cost})::VARCHAR, 7, '0') || '{letter}' || substr({rest}, 8)"


def _row_step(state: str, keeps: dict[str, str], to: str) -> str:
    keep = "".join(f", CASE WHEN NOT gone AND initial = '{i}' THEN {_with('w.' + q, 'cut', 'K')} END" for i, q in keeps.items())
    return f"least({_with('w.' + state, '2', 'D')}{keep}, CASE WHEN NOT gone THEN {_with('w.' + to, '1 + cut', 'R')} END) AS {state}"


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE["op12_conversation_repair"] = f"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n::BIGINT, range(0, 8)),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(0, 256) r(n))),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
harmed AS MATERIALIZED (
  SELECT k.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS harm FROM keyed k, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM harmed WHERE harm <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, rtrim(text, {_SPACE}) AS body FROM damaged),
judged AS MATERIALIZED (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, body = '' AS blank,
    body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, right(body, 1) NOT IN ('.', '!', '?') AS open_end,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
r AS MATERIALIZED (SELECT *, blank OR again AS gone, CASE WHEN open_end THEN 5 ELSE 0 END AS cut FROM judged),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
    count(*) FILTER (NOT gone AND open_end) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM r GROUP BY conv_id),
walk AS (
  SELECT conv_id, n + 1 AS i, '0000000' AS e, '0000010II' AS s, '0000005I' AS u, '0000000' AS a FROM counted
  UNION ALL
  SELECT conv_id, i, least(e, {_with('u', '5', 'I')}) AS e, least(s, {_with('u', '5', 'I')}) AS s, u, a FROM (
    SELECT conv_id, i, e, s, least(u, {_with('a', '5', 'I')}) AS u, least(a, {_with('u', '5', 'I')}) AS a FROM (
      SELECT w.conv_id, r.i, {_row_step('e', {'s': 's', 'u': 'u'}, 'u')}, {_row_step('s', {'u': 'u'}, 'u')}, {_row_step('u', {'a': 'a'}, 'a')}, {_row_step('a', {'u': 'u'}, 'u')}
      FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i - 1))),
best AS MATERIALIZED (SELECT conv_id, left(e, 7)::BIGINT AS cost, substr(e, 8) AS audit FROM walk WHERE i = 1),
letters AS (SELECT conv_id, p, audit[p:p] AS x FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM best)),
spots AS (
  SELECT conv_id, x, count(*) FILTER (x <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i, count(*) FILTER (x <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS place FROM letters),
left_rows AS (SELECT t.*, r.role, r.text, r.initial FROM spots t LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i WHERE x <> 'D'),
turned AS (SELECT *, max(CASE WHEN place = 1 AND x = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS has_system FROM left_rows),
lines AS (
  SELECT conv_id, place, CASE WHEN x = 'K' THEN role WHEN (place - has_system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN x = 'I' THEN '' ELSE text END AS line FROM turned),
hashed AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY place)) AS sha FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM o.conv_id"""
