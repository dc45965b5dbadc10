"""Messages checked against the schema of their source system.

A schema is a table: source system, place, path, type, whether the field is
required, its default. The rules of a system travel as one array to the system's
messages (a join on the system, of the size of the table), so one job checks the
messages of all systems, whatever fields they have, and a new system is a few
rows of a table.

Types: string, long, double, boolean, date, object, and array<...> of the first
four. A path is a field's name, or names joined with '.' for fields of objects
(LEVELS deep). Every breach is a reason with its path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.functions.text import trim_ws

SCHEMA = "source_system string, pos int, path string, type string, required boolean, default string"
RULE = ("pos", "path", "type", "required", "default")
#: Levels of nested objects whose fields rules may name.
LEVELS = 3
#: What a JSON value's own type must look like.
JSON_TYPE = {"string": "STRING", "long": "BIGINT", "double": "BIGINT|DOUBLE|DECIMAL.*", "boolean": "BOOLEAN", "date": "STRING", "object": "OBJECT<.*"}
UNKNOWN_SYSTEM, NO_JSON = "unknown source system", "payload is not a JSON object"


def with_rules(df: DataFrame, schema: DataFrame) -> DataFrame:
    """``df`` with its system's rules in order (``_rules``, null: unknown)."""
    rules = schema.groupBy(F.col("source_system").alias("_system")).agg(F.sort_array(F.collect_list(F.struct(*RULE))).alias("_rules"))
    return df.join(rules, F.col("source_system") == F.col("_system"), "left").drop("_system")


def json_type_pattern(kind: Column) -> Column:
    """A pattern for ``schema_of_variant`` of a value of this type; an empty list
    fits any array type."""
    out = F.lit(None).cast("string")
    for name, pattern in JSON_TYPE.items():
        out = F.when(kind == name, F.lit(pattern)).when(kind == f"array<{name}>", F.lit(f"ARRAY<({pattern}|VOID)>")).otherwise(out)
    return out


def fits(kind: Column, value: Column) -> Column:
    """Whether a JSON value (variant, not null) has this type."""
    like = F.coalesce(F.regexp_like(F.schema_of_variant(value), F.concat(F.lit("^("), json_type_pattern(kind), F.lit(")$"))), F.lit(False))
    day = F.try_to_date(F.try_variant_get(value, "$", "string"), "yyyy-MM-dd").isNotNull()
    return like & ((kind != "date") | day)


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.struct(text.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def typed_text(kind: Column, text: Column) -> Column:
    """The JSON value of a CSV text, null where it has not the type."""
    bare = trim_ws(text)
    double = bare.try_cast("double")
    parsed = F.try_parse_json(text)
    return (F.when(kind == "string", quoted(text))
            .when(kind == "long", bare.try_cast("long").cast("string"))
            .when(kind == "double", F.when(~F.isnan(double) & (F.abs(double) != F.lit(float("inf"))), double.cast("string")))
            .when(kind == "boolean", F.when(F.lower(bare).isin("true", "false"), F.lower(bare)))
            .when(kind == "date", F.when(F.try_to_date(bare, "yyyy-MM-dd").isNotNull(), quoted(bare)))
            .when(parsed.isNotNull() & fits(kind, parsed), F.to_json(parsed)))


def csv_messages(df: DataFrame, schema: DataFrame, columns: list[str], topics: dict[str, str]) -> DataFrame:
    """(file_name, row_no, source_system, topic, value, reasons): each record by
    its system's own fields. A blank field is its default if it has one, else an
    error if required, else null; ``value`` is the message as JSON, in the
    schema's order."""
    fields = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])
    topic = F.element_at(F.create_map(*[F.lit(x) for pair in topics.items() for x in pair]), F.col("source_system"))
    rows = with_rules(df.select("file_name", "row_no", "source_system", topic.alias("topic"), fields.alias("_fields")), schema)

    def checked(rule: Column) -> Column:
        text = F.element_at("_fields", rule["path"])
        blank = text.isNull() | (trim_ws(text) == "")
        text = F.when(blank, rule["default"]).otherwise(text)
        value = typed_text(rule["type"], text)
        reason = F.when(text.isNull() & rule["required"], F.concat(rule["path"], F.lit(" is required"))) \
            .when(text.isNotNull() & value.isNull(), F.concat(rule["path"], F.lit(" is not a valid "), rule["type"]))
        return F.struct(F.concat(quoted(rule["path"]), F.lit(":"), F.coalesce(value, F.lit("null"))).alias("value"), reason.alias("reason"))

    done = rows.withColumn("_done", F.transform("_rules", checked))
    unknown = F.col("_rules").isNull() | F.col("topic").isNull()
    reasons = F.when(unknown, F.array(F.lit(UNKNOWN_SYSTEM))).otherwise(F.filter(F.transform("_done", lambda d: d["reason"]), lambda r: r.isNotNull()))
    value = F.concat(F.lit("{"), F.array_join(F.transform("_done", lambda d: d["value"]), ","), F.lit("}"))
    return done.select("file_name", "row_no", "source_system", "topic", F.when(F.size(reasons) == 0, value).alias("value"), reasons.alias("reasons"))


def paths(value: Column) -> Column:
    """A JSON object's fields by path, objects' fields as well, LEVELS deep."""
    def entries(v: Column, prefix: Column | None) -> Column:
        own = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
        return F.transform(own, lambda e: F.struct((e["key"] if prefix is None else F.concat(prefix, F.lit("."), e["key"])).alias("path"), e["value"].alias("value")))

    level = entries(value, None)
    out = [level]
    for _ in range(LEVELS - 1):
        level = F.flatten(F.transform(F.filter(level, lambda e: F.regexp_like(F.schema_of_variant(e["value"]), F.lit("^OBJECT<"))), lambda e: entries(e["value"], e["path"])))
        out.append(level)
    return F.concat(*out)


def json_messages(df: DataFrame, schema: DataFrame, payload: str, strict: bool = True) -> DataFrame:
    """(file_name, row_no, source_system, payload, reasons): payloads untouched.
    STRICT (the default) checks them: fields of other types, required ones that
    are missing or null and have no default, and fields the schema does not have
    are reasons. RAW checks nothing."""
    base = ["file_name", "row_no", "source_system"]
    if not strict:
        return df.select(*base, F.col(payload).alias("payload"), F.array().cast("array<string>").alias("reasons"))
    rows = with_rules(df.select(*base, F.col(payload).alias("payload")), schema)
    parsed = F.try_parse_json("payload")
    is_object = F.coalesce(F.regexp_like(F.schema_of_variant(parsed), F.lit("^OBJECT<")), F.lit(False))
    rows = rows.withColumn("_found", F.when(is_object, paths(parsed)))

    def breach(rule: Column) -> Column:
        own = F.filter("_found", lambda e: e["path"] == rule["path"])
        value = F.get(own, F.lit(0))["value"]
        missing = value.isNull() | F.is_variant_null(value)
        return F.when(missing, F.when(rule["required"] & rule["default"].isNull(), F.concat(rule["path"], F.lit(" is required")))) \
            .when(~fits(rule["type"], value), F.concat(rule["path"], F.lit(" is not a valid "), rule["type"]))

    known = F.transform("_rules", lambda r: r["path"])
    # an object's own path, and what lies below a field that the schema has, are known
    extra = F.transform(F.filter("_found", lambda e: ~F.array_contains(known, e["path"])
                                 & ~F.exists(known, lambda k: F.startswith(k, F.concat(e["path"], F.lit("."))) | F.startswith(e["path"], F.concat(k, F.lit("."))))),
                        lambda e: F.concat(e["path"], F.lit(" is not in the schema")))
    reasons = F.when(F.col("_rules").isNull(), F.array(F.lit(UNKNOWN_SYSTEM))).when(F.col("_found").isNull(), F.array(F.lit(NO_JSON))) \
        .otherwise(F.concat(F.filter(F.transform("_rules", breach), lambda r: r.isNotNull()), F.array_sort(extra)))
    return rows.select(*base, "payload", reasons.alias("reasons"))


def run_summary(checked: DataFrame) -> DataFrame:
    """I8: per source system and file: all records, those without and with
    reasons, and how often each reason was given."""
    by = ["source_system", "file_name"]
    failed = F.size("reasons") > 0
    totals = checked.groupBy(*by).agg(F.count("*").alias("n_total"), F.count_if(~failed).alias("n_ok"), F.count_if(failed).alias("n_failed"))
    each = checked.select(*by, F.explode("reasons").alias("reason")).groupBy(*by, "reason").agg(F.count("*").alias("n"))
    told = each.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("reason", "n"))), lambda r: F.concat(r["reason"], F.lit(": "), r["n"])), "; ").alias("failure_reasons"))
    told = told.withColumnsRenamed({c: f"_{c}" for c in by})
    same = F.col("source_system").eqNullSafe(F.col("_source_system")) & F.col("file_name").eqNullSafe(F.col("_file_name"))
    return totals.join(told, same, "left").select(*by, "n_total", "n_ok", "n_failed", F.coalesce("failure_reasons", F.lit("")).alias("failure_reasons"))
