"""Validation rules compiled from configuration into column expressions.

A field's outcome is ``{FieldName, ValueScanned, IsValid, ValidationErrors}``; all
messages of a value accumulate but for checks that end the evaluation: a low
confidence, a missing value, a date that cannot be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions import dates
from folio.model import FieldRule
from folio.sources import staging

#: Fixed value: the characters that count as special; a space stands for any white space.
SPECIAL = "!@#$%^&*()-_=+[]{};:'\",.’<>/? "
THRESHOLD = 80.0
_READ = staging.hidden("pairs")


def _messages(*checks: Column) -> Column:
    """The messages that apply, in order."""
    return F.filter(F.array(*checks), lambda m: m.isNotNull())


def _blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def _limit(value: Column, rule: object, name: str) -> Column | None:
    """A length limit; blank ones are off, ones that are no number always complain."""
    if rule is None or rule == "":
        return None
    try:
        bound = int(str(rule))
    except ValueError:
        return F.lit(f"Invalid {name} configuration")
    wrong, sign = (F.length(value) < bound, "<") if name == "MinLength" else (F.length(value) > bound, ">")
    return F.when(wrong, F.concat(F.lit("Length '"), F.length(value).cast("string"), F.lit(f"' {sign} {name} '{bound}'")))


def _pattern(value: Column, pattern: str | None) -> Column | None:
    """Anchored at the start only."""
    return F.when(~value.rlike(f"^(?:{pattern})"), "Pattern validation failed") if pattern else None


def forbidden(value: Column, allowed: str = "") -> Column:
    """Distinct special characters of a value that are not allowed, in the order they appear."""
    listed = [c for c in SPECIAL if c not in allowed]
    bad = lambda c: c.isin(*listed) | (c.rlike(r"^\s$") if " " in listed else F.lit(False))
    return F.array_distinct(F.filter(F.split(value, ""), lambda c: (c != "") & bad(c)))


def _special(value: Column, rule: object) -> Column | None:
    if rule is True:
        return None
    found = forbidden(value, "" if rule is False else str(rule))
    return F.when(F.size(found) > 0, F.concat(F.lit("Special characters not allowed: "), F.array_join(found, ", ")))


def string_errors(value: Column, rule: FieldRule) -> Column:
    """Messages of the string rules."""
    v = F.trim(value)
    checks = [_limit(v, rule.min_length, "MinLength"), _limit(v, rule.max_length, "MaxLength"), _pattern(v, rule.pattern), _special(v, rule.special)]
    found = _messages(*(c for c in checks if c is not None)) if any(c is not None for c in checks) else F.array().cast("array<string>")
    return _unless_blank(value, rule, found)


def _unless_blank(value: Column, rule: FieldRule, found: Column) -> Column:
    missing = F.array(F.lit("Null value not allowed")) if rule.allow_null is False else F.array().cast("array<string>")
    return F.when(_blank(value), missing).otherwise(found)


def _bound(rule_date: str | None, rule: FieldRule, today: str) -> Column | None:
    if not rule_date:
        return None
    if rule_date.lower() == "today":
        return F.lit(today).cast("date")
    return dates.parse_rule_date(F.lit(rule_date), rule.date_format)


def date_errors(value: Column, rule: FieldRule, today: str) -> Column:
    """Messages of the date rules; bounds are inclusive, a bound that cannot be read is ignored.

    ``today`` is the day that rules mean by it, five hours behind UTC.
    """
    v = F.trim(value)
    parsed = dates.parse_rule_date(v, rule.date_format)
    unread = F.concat(F.lit(f"Invalid date format. Expected: '{rule.date_format}', got: '"), v, F.lit("'"))
    low, high = _bound(rule.min_date, rule, today), _bound(rule.max_date, rule, today)
    checks = []
    if low is not None:
        checks.append(F.when(parsed < low, F.lit(f"Date before MinDate '{rule.min_date}'")))
    if high is not None:
        checks.append(F.when(parsed > high, F.lit(f"Date after MaxDate {rule.max_date}")))
    in_order = _messages(*checks) if checks else F.array().cast("array<string>")
    return _unless_blank(value, rule, F.when(parsed.isNull(), F.array(unread)).otherwise(in_order))


def field_errors(value: Column, score: Column, rule: FieldRule, today: str, threshold: float = THRESHOLD) -> Column:
    """Confidence first, then missing values, then the rules of the field's kind."""
    sure = F.coalesce(score.try_cast("double"), F.lit(0.0))
    low = F.concat(F.lit("Not null value has a score '"), sure.cast("string"), F.lit(f"' below threshold '{threshold}'"))
    rest = date_errors(value, rule, today) if rule.kind == "date" else string_errors(value, rule)
    out = F.when((sure < threshold) & value.isNotNull(), F.array(low))
    if rule.allow_null is False:
        out = out.when(value.isNull(), F.array(F.lit("Null values are not allowed for this field")))
    return out.otherwise(rest)


def field_result(value: Column, errors: Column, name: str) -> Column:
    return F.struct(F.lit(name).alias("FieldName"), value.alias("ValueScanned"), (F.size(errors) == 0).alias("IsValid"), errors.alias("ValidationErrors"))


def read_pairs(docs: DataFrame, column: str) -> Column:
    """Key/value JSON as a map of strings, null for anything else; a variant column is not parsed again."""
    c = F.col(f"`{column}`")
    return c.try_cast("map<string,string>") if isinstance(docs.schema[column].dataType, T.VariantType) else F.from_json(c, "map<string,string>")


def parse_pairs(c: Column) -> Column:
    """The same of a text column, empty for anything else."""
    return F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>"))


def validate(docs: DataFrame, rules: list[FieldRule], today: str, pairs: str = "key_value_pairs", audit: bool = False, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``results``, ``data_is_valid`` and ``validation_passed`` (texts True or False).

    A document that holds an ``error`` or cannot be parsed fails.  With ``audit`` all
    documents are to be reviewed, so the first flag is False while the second tells
    the outcome.
    """
    parsed = docs.withColumn(_READ, read_pairs(docs, pairs))
    get = lambda k: F.try_element_at(F.col(_READ), F.lit(k))
    results = [field_result(get(r.name), field_errors(get(r.name), get(f"{r.name}_s"), r, today, threshold), r.name) for r in rules]
    kind = "array<struct<FieldName:string,ValueScanned:string,IsValid:boolean,ValidationErrors:array<string>>>"
    out = parsed.withColumn("results", (F.array(*results) if results else F.array()).cast(kind))
    broken = get("error").isNotNull() | F.col(_READ).isNull()
    passed = ~F.exists("results", lambda r: ~r["IsValid"]) & ~F.coalesce(broken, F.lit(False))
    text = F.when(passed, "True").otherwise("False")
    return out.withColumn("validation_passed", text).withColumn("data_is_valid", F.lit("False") if audit else text).drop(_READ)


def validate_long(docs: DataFrame, rule_rows: DataFrame, value: str = "value") -> DataFrame:
    """Documents by rules as rows: every document meets every rule of its collection.

    ``docs`` has ``doc, field, value``; rules have ``field, min_length, max_length, allow_null``.
    Rules are configuration, so Spark's own size estimate decides whether they are broadcast.
    """
    joined = docs.join(rule_rows, "field")
    v = F.trim(F.coalesce(F.col(value), F.lit("")))
    ok = F.when(v == "", F.col("allow_null")).otherwise((F.length(v) >= F.col("min_length")) & (F.length(v) <= F.col("max_length")))
    return joined.withColumn("is_valid", ok)


def rule_rows(collections: DataFrame) -> DataFrame:
    """``collection, audit, rules``: the rules of each collection's fields in their order, as data.

    ``collections`` are rows of configuration.  Flags may be texts in any case; a kind,
    limit, pattern, format or date that is empty is none.
    """
    known = lambda c: F.lower(F.trim(c))
    some = lambda c: F.when(c != "", c)

    def rule(f: Column) -> Column:
        v = lambda name: f["Validation"][name]
        special = v("AllowSpecialChars")
        return F.struct(
            f["FieldName"].alias("field"),
            F.coalesce(some(f["Type"]), F.lit("string")).alias("kind"),
            v("MinLength").alias("min_length"),
            v("MaxLength").alias("max_length"),
            some(v("Pattern")).alias("pattern"),
            (known(special) == "true").alias("any_special"),
            F.when(special.isNotNull() & (known(special) != "false"), special).otherwise("").alias("special"),
            (F.coalesce(v("AllowNull"), F.lit("")).isin("") | (known(v("AllowNull")) == "false")).alias("no_null"),
            F.coalesce(some(v("Format")), F.lit("mm/dd/yyyy")).alias("date_format"),
            some(v("MinDate")).alias("min_date"),
            some(v("MaxDate")).alias("max_date"),
        )

    audit = F.coalesce(known(F.col("review_all")) == "true", F.lit(False))
    return collections.select("collection", audit.alias("audit"), F.transform(F.coalesce("field_list", F.array()), rule).alias("rules"))


def _limit_by(v: Column, rule: Column, name: str) -> Column:
    number = F.replace(F.trim(rule), F.lit("_"), F.lit("")).try_cast("long")
    wrong, sign = (F.length(v) < number, "<") if name == "MinLength" else (F.length(v) > number, ">")
    said = F.concat(F.lit("Length '"), F.length(v).cast("string"), F.lit(f"' {sign} {name} '"), number.cast("string"), F.lit("'"))
    is_number = rule.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$")
    return F.when(F.coalesce(rule, F.lit("")) == "", None).when(~is_number, F.lit(f"Invalid {name} configuration")).when(wrong, said)


def _special_by(v: Column, rule: Column) -> Column:
    """The characters that are special, not allowed by the rule, and there."""
    allowed = rule["special"]
    bad = lambda c: (F.contains(F.lit(SPECIAL), c) & ~F.contains(allowed, c)) | (c.rlike(r"^\s$") & ~F.contains(allowed, F.lit(" ")))
    found = F.array_distinct(F.filter(F.split(v, ""), lambda c: (c != "") & bad(c)))
    return F.when(~F.coalesce(rule["any_special"], F.lit(False)) & (F.size(found) > 0), F.concat(F.lit("Special characters not allowed: "), F.array_join(found, ", ")))


def _date_by(c: Column, date_format: Column) -> Column:
    """The date in the format that a column names; an unknown one is the first."""
    first, *others = dates.RULE_FORMATS
    out = dates.parse_rule_date(c, first)
    for name in others:
        out = F.when(date_format == name, dates.parse_rule_date(c, name)).otherwise(out)
    return out


def errors_by(value: Column, score: Column, rule: Column, today: str, threshold: float = THRESHOLD) -> Column:
    """``field_errors`` of a rule that is a row: a struct as ``rule_rows`` makes it."""
    none = F.array().cast("array<string>")
    v, day = F.trim(value), F.lit(today).cast("date")
    strings = _messages(_limit_by(v, rule["min_length"], "MinLength"), _limit_by(v, rule["max_length"], "MaxLength"), F.when(~F.rlike(v, F.concat(F.lit("^(?:"), rule["pattern"], F.lit(")"))), "Pattern validation failed"), _special_by(v, rule))
    parsed = _date_by(v, rule["date_format"])
    bound = lambda c: F.when(F.lower(c) == "today", day).otherwise(_date_by(c, rule["date_format"]))
    low = F.when(parsed < bound(rule["min_date"]), F.concat(F.lit("Date before MinDate '"), rule["min_date"], F.lit("'")))
    high = F.when(parsed > bound(rule["max_date"]), F.concat(F.lit("Date after MaxDate "), rule["max_date"]))
    unread = F.concat(F.lit("Invalid date format. Expected: '"), rule["date_format"], F.lit("', got: '"), v, F.lit("'"))
    of_kind = F.when(rule["kind"] != "date", strings).when(parsed.isNull(), F.array(unread)).otherwise(_messages(low, high))
    checked = F.when(_blank(value), F.when(rule["no_null"], F.array(F.lit("Null value not allowed"))).otherwise(none)).otherwise(of_kind)
    sure = F.coalesce(score.try_cast("double"), F.lit(0.0))
    unsure = F.concat(F.lit("Not null value has a score '"), sure.cast("string"), F.lit(f"' below threshold '{threshold}'"))
    return F.when((sure < threshold) & value.isNotNull(), F.array(unsure)).when(rule["no_null"] & value.isNull(), F.array(F.lit("Null values are not allowed for this field"))).otherwise(checked)


def validate_by(docs: DataFrame, rules: DataFrame, today: str, pairs: str = "key_value_pairs", threshold: float = THRESHOLD) -> DataFrame:
    """``validate`` for documents of any collections in one plan: the rules are rows and not part of the plan.

    ``docs`` have ``collection``; ``rules`` are as ``rule_rows`` makes them, one row for each
    collection, broadcast if they are few enough.  A document is parsed once and meets the rules of its collection
    within its row, so nothing is exploded or grouped.  One of a collection without
    rules has no results and fails only if it cannot be read.
    """
    kind = "array<struct<FieldName:string,ValueScanned:string,IsValid:boolean,ValidationErrors:array<string>>>"
    read, mine, audit = (staging.hidden(c) for c in ("read", "rules", "audit"))
    few = staging.checked_broadcast(rules.select(F.col("collection"), F.col("rules").alias(mine), F.col("audit").alias(audit)), F.lit(1000) * (1 + F.size(mine)))
    joined = docs.withColumn(read, read_pairs(docs, pairs)).join(few, "collection", "left")
    get = lambda k: F.try_element_at(F.col(read), k)

    def result(rule: Column) -> Column:
        value = get(rule["field"])
        errors = errors_by(value, get(F.concat(rule["field"], F.lit("_s"))), rule, today, threshold)
        return F.struct(rule["field"].alias("FieldName"), value.alias("ValueScanned"), (F.size(errors) == 0).alias("IsValid"), errors.alias("ValidationErrors"))

    out = joined.withColumn("results", F.coalesce(F.transform(F.col(mine), result), F.array()).cast(kind))
    broken = F.col(read).isNull() | get(F.lit("error")).isNotNull()
    text = F.when(~F.exists("results", lambda r: ~r["IsValid"]) & ~broken, "True").otherwise("False")
    out = out.withColumn("validation_passed", text).withColumn("data_is_valid", F.when(F.col(audit), "False").otherwise(F.col("validation_passed")))
    return out.select(*(f"`{c}`" for c in docs.columns if c not in ("results", "validation_passed", "data_is_valid")), "results", "validation_passed", "data_is_valid")


def review_status(passed: Column) -> dict[str, Column]:
    """What a review item says of a document."""
    return {"Status": F.when(passed, "Complete").otherwise("Failed"), "Error": F.when(passed, "").otherwise("Validation Error"), "ErrorCode": F.when(passed, "").otherwise("1")}


def counts(validated: DataFrame) -> DataFrame:
    """Valid, invalid and all documents in one pass."""
    return validated.agg(F.count_if(F.col("validation_passed") == "True").alias("valid"), F.count_if(F.col("validation_passed") == "False").alias("invalid"), F.count("*").alias("total"))
