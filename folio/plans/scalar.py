"""Scalar functions, JSON, rules and costs over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import costs, dates, text
from folio.model import FieldRule
from folio.operators import load, matching, rules
from folio.plans.registry import query
from folio.plans.views import table


@query("q21_cleaners", r"SELECT p_partkey, regexp_replace(p_brand, '[^0-9]', '', 'g') AS phone, trim(regexp_replace(p_brand || ' 1/2-3', '[^0-9/-]', '', 'g')) AS dated, lower(trim(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g'))) AS id, lower(trim(regexp_replace(regexp_replace('  ' || p_name || ' #' || p_type, '[^A-Za-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))) AS txt FROM part")
def cleaners(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("p_brand")
    return table(spark, d, "part").select("p_partkey", text.clean_phone(b).alias("phone"), text.clean_date_text(F.concat(b, F.lit(" 1/2-3"))).alias("dated"), text.clean_id(b).alias("id"), text.clean_text(F.concat(F.lit("  "), "p_name", F.lit(" #"), "p_type")).alias("txt"))


@query("q22_person_name", "SELECT c_custkey, trim(replace(replace(replace(translate(lower(c_name || ' (NoClub) Types=Club'), '#:> <$\"^=()', ''), 'types', ''), 'noclub', ''), 'club', '')) AS name FROM customer")
def person_name(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", text.person_name(F.concat("c_name", F.lit(" (NoClub) Types=Club"))).alias("name"))


@query("q23_phone", "SELECT doc_id, regexp_replace(regexp_extract(text, '\\(\\d{3}\\) \\d{3}-\\d{4}'), '[^0-9]', '', 'g') AS phone FROM documents")
def phone(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.clean_phone(F.regexp_extract("text", r"\(\d{3}\) \d{3}-\d{4}", 0)).alias("phone"))


@query("q24_compact_date", "SELECT o_orderkey, strftime(o_orderdate, '%m%d%y') AS compact, replace(strftime(o_orderdate, '%m/%d/%Y'), '/', '') AS plain FROM orders")
def compact_date(spark: SparkSession, d: str) -> DataFrame:
    t = F.date_format("o_orderdate", "MM/dd/yyyy")
    return table(spark, d, "orders").select("o_orderkey", dates.compact_date(t).alias("compact"), text.slashless(t).alias("plain"))


@query("q25_mask", "SELECT c_custkey, left(c_name, 2) || '***' || right(c_name, 2) AS \"REF1\", CASE WHEN c_custkey % 2 = 0 THEN 'BLANK' ELSE left(c_mktsegment, 2) || '***' || right(c_mktsegment, 2) END AS \"REF2\" FROM customer")
def masked(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("REF1"), F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).alias("REF2"))
    return load.mask_references(rows)


@query("q26_file_names", "SELECT page_id, regexp_extract(url, '.*/(.*)$', 1) AS name, upper(split_part(regexp_extract(url, '.*/(.*)$', 1), '?', 1)) AS kind FROM pages")
def file_names(spark: SparkSession, d: str) -> DataFrame:
    name = text.file_name(F.col("url"))
    return table(spark, d, "pages").select("page_id", name.alias("name"), text.leading_part(name, "?").alias("kind"))


@query("q27_normalize_date", "SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS normal FROM orders")
def normalize_date(spark: SparkSession, d: str) -> DataFrame:
    ways = ["M/d/yyyy", "yyyy.MM.dd", "d MMMM yyyy", "yyyy-MM-dd", "MMM d, yyyy", "d-MMM-yy", "M/d/yy"]
    t, k = F.col("o_orderdate"), F.col("o_orderkey") % len(ways)
    written = F.coalesce(*(F.when(k == i, F.date_format(t, w)) for i, w in enumerate(ways)))
    return table(spark, d, "orders").select("o_orderkey", dates.normalize_date(written, "2025-06-01", "today").alias("normal"))


@query("q28_upper", "SELECT p_partkey, upper(p_name) AS name, p_brand AS brand FROM part")
def upper(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.force_case(F.col("p_name"), "UPPER").alias("name"), text.force_case(F.col("p_brand"), "AS-IS").alias("brand"))


@query("q29_remove", "SELECT p_partkey, regexp_replace(p_brand, '[aeiou#]', '', 'g') AS brand FROM part")
def remove(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.remove_pattern(F.col("p_brand"), "[aeiou#]").alias("brand"))


@query("q30_rescue", "WITH r AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN lang END AS given, CASE WHEN doc_id % 2 = 0 THEN '77' END AS score, nullif(regexp_extract(text, '[A-Z][a-z]{5,}'), '') AS found FROM documents) SELECT doc_id, coalesce(nullif(given, ''), found, given) AS word, CASE WHEN (given IS NULL OR given = '') AND found IS NOT NULL AND score IS NOT NULL THEN '10' ELSE score END AS score FROM r")
def rescue(spark: SparkSession, d: str) -> DataFrame:
    given, score = F.when(F.col("doc_id") % 5 != 0, F.col("lang")), F.when(F.col("doc_id") % 2 == 0, "77")
    word = text.rescue(given, F.col("text"), "[A-Z][a-z]{5,}")
    return table(spark, d, "documents").select("doc_id", word.alias("word"), text.rescued_score(given, F.col("text"), "[A-Z][a-z]{5,}", score).alias("score"))


@query("q31_rotations", "SELECT doc_id, 'root/' || doc_id || t.turn || '.png' AS path FROM documents, (VALUES (''), ('_rot90'), ('_rot180'), ('_rot270')) t(turn)")
def rotations(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("root/"), F.col("doc_id").cast("string"), F.lit(".png"))
    return table(spark, d, "documents").select("doc_id", F.explode(text.rotations(path)).alias("path"))


@query("q32_batch_names", "SELECT page_id, 'b' || page_id AS batch_name, 'out/x/b' || page_id AS prefix FROM pages")
def batch_names(spark: SparkSession, d: str) -> DataFrame:
    key = F.concat(F.lit("in/x/b"), F.col("page_id").cast("string"), F.lit(".zip"))
    return table(spark, d, "pages").select("page_id", text.batch_name(key).alias("batch_name"), text.target_prefix(key, "out").alias("prefix"))


@query("q33_json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing FROM events")
def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return load.explode_fields(table(spark, d, "events"), "props", {"k": "integer", "missing": "string"}).select("event_id", "k", "missing")


@query("q34_json_prefixed", "SELECT c_custkey, c_name AS input_c_name, c_mktsegment AS input_c_mktsegment FROM customer")
def json_prefixed(spark: SparkSession, d: str) -> DataFrame:
    kv = table(spark, d, "customer").select("c_custkey", F.to_json(F.struct("c_name", "c_mktsegment")).alias("kv"))
    return matching.extract_json(kv, "kv", ["c_name", "c_mktsegment"]).drop("kv")


@query("q35_safe_json", "SELECT event_id, CASE WHEN event_id % 4 < 2 THEN json_extract_string(props, '$.k') END AS k, CASE WHEN event_id % 4 < 2 THEN 1 ELSE 0 END AS n FROM events")
def safe_json(spark: SparkSession, d: str) -> DataFrame:
    broken = F.when(F.col("event_id") % 4 < 2, F.col("props")).when(F.col("event_id") % 4 == 2, F.lit("{broken"))
    pairs = rules.parse_pairs(broken)
    return table(spark, d, "events").select("event_id", F.try_element_at(pairs, F.lit("k")).alias("k"), F.size(pairs).alias("n"))


def _errors(spark: SparkSession, d: str, name: str, key: str, value, rule: FieldRule) -> DataFrame:
    found = rules.string_errors(value, rule)
    return table(spark, d, name).select(key, F.array_join(found, "; ").alias("errors"), (F.size(found) == 0).alias("is_valid"))


def _sql_errors(name: str, key: str, *cases: str) -> str:
    joined = f"concat_ws('; ', {', '.join(cases)})"
    return f"SELECT {key}, {joined} AS errors, {joined} = '' AS is_valid FROM {name}"


@query("q36_min_length", _sql_errors("part", "p_partkey", "CASE WHEN length(p_name) < 9 THEN 'Length ''' || length(p_name) || ''' < MinLength ''9''' END"))
def min_length(spark: SparkSession, d: str) -> DataFrame:
    return _errors(spark, d, "part", "p_partkey", F.col("p_name"), FieldRule("f", min_length="9", special=True))


@query("q37_max_length", _sql_errors("part", "p_partkey", "CASE WHEN length(p_name) > 9 THEN 'Length ''' || length(p_name) || ''' > MaxLength ''9''' END", "CASE WHEN length(p_name) >= 0 THEN 'Invalid MinLength configuration' END").replace("concat_ws('; ', CASE WHEN length(p_name) > 9", "concat_ws('; ', 'Invalid MinLength configuration', CASE WHEN length(p_name) > 9").replace(", CASE WHEN length(p_name) >= 0 THEN 'Invalid MinLength configuration' END", ""))
def max_length(spark: SparkSession, d: str) -> DataFrame:
    return _errors(spark, d, "part", "p_partkey", F.col("p_name"), FieldRule("f", min_length="many", max_length=9, special=True))


@query("q38_pattern", _sql_errors("customer", "c_custkey", "CASE WHEN NOT regexp_matches(c_mktsegment, '^(?:[A-M])') THEN 'Pattern validation failed' END"))
def pattern(spark: SparkSession, d: str) -> DataFrame:
    return _errors(spark, d, "customer", "c_custkey", F.col("c_mktsegment"), FieldRule("f", pattern="[A-M]", special=True))


@query("q39_special_none", _sql_errors("part", "p_partkey", "CASE WHEN contains(p_brand, '#') OR contains(p_name, ' ') THEN 'Special characters not allowed: ' || concat_ws(', ', CASE WHEN contains(p_brand, '#') THEN '#' END, CASE WHEN contains(p_name, ' ') THEN ' ' END) END"))
def special_none(spark: SparkSession, d: str) -> DataFrame:
    return _errors(spark, d, "part", "p_partkey", F.concat("p_brand", "p_name"), FieldRule("f"))


@query("q40_special_some", _sql_errors("part", "p_partkey", "CASE WHEN p_size % 3 = 0 THEN 'Null value not allowed' WHEN contains(p_name, ' ') THEN 'Special characters not allowed:  ' END"))
def special_some(spark: SparkSession, d: str) -> DataFrame:
    value = F.when(F.col("p_size") % 3 == 0, F.lit("  ")).otherwise(F.concat("p_brand", "p_name"))
    return _errors(spark, d, "part", "p_partkey", value, FieldRule("f", special="#-"))


@query("q41_date_rules", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'Invalid date format. Expected: ''yyyy-mm-dd'', got: ''' || strftime(o_orderdate, '%m/%d/%Y') || '''' ELSE concat_ws('; ', CASE WHEN o_orderdate < TIMESTAMP '1994-01-01' THEN 'Date before MinDate ''1994-01-01''' END, CASE WHEN o_orderdate > TIMESTAMP '1997-06-30' THEN 'Date after MaxDate today' END) END AS errors FROM orders")
def date_rules(spark: SparkSession, d: str) -> DataFrame:
    written = F.when(F.col("o_orderkey") % 9 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rule = FieldRule("f", "date", date_format="yyyy-mm-dd", min_date="1994-01-01", max_date="today")
    return table(spark, d, "orders").select("o_orderkey", F.array_join(rules.date_errors(written, rule, "1997-06-30"), "; ").alias("errors"))


@query("q42_documents", "SELECT p_partkey, CASE WHEN p_size >= 8 AND length(p_name) >= 9 AND p_partkey % 7 <> 0 THEN 'True' ELSE 'False' END AS validation_passed, 'False' AS data_is_valid FROM part")
def documents(spark: SparkSession, d: str) -> DataFrame:
    score = (F.col("p_size") * 10).alias("name_s")
    pairs = F.when(F.col("p_partkey") % 7 == 0, F.lit('{"error": "x"}')).otherwise(F.to_json(F.struct(F.col("p_name").alias("name"), score)))
    kv = table(spark, d, "part").select("p_partkey", pairs.alias("key_value_pairs"))
    checked = rules.validate(kv, [FieldRule("name", min_length=9, special=" "), FieldRule("other", allow_null=True)], "2024-01-01", audit=True)
    return checked.select("p_partkey", "validation_passed", "data_is_valid")


@query("q57_costs", "SELECT doc_id, round(n_chars / 1000 * 0.00135 + n_chars * 2 / 1000 * 0.0054, 9) AS cost, round((0.5 * 3600 * 8 * 30) * n_chars / 1000000 * 0.00135 * 1000 + (0.5 * 3600 * 8 * 30) * (n_chars * 2) / 1000000 * 0.0054 * 1000, 4) AS monthly FROM documents")
def cost(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_chars").cast("double")
    return table(spark, d, "documents").select("doc_id", F.round(costs.token_cost(n, n * 2), 9).alias("cost"), F.round(costs.monthly_cost(n, n * 2, F.lit(0.5)), 4).alias("monthly"))


@query("q58_response_tokens", "SELECT g, CAST(floor((4 + 2 * n * 10 - 1 + (v + 3 * n) / 3.5 + (2 * k + 2 * n) / 3.5) * 1.10) AS BIGINT) AS tokens FROM (SELECT p_size AS g, count(*) AS n, sum(CASE p_type WHEN 'ECONOMY' THEN 12 WHEN 'SMALL' THEN 43 ELSE 50 END) AS v, sum(CASE p_type WHEN 'ECONOMY' THEN 3 WHEN 'SMALL' THEN 4 ELSE length(p_type) END) AS k FROM part GROUP BY p_size)")
def response_tokens(spark: SparkSession, d: str) -> DataFrame:
    key = F.when(F.col("p_type") == "ECONOMY", "dob").when(F.col("p_type") == "SMALL", "Name").otherwise(F.col("p_type"))
    keys = table(spark, d, "part").select(F.col("p_size").alias("g"), F.explode(F.array(key, F.concat(key, F.lit("_s")))).alias("key"))
    return keys.groupBy("g").agg(costs.response_tokens(F.count("*"), F.sum(F.length("key")), F.sum(costs.value_chars(F.col("key")))).alias("tokens"))


@query("q63_text_helpers", "SELECT p_partkey, lower(p_name) || ' ' || lower(p_brand) AS document, CASE WHEN p_partkey % 2 = 0 THEN 'a/' || p_partkey ELSE 'pre/' || p_partkey END AS key, 'c' || p_partkey AS customer, lower(trim(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g'))) AS provider FROM part")
def text_helpers(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_partkey").cast("string")
    key = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("a/"), n)).otherwise(n)
    name = F.concat(F.lit("src.c"), n, F.lit("input.csv"))
    return table(spark, d, "part").select("p_partkey", text.search_document(F.col("p_name"), F.col("p_brand"), F.lit(None).cast("string")).alias("document"), text.full_key(key, "pre").alias("key"), text.customer_from_name(name, "src.").alias("customer"), text.cleaner_for("provider")(F.col("p_brand")).alias("provider"))


@query("q64_review_flags", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Complete' END AS status, CASE WHEN event_type = 'error' THEN '1' ELSE '' END AS code, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) > 0 THEN 1 ELSE 0 END AS phone_exists, CASE WHEN user_id % 2 = 1 THEN 1 ELSE 0 END AS required_match FROM events")
def review_flags(spark: SparkSession, d: str) -> DataFrame:
    s = rules.review_status(F.col("event_type") != "error")
    k = F.try_element_at(rules.parse_pairs(F.col("props")), F.lit("k"))
    f = matching.features((F.col("user_id") % 2).cast("int"), F.lit(1), F.lit(None).cast("string"), k)
    return table(spark, d, "events").select("event_id", s["Status"].alias("status"), s["ErrorCode"].alias("code"), k.try_cast("int").alias("k"), f["phone_exists"].alias("phone_exists"), f["required_match"].alias("required_match"))


@query("q65_european", "SELECT c_custkey, translate(format('{:,.2f}', c_acctbal), ',.', '.,') AS balance FROM customer")
def european(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", costs.european(F.col("c_acctbal")).alias("balance"))


@query("q70_sanitized_json", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'invalid_value' WHEN 1 THEN event_type END AS k, CASE WHEN event_id % 3 = 2 THEN 'Invalid JSON encountered: {broken ' || event_type END AS error FROM events")
def sanitized_json(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 0, F.lit('{"k":=*}')).when(F.col("event_id") % 3 == 1, F.to_json(F.struct(F.col("event_type").alias("k")))).otherwise(F.concat(F.lit("{broken "), "event_type"))
    found = text.parsed_json(raw)
    return table(spark, d, "events").select("event_id", F.try_element_at(found["pairs"], F.lit("k")).alias("k"), found["error"].alias("error"))


@query("q71_pretty_json", """SELECT p_partkey, '{' || chr(10) || '    "name": "' || p_name || '",' || chr(10) || '    "size": ' || CASE WHEN p_partkey % 2 = 0 THEN '"' || p_size || '"' ELSE 'null' END || chr(10) || '}' AS pairs FROM part""")
def pretty_json(spark: SparkSession, d: str) -> DataFrame:
    pairs = F.create_map(F.lit("name"), F.col("p_name"), F.lit("size"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")))
    return table(spark, d, "part").select("p_partkey", text.pretty_json(pairs).alias("pairs"))
