"""Similarity, blocking, matching and search over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import similarity, text
from folio.operators import matching, search
from folio.plans.registry import query
from folio.plans.views import table


def whole_keys(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned whole texts of all documents."""
    # a filter beside the column would clean every text a second time
    long = F.filter(F.array(text.clean_text(F.col("text"))), lambda key: F.length(key) >= 3)
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.explode(long).alias("key"))


def listed_keys(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned whole texts of all benchmark items: the list that documents are matched with."""
    return table(spark, d, "benchmark").select(F.col("item_id").alias("id"), text.clean_text(F.col("text")).alias("key")).filter(F.length("key") >= 3)


def _keys_sql(name: str, id_column: str, source: str) -> str:
    return rf"""{name} AS (SELECT * FROM (SELECT {id_column} AS id, lower(trim(regexp_replace(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))) AS key FROM {source}) WHERE length(key) >= 3),
{name}g AS (SELECT DISTINCT id, substr(key, i, 3) AS gram FROM (SELECT id, key, unnest(range(1, length(key) - 1)) AS i FROM {name})),
{name}n AS (SELECT id, count(*) AS n FROM {name}g GROUP BY id)"""


DOCUMENTS = _keys_sql("d", "doc_id", "documents")
PAIRS = f"""{_keys_sql("m", "item_id", "benchmark")}, {DOCUMENTS},
b AS (SELECT mg.id AS l_id, dg.id AS r_id, count(*) AS c FROM mg JOIN dg ON mg.gram = dg.gram GROUP BY 1, 2),
p AS (SELECT l_id, r_id, 1.0 - c::DOUBLE / (mn.n + dn.n - c) AS distance FROM b JOIN mn ON l_id = mn.id JOIN dn ON r_id = dn.id),
j AS (SELECT l_id, r_id, m.key AS l_key, d.key AS r_key, distance FROM p JOIN m ON l_id = m.id JOIN d ON r_id = d.id WHERE distance <= 0.8 + 1e-9)"""


@query("q43_edit_similarity", "SELECT p_partkey, round(1 - levenshtein(p_name, p_type) / greatest(length(p_name), length(p_type)), 6) AS similarity, round(100 * (1 - levenshtein(p_name, p_type) / greatest(length(p_name), length(p_type))), 6) AS percent FROM part")
def edit_similarity(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("p_name"), F.col("p_type")
    return table(spark, d, "part").select("p_partkey", F.round(similarity.edit_similarity(a, b), 6).alias("similarity"), F.round(similarity.edit_percent(a, b), 6).alias("percent"))


@query("q44_ngrams", f"WITH {DOCUMENTS} SELECT id, n FROM dn")
def ngrams(spark: SparkSession, d: str) -> DataFrame:
    return whole_keys(spark, d).select("id", F.size(similarity.ngrams(F.col("key"))).cast("long").alias("n"))


@query("q45_gram_pairs", f"WITH {PAIRS} SELECT l_id, r_id, round(distance, 6) AS distance FROM j")
def gram_pairs(spark: SparkSession, d: str) -> DataFrame:
    found = matching.block_pairs(listed_keys(spark, d), whole_keys(spark, d), texts=False)
    return found.select("l_id", "r_id", F.round("distance", 6).alias("distance"))


@query("q46_match_keys", f"WITH {PAIRS}, s AS (SELECT *, 1 - levenshtein(l_key, r_key) / greatest(length(l_key), length(r_key)) AS score FROM j WHERE least(length(l_key), length(r_key)) >= 0.34 * greatest(length(l_key), length(r_key))) SELECT l_id AS ref_id, r_id AS transaction_id, l_key AS ref_value, r_key AS input_value, 'text' AS matched_on_field, round(score, 6) AS score, round(distance, 6) AS distance FROM s WHERE score >= 0.35")
def match_keys(spark: SparkSession, d: str) -> DataFrame:
    found = matching.match_pairs(matching.block_pairs(listed_keys(spark, d), whole_keys(spark, d), threshold=0.35), "text", 0.35)
    return found.withColumns({"score": F.round("score", 6), "distance": F.round("distance", 6)})


_NAMES = """m AS (SELECT s_suppkey AS id, lower('supplier ' || s_suppkey % 40) AS name FROM supplier),
i AS (SELECT c_custkey AS id, lower('suplier ' || c_custkey % 90) AS name FROM customer),
lg AS (SELECT DISTINCT name, substr(name, x, 3) AS gram FROM (SELECT name, unnest(range(1, length(name) - 1)) AS x FROM m)),
rg AS (SELECT DISTINCT name, substr(name, x, 3) AS gram FROM (SELECT name, unnest(range(1, length(name) - 1)) AS x FROM i)),
pairs AS (SELECT lg.name AS l, rg.name AS r, count(*) AS c FROM lg JOIN rg ON lg.gram = rg.gram GROUP BY 1, 2),
good AS (SELECT l, r, 1 - levenshtein(l, r) / greatest(length(l), length(r)) AS score, 1.0 - c::DOUBLE / ((SELECT count(*) FROM lg WHERE name = l) + (SELECT count(*) FROM rg WHERE name = r) - c) AS distance FROM pairs)"""


@query("q47_match_columns", f"WITH {_NAMES}, f AS (SELECT 'name' AS c UNION ALL SELECT 'title') SELECT m.id AS ref_id, i.id AS transaction_id, l AS ref_value, r AS input_value, f.c AS matched_on_field, round(score, 6) AS score FROM good JOIN m ON m.name = l JOIN i ON i.name = r, f WHERE score >= 0.85 AND distance <= 0.8 + 1e-9")
def match_columns(spark: SparkSession, d: str) -> DataFrame:
    s, c = table(spark, d, "supplier"), table(spark, d, "customer")
    name = lambda word, col, n: F.concat(F.lit(f"{word} "), (F.col(col) % n).cast("string"))
    m = s.select(F.col("s_suppkey").alias("id"), name("Supplier", "s_suppkey", 40).alias("name")).withColumn("title", F.col("name"))
    i = c.select(F.col("c_custkey").alias("id"), name("Suplier", "c_custkey", 90).alias("name")).withColumn("title", F.col("name"))
    found = matching.match_columns(m, i, ["name", "title"], 0.85, digits=6)
    return found.select("ref_id", "transaction_id", "ref_value", "input_value", "matched_on_field", "score")


def _letters(number: Column) -> Column:
    return F.translate(F.lpad(number.cast("string"), 6, "0"), "0123456789", "abcdefghij")


def _letters_sql(number: str) -> str:
    return f"translate(lpad(CAST({number} AS VARCHAR), 6, '0'), '0123456789', 'abcdefghij')"


def _named_sql(name: str, key: str, source: str, end: str) -> str:
    """Two columns of names for each key, the n-grams of each, and how many these are."""
    return f"""{name}p AS (SELECT {key} AS id, {_letters_sql(f"{key} * 7919 % 100003")} AS f, {_letters_sql(f"{key} * 104729 % 99991")} AS l, {end} AS e FROM {source}),
{name} AS (SELECT 'name' AS c, id, f || ' ' || l || e AS k FROM {name}p UNION ALL SELECT 'title', id, l || e || ' ' || f FROM {name}p),
{name}g AS (SELECT DISTINCT c, id, substr(k, x, 3) AS gram FROM (SELECT c, id, k, unnest(range(1, length(k) - 1)) AS x FROM {name})),
{name}n AS (SELECT c, id, count(*) AS n FROM {name}g GROUP BY 1, 2)"""


_OWN_NAMES = f"""{_named_sql("m", "s_suppkey", "supplier", "''")}, {_named_sql("u", "c_custkey", "customer", "CASE WHEN c_custkey % 3 = 1 THEN 'x' ELSE '' END")},
pairs AS (SELECT mg.c, mg.id AS l, ug.id AS r, count(*) AS met FROM mg JOIN ug ON mg.c = ug.c AND mg.gram = ug.gram GROUP BY 1, 2, 3),
good AS (SELECT pairs.c, l, r, m.k AS lk, u.k AS rk, 1 - levenshtein(m.k, u.k) / greatest(length(m.k), length(u.k)) AS score, 1.0 - met::DOUBLE / (mn.n + un.n - met) AS distance
  FROM pairs JOIN mn ON mn.c = pairs.c AND mn.id = l JOIN un ON un.c = pairs.c AND un.id = r JOIN m ON m.c = pairs.c AND m.id = l JOIN u ON u.c = pairs.c AND u.id = r)"""


@query("q107_match_own_names", f"WITH {_OWN_NAMES} SELECT l AS ref_id, r AS transaction_id, lk AS ref_value, rk AS input_value, c AS matched_on_field, round(score, 6) AS score FROM good WHERE score >= 0.7 AND distance <= 0.8 + 1e-9")
def match_own_names(spark: SparkSession, d: str) -> DataFrame:
    """Two columns of names that every key has its own of; a third of the customers' have an edit."""

    def named(rows: DataFrame, key: str, end: Column) -> DataFrame:
        n = F.col(key)
        first, last = _letters(n * 7919 % 100003), F.concat(_letters(n * 104729 % 99991), end)
        return rows.select(n.alias("id"), F.concat_ws(" ", first, last).alias("name"), F.concat_ws(" ", last, first).alias("title"))

    m = named(table(spark, d, "supplier"), "s_suppkey", F.lit(""))
    i = named(table(spark, d, "customer"), "c_custkey", F.when(F.col("c_custkey") % 3 == 1, "x").otherwise(""))
    found = matching.match_columns(m, i, ["name", "title"], 0.7, digits=6)
    return found.select("ref_id", "transaction_id", "ref_value", "input_value", "matched_on_field", "score")


_SCORE = "CASE WHEN {a} = '' AND {b} = '' THEN 0 ELSE 100 * (1 - levenshtein({a}, {b}) / greatest(length({a}), length({b}))) END"


def _persons(rows: DataFrame, key: str, given: bool) -> DataFrame:
    """Person fields worked out of a key: the two sides agree in some of them."""
    n = F.col(key)
    dob = F.lit("01/02/1980") if given else F.when(n % 2 == 0, "01/02/1980").otherwise("11/12/1990")
    phone = F.concat(F.lit("555-"), n.cast("string")) if given else F.when(n % 4 == 0, "").when(n % 4 == 1, F.concat(F.lit("555"), n.cast("string"))).otherwise("(555) 9876")
    first, last = _letters(n * 7919 % 100003), _letters(n * 104729 % 99991)
    return rows.select(n.alias("id"), F.upper(first).alias("FirstName"), (last if given else F.when(n % 3 == 0, last).otherwise(F.concat(F.substring(last, 1, 5), F.lit("xx")))).alias("LastName"), phone.alias("Phone1"), dob.alias("DOB"))


def _persons_sql(name: str, key: str, source: str, given: bool) -> str:
    first, last = _letters_sql(f"{key} * 7919 % 100003"), _letters_sql(f"{key} * 104729 % 99991")
    other = f"CASE WHEN {key} % 3 = 0 THEN {last} ELSE left({last}, 5) || 'xx' END"
    phone = f"CASE WHEN {key} % 4 = 0 THEN '' WHEN {key} % 4 = 1 THEN '555' || {key} ELSE '5559876' END"
    return f"""{name} AS (SELECT {key} AS id, {first} AS f, {last if given else other} AS l, {f"'555' || {key}" if given else phone} AS p, {"'01021980'" if given else f"CASE WHEN {key} % 2 = 0 THEN '01021980' ELSE '11121990' END"} AS d FROM {source}),
{name}g AS (SELECT DISTINCT id, substr(key, i, 3) AS gram FROM (SELECT id, key, unnest(range(1, length(key) - 1)) AS i FROM (SELECT id, f || ' ' || l AS key FROM {name}))),
{name}n AS (SELECT id, count(*) AS n FROM {name}g GROUP BY id)"""


@query(
    "q48_person_table",
    f"WITH {_persons_sql('m', 's_suppkey', 'supplier', True)}, {_persons_sql('k', 'c_custkey', 'customer', False)}, "
    "c AS (SELECT mg.id AS m_id, kg.id AS i_id, count(*) AS c FROM mg JOIN kg ON mg.gram = kg.gram GROUP BY 1, 2), "
    "x AS (SELECT m_id, i_id, m.f AS f1, k.f AS f2, m.l AS l1, k.l AS l2, m.p AS p1, k.p AS p2, m.d AS d1, k.d AS d2 FROM c JOIN mn ON m_id = mn.id JOIN kn ON i_id = kn.id JOIN m ON m_id = m.id JOIN k ON i_id = k.id WHERE 1.0 - c::DOUBLE / (mn.n + kn.n - c) <= 0.8 + 1e-9), "
    f"s AS (SELECT m_id, i_id, {_SCORE.format(a='f1', b='f2')} AS f, {_SCORE.format(a='l1', b='l2')} AS l, {_SCORE.format(a='p1', b='p2')} AS p, {_SCORE.format(a='d1', b='d2')} AS d FROM x) "
    "SELECT m_id, i_id, CASE WHEN (p >= 90 AND f >= 90) OR (f >= 90 AND l >= 90 AND (d >= 90 OR p >= 90)) THEN 'Yes' ELSE 'No' END AS \"match\", concat_ws(', ', CASE WHEN f < 90 THEN 'FirstName' END, CASE WHEN l < 90 THEN 'LastName' END, CASE WHEN p < 90 THEN 'Phone1' END, CASE WHEN d < 90 THEN 'DOB' END) AS error, round((f + l + d) / 3, 6) AS confidence FROM s",
)
def person_table(spark: SparkSession, d: str) -> DataFrame:
    found = matching.match_persons(_persons(table(spark, d, "supplier"), "s_suppkey", True), _persons(table(spark, d, "customer"), "c_custkey", False))
    return found.select("m_id", "i_id", "match", "error", F.round("confidence", 6).alias("confidence"))


@query("q49_lsh_pairs")
def lsh_pairs(spark: SparkSession, d: str) -> DataFrame:
    found = matching.banded_pairs(listed_keys(spark, d), whole_keys(spark, d), recall=0.98, texts=False)
    return found.select("l_id", "r_id", F.round("distance", 6).alias("distance"))


_WORDS = r"""w AS (SELECT id, token, count(*) AS tf FROM (SELECT p_partkey AS id, unnest(regexp_split_to_array(lower(p_name || ' ' || p_brand || ' ' || p_type), '\s+')) AS token FROM part) WHERE token <> '' GROUP BY 1, 2),
f AS (SELECT token, 1.0 + ln((SELECT count(*) FROM part)::DOUBLE / (count(*) + 1.0)) AS idf FROM w GROUP BY token),
q AS (SELECT s_suppkey AS q_id, unnest(['re', 'bo.', 'brand#' || s_suppkey % 25, 'small']) AS raw, unnest([0, 1, 2, 3]) AS pos FROM supplier),
t AS (SELECT q_id, pos, CASE WHEN pos < 2 THEN replace(raw, '.', '') ELSE raw END AS token, pos < 2 AS prefix, CASE WHEN pos < 2 THEN 2.0 ELSE 1.0 END AS boost FROM q),
h AS (SELECT q_id, pos, id, sum(tf * idf * boost) AS part FROM t JOIN f ON CASE WHEN prefix THEN starts_with(f.token, t.token) ELSE f.token = t.token END JOIN w ON w.token = f.token GROUP BY 1, 2, 3),
s AS (SELECT q_id, id, (sum(part) + (count(DISTINCT pos) - 1) / pow(4 - 0.9, 2)) * 3 / 4 AS score FROM h GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(score, 9) DESC, id) AS rank FROM s)"""


def _hits(spark: SparkSession, d: str, k: int) -> tuple[DataFrame, DataFrame]:
    p, s = table(spark, d, "part"), table(spark, d, "supplier")
    postings = search.index(p.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("document")))
    brand = F.concat(F.lit("re bo. Brand#"), (F.col("s_suppkey") % 25).cast("string"), F.lit(" small"))
    queries = s.select(F.col("s_suppkey").alias("q_id"), brand.alias("query"))
    return search.top_hits(postings, search.query_tokens(queries), p.count(), k, coverage=0.9), queries


@query("q50_search", f"WITH {_WORDS} SELECT q_id, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 210")
def search_top(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d, search.HITS)[0].select("q_id", "id", F.round("score", 6).alias("score"), "rank")


@query(
    "q51_ranked_decision",
    f"WITH {_WORDS}, m AS (SELECT p_partkey AS id, lower(p_type) AS f, lower(p_brand) AS l, CASE WHEN p_partkey % 3 = 0 THEN 'nan' ELSE lower(p_type) END AS v, CAST(p_size AS VARCHAR) AS d, CAST(p_partkey % 10 AS VARCHAR) AS p FROM part), "
    "x AS (SELECT s_suppkey AS q_id, 'small' AS f, 'brand#' || s_suppkey % 25 AS l, CASE WHEN s_suppkey % 2 = 0 THEN 'nan' ELSE 'economy' END AS v, CAST(s_suppkey % 50 AS VARCHAR) AS d, CAST(s_suppkey % 10 AS VARCHAR) AS p FROM supplier), "
    "h2 AS (SELECT r.*, (r.id % 100) / 100.0 AS model, x.d = m.d AS dob, x.p = m.p AND x.f = m.f AS pf, x.v = 'nan' AND m.v = 'nan' AS np, "
    "x.f = m.f AND (x.l = m.l OR (NOT (x.v = 'nan' AND m.v = 'nan') AND x.v = m.v)) AND (x.d = m.d OR x.p = m.p) AS ni FROM r JOIN m ON r.id = m.id JOIN x ON r.q_id = x.q_id WHERE rank <= 210), "
    "o AS (SELECT *, score >= 50 OR (model > 0.89 AND dob) OR pf OR ni AS accept, CASE WHEN score >= 50 OR (model > 0.89 AND dob) THEN 100 WHEN pf OR ni OR np THEN CASE WHEN model < 0.57 THEN 99 ELSE least(100, CAST(trunc(score / 5.5 * 100) AS INTEGER)) END ELSE CAST(trunc(score / 13.5 * 100) AS INTEGER) END AS confidence FROM h2), "
    "c AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY accept DESC, CASE WHEN accept THEN rank ELSE -rank END) AS k FROM o) "
    "SELECT s_suppkey AS q_id, CASE WHEN accept THEN id END AS id, CASE WHEN accept THEN 'Yes' ELSE 'No' END AS found, coalesce(confidence, 0) AS confidence FROM supplier LEFT JOIN c ON s_suppkey = q_id AND k = 1",
)
def ranked_decision(spark: SparkSession, d: str) -> DataFrame:
    hits, queries = _hits(spark, d, search.HITS)
    n, k, t = F.col("p_partkey"), F.col("s_suppkey"), F.lower("p_type")
    fields = lambda *c: F.struct(*(v.cast("string").alias(f) for f, v in zip(("first", "last", "prev", "dob", "phone"), c, strict=True)))
    master = table(spark, d, "part").select(n.alias("id"), fields(t, F.lower("p_brand"), F.when(n % 3 == 0, "nan").otherwise(t), F.col("p_size"), n % 10).alias("master"))
    rows = table(spark, d, "supplier").select(k.alias("q_id"), fields(F.lit("small"), F.concat(F.lit("brand#"), (k % 25).cast("string")), F.when(k % 2 == 0, "nan").otherwise("economy"), k % 50, k % 10).alias("row"))
    met = hits.join(master, "id").join(rows, "q_id")
    return search.decide(met.withColumns(search.field_outcome(F.col("score"), (F.col("id") % 100) / 100.0)), queries)


@query("q52_weighted_score", "WITH s AS (SELECT p_partkey, round(0.6 * CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END + 0.4 * CASE WHEN p_size = p_partkey % 50 THEN 1 ELSE 0 END, 6) AS score FROM part) SELECT *, score >= 0.6 AS is_match, CASE WHEN score >= 0.6 THEN 'route_downstream' ELSE 'route_to_review' END AS route FROM s")
def weighted_score(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.col("p_type").alias("l_type"), F.lit("SMALL").alias("r_type"), F.col("p_size").cast("string").alias("l_size"), (F.col("p_partkey") % 50).cast("string").alias("r_size"))
    found = matching.weighted_match(p, {"type": (0.6, "exact"), "size": (0.4, "exact")}, 0.6)
    return found.select("p_partkey", F.round("score", 6).alias("score"), "is_match", "route")


@query("q72_master_clean", "SELECT c_custkey, trim(replace(replace(replace(translate(lower(c_name || ' (NoClub)'), '#:> <$\"^=()', ''), 'types', ''), 'noclub', ''), 'club', '')) AS \"FirstName\", lower(c_mktsegment) AS \"LastName\", '' AS \"PrevLastName\", '' AS \"Email\", '555' || c_custkey AS \"NORMALIZED_PHONE\", CASE WHEN c_custkey % 2 = 0 THEN '010280' ELSE '' END AS \"NORMALIZED_DOB\" FROM customer")
def master_clean(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("c_custkey")
    rows = table(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(" (NoClub)")).alias("FirstName"), F.col("c_mktsegment").alias("LastName"), F.lit(None).cast("string").alias("PrevLastName"), F.lit("a@b.c").alias("Email"), F.concat(F.lit("555-"), n.cast("string")).alias("Phone1"), F.when(n % 2 == 0, "01/02/1980").alias("DOB"))
    cleaned = matching.clean_master(rows.unionAll(rows))
    return cleaned.select(F.col("c_custkey").cast("long").alias("c_custkey"), "FirstName", "LastName", "PrevLastName", "Email", "NORMALIZED_PHONE", "NORMALIZED_DOB")


@query("q73_discovery")
def discovery(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"), F.concat("p_name", F.lit("s")).alias("m_name"), F.col("p_size").cast("double").cast("string").alias("size"), F.col("p_size").cast("string").alias("m_size"))
    return matching.discover(p, ["name", "size"])


@query("q66_sequence_ratio")
def sequence_ratio(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("ratio", similarity.sequence_ratio(F.col("p_name"), F.concat_ws(" ", "p_type", "p_name")))
    return p.select("p_partkey", "ratio", *(c.alias(n) for n, c in similarity.verdicts(F.col("ratio")).items()))
