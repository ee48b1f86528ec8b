"""Searches that skip, joins by segments and bands, rules as rows, segments of an index, records with line breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio import model
from folio.operators import align, events, load, matching, rules, search, segments
from folio.plans.linkage import PAIRS, listed_keys, whole_keys
from folio.plans.registry import query
from folio.plans.views import ENRICHMENT, enrichment, table
from folio.sources import adapters, readers, sinks
from folio.sources.staging import materialise, new_folder

_TEXT_WORDS = r"""w AS (SELECT id, token, count(*) AS tf FROM (SELECT doc_id AS id, unnest(regexp_split_to_array(lower(coalesce(text, '')), '\s+')) AS token FROM documents) WHERE token <> '' GROUP BY 1, 2),
f AS (SELECT token, 1.0 + ln((SELECT count(*) FROM documents)::DOUBLE / (count(*) + 1.0)) AS idf FROM w GROUP BY token),
t AS (SELECT q_id, token, pos, count(*) OVER (PARTITION BY q_id) AS n FROM (SELECT item_id AS q_id, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM (SELECT item_id, string_split(lower(coalesce(text, '')), ' ') AS l FROM benchmark)) WHERE token <> ''),
g AS (SELECT q_id, token, n, count(*) AS times FROM t GROUP BY 1, 2, 3),
h AS (SELECT q_id, w.id, sum(tf * idf * times) AS score, sum(times) AS held, any_value(n) AS n FROM g JOIN f USING (token) JOIN w ON w.token = g.token GROUP BY 1, 2),
s AS (SELECT q_id, id, CASE WHEN n > 1 THEN (score + (held - 1) / pow(n - 0.9, 2)) * (n - 1) / n ELSE score END AS score FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(score, 9) DESC, id) AS rank FROM s)"""


@query("q89_search_documents", f"WITH {_TEXT_WORDS} SELECT q_id, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 210")
def search_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every benchmark text searched in all documents, without the blocks that cannot hold a hit."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("document"))
    queries = table(spark, d, "benchmark").select(F.col("item_id").alias("q_id"), F.col("text").alias("query"))
    found = search.best_hits(search.block_index(docs), search.query_tokens(queries, names=0), search.HITS, 0.9)
    return found.hits.select("q_id", "id", F.round("score", 6).alias("score"), "rank")


def _decision_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Fields of parts as a master and of suppliers as rows, which agree in some of them."""
    n, k, t = F.col("p_partkey"), F.col("s_suppkey"), F.lower("p_type")
    fields = lambda *c: F.struct(*(v.cast("string").alias(f) for f, v in zip(search.FIELDS, c, strict=True)))
    master = table(spark, d, "part").select(n.alias("id"), fields(t, F.lower("p_brand"), F.when(n % 3 == 0, "nan").otherwise(t), F.col("p_size"), n % 97).alias("master"))
    rows = table(spark, d, "supplier").select(k.alias("q_id"), fields(F.lit("small"), F.concat(F.lit("brand#"), (k % 25).cast("string")), F.when(k % 2 == 0, "nan").otherwise("economy"), k % 50, k % 97).alias("row"))
    return master, rows


@query("q90_first_accepted")
def first_accepted(spark: SparkSession, d: str) -> DataFrame:
    """Ranked hits decided by a scan that stops, with a logistic model fitted to hits whose names and ids agree."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("document"))
    names = table(spark, d, "part").select("p_partkey", "p_name")
    asked = table(spark, d, "supplier").join(names, F.col("s_suppkey") == F.col("p_partkey")).select(F.col("s_suppkey").alias("q_id"), F.concat("p_name", F.lit(" small")).alias("query"))
    found = search.best_hits(search.block_index(parts), search.query_tokens(asked), search.HITS, 0.9)
    master, rows = _decision_sides(spark, d)
    same = lambda f: (F.col(f"row.{f}") == F.col(f"master.{f}")).cast("int")
    made = found.beside(master, rows).withColumns({"first_same": same("first"), "last_same": same("last"), "phone_same": same("phone"), "dob_same": same("dob")})
    met = materialise(made.withColumn("agree", F.col("first_same") * F.greatest("dob_same", "phone_same")))
    columns = ["first_same", "last_same", "phone_same", "dob_same", "score"]
    some = met.agg(F.min("agree"), F.max("agree")).first()
    if some[0] == some[1]:  # nothing to learn from
        scored = met.withColumn("model_score", F.lit(0.0))
    else:
        path = new_folder(spark)
        matching.fit_rescorer(met, columns, "agree").write().save(path)
        scored = matching.rescore(met, columns, path)
    return search.first_accepted(scored, table(spark, d, "supplier").select(F.col("s_suppkey").alias("q_id")))


_PART_KEYS = "k AS (SELECT min(p_partkey) AS id, lower(p_name || ' ' || replace(p_brand, '#', '') || ' ' || p_type) AS key FROM part GROUP BY 2)"


@query("q91_edit_pairs", f"WITH {_PART_KEYS}, c AS (SELECT a.id AS l_id, b.id AS r_id, a.key AS l_key, b.key AS r_key, greatest(length(a.key), length(b.key)) AS n FROM k a JOIN k b ON a.id < b.id AND abs(length(a.key) - length(b.key)) <= 0.1 * greatest(length(a.key), length(b.key)) + 1e-9) SELECT l_id, r_id, round(1 - levenshtein(l_key, r_key) / n, 6) AS score FROM c WHERE levenshtein(l_key, r_key) <= floor(0.1 * n + 1e-9)")
def edit_pairs(spark: SparkSession, d: str) -> DataFrame:
    key = F.lower(F.concat_ws(" ", "p_name", F.replace("p_brand", F.lit("#"), F.lit("")), "p_type"))
    keys = table(spark, d, "part").groupBy(key.alias("key")).agg(F.min("p_partkey").alias("id")).select("id", "key")
    return matching.edit_pairs(keys, keys, 0.9).filter("l_id < r_id").select("l_id", "r_id", F.round("score", 6).alias("score"))


@query("q92_banded_pairs", f"WITH {PAIRS} SELECT l_id, r_id, round(distance, 6) AS distance FROM j WHERE distance <= 0.7 + 1e-9")
def banded_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Bands so many that a pair at the distance is missed with a probability of one in a million."""
    found = matching.banded_pairs(listed_keys(spark, d), whole_keys(spark, d), 0.7, recall=1 - 1e-6, texts=False)
    return found.select("l_id", "r_id", F.round("distance", 6).alias("distance"))


@query(
    "q93_rule_rows",
    """WITH p AS (SELECT p_partkey, p_partkey % 3 AS c, p_name AS n, CAST(p_size AS VARCHAR) AS z, CASE WHEN p_partkey % 11 = 0 THEN '50' ELSE '95' END AS s FROM part),
    e AS (SELECT *, CASE WHEN s = '50' THEN 'Not null value has a score ''50.0'' below threshold ''80.0''' WHEN c = 0 THEN concat_ws('; ',
      CASE WHEN length(n) < 9 THEN 'Length ''' || length(n) || ''' < MinLength ''9''' END, CASE WHEN NOT regexp_matches(n, '^(?:[a-m])') THEN 'Pattern validation failed' END) WHEN c = 1 AND contains(n, ' ') THEN 'Special characters not allowed:  ' ELSE '' END AS name_errors,
      CASE WHEN c = 1 THEN CASE WHEN length(z) > 1 THEN 'Length ''' || length(z) || ''' > MaxLength ''1''' ELSE '' END END AS size_errors FROM p)
    SELECT p_partkey, name_errors, size_errors, CASE WHEN c = 2 OR (name_errors = '' AND coalesce(size_errors, '') = '') THEN 'True' ELSE 'False' END AS validation_passed,
      CASE WHEN c = 1 THEN 'False' WHEN c = 2 OR name_errors = '' THEN 'True' ELSE 'False' END AS data_is_valid FROM (SELECT * REPLACE (CASE WHEN c = 2 THEN NULL ELSE name_errors END AS name_errors) FROM e)""",
)
def rule_rows(spark: SparkSession, d: str) -> DataFrame:
    """Documents of three collections by rules that are rows of their configuration."""
    rule = lambda name, *v: (name, name, "string", None, None, [], tuple([*v] + [None] * (8 - len(v))))
    found = [("0", "false", True, [rule("name", "9", "", "[a-m]", "true")]), ("1", "TRUE", True, [rule("name", None, None, None, "false"), rule("size", None, "1")])]
    config = spark.createDataFrame([("acc", found)], model.CONFIG)
    n = F.col("p_partkey")
    sure = F.when(n % 11 == 0, "50").otherwise("95")
    pairs = F.to_json(F.struct(F.col("p_name").alias("name"), sure.alias("name_s"), F.col("p_size").cast("string").alias("size"), F.lit("99").alias("size_s")))
    docs = table(spark, d, "part").select("p_partkey", (n % 3).cast("string").alias("collection"), pairs.alias("key_value_pairs"))
    done = rules.validate_by(docs, rules.rule_rows(readers.collections(config)), "2024-01-01")
    of = lambda i: F.array_join(F.get("results", F.lit(i))["ValidationErrors"], "; ")
    return done.select("p_partkey", of(0).alias("name_errors"), of(1).alias("size_errors"), "validation_passed", "data_is_valid")


@query(
    "q94_manifest_records",
    "SELECT CAST(page_id AS VARCHAR) AS page_id, CASE WHEN page_id % 2 = 0 THEN 'first \"line\"' || chr(10) || url || '|' ELSE url END AS note, CASE WHEN page_id % 2 = 1 THEN 'x' END AS extra FROM pages",
)
def manifest_records(spark: SparkSession, d: str) -> DataFrame:
    """Two kinds of files with columns in another order; cells with line breaks, quotes and separators."""
    path, p = new_folder(spark), table(spark, d, "pages")
    note = F.concat(F.lit('first "line"\n'), "url", F.lit("|"))
    write = lambda df, name: df.write.option("header", "true").option("sep", "|").option("quoteAll", "true").option("escape", '"').csv(f"{path}/{name}")
    write(p.filter("page_id % 2 = 0").select(F.col("page_id").alias("PageId"), note.alias("Note")), "a")
    write(p.filter("page_id % 2 = 1").select(F.lit("x").alias("Extra"), F.col("url").alias("Note"), F.col("page_id").alias("Page Id")), "b")
    return readers.manifest(spark, f"{path}/*").select("page_id", "note", "extra")


@query(
    "q95_review_bodies",
    f"""WITH {ENRICHMENT}, i AS (SELECT batch_name AS b, image_path AS id, row_number() OVER (PARTITION BY batch_name ORDER BY image_path) AS k FROM enrichment WHERE data_is_valid <> 'True')
    SELECT b AS "BatchId", id AS "Id", 'Failed' AS "Status", 'Validation Error' AS "Error", '1' AS "ErrorCode" FROM i""",
)
def review_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The items that are in the bodies of the messages, read back from their JSON."""
    failed = F.col("data_is_valid") == "True"
    items = enrichment(spark, d).filter("data_is_valid <> 'True'").select(F.col("batch_name").alias("BatchId"), F.col("image_path").alias("Id"), *(c.alias(n) for n, c in rules.review_status(failed).items()))
    body = F.from_json("message", "BatchId string, Items array<struct<Id string, Status string, Error string, ErrorCode string>>")
    return events.review_messages(items).select(body.alias("m")).select("m.BatchId", F.explode("m.Items").alias("i")).select("BatchId", "i.*")


@query(
    "q96_index_segments",
    "WITH d AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 3 THEN '' WHEN p_partkey % 5 = 0 THEN 'second ' || p_type WHEN p_partkey % 2 = 0 THEN 'first ' || p_brand ELSE p_name || ' ' || p_brand END AS document FROM part) "
    "SELECT token, id, count(*) AS tf FROM (SELECT id, unnest(string_split(lower(document), ' ')) AS token FROM d) WHERE token <> '' GROUP BY token, id",
)
def index_segments(spark: SparkSession, d: str) -> DataFrame:
    """A base, two deltas, one that is older and ignored, documents that go, and all compacted."""
    path, p, n = new_folder(spark), table(spark, d, "part"), F.col("p_partkey")
    of = lambda rows, *c: rows.select(n.alias("id"), F.concat_ws(" ", *c).alias("document"))
    segments.create(of(p, "p_name", "p_brand"), path, "2024-01-01")
    segments.apply_delta(of(p.filter(n % 2 == 0), F.lit("first"), "p_brand"), path, "2024-01-02")
    segments.apply_delta(of(p, F.lit("older")), path, "2024-01-02")
    segments.apply_delta(of(p.filter(n % 5 == 0), F.lit("second"), "p_type"), path, "2024-01-05", removed=p.filter(n % 7 == 3).select(n.alias("id")))
    segments.apply_delta(of(p, F.lit("older")), path, "2024-01-04")
    segments.apply_delta(of(p.filter(n < 0), "p_name"), path, "2024-01-06", removed=p.filter((n % 7 == 3) & (n % 5 == 0)).select(n.alias("id")))
    segments.compact(spark, path)
    return segments.postings(spark, path)


@query("q97_batch_properties", f"WITH {ENRICHMENT} SELECT image_path, 'b7' AS \"BatchId\", 'src' AS \"Source\" FROM enrichment")
def batch_properties(spark: SparkSession, d: str) -> DataFrame:
    """What a batch has in common, written for later stages, read back and put beside its rows."""
    path = new_folder(spark)
    rows = enrichment(spark, d).select("image_path", F.lit("b7").alias("BatchId"), F.lit("src").alias("Source"))
    sinks.put_properties(rows, path, "BatchId", "Source")
    found = sinks.properties(spark, path, "BatchId", "Source")
    return rows.select("image_path", *(F.lit(v).alias(k) for k, v in found.items()))


@query("q98_appended_lookups", "SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'Error: ValueError: unknown' ELSE 'box ' || c_custkey END AS box, CASE WHEN c_custkey % 13 = 0 THEN 'Error: ValueError: unknown' WHEN c_custkey % 2 = 0 THEN c_name END AS parent FROM customer")
def appended_lookups(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a service as columns beside all rows; a call that fails is its row's only."""

    def service(requests: list[str]) -> list[str]:
        import json

        out = []
        for r in requests:
            key, name = r.split("|")
            if int(key) % 13 == 0:
                raise ValueError("unknown")
            out.append(json.dumps({"box": f"box {key}"} | ({"parent": name} if int(key) % 2 == 0 else {})))
        return out

    rows = table(spark, d, "customer").select("c_custkey", F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name").alias("request"))
    return adapters.append_lookup(rows, "request", service, {"box": "box", "parent": "parent"}).select("c_custkey", "box", "parent")


@query("q99_column_differences", "SELECT unnest(['c_acctbal', 'c_mktsegment']) AS missing, (SELECT count(*) FROM customer) AS n")
def column_differences(spark: SparkSession, d: str) -> DataFrame:
    """Columns that a target has and rows lack, with the rows that it holds for."""
    rows = table(spark, d, "customer")
    missing, _ = align.column_changes(rows.select("c_custkey", "c_name", "c_nationkey").columns, rows.columns)
    return rows.agg(F.count("*").alias("n")).select(F.explode(F.lit(missing)).alias("missing"), "n")


@query("q100_variant_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing FROM events")
def variant_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields of documents that were parsed once, when they were stored."""
    stored = materialise(load.as_variant(table(spark, d, "events").select("event_id", "props"), "props"))
    return load.explode_fields(stored, "props", {"k": "integer", "missing": "string"}).select("event_id", "k", "missing")


@query("q101_variant_documents", "SELECT p_partkey, CASE WHEN p_size >= 8 AND length(p_name) >= 9 AND p_partkey % 7 <> 0 THEN 'True' ELSE 'False' END AS validation_passed, 'False' AS data_is_valid FROM part")
def variant_documents(spark: SparkSession, d: str) -> DataFrame:
    pairs = F.when(F.col("p_partkey") % 7 == 0, F.lit('{"error": "x"}')).otherwise(F.to_json(F.struct(F.col("p_name").alias("name"), (F.col("p_size") * 10).alias("name_s"))))
    stored = materialise(load.as_variant(table(spark, d, "part").select("p_partkey", pairs.alias("key_value_pairs")), "key_value_pairs"))
    checked = rules.validate(stored, [model.FieldRule("name", min_length=9, special=" "), model.FieldRule("other", allow_null=True)], "2024-01-01", audit=True)
    return checked.select("p_partkey", "validation_passed", "data_is_valid")


@query("q102_listing", "SELECT DISTINCT replace(p_brand, '#', '') AS brand FROM part")
def listing(spark: SparkSession, d: str) -> DataFrame:
    """The folders of a written table, from the names of its files."""
    path = new_folder(spark)
    table(spark, d, "part").withColumn("brand", F.replace("p_brand", F.lit("#"), F.lit(""))).write.partitionBy("brand").parquet(path)
    found = readers.listing(spark, path, "*.parquet").filter("length > 0")
    return found.select(F.regexp_extract("path", "brand=([^/]+)/", 1).alias("brand")).distinct()


@query("q103_archives", "SELECT coalesce(source, 'none') || '-' || doc_id % 8 || '.zip' AS archive, doc_id || '.txt' AS name, sha256(coalesce(text, '')) AS digest FROM documents")
def archives(spark: SparkSession, d: str) -> DataFrame:
    """All texts written into archives and expanded again, member by member, in pieces."""
    path, n = new_folder(spark), F.col("doc_id")
    archive = F.concat_ws("-", F.coalesce("source", F.lit("none")), F.concat((n % 8).cast("string"), F.lit(".zip")))
    adapters.pack(table(spark, d, "documents").select(archive.alias("archive"), F.concat(n.cast("string"), F.lit(".txt")).alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content")), path)
    pieces = adapters.expand(spark, path).groupBy("archive", "name").agg(F.array_sort(F.collect_list(F.struct("part", "content"))).alias("pieces"))
    whole = F.aggregate("pieces", F.lit(b""), lambda x, p: F.concat(x, p["content"]))
    return pieces.select(F.substring_index("archive", "/", -1).alias("archive"), "name", F.sha2(whole, 256).alias("digest"))


@query("q104_table_columns", "SELECT * FROM (VALUES (0, 'n_nationkey', false), (1, 'n_name', false), (2, 'n_regionkey', true)) v(place, name, partitioned), (SELECT count(*) AS n FROM nation)")
def table_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns of a catalogue table, and the rows read by its name."""
    path = new_folder(spark)
    name = f"folio_{path[-12:]}"
    table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").write.partitionBy("n_regionkey").option("path", path).saveAsTable(name)
    columns, partitions = readers.table_columns(spark, name)
    n = readers.table(spark, name).count()
    spark.sql(f"DROP TABLE {name}")
    listed = spark.createDataFrame([(i, c, c in partitions) for i, c in enumerate(columns)], "place int, name string, partitioned boolean")
    return listed.withColumn("n", F.lit(n))


@query("q105_prompts", """SELECT c_custkey, 'Return one JSON object with these keys: ["name", "name_s", "segment", "segment_s"]. Missing values are null.' || chr(10) || c_name || ' ' || c_mktsegment AS request FROM customer""")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    """The request of an extraction for every row."""
    return table(spark, d, "customer").select("c_custkey", adapters.prompt(["name", "segment"], F.concat_ws(" ", "c_name", "c_mktsegment")).alias("request"))


@query("q106_inferred_csv", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def inferred_csv(spark: SparkSession, d: str) -> DataFrame:
    """Types worked out of written rows: whole numbers, decimals and texts."""
    path = new_folder(spark)
    sinks.csv(table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path, sep=";")
    found = readers.inferred_csv(spark, path, sep=";")
    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    if kinds["p_name"] != "string" or kinds["p_retailprice"] != "double" or kinds["p_size"] not in ("int", "bigint"):
        raise TypeError(f"types that were not inferred: {kinds}")
    return found.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", F.col("p_size").cast("int").alias("p_size"), "p_retailprice")
