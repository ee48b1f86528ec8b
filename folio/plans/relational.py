"""Scans, projections, joins, aggregations and routing over batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio import model
from folio.functions import text
from folio.model import JobParameters
from folio.operators import align, batches, load, rules
from folio.plans.registry import query
from folio.plans.views import ENRICHMENT, MANIFEST, enrichment, manifest, table
from folio.sources import readers, staging


@query("q01_batch_scan", f"WITH {ENRICHMENT} SELECT image_path, batch_name, transaction_id, data_is_valid FROM enrichment WHERE batch_name = 'src1' AND transaction_id = 'en' AND data_is_valid = 'True'")
def batch_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.batch_rows(enrichment(spark, d), "src1", "en", "image_path", "batch_name", "transaction_id", "data_is_valid")
    return rows.filter(F.col("data_is_valid") == "True")


@query("q02_projected_scan", f"WITH {ENRICHMENT} SELECT image_path, n_chars FROM enrichment WHERE batch_name = 'src2' AND transaction_id = 'fr'")
def projected_scan(spark: SparkSession, d: str) -> DataFrame:
    return readers.batch_rows(enrichment(spark, d), "src2", "fr", "image_path", "n_chars")


@query("q03_align", f"WITH {MANIFEST} SELECT batch_name, 'null' AS key_value_pairs, image_path, 'null' AS data_is_valid FROM manifest")
def align_target(spark: SparkSession, d: str) -> DataFrame:
    return align.to_target(manifest(spark, d), ["batch_name", "key_value_pairs", "image_path", "data_is_valid"])


@query("q04_snake_columns", "SELECT c_custkey AS customer_key, c_name AS full_name, c_mktsegment AS market_segment FROM customer")
def snake_columns(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return align.snake_columns(c.select(F.col("c_custkey").alias("CustomerKey"), F.col("c_name").alias("Full Name (Auto Extracted)"), F.col("c_mktsegment").alias("market-segment")))


@query("q05_ingest", "SELECT 'base/' || replace('Images' || chr(92) || doc_id || '.jpg', chr(92), '/') AS image_path, CASE WHEN doc_id % 4 = 0 THEN 'null' ELSE lang END AS lang, 't1' AS transaction_id, 'b1' AS batch_name, '' AS account_id, '' AS item_code, '' AS item_code_id FROM documents")
def ingest(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "documents").select(F.concat(F.lit("Images\\"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("image_path"), F.when(F.col("doc_id") % 4 != 0, F.col("lang")).alias("lang"))
    return align.ingest(raw, "b1", "t1", "base/")


@query("q06_override", f"WITH {MANIFEST} SELECT image_path, CASE WHEN batch_name = 'src3' THEN 'BOX-NEW' ELSE box_barcode END AS box_barcode FROM manifest")
def override(spark: SparkSession, d: str) -> DataFrame:
    given = JobParameters.parse_filters("{'src3': 'BOX-NEW', 'absent': 'BOX-X'}")
    return align.override_batches(manifest(spark, d), "box_barcode", given).select("image_path", "box_barcode")


@query("q07_reference_id", f"WITH {MANIFEST} SELECT image_path, CASE WHEN ref1 = 'null' THEN regexp_replace(md5(batch_name || '_' || image_path || '_' || image_filename), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') ELSE ref1 END AS ref1 FROM manifest")
def reference_id(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).select("image_path", align.reference_id(F.col("ref1"), F.col("batch_name"), F.col("image_path"), F.col("image_filename")).alias("ref1"))


@query("q08_rename_drop", f"WITH {MANIFEST} SELECT image_path, ref1, batch_name AS \"Batch\" FROM manifest")
def rename_drop(spark: SparkSession, d: str) -> DataFrame:
    m = manifest(spark, d).select("image_path", "ref1", F.lit("x").alias("ref2"), F.lit("y").alias("ref11"), "batch_name")
    return align.drop_matching(align.rename(m, {"batch_name": "Batch", "absent": "Other"}), r"ref\d+$", keep=("ref1",))


_NEW_ITEM = """new_item AS (SELECT '' AS "Customer File Barcode", '' AS "customerFileBarcode", '' AS "locationId", '' AS "departmentId", '' AS "Department", '' AS "File Barcode",
  CAST(doc_id AS VARCHAR) AS "customerSchemaType", CAST(doc_id AS VARCHAR) AS "itemType", 'account-1' AS "customerId", 'G-' || batch_name AS "parentId", 'BOX-' || batch_name AS "parentItemCode", 'BOX-' || batch_name AS "Box Barcode",
  image_path AS "sourcePath", '4' AS action, 'false' AS attachment, substr(ocr_liquid_text, 1, 900) AS "REF10", '2024-01-02 03:04' AS "Index Date", '2024-01-02 03:04' AS "REF30" FROM enrichment)"""
_EXISTING_ITEM = """existing_item AS (SELECT '' AS "Customer File Barcode", '' AS "customerFileBarcode", '' AS "locationId", '' AS "departmentId", '' AS "Department", '' AS "File Barcode",
  'FILE' AS "customerSchemaType", 'FILE' AS "itemType", 'account-1' AS "customerId", image_path AS "sourcePath", substr(ocr_liquid_text, 1, 900) AS "REF5", '2024-01-02 03:04' AS "Index Date", '2024-01-02 03:04' AS "REF30",
  'c' || doc_id AS "ItemCode", CAST(doc_id AS VARCHAR) AS "ItemCodeID", transaction_id FROM enrichment)"""
_NEW_COLUMNS = [*load.BLANK, "customerSchemaType", "itemType", "customerId", "parentId", "parentItemCode", "Box Barcode", "sourcePath", "action", "attachment", "REF10", "Index Date", "REF30"]
_EXISTING_COLUMNS = [*load.BLANK, "customerSchemaType", "itemType", "customerId", "sourcePath", "REF5", "Index Date", "REF30", "ItemCode", "ItemCodeID"]
_EXISTING_BATCH = "batch_x_file_ref5.zip"


def _new_items(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.col("doc_id").cast("string"), F.lit("-"), F.coalesce("transaction_id", F.lit("")), F.lit(".jpg"))
    rows = enrichment(spark, d).withColumns({"image_filename": name, "box_barcode": F.concat(F.lit("BOX-"), "batch_name"), "box_id": F.concat(F.lit("G-"), "batch_name")})
    return load.new_item_columns(rows, "account-1", F.lit("2024-01-02 03:04:05").cast("timestamp"))


def _existing_items(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id").cast("string")
    rows = enrichment(spark, d).withColumns({"item_code": F.concat(F.lit("c"), n), "item_code_id": n})
    return load.existing_item_columns(rows, _EXISTING_BATCH, "account-1", F.lit("2024-01-02 03:04:05").cast("timestamp"))


@query("q09_new_item", f"WITH {ENRICHMENT}, {_NEW_ITEM} SELECT * FROM new_item")
def new_item(spark: SparkSession, d: str) -> DataFrame:
    return _new_items(spark, d).select(*_NEW_COLUMNS)


@query("q68_new_payload", f"WITH {ENRICHMENT}, {_NEW_ITEM} SELECT \"customerId\", \"locationId\", \"parentId\", attachment, \"customerSchemaType\", \"itemType\", \"departmentId\", \"sourcePath\", CASE WHEN \"REF10\" = '' OR \"REF10\" IS NULL THEN 'BLANK' ELSE left(\"REF10\", 2) || '***' || right(\"REF10\", 2) END AS \"REF10\", left(\"REF30\", 2) || '***' || right(\"REF30\", 2) AS \"REF30\" FROM new_item")
def new_payload(spark: SparkSession, d: str) -> DataFrame:
    return load.mask_references(load.new_payload(_new_items(spark, d)))


@query("q69_existing_payload", f"WITH {ENRICHMENT}, {_EXISTING_ITEM} SELECT \"customerId\", \"locationId\", \"customerSchemaType\", \"itemType\", \"departmentId\", \"sourcePath\", \"REF5\", \"REF30\" FROM existing_item")
def existing_payload(spark: SparkSession, d: str) -> DataFrame:
    return load.existing_payload(_existing_items(spark, d), _EXISTING_BATCH)


@query("q10_mapping", "SELECT o_orderkey AS \"ID\", o_orderpriority AS \"REF1\", CAST(NULL AS VARCHAR) AS \"REF2\", CASE WHEN o_orderpriority = '5-LOW' THEN 3 WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS type_code FROM orders")
def mapping(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    kind = F.when(F.col("o_orderpriority") == "5-LOW", "FILE").when(F.col("o_orderpriority") == "1-URGENT", "BOX").otherwise("OTHER")
    typed = o.withColumn("code", load.type_code(kind))
    return load.mapped(typed, [("o_orderkey", "ID"), ("o_orderpriority", "REF1"), ("absent", "REF2"), ("code", "type_code")])


@query("q11_reenter", f"WITH {ENRICHMENT}, fixed AS (SELECT lang AS transaction_id, source AS batch_name, doc_id || '.jpg' AS image_filename, 'v' || doc_id AS corrected FROM documents) SELECT e.image_path, f.corrected FROM enrichment e JOIN fixed f ON e.transaction_id = f.transaction_id AND e.batch_name = f.batch_name AND regexp_extract(e.image_path, '.*/(.*)$', 1) = f.image_filename")
def reenter(spark: SparkSession, d: str) -> DataFrame:
    m = manifest(spark, d).select("transaction_id", "batch_name", "image_filename", F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("corrected"))
    return load.reenter(enrichment(spark, d), m).select("image_path", "corrected")


@query("q12_with_manifest", f"WITH {ENRICHMENT}, {MANIFEST} SELECT e.image_path, e.batch_name, e.data_is_valid, m.ref1, m.session_notes AS work_order FROM enrichment e JOIN manifest m ON e.transaction_id = m.transaction_id AND e.image_path = m.image_path")
def with_manifest(spark: SparkSession, d: str) -> DataFrame:
    joined = load.with_manifest(enrichment(spark, d).drop("doc_id"), manifest(spark, d).drop("doc_id")).withColumnRenamed("session_notes", "work_order")
    return joined.select("image_path", "batch_name", "data_is_valid", "ref1", "work_order")


@query("q13_dimension", "SELECT c_custkey, n_name AS box FROM customer LEFT JOIN (SELECT DISTINCT n_nationkey, n_name FROM nation) ON c_nationkey = n_nationkey")
def dimension(spark: SparkSession, d: str) -> DataFrame:
    boxes = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("box"))
    return load.with_dimension(table(spark, d, "customer"), boxes, "c_nationkey").select("c_custkey", "box")


@query("q14_map_join", f"WITH {MANIFEST} SELECT image_path, project AS \"REF3\", image_filename AS \"REF4\" FROM manifest")
def map_join(spark: SparkSession, d: str) -> DataFrame:
    found = load.template_fields(_template(spark, [("Box", [("project", "REF9")]), ("File", [("project", "REF3"), ("image_filename", "REF4"), ("absent", "REF5"), ("collection", None), ("doc_id", "none")])]), "FILE")
    return load.apply_template(manifest(spark, d), found).select("image_path", "REF3", "REF4")


@query("q15_config_lookup", f"WITH {MANIFEST}, config AS (SELECT * FROM (VALUES ('src0', 'c0', 'true'), ('src1', 'c1', 'bypass')) v(batch_name, account, mode)) SELECT image_path, coalesce(account, 'none') AS account, coalesce(mode, 'none') AS mode FROM manifest LEFT JOIN config ON manifest.batch_name = config.batch_name")
def config_lookup(spark: SparkSession, d: str) -> DataFrame:
    config = spark.createDataFrame([("c0", [("src0", "true", True, [])]), ("c1", [("src1", "bypass", False, []), ("other", "true", False, [])])], model.CONFIG)
    return load.with_configuration(manifest(spark, d), readers.collections(config)).select("image_path", "account", "mode")


@query("q16_counts", f"WITH {ENRICHMENT} SELECT count(*) FILTER (data_is_valid = 'True') AS valid, count(*) FILTER (data_is_valid = 'False') AS invalid, count(*) AS total FROM enrichment")
def counts(spark: SparkSession, d: str) -> DataFrame:
    return rules.counts(enrichment(spark, d).withColumnRenamed("data_is_valid", "validation_passed"))


@query("q17_grouped_concat", "SELECT conv_id, substr(string_agg(text, ' ' ORDER BY turn), 1, 900) AS text, min(turn) AS first_path FROM conversations GROUP BY conv_id")
def grouped_concat(spark: SparkSession, d: str) -> DataFrame:
    return load.grouped_text(table(spark, d, "conversations"), ["conv_id"], "turn", "text")


@query("q18_distinct", f"WITH {MANIFEST} SELECT batch_name, count(DISTINCT box_barcode) AS n_boxes, min(box_barcode) AS box, count(DISTINCT project) AS n_projects FROM manifest GROUP BY batch_name")
def distinct(spark: SparkSession, d: str) -> DataFrame:
    found = batches.distinct_values(manifest(spark, d), ["batch_name"], "box_barcode", "project")
    return found.select("batch_name", F.col("n_box_barcode").alias("n_boxes"), F.col("box_barcode").alias("box"), F.col("n_project").alias("n_projects"))


@query("q19_status", "SELECT user_id, bool_and(event_type = 'error') AS all_failed, bool_or(event_type = 'error') AS any_failed, count(*) FILTER (event_type = 'purchase') AS n_done, count(*) AS n FROM events GROUP BY user_id")
def status(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    return batches.outcomes(table(spark, d, "events"), ["user_id"], kind == "error", kind == "purchase")


@query("q20_union", "SELECT 'name' AS matched_on_field, c_name AS v FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'segment', c_mktsegment FROM customer WHERE c_custkey % 2 = 1")
def union(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    a = c.filter("c_custkey % 2 = 0").select(F.lit("name").alias("matched_on_field"), F.col("c_name").alias("v"))
    b = c.filter("c_custkey % 2 = 1").select(F.col("c_mktsegment").alias("v"), F.lit("segment").alias("matched_on_field"))
    return a.unionByName(b)


@query("q53_distinct_lines", "SELECT conv_id, string_agg(role, ' ' ORDER BY first) AS roles FROM (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY conv_id, role) GROUP BY conv_id")
def distinct_lines(spark: SparkSession, d: str) -> DataFrame:
    return batches.distinct_text(table(spark, d, "conversations"), ["conv_id"], "turn", "role", "roles")


@query("q54_centroids", "SELECT l_orderkey, l_linenumber, round((l_quantity + l_tax + l_discount + l_quantity * 2) / 4, 4) AS x, round((l_tax * 3 + l_discount) / 4, 4) AS y FROM lineitem")
def centroids(spark: SparkSession, d: str) -> DataFrame:
    from folio.sources.adapters import ocr_lines

    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    q, t, s = F.col("l_quantity"), F.col("l_tax"), F.col("l_discount")
    block = F.struct(F.lit("LINE").alias("type"), F.lit("t").alias("text"), F.array(point(q, t), point(t, t), point(s, t), point(q * 2, s)).alias("corners"))
    noise = F.struct(F.lit("WORD").alias("type"), F.lit("w").alias("text"), F.array(point(q, q)).alias("corners"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ocr_lines(F.array(block, noise)).alias("lines"))
    return rows.select("l_orderkey", "l_linenumber", F.col("lines")[0]["center"][0].alias("x"), F.col("lines")[0]["center"][1].alias("y"))


@query("q55_telemetry", f"WITH {ENRICHMENT} SELECT 'src' AS \"Source\", 'p' AS \"PipelineName\", transaction_id AS \"TransactionId\", batch_name AS \"BatchName\", image_path AS \"FilePath\", 'Validate' AS \"PipelineModule\", CASE data_is_valid WHEN 'True' THEN 'Complete' ELSE 'Failed' END AS \"State\", CAST(1 AS BIGINT) AS \"NoOfAsset\", '1704067200000' AS \"Time\" FROM enrichment")
def telemetry(spark: SparkSession, d: str) -> DataFrame:
    from folio.operators.events import telemetry

    state = F.when(F.col("data_is_valid") == "True", "Complete").otherwise("Failed")
    dims = {"Source": F.lit("src"), "PipelineName": F.lit("p"), "TransactionId": F.col("transaction_id"), "BatchName": F.col("batch_name"), "FilePath": F.col("image_path")}
    return telemetry(enrichment(spark, d), "Validate", state, F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit(1), **dims)


@query("q56_review_messages", f"WITH {ENRICHMENT} SELECT batch_name AS \"BatchId\", count(*) AS n_items FROM enrichment WHERE data_is_valid <> 'True' GROUP BY batch_name")
def review_messages(spark: SparkSession, d: str) -> DataFrame:
    from folio.operators.events import review_messages

    failed = F.col("data_is_valid") == "True"
    items = enrichment(spark, d).filter("data_is_valid <> 'True'").select(F.col("batch_name").alias("BatchId"), F.col("image_path").alias("Id"), *(c.alias(n) for n, c in rules.review_status(failed).items()))
    return review_messages(items).groupBy("BatchId").agg(F.sum("n_items").alias("n_items"))


@query("q59_filters", "SELECT url, CASE WHEN regexp_matches(lower(url), '\\.(tif|jpeg|jpg|png|tiff)$') THEN 1 ELSE 0 END AS image FROM pages WHERE url IS NOT NULL AND length(url) >= 3 AND page_id / 10.0 >= 2.5")
def filters(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").filter(F.col("url").isNotNull() & (F.length("url") >= 3) & (F.col("page_id") / 10.0 >= 2.5))
    return p.select("url", F.when(text.is_image(F.col("url")), 1).otherwise(0).alias("image"))


def _template(spark: SparkSession, entities: list) -> DataFrame:
    return spark.createDataFrame([(entities,)], "entities array<struct<entity:string, fields:array<struct<name:string, ref:string>>>>")


@query("q60_existing_item", f"WITH {ENRICHMENT}, {_EXISTING_ITEM}, m AS (SELECT * FROM (VALUES ('en', 'REF1'), ('fr', 'REF2')) v(transaction_id, ref)) SELECT e.* EXCLUDE (transaction_id), m.ref FROM existing_item e JOIN m ON e.transaction_id = m.transaction_id")
def existing_item(spark: SparkSession, d: str) -> DataFrame:
    template = _template(spark, [("Box", [("x", "REF9")]), ("File", [("en", "REF1"), ("fr", "REF2"), ("de", None)])])
    found = load.template_fields(template, "FILE").filter(F.col("ref").isNotNull())
    # few names and as few languages: a shuffle by them would put all texts of a language in one task
    few = staging.checked_broadcast(found, F.octet_length("name") + F.octet_length("ref"))
    return _existing_items(spark, d).join(few, F.col("transaction_id") == F.col("name")).select(*_EXISTING_COLUMNS, "ref")


@query("q61_any_first_labels", "SELECT o_custkey, bool_or(o_orderstatus = 'F') AS any_f, min(o_orderkey) AS first_key, concat_ws(', ', CASE WHEN count(*) FILTER (o_orderstatus = 'O') = 0 THEN 'O' END, CASE WHEN count(*) FILTER (o_orderstatus = 'P') = 0 THEN 'P' END) AS missing FROM orders GROUP BY o_custkey")
def any_first_labels(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("o_orderstatus")
    none = lambda x: F.when(F.count_if(s == x) == 0, x)
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.bool_or(s == "F").alias("any_f"), F.min("o_orderkey").alias("first_key"), F.concat_ws(", ", none("O"), none("P")).alias("missing"))


@query("q62_sorted_first", f"WITH {MANIFEST} SELECT image_path, doc_id FROM manifest ORDER BY image_path, doc_id LIMIT 50")
def sorted_first(spark: SparkSession, d: str) -> DataFrame:
    return batches.in_path_order(manifest(spark, d).select("image_path", "doc_id"), "doc_id").limit(50)


@query("q85_sorted_names", f"WITH {MANIFEST} SELECT image_filename, doc_id FROM manifest ORDER BY image_filename, doc_id LIMIT 50")
def sorted_names(spark: SparkSession, d: str) -> DataFrame:
    return batches.in_path_order(manifest(spark, d), "doc_id", by_name=True).select("image_filename", "doc_id").limit(50)


@query("q86_first_row", "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_row(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    return batches.first_row(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("q67_routes", "WITH r AS (SELECT page_id, page_id % 3 AS k, page_id % 2 = 0 AS conf, page_id % 5 = 0 AS skip FROM pages), e AS (SELECT *, CASE WHEN k = 0 OR (k = 1 AND conf) THEN 'run' WHEN k = 1 THEN 'skip' ELSE 'error' END AS extract FROM r) SELECT page_id, CASE k WHEN 0 THEN 'csv' WHEN 1 THEN 'per_image' ELSE 'error' END AS connect, extract, CASE WHEN skip THEN 'skip' ELSE extract END AS validate, CASE WHEN k = 0 AND conf THEN 'new_items' WHEN k = 1 AND conf THEN 'existing_items' ELSE 'partial_update' END AS load FROM e")
def routes(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    key = F.when(F.col("page_id") % 3 == 0, "indexed/a.zip").when(F.col("page_id") % 3 == 1, "image-extract/a.zip").otherwise("else/a.zip")
    made = load.route(key, F.col("page_id") % 2 == 0, F.col("page_id") % 5 == 0)
    return p.select("page_id", *(made[k].alias(k) for k in ("connect", "extract", "validate", "load")))