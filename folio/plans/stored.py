"""What is written and read back: files, tables that grow, a stored index, configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio import model
from folio.functions import text
from folio.operators import load, matching, search
from folio.plans.linkage import listed_keys
from folio.plans.registry import query
from folio.plans.views import ENRICHMENT, MANIFEST, enrichment, manifest, table
from folio.sources import adapters, readers, sinks
from folio.sources.staging import new_folder as folder


@query("q74_csv", "SELECT p_partkey, p_name || '; \"' || p_brand || '\"' AS p_name, p_retailprice FROM part")
def csv(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark)
    rows = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit('; "'), "p_brand", F.lit('"')).alias("p_name"), "p_retailprice")
    sinks.csv(rows, path, sep=";")
    return readers.typed_csv(spark, path, rows.schema, sep=";")


@query("q75_manifest", f"WITH {MANIFEST} SELECT image_path, 'a|b ' || batch_name AS box_name, CASE WHEN ref1 = 'null' THEN NULL ELSE ref1 END AS ref_1 FROM manifest")
def pipe_manifest(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark)
    rows = manifest(spark, d).select(F.col("image_path").alias("Image Path"), F.concat(F.lit("a|b "), "batch_name").alias("BoxName"), F.col("ref1").alias("Ref-1"))
    rows.write.option("header", "true").option("sep", "|").option("quoteAll", "true").csv(path)
    return readers.manifest(spark, path)


_TARGET = ["batch_name", "image_path", "note", "data_is_valid"]


@query(
    "q76_append_overwrite",
    f"WITH {ENRICHMENT}, twice AS (SELECT batch_name, image_path, 'null' AS note, data_is_valid FROM enrichment UNION ALL SELECT batch_name, image_path, 'null', 'True' FROM enrichment WHERE data_is_valid = 'True') "
    "SELECT batch_name, image_path, CASE WHEN batch_name = 'src1' THEN 'replaced' ELSE note END AS note, data_is_valid FROM twice",
)
def append_overwrite(spark: SparkSession, d: str) -> DataFrame:
    path, rows = folder(spark), enrichment(spark, d)
    sinks.append(rows, path, _TARGET)
    sinks.append(rows.filter("data_is_valid = 'True'"), path, _TARGET)
    # a change of one batch, worked out of the table that it replaces a part of
    read = lambda: spark.read.schema(", ".join(f"{c} string" for c in _TARGET)).parquet(path)
    sinks.overwrite_read(spark, read().filter("batch_name = 'src1'").withColumn("note", F.lit("replaced")), path)
    return read()


@query("q77_configuration", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'acc0' WHEN 1 THEN 'acc1' ELSE 'none' END AS account, CASE s_suppkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'bypass' ELSE 'none' END AS mode, 9 AS min_length FROM supplier")
def configuration(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark)
    rule = ("name", "Name", "string", "UPPER", None, [], ("9", None, None, None, None, None, None, None))
    rows = [(f"acc{i}", [(f"c{i}", mode, True, [rule])]) for i, mode in enumerate(("true", "bypass"))]
    spark.createDataFrame(rows, model.CONFIG).write.json(path)
    config = readers.configuration(spark, path)
    (found,) = readers.field_rules(readers.collection(config, "c0"))
    s = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("c"), (F.col("s_suppkey") % 3).cast("string")).alias("batch_name"))
    return load.with_configuration(s, config).select("s_suppkey", "account", "mode", F.lit(int(found.min_length)).alias("min_length"))


@query(
    "q78_index_delta",
    "WITH d AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 10 = 0 THEN 'new ' || p_type WHEN p_partkey % 10 <> 1 THEN p_name || ' ' || p_brand ELSE '' END AS document FROM part) "
    "SELECT token, id, count(*) AS tf FROM (SELECT id, unnest(string_split(lower(document), ' ')) AS token FROM d) WHERE token <> '' GROUP BY token, id",
)
def index_delta(spark: SparkSession, d: str) -> DataFrame:
    path, p, n = folder(spark), table(spark, d, "part"), F.col("p_partkey")
    search.store_index(p.select(n.alias("id"), F.concat_ws(" ", "p_name", "p_brand").alias("document")), path)
    changed = p.filter(n % 10 < 2).select(n.alias("id"), F.when(n % 10 == 0, F.concat(F.lit("new "), "p_type")).alias("document"))
    search.store_index(changed, path, delta=True)
    return search.open_index(spark, path)


@query("q79_lsh_equal", r"WITH k AS (SELECT item_id AS id, lower(trim(regexp_replace(regexp_replace(text, '[^A-Za-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))) AS key FROM benchmark) SELECT l.id AS l_id, r.id AS r_id, CAST(0 AS DOUBLE) AS distance FROM k l JOIN k r ON l.key = r.key WHERE length(l.key) >= 3")
def lsh_equal(spark: SparkSession, d: str) -> DataFrame:
    """Equal keys share every MinHash, so LSH is exact for them."""
    keys = listed_keys(spark, d)
    return matching.lsh_pairs(keys, keys).filter("l_key = r_key").select("l_id", "r_id", "distance")


@query(
    "q80_batch_branches",
    f"WITH {ENRICHMENT} SELECT 'valid' AS branch, image_path FROM enrichment WHERE data_is_valid = 'True' UNION ALL SELECT 'bypass', image_path FROM enrichment "
    "UNION ALL SELECT 'retrigger', image_path FROM enrichment WHERE doc_id % 2 = 0 AND batch_name IS NOT NULL AND transaction_id IS NOT NULL",
)
def batch_branches(spark: SparkSession, d: str) -> DataFrame:
    rows = enrichment(spark, d)
    corrected = manifest(spark, d).filter("doc_id % 2 = 0").select("transaction_id", "batch_name", "image_filename", F.lit("v").alias("corrected"))
    ways = {"valid": (None, False, False), "bypass": (None, False, True), "retrigger": (corrected, True, False)}
    made = [load.load_rows(rows, *way).select(F.lit(name).alias("branch"), "image_path") for name, way in ways.items()]
    return made[0].unionAll(made[1]).unionAll(made[2])


@query("q81_inline", "SELECT v.r_regionkey, r_name, v.zone FROM region JOIN (VALUES ('0', 'a'), ('1', 'b'), ('9', 'c')) v(r_regionkey, zone) ON CAST(region.r_regionkey AS VARCHAR) = v.r_regionkey")
def inline(spark: SparkSession, d: str) -> DataFrame:
    zones = readers.inline(spark, [("0", "a"), ("1", "b"), ("9", "c")], model.strings("r_regionkey", "zone"))
    return readers.all_strings(table(spark, d, "region").select("r_regionkey", "r_name")).join(zones, "r_regionkey")


@query(
    "q82_image_names",
    "SELECT 'x/acc_code_' || page_id || '.TIF' AS image_path, 'acc' AS account_id, 'code' AS item_code, page_id || '.TIF' AS item_code_id, 'acc_code_' || page_id || '.TIF' AS image_filename, 'coll' AS collection, 'proj' AS project, '_coll_proj_R1' AS batch_name, 't1' AS transaction_id FROM pages WHERE page_id % 3 <> 0",
)
def image_names(spark: SparkSession, d: str) -> DataFrame:
    ending = F.when(F.col("page_id") % 3 == 0, ".pdf").otherwise(".TIF")
    paths = table(spark, d, "pages").select(F.concat(F.lit("x/acc_code_"), F.col("page_id").cast("string"), ending).alias("path"))
    made = readers.image_manifest(paths, "_coll_proj_R1", "t1")
    return made.select("image_path", "account_id", "item_code", "item_code_id", "image_filename", "collection", "project", "batch_name", "transaction_id")


@query("q83_parquet", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def parquet(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark)
    for rows in (table(spark, d, "nation").select("n_name"), table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")):
        sinks.parquet(rows, path)  # the second replaces the first
    return readers.table(spark, path)


@query("q84_proper_case", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS name FROM part")
def proper_case(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.force_case(F.col("p_name"), "PROPER").alias("name"))


_LINES = "CASE WHEN c_custkey % 7 = 0 THEN 'Could Not be Processed' ELSE {} END"
_TEXT = _LINES.format("c_custkey || '.png same ' || c_custkey || '_rot90.png ' || c_custkey || '_rot180.png ' || c_custkey || '_rot270.png'")
_SPOT = """'["' || c_custkey || '{}.png", [2.5, 0.25]], ["same", [2.5, 0.25]]'"""
_SPOTS = _LINES.format("'[' || " + " || ', ' || ".join(_SPOT.format(t) for t in ("", "_rot90", "_rot180", "_rot270")) + " || ']'")


@query("q87_read_images", f"SELECT c_custkey, {_TEXT} AS ocr_liquid_text, {_SPOTS} AS ocr_spatial_info FROM customer")
def read_images(spark: SparkSession, d: str) -> DataFrame:
    def service(paths: list[str]) -> list[str]:
        import json

        out, corners = [], [{"x": x, "y": y} for x, y in ((1, 0), (4, 0), (4, 0.5), (1, 0.5))]
        for path in paths:
            name = path.rsplit("/", 1)[-1]
            if int(name.split(".")[0].split("_")[0]) % 7 == 0:
                raise RuntimeError("unreadable")
            words = [{"type": "WORD", "text": "word", "corners": corners}]
            out.append(json.dumps(words + [{"type": "LINE", "text": t, "corners": corners} for t in (name, "same")]))
        return out

    images = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("root/"), F.col("c_custkey").cast("string"), F.lit(".png")).alias("image_path"))
    return adapters.read_images(images, service, rotated=True).drop("image_path")


_IMAGE_ROW = [f"c{i:02}" for i in range(15)]


@query(
    "q88_image_rows",
    "SELECT '' AS c00, 'x/acc_code_' || page_id || '.TIF' AS c01, 'acc_code_' || page_id || '.TIF' AS c02, 't1' AS c03, 'proj' AS c04, 'coll' AS c05, '' AS c06, '3/9/24 08:05' AS c07, '' AS c08, '' AS c09, '' AS c10, 'code' AS c11, page_id || '.TIF' AS c12, 'acc' AS c13, '_coll_proj_R1' AS c14 FROM pages",
)
def image_rows(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "pages").select(F.concat(F.lit("x/acc_code_"), F.col("page_id").cast("string"), F.lit(".TIF")).alias("path"))
    return readers.image_rows(paths, "_coll_proj_R1", "t1", _IMAGE_ROW, F.lit("2024-03-09 08:05:00").cast("timestamp"))
