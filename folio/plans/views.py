"""The test tables, and batch tables made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".jpg"))
    return d.select(
        F.concat(F.lit("root/"), "source", F.lit("/"), name).alias("image_path"),
        F.col("source").alias("batch_name"),
        F.col("lang").alias("transaction_id"),
        name.alias("image_filename"),
        F.lit("collection-a").alias("collection"),
        F.concat(F.lit("project-"), "lang").alias("project"),
        F.concat(F.lit("BOX-"), "source").alias("box_barcode"),
        F.when(F.col("doc_id") % 3 == 0, "null").otherwise(F.concat(F.lit("R"), F.col("doc_id").cast("string"))).alias("ref1"),
        F.concat(F.lit("notes "), F.col("doc_id").cast("string")).alias("session_notes"),
        "doc_id",
    )


def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = d.join(labels, "doc_id", "left")
    return joined.select(
        F.concat(F.lit("root/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("image_path"),
        F.col("source").alias("batch_name"),
        F.col("lang").alias("transaction_id"),
        F.col("text").alias("ocr_liquid_text"),
        F.when(F.col("quality") == 1, "True").when(F.col("quality") == 0, "False").otherwise("Could Not be Processed").alias("data_is_valid"),
        "doc_id",
        "n_chars",
    )


MANIFEST = """manifest AS (
  SELECT 'root/' || source || '/' || doc_id || '.jpg' AS image_path, source AS batch_name, lang AS transaction_id,
         doc_id || '.jpg' AS image_filename, 'collection-a' AS collection, 'project-' || lang AS project,
         'BOX-' || source AS box_barcode, CASE WHEN doc_id % 3 = 0 THEN 'null' ELSE 'R' || doc_id END AS ref1,
         'notes ' || doc_id AS session_notes, doc_id
  FROM documents)"""
ENRICHMENT = """enrichment AS (
  SELECT 'root/' || source || '/' || d.doc_id || '.jpg' AS image_path, source AS batch_name, lang AS transaction_id,
         text AS ocr_liquid_text, d.doc_id, n_chars,
         CASE WHEN quality = 1 THEN 'True' WHEN quality = 0 THEN 'False' ELSE 'Could Not be Processed' END AS data_is_valid
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
