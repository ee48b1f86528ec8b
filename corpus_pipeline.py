"""A corpus cleaned in stages, each written as Parquet and read by the next.

Nulls, empty and very long texts, repeated rows, empty tables and further columns are
what the operators say of them; the columns of documents pass through all stages, the
last gives ``n_tokens`` and ``token_ids`` in the place of the text.  Each stage but the
last written is removed once the next one is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import bpe, decontaminate, line_dedup, near_dup, shared, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents scored as toxic go.  Learns from the labels of the documents given."""
    model = toxicity.train_for(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mark = shared.hidden("score")
    scored = toxicity.score(docs, model, *docs.columns, name=mark)
    return scored.filter(F.col(mark) < toxicity.THRESHOLD).drop(mark)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines that many documents share stay in one of them."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near-duplicates stays."""
    return near_dup.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a window of a benchmark text go."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token ids of what is left, beside the columns of documents but the text."""
    kept = [c for c in docs.columns if c != "text"]
    # executors still hold what earlier stages needed, so the workers get less
    return bpe.encode(docs, *bpe.default_vocabulary(), *kept, cache=bpe.SMALL_CACHE)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dup", near_dup_stage),
    ("decontaminate", decontaminate_stage),
    ("bpe", bpe_stage),
]

#: The first stage is learned and the third hashes; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; intermediate tables go to the shared folder."""
    folder = f"{shared.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        with shared.scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if before:
            shared.remove(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return docs
