"""Telemetry events and review messages as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.sources import staging

_PARTS = staging.hidden("parts")

STATES = ("Ready", "Complete", "Failed", "NoOp")
REQUIRED = ("Source", "PipelineName", "TransactionId", "BatchName")


def telemetry(rows: DataFrame, module: str, state: Column, at: Column, n_assets: Column, **dimensions: Column) -> DataFrame:
    """One flat event for each row; a missing required dimension fails when the plan is made."""
    missing = [d for d in REQUIRED if d not in dimensions]
    if missing:
        raise ValueError(f"dimensions missing: {', '.join(missing)}")
    measures = {"PipelineModule": F.lit(module), "State": state, "NoOfAsset": n_assets.cast("long"), "Time": F.unix_millis(at).cast("string")}
    return rows.select(*(c.alias(n) for n, c in {**dimensions, **measures}.items()))


def as_records(events: DataFrame) -> DataFrame:
    """Events as the nested JSON records of a time-series store."""
    measures = ("PipelineModule", "State", "NoOfAsset")
    names = [c for c in events.columns if c not in measures and c != "Time"]
    dims = F.filter(F.array(*(F.struct(F.lit(n).alias("Name"), F.col(n).cast("string").alias("Value"), F.lit("VARCHAR").alias("DimensionValueType")) for n in names)), lambda d: d["Value"].isNotNull())
    values = F.array(*(F.struct(F.lit(m).alias("Name"), F.col(m).cast("string").alias("Value"), F.lit("BIGINT" if m == "NoOfAsset" else "VARCHAR").alias("Type")) for m in measures))
    record = F.struct(dims.alias("Dimensions"), F.lit("IMAGE").alias("MeasureName"), values.alias("MeasureValues"), F.lit("MULTI").alias("MeasureValueType"), F.col("Time"), F.lit("MILLISECONDS").alias("TimeUnit"))
    return events.select(F.to_json(record).alias("record"))


def review_messages(items: DataFrame, batch: str = "BatchId") -> DataFrame:
    """One message for each batch and part of about a thousand items; columns beside the batch are an item's.

    Parts keep a batch of any size from gathering in one task.
    """
    columns = [c for c in items.columns if c != batch]
    sizes = items.groupBy(batch).agg(F.ceil(F.count("*") / 1000).alias(_PARTS))
    dealt = items.join(sizes, batch).withColumn("part", F.pmod(F.xxhash64(*columns[:1]), F.col(_PARTS)))
    got = dealt.groupBy(batch, "part").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("Items"))
    return got.select(batch, "part", F.size("Items").cast("long").alias("n_items"), F.to_json(F.struct(F.col(batch), F.col("Items"))).alias("message"))
