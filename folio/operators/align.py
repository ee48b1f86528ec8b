"""Columns: alignment to a target, renames, drops, fills, overrides."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import text


def to_target(df: DataFrame, target: list[str], missing: str = "null") -> DataFrame:
    """The target's columns in its order: absent ones filled with the marker, others left out."""
    have = set(df.columns)
    return df.select(*(F.col(c) if c in have else F.lit(missing).alias(c) for c in target))


def column_changes(have: list[str], target: list[str]) -> tuple[list[str], list[str]]:
    """Columns to add and columns to leave out, in order."""
    return [c for c in target if c not in have], [c for c in have if c not in target]


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(text.snake_case, df.columns))


def ingest(df: DataFrame, batch_name: str, transaction_id: str, prefix: str) -> DataFrame:
    """Fills blanks with the marker, adds the batch's constants, rebuilds paths, blanks the item ids."""
    path = F.concat(F.lit(prefix), F.replace(F.col("image_path"), F.lit("\\"), F.lit("/")))
    constants = {"transaction_id": transaction_id, "batch_name": batch_name, "account_id": "", "item_code": "", "item_code_id": ""}
    return df.na.fill("null").withColumns({"image_path": path, **{k: F.lit(v) for k, v in constants.items()}})


def override(df: DataFrame, column: str, value: str | None) -> DataFrame:
    return df if value is None else df.withColumn(column, F.lit(value))


def override_batches(df: DataFrame, column: str, given: dict[str, str], batch: str = "batch_name") -> DataFrame:
    """The same for the batches that job parameters give a value; the others keep theirs."""
    if not given:
        return df
    values = F.create_map(*(F.lit(x) for pair in given.items() for x in pair))
    return df.withColumn(column, F.coalesce(F.try_element_at(values, F.col(batch)), F.col(column)))


def reference_id(ref: Column, *parts: Column) -> Column:
    """The reference, or where it is the marker a UUID of the parts joined by ``_``."""
    key = parts[0]
    for p in parts[1:]:
        key = F.concat(key, F.lit("_"), p)
    return F.when(ref == "null", text.md5_uuid(key)).otherwise(ref)


def rename(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in labels.items() if k in df.columns})


def drop_matching(df: DataFrame, pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Without the columns whose names match from their start, but for those to keep."""
    return df.drop(*(c for c in df.columns if re.match(pattern, c) and c not in keep))


def single_value(df: DataFrame, column: str) -> str:
    """The one value of a column; ValueError unless there is exactly one."""
    n, value = df.agg(F.count_distinct(column), F.min(column)).first()
    if n != 1:
        raise ValueError(f"{column} has {n} values")
    return value
