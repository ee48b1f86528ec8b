"""Facts about the rows of a batch: distinct values, outcomes, first rows, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import text


def distinct_values(rows: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """``keys``, and ``n_<column>`` and ``<column>``, the number of its distinct values and the smallest, of each group."""
    return rows.groupBy(*keys).agg(*(a for c in columns for a in (F.count_distinct(c).alias(f"n_{c}"), F.min(c).alias(c))))


def outcomes(rows: DataFrame, keys: list[str], failed: Column, done: Column) -> DataFrame:
    """``all_failed, any_failed, n_done, n`` of each group; rows whose condition is null count in ``n`` only."""
    return rows.groupBy(*keys).agg(F.bool_and(failed).alias("all_failed"), F.bool_or(failed).alias("any_failed"), F.count_if(done).alias("n_done"), F.count("*").alias("n"))


def distinct_text(rows: DataFrame, keys: list[str], order: str, value: str, name: str = "text") -> DataFrame:
    """Distinct values of each group, joined in the order of their first occurrence (ties by value).

    Repeats go before values are gathered, so a task holds no more than the text that comes
    out.  Nulls are left out; a group with nothing else has the empty text.
    """
    once = rows.groupBy(*keys, value).agg(F.min(order).alias("_first"))
    values = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct("_first", value))))
    return once.groupBy(*keys).agg(F.array_join(F.transform(values, lambda x: x[value]), " ").alias(name))


def first_row(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each group in ``order``, all columns; of several equal in it any one."""
    others = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(first).select(*keys, "_row.*")


def in_path_order(rows: DataFrame, *ties: str, path: str = "image_path", by_name: bool = False) -> DataFrame:
    """Rows sorted by path, or by the file name in it, and by ``ties``."""
    return rows.orderBy(text.file_name(F.col(path)) if by_name else path, *ties)
