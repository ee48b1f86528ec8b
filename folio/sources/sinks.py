"""Writes: aligned appends, overwrites of a table that was read, files, events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from folio.operators import align


def append(df: DataFrame, path: str, target: list[str], partition_by: str = "batch_name") -> None:
    """Appends the rows aligned to the target's columns; the number of files is the plan's, not one."""
    align.to_target(df, target).write.mode("append").partitionBy(partition_by).parquet(path)


def overwrite_read(spark: SparkSession, df: DataFrame, path: str, partition_by: str = "batch_name") -> None:
    """Replaces the partitions of ``df`` in the table it may have been read from.

    The rows are staged beside the table first, on the same storage, so reading is
    done before anything is replaced; other partitions stay.
    """
    stage = f"{path.rstrip('/')}__stage_{uuid.uuid4().hex}"
    df.write.parquet(stage)
    staged = spark.read.schema(df.schema).parquet(stage)
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(stage)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)


def put_properties(df: DataFrame, path: str, *columns: str) -> dict[str, str]:
    """Writes the one value that each column has in a batch as a JSON row for later stages, and returns them."""
    found = {c: align.single_value(df, c) for c in columns}
    df.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"`{c}` string" for c in found)).write.mode("overwrite").json(path)
    return found


def properties(spark: SparkSession, path: str, *columns: str) -> dict[str, str]:
    """What ``put_properties`` wrote."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).json(path).first().asDict()


def preview(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)


def append_events(events: DataFrame, path: str) -> None:
    """Appends telemetry; the folder can be read as a stream."""
    events.write.mode("append").parquet(path)
