"""Intermediate tables in the folder that all executors share, and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast up to this many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20


def hidden(name: str) -> str:
    """A column name that tables do not have, for columns that go again."""
    return f"__folio_{name}"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only on a local master whose session names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = getattr(spark, "_folio_staging", None) or tempfile.mkdtemp(prefix="folio-")
        spark._folio_staging = shared
    return shared.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, *partitions: str) -> DataFrame:
    """The rows written as Parquet (a folder for each value of ``partitions``) and read back."""
    path = new_folder(df.sparkSession)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Arrow batches of at most so many rows and bytes: settings of the session, only ever made smaller.

    A batch is held on both sides of the pipe to Python, so long texts would else fill an executor.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        number, unit = re.match(r"(-?\d+)([kmg]?)", spark.conf.get(f"spark.sql.execution.arrow.{name}").lower()).groups()
        if not 0 < int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def checked_broadcast(df: DataFrame, size: Column | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has few enough rows and bytes (``size`` of each, if they vary), else as it is."""
    n, total = df.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.sum(F.lit(0) if size is None else size)).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (total or 0) <= BROADCAST_BYTES else df
