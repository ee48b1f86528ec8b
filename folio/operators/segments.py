"""A stored index of segments: a base, dated deltas with tombstones, and compaction.

Folders of ``path``: ``postings`` and ``gone`` with a folder for each version, and ``log`` with a
row for each version that is complete.  A version counts only once its row is in the log,
which is written last, so a write that fails or is run again leaves no half of a version to be read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import search
from folio.sources import staging

#: Deltas on top of a base before they are compacted.
DELTAS = 20
_LOG = "version int, dated string, base boolean"


@dataclass(frozen=True)
class Log:
    """What is complete: the newest date, the last version, the base and the deltas on top of it."""

    newest: str
    last: int
    base: int
    deltas: tuple[int, ...]


def read_log(spark: SparkSession, path: str) -> Log:
    """A row for each version: a few, as deltas come by the day."""
    rows = sorted(tuple(r) for r in spark.read.schema(_LOG).parquet(f"{path}/log").collect())
    base = max(v for v, _, is_base in rows if is_base)
    return Log(max(d for _, d, _ in rows), rows[-1][0], base, tuple(v for v, _, _ in rows if v > base))


def _complete(spark: SparkSession, path: str, version: int, dated: str, base: bool, mode: str = "append") -> None:
    spark.createDataFrame([(version, dated, base)], _LOG).coalesce(1).write.mode(mode).parquet(f"{path}/log")


def _write(postings: DataFrame, path: str, version: int) -> None:
    """Postings by ranges of tokens, sorted, so that a token is in few files and row groups."""
    postings.select("token", "id", "tf").repartitionByRange("token", "id").sortWithinPartitions("token", "id").write.mode("overwrite").parquet(f"{path}/postings/version={version}")


def create(master: DataFrame, path: str, dated: str) -> None:
    """The first base of ``id, document``, as of a date (``yyyy-mm-dd``); replaces an index that was there."""
    spark = master.sparkSession
    staging.remove(spark, path)
    _write(search.index(master), path, 0)
    _complete(spark, path, 0, dated, True)


def apply_delta(master: DataFrame, path: str, dated: str, removed: DataFrame | None = None) -> bool:
    """Documents of a later date replace older ones whole, and the ids of ``removed`` go; False if it is not newer.

    A delta dated no later than the newest one has been applied, and is ignored.  After
    ``DELTAS`` of them all are compacted.
    """
    spark = master.sparkSession
    log = read_log(spark, path)
    if dated <= log.newest:
        return False
    version = log.last + 1
    gone = master.select("id") if removed is None else master.select("id").unionAll(removed.select("id"))
    _write(search.index(master), path, version)
    gone.distinct().write.mode("overwrite").parquet(f"{path}/gone/version={version}")
    _complete(spark, path, version, dated, False)
    if len(log.deltas) + 1 >= DELTAS:
        compact(spark, path)
    return True


def postings(spark: SparkSession, path: str) -> DataFrame:
    """``token, id, tf`` of the last version of every document; a base alone is read as it is."""
    log = read_log(spark, path)
    of = lambda folder, v: spark.read.parquet(f"{path}/{folder}/version={v}").withColumn("version", F.lit(v))
    base = of("postings", log.base)
    if not log.deltas:
        return base.drop("version")
    every, gone = base, None
    for v in log.deltas:
        every = every.unionByName(of("postings", v))
        gone = of("gone", v) if gone is None else gone.unionByName(of("gone", v))
    # a posting lives if its document is not gone in a later version
    last = gone.groupBy("id").agg(F.max("version").alias("last"))
    alive = every.join(staging.checked_broadcast(last), "id", "left").filter(F.col("last").isNull() | (F.col("version") >= F.col("last")))
    return alive.select("token", "id", "tf")


def compact(spark: SparkSession, path: str) -> None:
    """A new base of all that lives; what it replaces goes once it is complete."""
    log = read_log(spark, path)
    if not log.deltas:
        return
    version = log.last + 1
    _write(postings(spark, path), path, version)
    _complete(spark, path, version, log.newest, True)
    for v in (log.base, *log.deltas):
        staging.remove(spark, f"{path}/postings/version={v}")
        staging.remove(spark, f"{path}/gone/version={v}")
