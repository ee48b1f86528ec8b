"""Small helpers of the operators: cutting lineage, size-checked broadcasts, id hashes."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast up to this many rows of at most a few hundred bytes.
BROADCAST_ROWS = 100_000
#: Bytes of a broadcast side whose rows have no fixed size.
BROADCAST_BYTES = 16 << 20
#: Rows and bytes of an Arrow batch on its way to Python; a longer row is a batch of its own.
ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20


def hidden(name: str) -> str:
    """A column name that tables do not have, for columns that go again."""
    return f"__folio_{name}"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only on a local master whose session names none.

    On a cluster a folder of one machine would lose rows without an error, so there a
    session without ``spark.checkpoint.dir`` raises ValueError.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = getattr(spark, "_folio_folder", None) or tempfile.mkdtemp(prefix="folio-")
        spark._folio_folder = folder
    return folder.rstrip("/")


_SCRATCH: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialised inside go at the end, so results must be written before it."""
    made: list[str] = []
    _SCRATCH.append(made)
    try:
        yield
    finally:
        _SCRATCH.remove(made)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back: cuts lineage, survives lost executors.

    The table stays until the ``scratch`` around it ends, or else for whoever cleans the folder.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/folio-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with batches of at most ``ARROW_ROWS`` rows and about ``ARROW_BYTES``.

    A batch is held on both sides of the pipe, so long documents would else fill an
    executor.  Both limits are settings of the session, as Spark has no others; they are
    only ever made smaller, and change no result.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        number, unit = re.match(r"(-?\d+)([kmg]?)", conf.get(f"spark.sql.execution.arrow.{name}").lower()).groups()
        if not 0 < int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] <= most:
            conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    return df.mapInArrow(run, schema)


def checked_broadcast(df: DataFrame, bound: int = BROADCAST_ROWS, size: Column | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``bound`` rows, else as it is.

    ``size`` is the bytes of a row where these have no fixed size; their sum must be at
    most ``BROADCAST_BYTES`` too.  Reads at most ``bound + 1`` rows, so give a
    materialised or cheap frame.
    """
    n, total = df.limit(bound + 1).agg(F.count("*"), F.sum(F.lit(0) if size is None else size)).first()
    return F.broadcast(df) if n <= bound and (total or 0) <= BROADCAST_BYTES else df


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, also where ``body`` uses it in further lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


@contextlib.contextmanager
def one_blas_thread() -> Iterator[None]:
    """Small matrix products one after the other: waiting for threads costs them ten times their work.

    Does nothing where numpy's own OpenBLAS is not found.
    """
    folder = Path(np.__file__).resolve().parent.parent / "numpy.libs"
    found = next(iter(folder.glob("*openblas*")), None) if folder.is_dir() else None
    calls = None
    if found:
        library = ctypes.CDLL(str(found))
        for name in ("scipy_openblas_{}_num_threads64_", "openblas_{}_num_threads64_", "openblas_{}_num_threads"):
            if hasattr(library, name.format("set")):
                calls = getattr(library, name.format("get")), getattr(library, name.format("set"))
                break
    before = calls[0]() if calls else 0
    if calls:
        calls[1](1)
    try:
        yield
    finally:
        if calls:
            calls[1](before)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else; pure ASCII takes the faster built-in."""
    upper = "".join(map(chr, range(65, 91)))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def sample_texts(rows: DataFrame, most: dict, most_bytes: int, label: str | None = None, key: str = "doc_id") -> pa.Table:
    """Whole rows ``key, label, text`` in the order of the key: about ``most[label]`` of each label, ``most_bytes`` at most.

    Rows are picked by the hash of their key and text, the same whatever the partitions
    are; a label with fewer rows is kept whole, and rows that are alike are one.
    ``most[None]`` holds for labels without an entry.  Texts are taken in the order of
    their draw, and one that does not fit into what is left of ``most_bytes`` is left out
    alone; so a text above the bound, however early it is drawn, costs no other its place.
    """
    mark = F.lit("") if label is None else F.col(label).cast("string")
    named = rows.select(F.col(key).alias("key"), mark.alias("label"), F.col("text").cast("string").alias("text")).filter(F.octet_length("text") > 0)
    counts = {r[0]: r[1] for r in named.groupBy("label").count().collect()}
    # 0 to 1 where a row is within the share of its label
    place, draw = F.lit(1.0), F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    for value, n in counts.items():
        share = most.get(value, most.get(None, 0)) / n
        place = F.when(F.col("label").eqNullSafe(F.lit(value)), draw if share >= 1 else draw / F.lit(max(share, 1e-12))).otherwise(place)
    drawn = named.withColumns({"place": place, "version": F.xxhash64("text"), "bytes": F.octet_length("text").cast("long")}).filter("place < 1")
    picked = materialise(drawn.dropDuplicates(["key", "label", "version"]))
    order = ["place", "key", "version"]
    if (picked.agg(F.sum("bytes")).first()[0] or 0) > most_bytes:
        # as many rows as the shares allow, about; of these only sizes come to the driver
        sizes = picked.filter(F.col("bytes") <= most_bytes).select("bytes", *order, "label").toArrow().sort_by([(c, "ascending") for c in order])
        left, fits = most_bytes, []
        for size in sizes["bytes"].to_pylist():
            fits.append(size <= left)
            left -= size if fits[-1] else 0
        kept = picked.sparkSession.createDataFrame(sizes.filter(pa.array(fits, pa.bool_())).drop_columns(["bytes", "place"]))
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("key", "version", "label")]
        picked = picked.alias("a").join(F.broadcast(kept.alias("b")), same, "left_semi")
    return picked.select("key", "label", "text").toArrow().sort_by([("key", "ascending"), ("text", "ascending")])


def chunk_of(column: pa.ChunkedArray) -> pa.Array:
    """All of a text column as one array."""
    return pa.concat_arrays([pa.array([], pa.large_utf8()), *column.cast(pa.large_utf8()).chunks])
