"""Removal of lines that many documents share, in DataFrame operations only.

1. Lines become ``(key hash, document, position)``, one row each, written once.
2. These rows are range-partitioned by the hash and sorted within the partitions by
   hash, then document (the largest first), then position.  A sliding pass over the
   sorted runs needs no look back: the first document of a run keeps its lines, the
   first occurrence; a row of the third or a later document is dropped, and one of the
   second if a third follows.  Only rows to drop leave the pass.
3. Keys so frequent that they would fill a partition (a hash-picked sample of documents
   tells which; at most ``HOT``) are range-partitioned by hash and piece, a document being
   in one piece of a key.  The first occurrences of the pieces are carried over: the
   largest of them is the first occurrence of the key, the others are dropped too.  The
   sample only decides how rows are dealt out, not which lines go: the pieces are counted
   whole.
4. Positions to drop are gathered by document as a run-length bitmap: starts and lengths
   of the runs of lines kept.  Text is not moved up to here.
5. ``apply_bitmap`` cuts the kept runs out of the lines of a text.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` are never dropped; rows that repeat a doc_id count as one document
for the number of holders, and each loses the same positions if their texts are
alike; a null doc_id counts as one document, the smallest, and loses nothing; a text of
any length is split whole; an empty table gives an empty result.  Other columns of the
input, whatever their names, are kept by ``dedup_lines`` and not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import shared

#: Stripped from both ends of a line to get its key.
BLANKS = " \t\n\x0b\x0c\r"
#: Most keys that are dealt to pieces, pieces of each at least, and documents of the sample that tells which, about.
HOT, PIECES, SAMPLE = 1000, 64, 10_000


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return shared.ascii_lower(F.btrim(line, F.lit(BLANKS)))


def occurrences(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """``doc_id, version, h1, h2, pos``: every line whose key is long enough, by a 128-bit hash of the key."""
    text = F.col("text").cast("string")
    lines = docs.select("doc_id", F.xxhash64(text).alias("version"), F.posexplode(lines_of(text)).alias("pos", "line"))
    keyed = lines.filter(F.length(F.btrim("line", F.lit(BLANKS))) >= min_chars).withColumn("key", line_key(F.col("line")))
    return keyed.select("doc_id", "version", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "pos")


def hot_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """``h1, h2`` of at most ``HOT`` keys that hold more than that share of the lines of a sample of documents.

    With more shuffle partitions than ``HOT`` it is a partition's share, and as many keys.
    """
    return _hot(occurrences(docs, min_chars), docs.count())


def _hot(lines: DataFrame, n_docs: int) -> DataFrame:
    share = max(1, int((1 << 20) * SAMPLE / max(n_docs, 1)))
    drawn = lines.filter(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 20)) < share)
    counts = shared.materialise(drawn.groupBy("h1", "h2").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counts.filter(F.col("n") > max(total / max(HOT, partitions), 10)).select("h1", "h2")


def dropped_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``doc_id, version, pos`` of the lines that go."""
    pieces = max(PIECES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # texts are split and hashed once: the sample, the bounds of the ranges and the pass read what comes of it
    lines = shared.materialise(occurrences(docs, min_chars))
    hot = F.broadcast(_hot(lines, docs.count()).withColumn("hot", F.lit(True)))  # HOT rows at most, by the way it is made
    piece = F.when(F.col("hot"), 1 + F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(pieces))).otherwise(0)
    keyed = lines.join(hot, ["h1", "h2"], "left").withColumn("piece", piece).withColumn("doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))))
    runs = keyed.repartitionByRange("h1", "h2", "piece").sortWithinPartitions("h1", "h2", "piece", F.desc("doc"), "pos")
    run = Window.partitionBy("h1", "h2", "piece")
    # which document of its run a row is of, the last document at hand, and for pieces how many there are
    ranked = runs.select("*", F.dense_rank().over(run.orderBy(F.desc("doc"))).alias("nth"))
    ranked = ranked.select("*", F.max("nth").over(run).alias("docs"))
    sure = (F.col("piece") == 0) & (F.col("docs") >= min_docs) & (F.col("nth") > 1)
    kept = ranked.filter(sure | (F.col("piece") > 0)).select("doc_id", "version", "pos", "h1", "h2", "piece", "doc", "nth", "docs")
    carried = shared.materialise(kept)
    # one row for each piece: its first occurrence and its documents
    firsts = carried.filter((F.col("piece") > 0) & (F.col("nth") == 1)).groupBy("h1", "h2", "piece").agg(F.max("doc").alias("doc"), F.max("docs").alias("docs"))
    keepers = firsts.groupBy("h1", "h2").agg(F.max("doc").alias("keeper"), F.sum("docs").alias("holders"))
    small = F.broadcast(keepers.filter(F.col("holders") >= min_docs))  # again HOT rows at most
    split = carried.filter("piece > 0").join(small, ["h1", "h2"]).filter("doc < keeper")
    gone = carried.filter("piece = 0").select("doc_id", "version", "pos").unionAll(split.select("doc_id", "version", "pos"))
    return gone.filter("doc_id IS NOT NULL")


def kept_runs(dropped: Column) -> Column:
    """Sorted dropped positions as the run-length code of the lines kept: ``start, length``, the last run open."""

    def run(i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(dropped, i - 1))
        return F.struct((before + 1).alias("start"), (F.coalesce(F.get(dropped, i), F.lit(2**31 - 1)) - before - 1).alias("length"))

    return F.filter(F.transform(F.sequence(F.lit(0), F.size(dropped)), run), lambda r: r["length"] > 0)


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, version, runs``: run-length keep bitmaps of the documents that lose lines."""
    by_doc = dropped_lines(docs, min_chars, min_docs).groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))
    return by_doc.select("doc_id", "version", kept_runs(F.col("dropped")).alias("runs"))


def apply_bitmap(lines: Column, runs: Column) -> Column:
    """The lines that the bitmap keeps; a null bitmap keeps all."""
    cut = lambda x: F.flatten(F.transform(runs, lambda r: F.slice(x, r["start"] + 1, r["length"])))
    return F.when(runs.isNull(), lines).otherwise(shared.let(lines, cut))


LINES, KEPT = shared.hidden("lines"), shared.hidden("kept")


def with_bitmaps(docs: DataFrame, **limits: int) -> DataFrame:
    """The rows of ``docs`` with ``LINES`` and ``KEPT``, both arrays of lines."""
    text = F.col("text").cast("string")
    doc, version, runs = (shared.hidden(x) for x in ("id", "version", "runs"))
    bitmaps = keep_bitmaps(docs, **limits).toDF(doc, version, runs)
    joined = docs.join(bitmaps, (docs["doc_id"] == bitmaps[doc]) & (F.xxhash64(docs["text"].cast("string")) == bitmaps[version]), "left")
    cut = joined.withColumn(LINES, lines_of(text)).withColumn(KEPT, apply_bitmap(F.col(LINES), F.col(runs)))
    return cut.drop(doc, version, runs)


def dedup_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """``docs`` with the lines that stay as ``text``; all other columns and all rows are kept."""
    return with_bitmaps(docs, **limits).withColumn("text", F.array_join(KEPT, "\n")).drop(LINES, KEPT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = with_bitmaps(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    lines, kept = F.size(LINES).cast("long"), F.size(KEPT).cast("long")
    return cut.select("doc_id", lines.alias("n_lines"), (lines - kept).alias("n_dropped"), F.sha2(F.array_join(KEPT, "\n"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.doc_id, pos, line, f.keeper IS NOT NULL AND k.doc_id < f.keeper AS gone FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
