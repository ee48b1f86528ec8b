"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are hashed; of every ``WINDOW - K + 1`` consecutive k-gram hashes the least
is the fingerprint of the window of ``WINDOW`` words that they fill.  Equal
windows have equal fingerprints, so every shared span of ``WINDOW`` words or more
shares one.  The benchmark's fingerprints are folded into a Bloom filter, an array of
64-bit words of ``BITS_PER_WINDOW`` bits for each (at most ``MOST_BITS``), which is a
scalar of the plan.  A benchmark whose windows ask for more bits is dealt by hash to
several filters, and the documents are read once for each, so a filter never fills.  Of a document's runs of windows with the same
fingerprint only those that the filter lets through are kept, with the word hashes of
the run.  These few rows are joined with the benchmark's fingerprints and extended, by
comparing the hash of each full window of the run with the benchmark's windows.  So
neither text nor fingerprints of documents are shuffled, whatever the benchmark's size.

A benchmark text of fewer words than ``WINDOW`` is one window of its own length.
Documents are looked up for such lengths at the positions whose first word passes a
second filter, that of the first words of the short texts.

Defined results: null and empty texts have no words and no hits; an empty
benchmark marks nothing; a text of any length is read whole; rows that repeat a doc_id
are judged each by their text; repeated items count by their item_id; an empty table
gives an empty result; further columns, whatever their names, are kept or not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import shared

#: Words of a window, and of the k-grams that are winnowed.
WINDOW, K = 10, 5
#: Bits of a filter for each entry, and at most.
BITS_PER_WINDOW, MOST_BITS = 24, 1 << 26
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_hashes(text: Column) -> Column:
    lowered = shared.ascii_lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.transform(F.array_remove(F.split(lowered, _SEPARATORS), ""), lambda w: F.xxhash64(w))


def _indices(last: Column) -> Column:
    """0 to ``last``, empty if that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _least(wh: Column, body) -> Column:
    """Hands ``body`` the fingerprint of the window at each start."""
    grams = F.transform(_indices(F.size(wh) - K), lambda i: F.xxhash64(F.slice(wh, i + 1, K)))
    least = lambda g: F.transform(_indices(F.size(wh) - WINDOW), lambda s: F.array_min(F.slice(g, s + 1, WINDOW - K + 1)))
    return shared.let(grams, lambda g: shared.let(least(g), body))


def bloom(hashes: DataFrame) -> DataFrame:
    """One row ``bits`` for a column of hashes ``f``: an array of 64-bit words with two bits set for each hash.

    The array has as many words as the number of hashes asks for, a power of two.
    """
    n = hashes.count()
    size = 64
    while size < min(n * BITS_PER_WINDOW, MOST_BITS):
        size *= 2
    at = hashes.select(F.explode(F.array(*_places(F.col("f"), F.lit(size)))).alias("p"))
    words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("b"))
    dense = hashes.sparkSession.range(size // 64).withColumnRenamed("id", "w").join(words, "w", "left").select("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("bits"))


def _places(f: Column, size: Column) -> tuple[Column, Column]:
    return F.pmod(f, size), F.pmod(F.shiftright(f, 32), size)


def passes(bits: Column, f: Column) -> Column:
    """Whether the filter may hold the hash: always for one that it was made of."""
    there = lambda p: F.call_function("shiftright", F.get(bits, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    first, second = _places(f, F.size(bits).cast("long") * 64)
    return there(first) & there(second)


def runs(wh: Column, bits: Column) -> Column:
    """``f, start, len, words``: runs of windows with the same fingerprint, if the filter lets it through, and the words they cover."""

    def cut(least: Column) -> Column:
        n = F.size(least)
        begins = F.filter(_indices(n - 1), lambda s: (s == 0) | (F.get(least, s) != F.get(least, s - 1)))

        def between(b: Column) -> Column:
            # a run ends where the next one begins
            each = F.transform(b, lambda s, i: F.struct(s.alias("s"), (F.coalesce(F.get(b, i + 1), n) - s).alias("n")))
            one = lambda r: F.struct(F.get(least, r["s"]).alias("f"), r["s"].alias("start"), F.lit(WINDOW).alias("len"), F.slice(wh, r["s"] + 1, r["n"] + WINDOW - 1).alias("words"))
            return F.transform(F.filter(each, lambda r: passes(bits, F.get(least, r["s"]))), one)

        return shared.let(begins, between)

    return _least(wh, cut)


def short_runs(wh: Column, length: int, first: Column) -> Column:
    """The same for windows of a shorter length, at the starts whose first word the filter lets through."""
    starts = F.filter(_indices(F.size(wh) - length), lambda s: passes(first, F.get(wh, s)))
    window = lambda s: F.slice(wh, s + 1, length)
    return F.transform(starts, lambda s: F.struct(F.xxhash64(F.lit(length), window(s)).alias("f"), s.alias("start"), F.lit(length).alias("len"), window(s).alias("words")))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``f, len, w, items, first``: the distinct windows of all items and the ids of those that have them."""
    wh, n = F.col("wh"), F.size("wh")
    full = _least(wh, lambda m: F.transform(_indices(F.size(m) - 1), lambda s: F.struct(F.get(m, s).alias("f"), F.lit(WINDOW).alias("len"), F.xxhash64(F.slice(wh, s + 1, WINDOW)).alias("w"), F.lit(None).cast("long").alias("first"))))
    whole = F.array(F.struct(F.xxhash64(n, wh).alias("f"), n.alias("len"), F.xxhash64(wh).alias("w"), F.get(wh, F.lit(0)).alias("first")))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), word_hashes(F.col("text")).alias("wh")).filter(n > 0)
    each = items.select("item_id", F.explode(F.when(n >= WINDOW, full).otherwise(whole)).alias("x")).select("item_id", "x.*")
    return each.groupBy("f", "len", "w").agg(F.collect_set("item_id").alias("items"), F.max("first").alias("first"))


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, row, n_words, spans, item_ids`` of every row of ``docs``.

    ``spans`` are the ``start, stop`` word positions of the windows found, sorted;
    ``row`` is the hash of the text.
    """
    windows = shared.materialise(item_windows(benchmark))
    lengths = sorted(r[0] for r in windows.filter(F.col("len") < WINDOW).select("len").distinct().collect())
    hashes = shared.materialise(windows.filter(F.col("len") == WINDOW).select("f").distinct())
    parts = max(1, -(-hashes.count() * BITS_PER_WINDOW // MOST_BITS))
    text = F.col("text").cast("string")

    def read(full: DataFrame, short: DataFrame | None) -> DataFrame:
        """``doc_id, row, n_words, near``: what one filter lets through; windows of fewer words only with their filter."""
        near = lambda wh, b, f: F.concat(runs(wh, b), *(short_runs(wh, n, f) for n in (lengths if short is not None else [])))
        both = lambda wh, b, f: F.struct(F.size(wh).cast("long").alias("n_words"), near(wh, b, f).alias("near"))
        # the hashes and each filter are named once, so that the plan holds the filters as scalars and not as columns of every row
        found = shared.let(F.col("full"), lambda b: shared.let(F.col("short"), lambda f: shared.let(F.col("wh"), lambda wh: both(wh, b, f))))
        bits = [F.array().cast("array<bigint>") if x is None else shared.materialise(bloom(x)).scalar() for x in (full, short)]
        keyed = docs.select("doc_id", F.xxhash64(text).alias("row"), word_hashes(F.col("text")).alias("wh"), bits[0].alias("full"), bits[1].alias("short"))
        return shared.materialise(keyed.select("doc_id", "row", found.alias("x")).select("doc_id", "row", "x.*"))

    part = F.pmod(F.xxhash64(F.lit(5), "f"), F.lit(parts))
    first = windows.filter("first IS NOT NULL").select(F.col("first").alias("f")).distinct()
    every = [read(hashes.filter(part == k), None if k else first) for k in range(parts)]
    measured = every[0]
    near = reduce(DataFrame.unionAll, every).filter(F.size("near") > 0).select("doc_id", "row", F.explode("near").alias("x")).select("doc_id", "row", "x.*").distinct()
    known = shared.checked_broadcast(windows.select("f").distinct())
    each = near.join(known, "f").select("doc_id", "row", "start", "len", "words", F.explode(_indices(F.size("words") - F.col("len"))).alias("j"))
    each = each.select("doc_id", "row", (F.col("start") + F.col("j")).alias("start"), "len", F.xxhash64(F.slice("words", F.col("j") + 1, F.col("len"))).alias("w"))
    size = F.aggregate("items", F.lit(64), lambda total, x: total + 16 + F.octet_length(x))
    met = each.join(shared.checked_broadcast(windows.select("len", "w", "items"), size=size), ["len", "w"])
    found = met.groupBy("doc_id", "row").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("stop")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
    )
    found = found.withColumnsRenamed({"doc_id": "_doc", "row": "_row"})
    joined = measured.select("doc_id", "row", "n_words").join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("row").eqNullSafe(F.col("_row")), "left")
    return joined.select("doc_id", "row", "n_words", *(F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c) for c in ("spans", "item_ids")))


def covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("stop"))
    add = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], acc["stop"]))).alias("n"), F.greatest(acc["stop"], s["stop"]).alias("stop"))
    return F.aggregate(spans, start, add, lambda acc: acc["n"])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids, spans, contaminated`` of every row."""
    found = hits(docs, benchmark)
    n_hit = covered(F.col("spans"))
    return found.select("doc_id", "row", "n_words", n_hit.alias("n_hit"), "item_ids", "spans", (F.size("spans") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any word of a benchmark window; all columns stay."""
    doc, row = shared.hidden("id"), shared.hidden("row")
    bad = report(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias(doc), F.col("row").alias(row)).distinct()
    bad = shared.checked_broadcast(shared.materialise(bad))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64(F.col("text").cast("string")) == F.col(row)), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), ids.alias("items_sha256"), "contaminated")


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id, ws, least(len(ws), 10) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark) WHERE len(ws) > 0
), bw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[s : s + k - 1], ' ') AS w
  FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM b)
), dw AS (
  SELECT doc_id, s, k, array_to_string(ws[s : s + k - 1], ' ') AS w
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM b))
), h AS (
  SELECT doc_id, s, dw.k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.w = bw.w
), n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM h) GROUP BY doc_id
), i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN i ON d.doc_id = i.doc_id
"""
