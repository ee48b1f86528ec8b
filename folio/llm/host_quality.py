"""Quality rules with host-level verdicts.

Every document is measured once.  Failures are summed by host with partial
aggregation, so a host with a third of all rows costs each task one row.  The
rate of a host is shrunk towards a beta prior that is fitted to all hosts by the
method of moments: the spread of the raw rates less what chance alone gives hosts of so
few documents, so that many small hosts do not pass for a wide prior.  Hosts whose
shrunk rate is above ``max_host_rate`` (not those at it) lose all their documents;
elsewhere a document stays unless it breaks a rule itself.

Defined results: a null or empty text has no words and so fails; a null host is
a host of its own; an empty table gives an empty result; repeated rows are
counted each; a text of any length is measured whole; further columns, whatever their
names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import shared
from folio.llm import textkernel as tk


@dataclass(frozen=True)
class Rules:
    """Limits of the document rules and of the host rule."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbols_per_100_words: int = 100
    max_dup_lines: int = 20
    max_host_rate: float = 0.6
    max_prior_weight: float = 1000.0


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: Hosts that hold more than a share of one in so many rows are joined apart where hosts are too many to send.
HOT = 1000
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs again, and whether an equal one came earlier."""
    again, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        again[order[1:][same]] = True
        later[order[1:][same]] = True
        again[order[:-1][same]] = True
    return again, later


def measure_block(block: tk.Block) -> list[np.ndarray]:
    """The five measures of each row of a block."""
    data, offsets, rows = block.data, block.offsets, block.rows
    w = tk.words(block, lower=False)
    totals = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    space = tk.SPACE[data]
    chars = totals(~space & ((data & 0xC0) != 0x80))
    symbols = totals(_SYMBOL[data])
    # repeated three-word windows
    grams = tk.gram_hash(w.hash, 3)
    at = np.flatnonzero(w.row[: len(grams)] == w.row[2:]) if len(grams) else np.zeros(0, np.int64)
    row = w.row[at]
    again, _ = _repeats(tk.mix(grams[at] + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    covered = np.zeros(len(w.start), dtype=bool)
    for k in range(3):
        covered[at[again] + k] = True
    repeated = np.bincount(w.row[covered], minlength=rows)
    # lines: between newlines and the bounds of rows
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, offsets[1:]]))
    line_row = np.repeat(np.arange(rows), 1 + np.diff(np.searchsorted(breaks, offsets)))
    some = np.concatenate([[0], np.cumsum(~space)])
    worded = some[end] > some[start]
    start, end, line_row = start[worded], end[worded], line_row[worded]
    keys = tk.mix(tk.range_hash(data, start, end) + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, later = _repeats(keys)
    dups = np.bincount(line_row[later], minlength=rows)
    return [w.per_row(), chars, symbols, dups, repeated]


def measures(docs: DataFrame, *keep: str) -> DataFrame:
    """The measures of every row beside the columns named."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", " + MEASURES
    names = [x.split()[0] for x in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure_block(b) for b in tk.blocks(batch.column("_text"))]
            columns = [pa.array(np.concatenate([f[i] for f in found]) if found else np.zeros(0), pa.int64()) for i in range(5)]
            yield pa.record_batch([*(batch.column(i) for i in range(len(keep))), *columns], names=[*keep, *names])

    return docs.select(*keep, F.col("text").cast("string").alias("_text")).transform(shared.arrow, run, schema)


def with_failures(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    n = F.col("n_words")
    base = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * n)
    own = (100 * F.col("n_symbols") > rules.max_symbols_per_100_words * n) | (F.col("n_dup_lines") > rules.max_dup_lines)
    return measured.withColumns({"base_failed": base, "own_failed": base | own})


def host_rates(judged: DataFrame, host: str, rules: Rules = Rules()) -> DataFrame:
    """``host, n_docs, n_failed, rate`` with the rate shrunk by the beta prior of all hosts."""
    hosts = judged.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n_docs"), F.count_if("own_failed").alias("n_failed"))
    raw = F.col("n_failed") / F.col("n_docs")
    m, v, a = hosts.agg(F.avg(raw), F.var_pop(raw), F.avg(1.0 / F.col("n_docs"))).first()
    m = min(max(m or 0.0, 1e-6), 1 - 1e-6)
    # a beta prior of variance t gives raw rates the variance t + (m (1 - m) - t) / n
    spread = (v - m * (1 - m) * a) / (1 - a) if v is not None and a < 1 else 0.0
    weight = min(max(m * (1 - m) / spread - 1, 1.0), rules.max_prior_weight) if spread > 1e-12 else rules.max_prior_weight
    return hosts.withColumn("rate", (F.col("n_failed") + F.lit(m * weight)) / (F.col("n_docs") + F.lit(weight)))


def apply_rules(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """``doc_id, host``, the measures, ``base_failed, own_failed, host_rate, kept`` of every row."""
    judged = with_failures(measures(docs.select(F.col("doc_id"), F.col(host).alias("host"), "text"), "doc_id", "host"), rules)
    judged = shared.materialise(judged)
    hosts = host_rates(judged, "host", rules).select(F.col("host").alias("_host"), "n_docs", F.col("rate").alias("host_rate"))
    same = F.col("host").eqNullSafe(F.col("_host"))
    few = shared.checked_broadcast(hosts)
    if few is hosts:
        # too many hosts to send: those with a thousandth of all rows are, the others' rows are shuffled
        hot = F.broadcast(hosts.filter(F.col("n_docs") * HOT > judged.count()))  # HOT rows at most, by the way it is made
        rest = judged.join(hot.select("_host"), same, "left_anti")
        joined = judged.join(hot, same).unionByName(rest.join(hosts, same, "left"))
    else:
        joined = judged.join(few, same, "left")
    joined = joined.drop("_host", "n_docs")
    return joined.withColumn("kept", ~F.col("own_failed") & (F.col("host_rate") <= rules.max_host_rate))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.select("doc_id", *(x.split()[0] for x in MEASURES.split(", ")), "base_failed", "kept")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), g AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN dup ON d.doc_id = dup.doc_id
), j AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words
         OR 100 * n_symbols > 100 * n_words OR n_dup_lines > 20 AS own_failed
  FROM m
), h AS (
  SELECT source, count(*) AS n, count(*) FILTER (own_failed) AS f FROM j GROUP BY source
), mv AS (
  SELECT least(greatest(avg(f / n), 1e-6), 1 - 1e-6) AS m, var_pop(f / n) AS v, avg(1.0::DOUBLE / n) AS a FROM h
), sp AS (
  SELECT m, CASE WHEN a < 1 THEN (v - m * (1 - m) * a) / (1 - a) ELSE 0 END AS s FROM mv
), p AS (
  SELECT m, CASE WHEN s > 1e-12 THEN least(greatest(m * (1 - m) / s - 1, 1.0), 1000.0) ELSE 1000.0 END AS k FROM sp
), r AS (
  SELECT source, (f + m * k) / (n + k) AS rate FROM h CROSS JOIN p
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT own_failed AND rate <= 0.6 AS kept
FROM j JOIN r ON j.source IS NOT DISTINCT FROM r.source
"""
