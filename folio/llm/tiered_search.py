"""Ranked lexical search over a tiered, impact-ordered index.

Terms are maximal runs of characters that are no separators, A-Z in lower case.  A
posting's impact is ``1e9 * tf div (1000 * tf + 8 * m)`` with ``m`` from the document's length
in terms, a term's weight ``floor(1000 * ln((2N + 2) / (2df + 1)))``; a score is the sum of
weight times impact over an item's terms.

*The index.*  One pass counts the documents of every term, added up within tasks before
they are shuffled.  A second pass writes a row for each document, whose postings are in
columns by tier: ``tier0`` has those whose weight times impact is at least ``CUTS[0]`` of the
largest there can be and all of rare terms, the next ones those of lower impact.  So
reading the first tiers is reading fewer columns of the same table, a document's
postings are together, and nothing but counts is shuffled.  Which terms are frequent
is sent to the tasks: a term in more than one of ``RARE`` documents; there are at most ``RARE``
times the mean number of distinct terms of a document, and ``RARE`` is halved until they
are ``MOST_FREQUENT`` or fewer (this only moves postings between tiers).  With each task's
rows go the largest impacts that it put below each tier, the residual bounds of terms.

*A search* reads tier 0 for all items.  Each task hands on the 10 best scores so far of an item, and the
10th best of all tasks is its floor.  If the residual bounds of an item's terms add up to less
than the floor, no document that has not been seen can be among the best.  For such items
the tier is read once more for the documents whose score so far, with the residual bounds of the
terms they have not shown, reaches the floor.  If these are few in every task
(``CANDIDATES``), the result is proven to be among them, and they alone are scored by all
their tiers.  An item without that proof falls through to the next tier; with the last tier
all scores are exact.  So results never depend on tiers, cuts or bounds.

Terms are 64-bit hashes; two terms of the corpus are taken for one with a probability of
about the square of the number of terms over 2^65.  Items are handled in blocks of
``ITEMS``, whose terms are sent to the tasks.

Defined results: null and empty texts have no terms, are in no result and, as items,
have none; rows that repeat a doc_id are documents each, rows that repeat an item are
ranked each; equal scores are ranked by doc_id, a null one last; a document of any length is read whole; without documents or items
the result is empty; further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import shared
from folio.llm import textkernel as tk

#: Best documents of an item.
TOP = 10
#: Shares of the largest weight times impact that part the tiers.
CUTS = (0.2, 0.1)
#: A term in more than one of so many documents is frequent; frequent terms at most.
RARE, MOST_FREQUENT = 100, 1 << 18
#: Documents that a task hands on for an item, items of a block, scores worked out at a time, counts held by a task.
CANDIDATES, ITEMS, CELLS, COUNTS = 64, 1024, 1 << 20, 1 << 20


def postings(block: tk.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and frequency of the distinct terms of each row, and all terms of each row."""
    w = tk.words(block, tk.NON_WORD)
    terms = w.hash.view(np.int64)
    order = np.lexsort((terms, w.row))
    row, term = w.row[order], terms[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return row[at], term[at], np.diff(np.append(at, len(row))), w.per_row()


def term_counts(docs: DataFrame) -> DataFrame:
    """``term, df, n`` of every term; the null term has the documents with a term and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts, held, documents, words = [], [], 0, 0, 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            found, back = np.unique(np.concatenate(terms), return_inverse=True)
            return found, np.bincount(back, np.concatenate(counts), len(found)).astype(np.int64)

        def out(term: pa.Array, df: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([term, pa.array(df), pa.array(n)], names=["term", "df", "n"])

        for batch in batches:
            for block in tk.blocks(batch.column(0)):
                _, term, _, n = postings(block)
                documents, words = documents + int((n > 0).sum()), words + int(n.sum())
                found, count = np.unique(term, return_counts=True)
                terms.append(found)
                counts.append(count)
                held += len(found)
                if held > 2 * COUNTS:
                    found, count = merged()
                    if len(found) > COUNTS:
                        yield out(pa.array(found), count, np.zeros(len(found), np.int64))
                        found, count = found[:0], count[:0]
                    terms, counts, held = [found], [count], len(found)
        if terms:
            found, count = merged()
            yield out(pa.array(found), count, np.zeros(len(found), np.int64))
        yield out(pa.array([None], pa.int64()), np.array([documents]), np.array([words]))

    each = docs.select(F.col("text").cast("string").alias("_text")).transform(shared.arrow, run, "term long, df long, n long")
    return each.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))


@dataclass
class Index:
    """Rows ``row, doc_id, tier0, tier1, ..`` of documents, the counts of terms and their residual bounds."""

    documents: DataFrame
    terms: DataFrame
    bounds: DataFrame
    n_docs: int
    tiers: int


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def build(docs: DataFrame, cuts: tuple[float, ...] = CUTS) -> Index:
    """The index of all rows of ``doc_id, text``; its tables go to the shared folder."""
    counts = shared.materialise(term_counts(docs))
    n_docs, n_words = next(((r[0] or 0, r[1] or 0) for r in counts.filter("term IS NULL").select("df", "n").collect()), (0, 0))
    terms = counts.filter("term IS NOT NULL").select("term", "df")
    rare = RARE
    while terms.filter(F.col("df") * rare > n_docs).count() > MOST_FREQUENT and rare > 1:
        rare //= 2
    frequent = terms.filter(F.col("df") * rare > n_docs).toArrow().sort_by("term")
    known, df = (frequent[c].combine_chunks().to_numpy() for c in ("term", "df"))
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1)))
    least = np.array([c * weight(n_docs, 1) * 1e6 for c in cuts])
    tiers = len(cuts) + 1
    names = ["row", "doc_id", *(f"tier{k}" for k in range(tiers))]
    pair = pa.struct([("term", pa.int64()), ("impact", pa.int32())])

    def lists(rows: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray) -> pa.Array:
        offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(term), pa.array(impact.astype(np.int32))], fields=list(pair))
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = np.zeros((tiers, len(known)), np.int64)
        for batch in batches:
            for block in tk.blocks(batch.column(2)):
                row, term, tf, n = postings(block)
                m = 25 + 75 * n * n_docs // max(n_words, 1)
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
                at = np.minimum(np.searchsorted(known, term), max(len(known) - 1, 0))
                common = known[at] == term if len(known) else np.zeros(len(term), bool)
                tier = np.zeros(len(term), np.int64)
                tier[common] = (weights[at[common]] * impact[common] < least[:, None]).sum(axis=0)
                for k in range(tiers - 1):
                    low = tier > k
                    np.maximum.at(below[k], at[low], impact[low])
                some = np.flatnonzero(n > 0)
                place = np.full(block.rows, -1)
                place[some] = np.arange(len(some))
                kept = [batch.column(i).slice(block.first, block.rows).take(pa.array(some)) for i in range(2)]
                each = [lists(len(some), place[row[tier == k]], term[tier == k], impact[tier == k]) for k in range(tiers)]
                yield pa.record_batch([*kept, *each], names=names)
        # one row without a document: the largest impacts below each tier
        empty = [pa.array([None], pa.int64())] * 2
        each = []
        for k in range(tiers):
            at = np.flatnonzero(below[k])
            each.append(lists(1, np.zeros(len(at), np.int64), known[at], below[k][at]))
        yield pa.record_batch([*empty, *each], names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"))
    schema = "row long, doc_id long, " + ", ".join(f"tier{k} array<struct<term: bigint, impact: int>>" for k in range(tiers))
    made = shared.materialise(rows.transform(shared.arrow, run, schema))
    residual = None
    for k in range(tiers - 1):
        each = made.filter("row IS NULL").select(F.lit(k).alias("tier"), F.explode(f"tier{k}").alias("p")).select("tier", "p.*")
        residual = each if residual is None else residual.unionAll(each)
    bounds = made.limit(0).selectExpr("0 AS tier", "0L AS term", "0 AS impact") if residual is None else residual
    bounds = shared.materialise(bounds.groupBy("tier", "term").agg(F.max("impact").alias("impact")))
    return Index(made.filter("row IS NOT NULL"), terms, bounds, n_docs, tiers)


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term, qtf``: the distinct terms of every row, which is numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tk.blocks(batch.column(2)):
                row, term, tf, _ = postings(block)
                take = pa.array(row + block.first)
                yield pa.record_batch([batch.column(0).take(take), batch.column(1).take(take), pa.array(term), pa.array(tf.astype(np.int64))], names=["item", "item_id", "term", "qtf"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string").alias("_text"))
    kind = items.schema["item_id"].dataType.simpleString()
    return rows.transform(shared.arrow, run, f"item long, item_id {kind}, term long, qtf long")


@dataclass
class Asked:
    """The terms of a block of items: for each distinct term the items that hold it, their weights and residual bounds."""

    terms: np.ndarray
    first: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    residual: np.ndarray  # by tier: weight times the largest impact below it

    @staticmethod
    def of(rows: pa.Table, items: np.ndarray, n_docs: int, tiers: int) -> Asked:
        rows = rows.sort_by([("term", "ascending"), ("item", "ascending")])
        column = lambda c: rows[c].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        terms, first = np.unique(column("term"), return_index=True)
        heft = column("qtf") * np.array([weight(n_docs, d) for d in column("df").tolist()], np.int64)
        residual = np.stack([heft * column(f"below{k}") for k in range(tiers - 1)] + [np.zeros(len(heft), np.int64)])
        return Asked(terms, np.append(first, len(heft)), np.searchsorted(items, column("item")), heft, residual)

    def unseen(self, n: int, tier: int) -> np.ndarray:
        """The most that a document without any posting in the tiers up to ``tier`` can score, for each of ``n`` items."""
        total = np.zeros(n, np.int64)
        np.add.at(total, self.item, self.residual[tier])
        return total


def bounds_of(asked: Asked, n: int, tier: int, lists: list[pa.ListArray], upper: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Lower and, if asked for, upper bounds of the scores: documents by ``n`` items, from the tiers given."""
    documents = len(lists[0])
    low, shown = (np.zeros(documents * n, np.int64) for _ in range(2))
    for each in lists:
        values, doc = each.flatten(), np.repeat(np.arange(documents), each.value_lengths().to_numpy(zero_copy_only=False))
        term, impact = values.field(0).to_numpy(), values.field(1).to_numpy().astype(np.int64)
        at = np.minimum(np.searchsorted(asked.terms, term), len(asked.terms) - 1)
        hit = np.flatnonzero(asked.terms[at] == term)
        at, doc, impact = at[hit], doc[hit], impact[hit]
        times = asked.first[at + 1] - asked.first[at]
        entry = np.repeat(asked.first[at] - np.cumsum(times) + times, times) + np.arange(times.sum())
        cell = np.repeat(doc, times) * n + asked.item[entry]
        np.add.at(low, cell, asked.weight[entry] * np.repeat(impact, times))
        if upper:
            np.add.at(shown, cell, asked.residual[tier][entry])
    low, shown = low.reshape(documents, n), shown.reshape(documents, n)
    return low, low + (asked.unseen(n, tier) - shown) if upper else low


class Best:
    """What a task hands on of each item: its best documents, or those whose bound reaches the floor."""

    def __init__(self, floor: np.ndarray, reaching: bool) -> None:
        self.floor, self.reaching = floor.copy(), reaching
        self.open = np.zeros(len(floor), bool)  # items that too many documents reach
        self.held = [np.zeros(0, np.int64) for _ in range(4)]  # item, row, doc_id (nulls highest), score

    def add(self, row: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        if not self.reaching and len(row) >= TOP:
            self.floor = np.maximum(self.floor, np.partition(low, len(row) - TOP, axis=0)[len(row) - TOP])
        d, i = np.nonzero((high >= self.floor) & (high > 0) & ~self.open)
        held = [np.concatenate([a, b]) for a, b in zip(self.held, [i, row[d], doc[d], low[d, i]], strict=True)]
        if self.reaching:
            self.open |= np.bincount(held[0], minlength=len(self.open)) > CANDIDATES
            keep = ~self.open[held[0]]
        else:
            order = np.lexsort((held[1], held[2], -held[3], held[0]))
            held = [a[order] for a in held]
            item = held[0]
            nth = np.arange(len(item)) - np.searchsorted(item, item)
            tenth = nth == TOP - 1
            self.floor[item[tenth]] = np.maximum(self.floor[item[tenth]], held[3][tenth])
            keep = nth < TOP
        self.held = [a[keep] for a in held]


FOUND = "item int, row long, doc_id long, score long"


def scan(index: Index, asked: Asked, floor: np.ndarray, tier: int, reaching: bool = False) -> DataFrame:
    """``FOUND``: by the tiers up to ``tier``, the best documents of each item in every task that reach the floor.

    With ``reaching`` all documents whose upper bound reaches the floor, and a null row for
    an item that too many do.
    """
    n = len(floor)
    columns = [f"tier{k}" for k in range(tier + 1)]
    most = max(1, CELLS // max(n, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(floor, reaching)
        for batch in batches:
            for first in range(0, batch.num_rows, most):
                part = batch.slice(first, most)
                row = part.column(0).to_numpy()
                doc = part.column(1).fill_null(2**63 - 1).to_numpy()
                best.add(row, doc, *bounds_of(asked, n, tier, part.columns[2:], reaching))
        item, row, doc, low = best.held
        more = np.flatnonzero(best.open)
        gone = np.append(np.zeros(len(item), bool), np.ones(len(more), bool))
        fill = lambda a: pa.array(np.append(a, np.zeros(len(more), np.int64)), mask=gone)
        # a null id sorts as the largest number, and comes out as null
        doc = pa.array(np.append(doc, np.zeros(len(more), np.int64)), mask=gone | (np.append(doc, more) == 2**63 - 1))
        yield pa.record_batch([pa.array(np.append(item, more).astype(np.int32)), fill(row), doc, fill(low)], names=["item", "row", "doc_id", "score"])

    return index.documents.select("row", "doc_id", *columns).transform(shared.arrow, run, FOUND)


def exact_scores(index: Index, asked: Asked, n: int, wanted: DataFrame) -> DataFrame:
    """``item, row, doc_id, score`` of the pairs ``item, row``, by all tiers of these documents."""
    last = index.tiers - 1
    columns = [f"tier{k}" for k in range(last + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                score = bounds_of(asked, n, last, part.columns[3:])[0][0]
                items = part.column(2)[0].as_py()
                yield pa.record_batch([pa.array(items, pa.int32()), *(pa.array([part.column(c)[0].as_py()] * len(items), pa.int64()) for c in (0, 1)), pa.array(score[items])], names=["item", "row", "doc_id", "score"])

    few = shared.checked_broadcast(wanted.groupBy("row").agg(F.collect_set("item").alias("items")))
    rows = index.documents.join(few, "row").select("row", "doc_id", "items", *columns)
    return rows.transform(shared.arrow, run, "item int, row long, doc_id long, score long")


def search(index: Index, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score, tiers``: the best documents of each row of ``item_id, text``.

    ``tiers`` is how many tiers were read until the result was proven.
    """
    if top > TOP:
        raise ValueError(f"tasks keep {TOP} documents")
    terms = shared.materialise(item_terms(items))
    asked = terms.join(shared.checked_broadcast(index.terms), "term")
    residual = index.bounds.groupBy("term").agg(F.count("*").alias("bounds"), *(F.max(F.when(F.col("tier") == k, F.col("impact"))).alias(f"below{k}") for k in range(index.tiers - 1)))
    asked = shared.materialise(asked.join(residual, "term", "left"))
    names = terms.select("item", "item_id").distinct()
    blocks = max(1, -(-names.count() // ITEMS))
    done = None
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        for found in _block(index, mine):
            done = found if done is None else done.unionAll(found)
    if done is None:
        done = names.limit(0).selectExpr("0L AS item", "0L AS row", "0L AS doc_id", "0L AS score", "0 AS tiers")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = done.filter("score > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score", "tiers")


def _block(index: Index, rows: pa.Table) -> Iterator[DataFrame]:
    """Tables ``item, row, doc_id, score, tiers`` with the best documents of the items, and maybe some more."""
    items = np.unique(rows["item"].combine_chunks().to_numpy()) if len(rows) else np.zeros(0, np.int64)
    floor = np.zeros(len(items), np.int64)
    for tier in range(index.tiers):
        if not len(items):
            return
        asked = Asked.of(rows, items, index.n_docs, index.tiers)
        number = F.element_at(F.lit(items.tolist()), F.col("item") + 1).alias("item")
        found = shared.materialise(scan(index, asked, floor, tier))
        if tier == index.tiers - 1:
            yield found.select(number, "row", "doc_id", "score", F.lit(tier + 1).alias("tiers"))
            return
        nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        tenth = found.withColumn("nth", nth).filter(F.col("nth") == TOP).select("item", "score")
        for item, score in tenth.collect():
            floor[item] = max(floor[item], score)
        closed = np.flatnonzero(asked.unseen(len(items), tier) < floor)
        if not len(closed):
            continue
        mine, own = _only(rows, items, closed)
        near = Asked.of(mine, own, index.n_docs, index.tiers)
        reached = shared.materialise(scan(index, near, floor[closed], tier, reaching=True))
        too_many = {r[0] for r in reached.filter("row IS NULL").select("item").distinct().collect()}
        proven = [i for i in range(len(own)) if i not in too_many]
        if proven:
            wanted = shared.materialise(reached.filter(F.col("row").isNotNull() & ~F.col("item").isin(list(too_many))).select("item", "row"))
            scores = exact_scores(index, near, len(own), wanted).join(wanted, ["item", "row"], "left_semi")
            named = F.element_at(F.lit(own.tolist()), F.col("item") + 1).alias("item")
            yield shared.materialise(scores.select(named, "row", "doc_id", "score", F.lit(tier + 1).alias("tiers")))
        left = np.setdiff1d(np.arange(len(items)), closed[proven])
        rows, items = _only(rows, items, left)
        floor = floor[left]


def _only(rows: pa.Table, items: np.ndarray, places: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """The terms and numbers of some items."""
    return rows.filter(pa.array(np.isin(rows["item"].combine_chunks().to_numpy(), items[places]))), items[places]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), p AS (
  SELECT doc_id, term, count(*) AS tf FROM w GROUP BY doc_id, term
), n AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY doc_id
), s AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n
), v AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, docs
), b AS (
  SELECT item_id, term, count(*) AS qtf FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term
), r AS (
  SELECT item_id, p.doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
  FROM b JOIN v ON b.term = v.term JOIN p ON p.term = b.term JOIN n ON n.doc_id = p.doc_id, s GROUP BY item_id, p.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 10
"""
