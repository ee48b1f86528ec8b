"""Near-duplicate groups by MinHash with odd sketches.

A document's set holds its distinct runs of five words.  Steps:

1. One pass makes ``PERMS`` MinHash values of every set, hashes them in ``BANDS``
   bands of ``ROWS``, and folds them into an odd sketch: every sample flips one of
   ``BITS`` bits, so the XOR of two sketches counts the samples that differ and
   estimates high similarities well.
2. Rows with equal sets are one node from here on, whatever their ids are.
3. In each bucket of a band every node is paired with the bucket's first node
   only.  Pairs whose sketches rule the threshold out (by more than five standard
   errors) go; the rest are confirmed on the full sets.  Confirmed links give
   provisional components.
4. Nodes of a bucket outside the component of its first node are compared, by
   sketch, with all of the bucket that are in other components than they; again
   survivors are confirmed on full sets.  So any two nodes that share a bucket end
   up compared or in one component, and no step emits all pairs of a group: pairs
   are looked at inside a task, in groups of bounded size, and links come out only
   where they join components.
5. Components of all links, by contraction, are joined back.

Two sets of similarity 0.75 share no bucket with probability (1-0.75^4)^32 = 5e-6.

Defined results: no words (null, empty or blank texts): no shingles, linked with
nothing, kept; fewer than five words: the whole sequence is the one shingle; a
similarity of exactly 0.75 links; a text of any length is measured whole, and a task
holds a block of rows or one longer text; rows that repeat a doc_id get the component
of their own text, so two texts under one id may be in two; ``keep_one`` keeps of each
component the row with the smallest doc_id (of several the one whose text has the
smallest hash), and one of rows that are alike in id and text; a null doc_id has a null
component and is kept; an empty table gives an empty result; other columns, whatever
their names, are kept by ``keep_one`` and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import graph, shared
from folio.llm import textkernel as tk

BANDS, ROWS, BITS = 32, 4, 512
PERMS = BANDS * ROWS
THRESHOLD = (75, 100)
#: XOR counts above this rule out a similarity of 0.75 (57 expected there, about 8.5 standard error).
MAX_FLIPS = 104
#: Outliers of a bucket in one group, about; its members in one; pairs of one copy of a text.
LIST, SUB, FAN = 256, 1024, 64
_U = np.uint64
_RNG = np.random.default_rng(20)
_XOR = _RNG.integers(0, 1 << 63, PERMS, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 63, PERMS, dtype=np.uint64) | _U(1)
_SKETCH = [f"k{i}" for i in range(BITS // 64)]
_STATS = "doc_id long, version long, n_shingles long, s1 long, s2 long, bands array<bigint>, " + ", ".join(f"{k} long" for k in _SKETCH)


def signatures(block: tk.Block) -> dict[str, np.ndarray]:
    """Set sizes, set hashes, band hashes and odd sketches of the rows of a block."""
    w = tk.words(block)
    g, at = tk.shingles(w, block.rows)
    n = np.diff(at)
    full = np.flatnonzero(n)
    low = np.zeros((block.rows, PERMS), dtype=_U)
    s1, s2 = np.zeros(block.rows, _U), np.zeros(block.rows, _U)
    if len(full):
        starts = at[:-1][full]
        s1[full] = np.add.reduceat(tk.mix(g + _U(1)), starts)
        s2[full] = np.add.reduceat(tk.mix(g ^ _U(0x5851F42D4C957F2D)), starts)
        for p in range(PERMS):
            low[full, p] = np.minimum.reduceat((g ^ _XOR[p]) * _MUL[p], starts)
    bands = np.zeros((block.rows, BANDS), dtype=_U)
    for r in range(ROWS):
        bands = tk.mix(bands * _U(0xA24BAED4963EE407) + low[:, r::ROWS] + _U(r + 1))
    bands = tk.mix(bands + np.arange(BANDS, dtype=_U) * _U(0x9E3779B97F4A7C15))
    bit = (tk.mix(low + np.arange(PERMS, dtype=_U) * _U(0xD6E8FEB86659FD93)) >> _U(64 - BITS.bit_length() + 1)).astype(np.int64)
    parity = np.bincount((np.arange(block.rows)[:, None] * BITS + bit).ravel(), minlength=block.rows * BITS) & 1
    sketch = np.packbits(parity.astype(bool).reshape(block.rows, BITS), axis=1).view(_U)
    return {"n": n, "s1": s1, "s2": s2, "bands": bands, "sketch": sketch, "full": n > 0}


def measure(docs: DataFrame) -> DataFrame:
    """``_STATS`` of every row: ``version`` is the hash of its text, ``bands`` is empty for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tk.blocks(batch.column("text")):
                x = signatures(block)
                ends = np.concatenate([[0], np.cumsum(x["full"] * BANDS)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(x["bands"][x["full"]].ravel().view(np.int64)))
                longs = [pa.array(a.view(np.int64)) for a in (x["s1"], x["s2"])]
                sketch = [pa.array(np.ascontiguousarray(x["sketch"][:, i]).view(np.int64)) for i in range(len(_SKETCH))]
                same = [batch.column(c).slice(block.first, block.rows) for c in ("doc_id", "version")]
                yield pa.record_batch([*same, pa.array(x["n"], pa.int64()), *longs, bands, *sketch], names=["doc_id", "version", "n_shingles", "s1", "s2", "bands", *_SKETCH])

    return versioned(docs).transform(shared.arrow, run, _STATS)


def versioned(docs: DataFrame) -> DataFrame:
    """``doc_id, version, text``."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))


def node_texts(nodes: DataFrame, wanted: DataFrame, docs: DataFrame, repeats: bool) -> DataFrame:
    """``node, text`` of the nodes wanted, each once also where its row ``repeats``."""
    ids = shared.checked_broadcast(shared.materialise(nodes.join(wanted.select("node").distinct(), "node").select("node", "doc_id", "version")))
    texts = versioned(docs).join(ids, ["doc_id", "version"]).select("node", "text")
    return texts.dropDuplicates(["node"]) if repeats else texts


def flips(left: str, right: str) -> Column:
    """Bits in which the sketches ``<left>_k0..`` and ``<right>_k0..`` differ."""
    total = F.lit(0)
    for k in _SKETCH:
        total = total + F.bit_count(F.col(f"{left}_{k}").bitwiseXOR(F.col(f"{right}_{k}")))
    return total


def _named(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(F.col("node").alias(name), F.col("n_shingles").alias(f"{name}_n"), *(F.col(k).alias(f"{name}_{k}") for k in _SKETCH))


def possible(left_n: Column, right_n: Column) -> Column:
    """Sizes that allow the threshold."""
    low, high = THRESHOLD
    return (high * F.least(left_n, right_n)) >= (low * F.greatest(left_n, right_n))


def confirm(pairs: DataFrame, texts_of) -> DataFrame:
    """Those pairs ``a, b`` whose full sets have the similarity asked for; ``texts_of`` gives ``node, text``.

    Every pair goes to a copy of the text of its ``b``; copies are dealt out by the size
    ``m`` of the bucket that the pair is from, so that each meets ``FAN`` others at most,
    about, and a task holds the set of one ``b`` at a time.
    """
    low, high = THRESHOLD
    dealt = shared.materialise(pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.ceil(F.col("m") / FAN)).alias("copy")))
    wanted = dealt.select(F.col("a").alias("node"), "b", "copy", F.lit(1).alias("role")).unionAll(dealt.select(F.col("b").alias("node"), "b", "copy", F.lit(0).alias("role")).distinct())
    rows = wanted.join(texts_of(wanted), "node").repartition("b", "copy").sortWithinPartitions("b", "copy", "role", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sets = None, []
        for batch in batches:
            b, copy, role, node = (batch.column(c).to_numpy() for c in ("b", "copy", "role", "node"))
            found_a, found_b = [], []
            for block in tk.blocks(batch.column("text")):
                g, at = tk.shingles(tk.words(block), block.rows)
                for r in range(block.rows):
                    i = block.first + r
                    own = g[at[r] : at[r + 1]]
                    if (b[i], copy[i]) != held:
                        held, sets = (b[i], copy[i]), []
                    if role[i] == 0:
                        sets.append(own.copy())
                        continue
                    for other in sets:
                        small, large = sorted((own, other), key=len)
                        if not len(small) or high * len(small) < low * len(large):
                            continue
                        where = np.minimum(np.searchsorted(large, small), len(large) - 1)
                        both = int((large[where] == small).sum())
                        if high * both >= low * (len(own) + len(other) - both):
                            found_a.append(node[i])
                            found_b.append(b[i])
                            break
            yield pa.record_batch([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return shared.materialise(rows.select("node", "b", "copy", "role", "text").transform(shared.arrow, run, "a long, b long").distinct())


_MEMBER = ["key", "band", "part", "sub", "role", "node", "own", "n_shingles", "bands", *_SKETCH]
_MEMBER_DDL = "key long, band int, part long, sub long, role int, node long, own long, n_shingles long, bands array<bigint>, " + ", ".join(f"{k} long" for k in _SKETCH)


class _Outliers:
    """The outliers of one group, which its members are compared with as they come by."""

    def __init__(self) -> None:
        self.columns: dict[str, np.ndarray] = {}
        self.sets: list[np.ndarray] = []

    def add(self, rows: dict[str, np.ndarray], sets: list[np.ndarray]) -> None:
        self.columns = {c: np.concatenate([self.columns[c], v]) if self.columns else v for c, v in rows.items()}
        self.sets += sets

    def likely(self, m: dict[str, np.ndarray], band: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices of members and outliers that sizes and sketches leave, in the first band that they share."""
        o, (low, high) = self.columns, THRESHOLD
        if not o:
            return np.zeros(0, int), np.zeros(0, int)
        n, k = m["n_shingles"][:, None], o["n_shingles"][None, :]
        ok = (high * np.minimum(n, k) >= low * np.maximum(n, k)) & (m["own"][:, None] != o["own"][None, :])
        x, y = np.nonzero(ok)
        differ = np.bitwise_count(m["sketch"][x] ^ o["sketch"][y]).sum(axis=1)
        x, y = x[differ <= MAX_FLIPS], y[differ <= MAX_FLIPS]
        first = (m["bands"][x] == o["bands"][y]).argmax(axis=1) == band
        return x[first], y[first]


def _groups(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[tuple[tuple, int, dict[str, np.ndarray], list[np.ndarray], pa.RecordBatch]]:
    """Runs of rows of one group and role, at most 512 at a time."""
    for whole in batches:
        for i in range(0, whole.num_rows, 512):
            batch = whole.slice(i, 512)
            at = {c: np.asarray(batch.column(c)) for c in ("key", "band", "part", "sub", "role", "node", "own", "n_shingles")}
            at["sketch"] = np.stack([np.asarray(batch.column(k)).view(np.uint64) for k in _SKETCH], axis=1)
            at["bands"] = np.asarray(batch.column("bands").flatten()).reshape(-1, BANDS)
            sets: list[np.ndarray] = []
            for block in tk.blocks(batch.column("text")) if texts else ():
                g, ends = tk.shingles(tk.words(block), block.rows)
                sets += [g[ends[r] : ends[r + 1]] for r in range(block.rows)]
            same = np.ones(batch.num_rows, dtype=bool)
            for c in ("key", "part", "sub", "role"):
                same[1:] &= at[c][1:] == at[c][:-1]
            cuts = [0, *np.flatnonzero(~same), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b:
                    yield (at["key"][a], at["part"][a], at["sub"][a]), int(at["role"][a]), {c: v[a:b] for c, v in at.items()}, sets[a:b], batch.slice(a, b - a)


def _active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes on the rows that have a likely partner in their group: no row twice."""
    held, outliers, kept, used = None, _Outliers(), [], np.zeros(0, bool)

    def flush() -> Iterator[pa.RecordBatch]:
        if kept and used.any():
            table = pa.Table.from_batches(kept).filter(pa.array(used))
            yield from table.combine_chunks().to_batches()

    for group, role, rows, _, batch in _groups(batches, False):
        if group != held:
            yield from flush()
            held, outliers, kept, used = group, _Outliers(), [], np.zeros(0, bool)
        if role == 0:
            outliers.add({c: rows[c] for c in ("own", "n_shingles", "sketch", "bands")}, [])
            kept.append(batch)
            used = np.concatenate([used, np.zeros(batch.num_rows, bool)])
            continue
        x, y = outliers.likely(rows, int(rows["band"][0]))
        used[y] = True
        mask = np.zeros(batch.num_rows, bool)
        mask[x] = True
        yield batch.filter(pa.array(mask))
    yield from flush()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join components within each group, confirmed on full sets."""
    low, high = THRESHOLD
    held, outliers, top = None, _Outliers(), {}

    def root(x: int) -> int:
        while (up := top.get(x, x)) != x:
            top[x] = x = top.get(up, up)
        return x

    for group, role, rows, sets, _ in _groups(batches, True):
        if group != held:
            held, outliers, top = group, _Outliers(), {}
        if role == 0:
            outliers.add({c: rows[c] for c in ("node", "own", "n_shingles", "sketch", "bands")}, [s.copy() for s in sets])
            continue
        found_a, found_b = [], []
        for x, y in zip(*outliers.likely(rows, int(rows["band"][0])), strict=True):
            p, q = root(int(rows["own"][x])), root(int(outliers.columns["own"][y]))
            if p == q:
                continue
            small, large = sorted((sets[x], outliers.sets[y]), key=len)
            where = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[where] == small).sum())
            if high * both >= low * (len(small) + len(large) - both):
                top[max(p, q)] = min(p, q)
                found_a.append(rows["node"][x])
                found_b.append(outliers.columns["node"][y])
        yield pa.record_batch([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])


def outlier_links(members: DataFrame, nodes: DataFrame, labels: DataFrame, texts_of) -> DataFrame | None:
    """Links of step 4; ``members`` are ``key, band, node, first`` of buckets of three or more.

    A bucket's outliers are dealt to parts of about ``LIST``, its members to ``SUB``;
    a group is one of each.  Sketches first leave the rows that have a likely
    partner; only these get their text.  A pair is looked at in the first band that
    its nodes share.
    """
    named = labels.select("node", "component")
    with_own = members.join(named, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("own"), "first")
    marked = with_own.join(named.select(F.col("node").alias("first"), F.col("component").alias("of_first")), "first", "left")
    marked = shared.materialise(marked.select("key", "band", "node", "own", (F.col("own") != F.coalesce("of_first", "first")).alias("out")))
    # hot buckets: the members stay where they are while the counts come to them
    counts = shared.checked_broadcast(shared.materialise(marked.groupBy("key").agg(F.count_if("out").alias("outliers"), F.count("*").alias("m")).filter("outliers > 0")))
    parts, subs = F.ceil(F.col("outliers") / LIST), F.ceil(F.col("m") / SUB)
    dealt = marked.join(counts, "key").select("key", "band", "node", "own", "out", parts.alias("parts"), subs.alias("subs"))
    number = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    hashed = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(n))
    lists = dealt.filter("out").select("key", "band", hashed(1, "parts").alias("part"), number("subs").alias("sub"), F.lit(0).alias("role"), "node", "own")
    others = dealt.select("key", "band", number("parts").alias("part"), hashed(2, "subs").alias("sub"), F.lit(1).alias("role"), "node", "own")
    rows = lists.unionAll(others).join(nodes.select("node", "n_shingles", "bands", *_SKETCH), "node").select(*_MEMBER)
    order = ("key", "part", "sub")
    active = shared.materialise(rows.repartition(*order).sortWithinPartitions(*order, "role").transform(shared.arrow, _active, _MEMBER_DDL))
    if active.isEmpty():
        return None
    found = active.join(texts_of(active), "node").repartition(*order).sortWithinPartitions(*order, "role").select(*_MEMBER, "text").transform(shared.arrow, _linked, "a long, b long")
    return shared.materialise(found.distinct())


def grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, version, n_shingles, least`` of every row.

    ``least`` is the smallest ``doc_id, version`` of the row's component; null without a
    doc_id or shingles.  ``version`` is the hash of the row's text.
    """
    stats = shared.materialise(measure(docs).withColumn("uid", F.monotonically_increasing_id()))
    full = stats.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    repeats = not full.groupBy("doc_id", "version").count().filter("count > 1").isEmpty()
    by_set = full.groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "version", "uid")).alias("x"), *(F.first(c).alias(c) for c in ("n_shingles", "bands", *_SKETCH)))
    nodes = shared.materialise(by_set.select("s1", "s2", F.col("x.uid").alias("node"), "x.doc_id", "x.version", "n_shingles", "bands", *_SKETCH))
    texts_of = lambda wanted: node_texts(nodes, wanted, docs, repeats)
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    first = buckets.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("m")).filter("m > 1")
    members = shared.materialise(buckets.join(first, "key").select("key", "band", "node", "first", "m"))
    pairs = members.filter("node <> first").groupBy(F.col("node").alias("a"), F.col("first").alias("b")).agg(F.max("m").alias("m"))
    likely = pairs.join(_named(nodes, "a"), "a").join(_named(nodes, "b"), "b").filter(possible(F.col("a_n"), F.col("b_n")) & (flips("a", "b") <= MAX_FLIPS))
    links = confirm(likely.select("a", "b", "m"), texts_of)
    labels = graph.components(links)
    empty = nodes.select("node", F.col("node").alias("component")).limit(0)
    more = outlier_links(members.filter("m > 2").drop("m"), nodes, empty if labels is None else labels, texts_of)
    if more is not None and not more.isEmpty():
        labels = graph.components(links.unionByName(more))
    own = F.struct("doc_id", "version")
    if labels is None:
        sets = nodes.select("s1", "s2", own.alias("least"))
    else:
        # only nodes that have links are moved to find the smallest id of their component
        ids = nodes.select("node", own.alias("own"))
        least = labels.join(ids, "node").groupBy("component").agg(F.min("own").alias("least"))
        sets = nodes.join(labels.join(shared.checked_broadcast(shared.materialise(least)), "component").select("node", "least"), "node", "left").select("s1", "s2", F.coalesce("least", own).alias("least"))
    sets = sets.withColumnsRenamed({"s1": "_s1", "s2": "_s2"})
    joined = stats.join(sets, (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2")), "left")
    return joined.select("doc_id", "version", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("least")).alias("least"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    return grouped(docs).select("doc_id", "n_shingles", F.coalesce("least.doc_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each group; all columns stay."""
    doc, version = shared.hidden("id"), shared.hidden("version")
    found = shared.materialise(grouped(docs).filter("least IS NOT NULL"))
    same = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("version") == F.col("least.version"))
    keys = lambda rows: shared.checked_broadcast(shared.materialise(rows.select(F.col("doc_id").alias(doc), F.col("version").alias(version)).distinct()))
    here = (F.col("doc_id").cast("long") == F.col(doc)) & (F.xxhash64(F.col("text").cast("string")) == F.col(version))
    out = docs.join(keys(found.filter(~same)), here, "left_anti")
    again = found.filter(same).groupBy("doc_id", "version").count().filter("count > 1")
    if again.isEmpty():
        return out
    again = keys(again)
    once = docs.join(again, here).dropDuplicates([doc, version]).select(*(F.col(f"`{c}`") for c in docs.columns))
    return out.join(again, here, "left_anti").unionAll(once)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + least(len(ws), 5) - 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS i FROM d WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * k >= 75 * (na.n + nb.n - k)
), r AS (
  SELECT doc_id, doc_id AS reach FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a
), c AS (
  SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.doc_id
"""
