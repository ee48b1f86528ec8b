"""Toxicity by multiple-instance learning.

Only documents carry labels.  A sentence has the probability sigmoid(b + sum of
the weights of its features); a document is toxic if any sentence is, so its
probability is the noisy-or 1 - prod(1 - p).  The weights maximise the likelihood
of the document labels, and the sentence probabilities then tell where a document
offends.  Features are the hashes of words and of their first bytes, which also
meet words that share a stem.

The fit takes at most about ``per_class`` labelled documents of each class, picked
by a hash of their id, and ``FIT_BYTES`` of whole texts (documented bounds); scoring
covers whole texts of any length, block by block, without a shuffle.

Defined results: null and empty texts have no sentences and score 0; without
labels of both classes all scores are 0; of several labels of a document the
larger counts; repeated rows are scored each and alike; a score of exactly
``THRESHOLD`` is toxic; an empty table gives an empty result; further columns of the
input, whatever their names, are kept or not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm import shared
from folio.llm import textkernel as tk

#: Buckets of the feature hash, and lengths in bytes of the word beginnings used.
BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6, 7)
#: Labelled documents of each class that a fit uses at most, about.
PER_CLASS = {0: 2000, 1: 1200}
#: Bytes of text that a fit uses at most.
FIT_BYTES = 32 << 20
THRESHOLD = 0.7
_STOP = np.zeros(256, dtype=np.int64)
_STOP[[10, 33, 46, 63]] = 1  # newline ! . ?


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32 by bucket
    bias: float


def sentence_features(block: tk.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, tk.Words]:
    """Features by word (one column each), sentence of each word, row of each sentence, the words."""
    w = tk.words(block, separators=tk.NON_WORD)
    number = np.cumsum(_STOP[block.data])[w.start] if len(w.start) else np.zeros(0, np.int64)
    new = np.ones(len(w.start), dtype=bool)
    new[1:] = (number[1:] != number[:-1]) | (w.row[1:] != w.row[:-1])
    sentence = np.cumsum(new) - 1
    columns = [w.hash]
    for n in BEGINNINGS:
        beginning = w.hasher(w.start, np.minimum(w.start + n, w.end)) + np.uint64(n)
        columns.append(np.where(w.end - w.start > n, tk.mix(beginning), np.uint64(0)))
    features = (np.stack(columns, axis=1) & np.uint64(BUCKETS - 1)).astype(np.int32) if len(w.start) else np.zeros((0, len(columns)), np.int32)
    return features, sentence, w.row[new], w


def fit(texts: pa.Array, labels: np.ndarray, steps: int = 120, rate: float = 0.5, penalty: float = 5e-4) -> Model:
    """Noisy-or likelihood of the document labels, climbed by proximal Adagrad with an L1 penalty."""
    found, rows, n_sent = [], [], 0
    spread = np.zeros(BUCKETS, np.int32)
    for block in tk.blocks(texts):
        f, s, row, _ = sentence_features(block)
        pair = np.unique((s[:, None] * BUCKETS + f).ravel())  # a feature counts once in a sentence
        if len(pair):
            spread += np.bincount(np.unique(row[pair // BUCKETS] * BUCKETS + pair % BUCKETS) % BUCKETS, minlength=BUCKETS).astype(np.int32)
        found.append((n_sent, pair))
        rows.append((row + block.first).astype(np.int32))
        n_sent += len(row)
    # features of fewer than 3 documents tell nothing about others
    seen = np.flatnonzero(spread >= 3)
    seen = seen[seen != 0]
    index = np.full(BUCKETS, -1, np.int32)
    index[seen] = np.arange(len(seen))
    s, f, row = [], [], np.concatenate(rows)
    for first, pair in found:
        column = index[pair % BUCKETS]
        s.append((pair[column >= 0] // BUCKETS + first).astype(np.int32))
        f.append(column[column >= 0])
    del found
    s, f = np.concatenate(s), np.concatenate(f)
    y = labels.astype(bool)
    least = penalty + 0.5 / len(y)  # about the pull of a document: what chance words have
    w, b = np.zeros(len(seen)), -7.0
    gw, gb = np.full(len(seen), 1e-6), 1e-6
    for step in range(steps):
        if step == steps // 2:  # from here on without the penalty, for the features that it left
            least, alive = 0.0, w != 0
            keep = alive[f]
            s, f = s[keep], f[keep]
        z = b + np.bincount(s, w[f], minlength=n_sent)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.bincount(row, -np.logaddexp(0, z), minlength=len(y))  # log of no toxic sentence
        some = np.maximum(-np.expm1(none), 1e-12)
        slope = np.where(y, np.exp(none) / some, -1.0)
        dz = slope[row] * p
        dw = np.bincount(f, dz[s], minlength=len(seen)) / len(y)
        db = dz.sum() / len(y)
        gw += dw * dw
        gb += db * db
        w += rate * dw / np.sqrt(gw)
        b += rate * db / np.sqrt(gb)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * least / np.sqrt(gw), 0)
    weights = np.zeros(BUCKETS, np.float32)
    weights[seen] = w
    return Model(weights, float(b))


def score_block(model: Model, block: tk.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, tk.Words, np.ndarray]:
    """Document scores; logits, rows of sentences; words and the sentence of each."""
    f, sentence, row, w = sentence_features(block)
    # a feature counts once in a sentence
    pair = np.unique(sentence[:, None].repeat(f.shape[1], 1).ravel() * BUCKETS + f.ravel()) if len(f) else np.zeros(0, np.int64)
    pair = pair[model.weights[pair % BUCKETS] != 0]
    z = model.bias + np.bincount(pair // BUCKETS, model.weights[pair % BUCKETS], minlength=len(row))
    none = np.bincount(row, -np.logaddexp(0, z), minlength=block.rows)
    return -np.expm1(none), z, row, w, sentence


def train(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] | None = None) -> Model:
    """Fit on the labelled rows of ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``)."""
    per_class = per_class or PER_CLASS
    marks = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return Model(np.zeros(BUCKETS, np.float32), -30.0)
    # few marks are picked first, so that only their texts are looked for
    draw = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 20))
    share = F.when(F.col("toxic") == 1, int((1 << 20) * per_class[1] / counts[1]) + 1).otherwise(int((1 << 20) * per_class[0] / counts[0]) + 1)
    chosen = shared.checked_broadcast(shared.materialise(marks.filter(draw < share)))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id").select("doc_id", "toxic", "text")
    table = shared.sample_texts(texts, {None: 2 * max(per_class.values())}, FIT_BYTES, "toxic")
    if table.num_rows == 0:
        return Model(np.zeros(BUCKETS, np.float32), -30.0)
    return fit(shared.chunk_of(table["text"]), np.array(table["label"].to_pylist()).astype(int))


def score(docs: DataFrame, model: Model, *keep: str, name: str = "score") -> DataFrame:
    """The columns named and, as ``name``, the score of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    keep = tuple(docs.columns[docs.columns.index(k)] for k in keep)
    schema = T.StructType([*docs.select(*(F.col(f"`{k}`") for k in keep)).schema, T.StructField(name, T.DoubleType())])
    text = keep.index("text") if "text" in keep else len(keep)
    extra = [] if "text" in keep else [F.col("text").cast("string").alias(shared.hidden("text"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            scores = [score_block(m, b)[0] for b in tk.blocks(batch.column(text))]
            found = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.record_batch([*(batch.column(i) for i in range(len(keep))), found], names=[*keep, name])

    return docs.select(*(F.col(f"`{k}`") for k in keep), *extra).transform(shared.arrow, run, schema)


def locate(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``doc_id, sentence, score``: the sentences whose own probability is ``least`` or more."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            ids, sentences, scores = [], [], []
            for block in tk.blocks(batch.column("text")):
                _, z, row, w, sentence = score_block(m, block)
                p = 1 / (1 + np.exp(-z))
                for k in np.flatnonzero(p >= least):
                    words = np.flatnonzero(sentence == k)
                    ids.append(batch.column("doc_id")[block.first + int(row[k])].as_py())
                    sentences.append(bytes(block.data[w.start[words[0]] : w.end[words[-1]]]).decode("utf-8", "replace"))
                    scores.append(float(p[k]))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sentences, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "sentence", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).transform(shared.arrow, run, "doc_id long, sentence string, score double")


def is_held_out(column: str = "doc_id"):
    return shared.id_remainder(column, 3) == 1


def train_for(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the query and the pipeline: never sees a label of a held-out document."""
    return train(docs, labels.filter(~is_held_out()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train_for(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model, "doc_id")
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
