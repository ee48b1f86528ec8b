"""Language identification by a string kernel with Nystroem landmarks.

The blended-spectrum presence kernel of two texts is the number of byte n-grams
(n = 1 to 3, letters only, hashed to ``BITS`` buckets) that both contain, divided by
the root of the product of their own numbers.  A bounded sample of labelled
documents gives landmarks; kernel values to the landmarks, whitened by the
landmarks' own kernel matrix, are the features of a one-versus-rest kernel ridge
regression.  Scoring a block of texts is two matrix products.

Texts are cut into stretches of ``SPAN`` bytes, each of which is scored, and a
document's values are the means over its stretches weighted by their letters, so
the whole of a long text counts and its presence sets do not fill up.

The fit takes about ``PER_LABEL`` whole texts of each language and ``FIT_BYTES`` at
most, picked by a hash of their id, and of their stretches, wherever they stand in the
texts, ``STRETCHES`` of each language and ``LANDMARKS`` as landmarks, picked by a hash of
what they hold.

Defined results: ``und`` with score 0 for a null text or one without a letter, and
for every text if no label can be learned from; ties go to the label that sorts
first; a null label is not learned from; repeated rows are predicted each and alike; a
text of any length is read whole; an empty table gives an empty result; further
columns, whatever their names, are not looked at.
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

BITS = 1 << 12
SPAN = 4096
#: Labelled documents of each language that a fit uses, about; bytes of them all; stretches and landmarks of each.
PER_LABEL, FIT_BYTES, STRETCHES, LANDMARKS = 600, 32 << 20, 2000, 40
RIDGE = 1e-2
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[np.arange(97, 123)] = np.arange(97, 123)
_FOLD[np.arange(65, 91)] = np.arange(97, 123)
_FOLD[np.arange(128, 256)] = np.arange(128, 256)


@dataclass(frozen=True)
class Model:
    labels: list[str]
    landmarks: np.ndarray  # BITS x landmarks, float32
    sizes: np.ndarray  # roots of the landmarks' own kernel values
    weights: np.ndarray  # landmarks x labels: whitening and ridge weights in one


def presence(block: tk.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Presence rows of the stretches of a block, the block's row and the letters of each."""
    data, rows = _FOLD[block.data], block.rows
    pieces = np.maximum(1, -(-np.diff(block.offsets) // SPAN))
    row = np.repeat(np.arange(rows), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = block.offsets[:-1][row] + nth * SPAN
    end = np.minimum(start + SPAN, block.offsets[1:][row])
    stretch = np.repeat(np.arange(len(row)), end - start)
    seen = np.zeros((len(row), BITS), dtype=bool)
    letter = data != 32
    letters = np.bincount(stretch[letter], minlength=len(row))
    pairs = data[:-1].astype(np.int64) << 8 | data[1:]
    keys = [data.astype(np.int64) << 24, (pairs << 24) + 1, (pairs[:-1] << 24) + data[2:].astype(np.int64) + 256] if len(data) else []
    for n, key in enumerate(keys, 1):
        if len(key):
            h = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
            first, last = stretch[: len(key)], stretch[n - 1 :]
            ok = first == last
            seen[first[ok], h[ok].astype(np.int64)] = True
    return seen, row, letters


def kernel_to(model_landmarks: np.ndarray, sizes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    own = np.sqrt(np.maximum(seen.sum(axis=1), 1)).astype(np.float32)
    return (seen.astype(np.float32) @ model_landmarks) / (own[:, None] * sizes[None, :])


def fit(texts: pa.Array, labels: list[str]) -> Model:
    """Nystroem landmarks and ridge weights from labelled texts."""
    seen, owner = [], []
    for block in tk.blocks(texts):
        s, row, n = presence(block)
        seen.append(np.packbits(s[n > 0], axis=1))
        owner.append(row[n > 0] + block.first)
    packed, owner = np.concatenate(seen), np.concatenate(owner)
    names = sorted({labels[i] for i in owner})
    y = np.array([names.index(labels[i]) for i in owner])
    draw = tk.mix((packed.view(np.uint64) * tk.mix(np.arange(1, packed.shape[1] // 8 + 1, dtype=np.uint64))).sum(axis=1))
    order = np.lexsort((draw, y))
    nth = np.arange(len(y)) - np.searchsorted(y[order], y[order])
    picked = order[nth < STRETCHES]
    x, y, nth = np.unpackbits(packed[picked], axis=1).astype(bool), y[picked], nth[nth < STRETCHES]
    marks = np.flatnonzero(nth < LANDMARKS)
    landmarks = x[marks].astype(np.float32).T.copy()
    sizes = np.sqrt(np.maximum(x[marks].sum(axis=1), 1)).astype(np.float32)
    own = kernel_to(landmarks, sizes, x[marks]).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    use = values > 1e-4 * values.max()
    whiten = vectors[:, use] / np.sqrt(values[use])
    phi = kernel_to(landmarks, sizes, x) @ whiten
    balance = 1.0 / np.bincount(y, minlength=len(names))[y]  # each language weighs the same
    target = np.where(y[:, None] == np.arange(len(names))[None, :], 1.0, 0.0)
    gram = phi.T @ (phi * balance[:, None]) + RIDGE * np.eye(phi.shape[1])
    weights = whiten @ np.linalg.solve(gram, phi.T @ (target * balance[:, None]))
    return Model(names, landmarks, sizes, weights.astype(np.float32))


def predict_block(model: Model, block: tk.Block) -> tuple[np.ndarray, np.ndarray]:
    """Index of the label (-1 for none) and score of each row."""
    seen, row, letters = presence(block)
    values = kernel_to(model.landmarks, model.sizes, seen) @ model.weights
    total = np.zeros((block.rows, len(model.labels)))
    np.add.at(total, row, values * letters[:, None])
    n = np.bincount(row, letters, minlength=block.rows)
    mean = total / np.maximum(n, 1)[:, None]
    best = mean.argmax(axis=1)
    score = np.clip(mean[np.arange(block.rows), best], 0, 1)
    for r in np.flatnonzero(_doubtful(block)):
        text = bytes(block.data[block.offsets[r] : block.offsets[r + 1]]).decode("utf-8", "replace")
        if not any(c.isalpha() for c in text):
            n[r] = 0
    best[n == 0], score[n == 0] = -1, 0
    return best, score


def _doubtful(block: tk.Block) -> np.ndarray:
    """Rows without an ASCII letter; whether they have another is looked up in their characters."""
    ascii_letter = (_FOLD[block.data] != 32) & (block.data < 128)
    return np.diff(np.concatenate([[0], np.cumsum(ascii_letter)])[block.offsets]) == 0


def train(docs: DataFrame, label: str = "lang", per_label: int = PER_LABEL) -> Model | None:
    """Fit on a bounded, hash-picked sample of the rows with a label."""
    table = shared.sample_texts(docs.filter(F.col(label).isNotNull()), {None: per_label}, FIT_BYTES, label)
    texts = shared.chunk_of(table["text"])
    if not any((_FOLD[block.data] != 32).any() for block in tk.blocks(texts)):
        return None
    return fit(texts, table["label"].to_pylist())


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        names = np.array([*(m.labels if m else []), "und"], dtype=object)
        for batch in batches:
            n = batch.num_rows
            best, score = np.full(n, -1), np.zeros(n)
            for block in tk.blocks(batch.column("text")) if m else ():
                rows = slice(block.first, block.first + block.rows)
                best[rows], score[rows] = predict_block(m, block)
            yield pa.record_batch([batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).transform(shared.arrow, run, "doc_id long, lang_pred string, score double")


def is_held_out(column: str = "doc_id"):
    return shared.id_remainder(column, 4) == 2


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.filter(~is_held_out()))
    return predict(docs, model).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
