"""Log-bilinear language model trained with noise-contrastive estimation.

Tokens are the words of a text and one end.  Words with enough training occurrences
(``LEAST``; the ``OWN`` most frequent) are items of their own, each with an output
vector r_w, a bias b_w and a context vector; all other words share items by their last
bytes, and the end has one.  The vocabulary of own words so grows with the corpus up
to ``OWN``.  The item w after the items x, y scores r_w . q + b_w with
q = C_1 e_y + C_2 e_x; the classes that items are dealt to (by frequency, about the root of
their number) score u_c . q + a_c.  Both are trained by telling corpus trigrams from noise
drawn from the corpus frequencies.

Training: the driver starts on a bounded, hash-picked sample of documents; from there
each partition of *all* training documents trains a copy on all of its tokens, and the
copies are averaged, each row weighted by how often a copy moved it.  Copies are added
up in a tree, so the driver gets few of them.  A corpus of few tokens is passed over
several times (``AIM``); from then on work grows with the corpus.

Scoring: products of all contexts' q with the class vectors, and with the item vectors
of the token's class, are normalised by their exact sums.  Within a shared item a word
has its smoothed share of the item's corpus count, so the probabilities of all known
words and one unknown word of each shared item sum to one.

Counts cover every training document.  The table of the most frequent words (about
``TABLE``) is sent to all tasks; the other tokens of a document, rare by construction,
meet their counts in a shuffled join, so no key of it is hot.

Defined results: a null or empty text is one end token; without training documents
every token is unknown; rows that repeat a doc_id are scored each; a text of any length
is scored whole, a block of rows at a time; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import shared
from folio.llm import textkernel as tk

#: Most words with vectors of their own, training occurrences that such a word needs, items shared by word endings.
OWN, LEAST, SHARED = 8000, 30, 32
#: Entries of the table of counts that is sent to all tasks, about.
TABLE = 1 << 17
#: Dimensions, tokens of a step, noise words and noise classes of a step.
WIDTH, BATCH, NOISE, NOISE_CLASSES = 24, 4096, 32, 16
#: Documents and bytes of the sample that training starts on, at most about; tokens that training sees at least.
START_DOCS, START_BYTES, AIM = 2000, 8 << 20, 4_000_000
RATE, LATE_RATE = 0.1, 0.04
#: Tokens that are dealt to classes at a time, and rows of one product.
CHUNK, PRODUCT = 1 << 16, 4096
_U = np.uint64
END = _U(0x1F83D9ABFB41BD6B)


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the frequent words by hash; items; corpus size."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray
    own: np.ndarray  # sorted hashes of the words with an item of their own
    item_counts: np.ndarray  # training tokens of each item: own words, shared items, the end
    slots: np.ndarray  # training tokens and types and one more, of each shared item
    tokens: int  # N
    types: int  # V

    @property
    def denominator(self) -> int:
        return self.tokens + self.types + 1

    @property
    def items(self) -> int:
        return len(self.own) + SHARED + 1

    @property
    def end(self) -> int:
        return len(self.own) + SHARED

    @property
    def start(self) -> int:
        """The context of the places before a text."""
        return self.items

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Items in the order of their classes (the most frequent first), and where each class begins."""
        order = np.lexsort((np.arange(self.items), -self.item_counts))
        size = int(np.ceil(np.sqrt(self.items)))
        return order, np.append(np.arange(0, self.items, size), self.items)


@dataclass
class Parameters:
    """Vectors by row; ``words`` and ``class_vectors`` have their bias in the last column."""

    context: np.ndarray  # (items + 1) x d
    words: np.ndarray  # items x (d + 1)
    class_vectors: np.ndarray  # classes x (d + 1)
    mix: np.ndarray  # 2d x d: C_1 over C_2

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.words, self.class_vectors, self.mix]

    def copy(self) -> Parameters:
        return Parameters(*(p.copy() for p in self.parts()))


def tokens(block: tk.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, ending (-1 for the end) and row of every token; each row has its end last."""
    w = tk.words(block)
    n = len(w.start) + block.rows
    at = np.arange(len(w.start)) + w.row
    ends = w.first[1:] + np.arange(block.rows)
    hashes, ending = np.empty(n, _U), np.full(n, -1, np.int8)
    hashes[at], hashes[ends] = w.hash, END
    ending[at] = (w.hasher(np.maximum(w.end - 2, w.start), w.end) & _U(SHARED - 1)).astype(np.int8)
    row = np.empty(n, np.int32)
    row[at], row[ends] = w.row, np.arange(block.rows)
    return hashes, ending, row


def find(sorted_hashes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index of each hash, or -1."""
    if not len(sorted_hashes):
        return np.full(len(hashes), -1, np.int32)
    i = np.minimum(np.searchsorted(sorted_hashes, hashes), len(sorted_hashes) - 1).astype(np.int32)
    return np.where(sorted_hashes[i] == hashes, i, np.int32(-1))


def items_of(v: Vocabulary, hashes: np.ndarray, ending: np.ndarray) -> np.ndarray:
    i = find(v.own, hashes)
    return np.where(ending < 0, np.int32(v.end), np.where(i >= 0, i, len(v.own) + ending.astype(np.int32)))


def contexts(v: Vocabulary, item: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The item before each token, and the one before that."""
    near, far = np.full(len(item), v.start, np.int32), np.full(len(item), v.start, np.int32)
    near[1:] = np.where(row[1:] == row[:-1], item[:-1], v.start)
    far[2:] = np.where(row[2:] == row[:-2], item[:-2], v.start)
    return near, far


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def count_words(docs: DataFrame) -> DataFrame:
    """``hash, ending, c``: corpus counts of every token of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tk.blocks(batch.column("text")):
                h, ending, _ = tokens(block)
                unique, at, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.record_batch([pa.array(unique.view(np.int64)), pa.array(ending[at]), pa.array(n.astype(np.int32))], names=["hash", "ending", "c"])

    return _texts(docs).transform(shared.arrow, run, "hash long, ending byte, c int").groupBy("hash", "ending").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (sorted), endings and counts of about ``most`` words that are counted ``least`` times or more.

    Whole levels of frequency, eight to an octave, and of the first that does not fit
    the part that a hash picks: so it never comes out empty, and ties need no sort.
    """
    found = counts.filter((F.col("ending") >= 0) & (F.col("c") >= least)).withColumn("level", F.floor(F.log2("c") * 8))
    kept, lowest, share = 0, None, 0
    for level, n in sorted(((r[0], r[1]) for r in found.groupBy("level").count().collect()), reverse=True):
        lowest, share = level, min(1 << 20, (most - kept) * (1 << 20) // n)
        kept += n
        if kept >= most:
            break
    if lowest is None:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    part = found.filter((F.col("level") > lowest) | ((F.col("level") == lowest) & (F.pmod(F.xxhash64("hash"), F.lit(1 << 20)) < share)))
    table = part.select("hash", "ending", "c").toArrow()
    h, ending, c = (table[x].to_numpy() for x in ("hash", "ending", "c"))
    order = np.argsort(h.view(_U))
    return h.view(_U)[order], ending[order].astype(np.int64), c[order]


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the materialised counts; what comes to the driver is bounded by ``TABLE`` and ``OWN``."""
    total = counts.agg(F.sum("c"), F.count("*"), F.sum(F.when(F.col("ending") < 0, F.col("c")))).first()
    hashes, _, c = frequent(counts, TABLE)
    own, endings, own_c = frequent(counts, OWN, LEAST)
    hashes, at = np.unique(np.concatenate([hashes, own]), return_index=True)  # own words are always in the table
    c = np.concatenate([c, own_c])[at]
    in_shared, slots = np.zeros(SHARED, np.int64), np.ones(SHARED, np.int64)
    for e, n, v in counts.filter("ending >= 0").groupBy("ending").agg(F.sum("c"), F.count("*")).collect():
        in_shared[e] += n
        slots[e] += n + v
    np.subtract.at(in_shared, endings, own_c)
    np.subtract.at(slots, endings, own_c + 1)
    return Vocabulary(hashes, c, own, np.concatenate([own_c, in_shared, [total[2] or 0]]).astype(np.int64), slots, int(total[0] or 0), int(total[1]))


class Trainer:
    """Noise-contrastive steps with Adagrad on one copy of the parameters."""

    def __init__(self, v: Vocabulary, p: Parameters, squares: list[np.ndarray], seed: int, rate: float) -> None:
        self.v, self.p, self.squares, self.rate = v, p, squares, rate
        self.rng = np.random.default_rng(seed)
        order, bounds = v.classes()
        self.class_of = np.empty(v.items, np.int32)
        self.class_of[order] = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        unigram = v.item_counts + 1.0
        unigram /= unigram.sum()
        of_classes = np.bincount(self.class_of, unigram)
        self.levels = [(np.cumsum(q), np.log(q * k).astype(np.float32), k) for q, k in ((unigram, NOISE), (of_classes, NOISE_CLASSES))]
        self.small = np.uint16 if v.items < 1 << 16 else np.int32
        self.moved = [np.zeros(len(x)) for x in p.parts()]
        self.steps = 0

    def _move(self, which: int, index: np.ndarray, grads: np.ndarray) -> None:
        """Adagrad on the rows that have a gradient; their gradients are summed first."""
        order = np.argsort(index.astype(self.small), kind="stable")  # of 16 bits: sorted by counting
        index = index[order]
        at = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
        rows, total = index[at], np.add.reduceat(grads[order], at, axis=0)
        square = self.squares[which][rows] + total * total
        self.squares[which][rows] = square
        self.p.parts()[which][rows] += self.rate * total / np.sqrt(square)
        self.moved[which][rows] += np.diff(np.append(at, len(index)))

    def step(self, near: np.ndarray, far: np.ndarray, item: np.ndarray) -> None:
        p, n = self.p, len(item)
        both = np.concatenate([p.context[near], p.context[far]], axis=1)
        q = both @ p.mix
        dq = np.zeros_like(q)
        for which, vectors, y, (ends, log_kq, k) in zip((1, 2), (p.words, p.class_vectors), (item, self.class_of[item]), self.levels, strict=True):
            drawn = np.minimum(np.searchsorted(ends, self.rng.random(k)), len(ends) - 1)
            mine, noise = vectors[y], vectors[drawn]
            true = np.einsum("ij,ij->i", q, mine[:, :-1]) + mine[:, -1] - log_kq[y]
            fake = q @ noise[:, :-1].T + (noise[:, -1] - log_kq[drawn])
            gt = 1 / (1 + np.exp(np.minimum(true, 60))) / n
            gf = -1 / (1 + np.exp(np.minimum(-fake, 60))) / n
            dq += gt[:, None] * mine[:, :-1] + gf @ noise[:, :-1]
            grads = np.empty((n + k, q.shape[1] + 1), np.float32)
            np.multiply(q, gt[:, None], out=grads[:n, :-1])
            grads[n:, :-1] = gf.T @ q
            grads[:n, -1], grads[n:, -1] = gt, gf.sum(0)
            self._move(which, np.concatenate([y, drawn]), grads)
        back = dq @ p.mix.T
        d = q.shape[1]
        self._move(3, np.arange(2 * d), both.T @ dq)
        self._move(0, np.concatenate([near, far]), np.concatenate([back[:, :d], back[:, d:]]))
        self.steps += 1

    def block(self, block: tk.Block) -> int:
        """One pass over the tokens of a block, drawn without regard to their order; their number."""
        h, ending, row = tokens(block)
        item = items_of(self.v, h, ending)
        near, far = contexts(self.v, item, row)
        order = self.rng.permutation(len(item))
        for i in range(0, len(order), BATCH):
            at = order[i : i + BATCH]
            self.step(near[at], far[at], item[at])
        return len(item)


def fresh(v: Vocabulary, d: int = WIDTH) -> tuple[Parameters, list[np.ndarray]]:
    """Parameters before training, and Adagrad's sums: biases are log frequencies."""
    rng = np.random.default_rng(11)
    order, bounds = v.classes()
    unigram = v.item_counts + 1.0
    unigram /= unigram.sum()
    small = lambda n, scale: (rng.standard_normal((n, d)) * scale).astype(np.float32)
    biased = lambda x, b: np.concatenate([x, np.log(b)[:, None].astype(np.float32)], axis=1)
    p = Parameters(small(v.items + 1, 0.1), biased(small(v.items, 0.1), unigram), biased(small(len(bounds) - 1, 0.1), np.add.reduceat(unigram[order], bounds[:-1])), np.concatenate([np.eye(d, dtype=np.float32), 0.5 * np.eye(d, dtype=np.float32)]))
    return p, [np.full(x.shape, 1e-7, np.float32) for x in p.parts()]


def start(docs: DataFrame, v: Vocabulary) -> tuple[Parameters, list[np.ndarray], int]:
    """Parameters, Adagrad's sums and tokens seen, after training on a bounded sample of documents."""
    p, squares = fresh(v)
    column = shared.chunk_of(shared.sample_texts(docs, {None: START_DOCS}, START_BYTES)["text"])
    trainer, seen = Trainer(v, p, squares, 3, RATE), 0
    with shared.one_blas_thread():
        while len(column):
            before = seen
            for block in tk.blocks(column):
                seen += trainer.block(block)
            if seen >= AIM // 4 or seen + (seen - before) > AIM:
                break
    return p, squares, seen


def _packed(moved: list[np.ndarray], parts: list[np.ndarray]) -> list[bytes]:
    """The rows that moved, times how often: number, index, weights, values of each part."""
    out = []
    for n, x in zip(moved, parts, strict=True):
        rows = np.flatnonzero(n)
        out.append(b"".join([np.int64(len(rows)).tobytes(), rows.astype(np.int32).tobytes(), n[rows].tobytes(), (x[rows] * n[rows][:, None]).astype(np.float32).tobytes()]))
    return out


class Sums:
    """Weighted sums of copies of the parameters."""

    def __init__(self, shapes: list[tuple[int, int]]) -> None:
        self.weights = [np.zeros(n) for n, _ in shapes]
        self.values = [np.zeros(s, np.float64) for s in shapes]

    def add(self, blobs: list[bytes]) -> None:
        for weight, value, blob in zip(self.weights, self.values, blobs, strict=True):
            n = int(np.frombuffer(blob, np.int64, 1)[0])
            rows = np.frombuffer(blob, np.int32, n, 8)
            weight[rows] += np.frombuffer(blob, np.float64, n, 8 + 4 * n)
            value[rows] += np.frombuffer(blob, np.float32, -1, 8 + 12 * n).reshape(n, value.shape[1])

    def blobs(self) -> list[bytes]:
        out = []
        for weight, value in zip(self.weights, self.values, strict=True):
            rows = np.flatnonzero(weight)
            out.append(b"".join([np.int64(len(rows)).tobytes(), rows.astype(np.int32).tobytes(), weight[rows].tobytes(), value[rows].astype(np.float32).tobytes()]))
        return out


_COPY = "context binary, words binary, class_vectors binary, mix binary"


def train(docs: DataFrame, v: Vocabulary) -> Parameters:
    """Parameters from all rows of ``docs``; see above."""
    p, squares, seen = start(docs, v)
    if not v.tokens:
        return p
    passes = max(1, round((AIM - seen) / v.tokens))
    shipped = docs.sparkSession.sparkContext.broadcast((v, p, squares))
    shapes = [x.shape for x in p.parts()]

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, p, squares = shipped.value
        trainer = Trainer(v, p.copy(), [s.copy() for s in squares], 5, LATE_RATE)
        with shared.one_blas_thread():
            for batch in batches:
                for block in tk.blocks(batch.column("text")):
                    for _ in range(passes):
                        trainer.block(block)
        if trainer.steps:
            yield pa.record_batch([pa.array([b], pa.binary()) for b in _packed(trainer.moved, trainer.p.parts())], names=[c.split()[0] for c in _COPY.split(", ")])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, some = Sums(shapes), False
        for batch in batches:
            for i in range(batch.num_rows):
                sums.add([c[i].as_py() for c in batch.columns])
                some = True
        if some:
            yield pa.record_batch([pa.array([b], pa.binary()) for b in sums.blobs()], names=batch.schema.names)

    made = _texts(docs).transform(shared.arrow, copies, _COPY)
    groups = int(np.ceil(np.sqrt(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    table = made.repartition(groups).transform(shared.arrow, added, _COPY).toArrow()
    sums = Sums(shapes)
    for row in zip(*(table[c] for c in table.column_names), strict=True):
        sums.add([x.as_py() for x in row])
    for x, weight, value in zip(p.parts(), sums.weights, sums.values, strict=True):
        rows = np.flatnonzero(weight)
        x[rows] = value[rows] / weight[rows][:, None]
    return p


def log_normalised(q: np.ndarray, vectors: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row of ``q @ vectors`` at ``y``."""
    out = np.empty(len(q), np.float32)
    for i in range(0, len(q), PRODUCT):
        z = q[i : i + PRODUCT] @ vectors
        own = z[np.arange(len(z)), y[i : i + PRODUCT]]
        if z.max() > 60:  # else no sum can overflow
            top = z.max(axis=1)
            z -= top[:, None]
            own -= top
        np.exp(z, out=z)
        out[i : i + PRODUCT] = own - np.log(z.sum(axis=1))
    return out


class Scorer:
    """Normalised log10 probabilities of items after contexts."""

    def __init__(self, v: Vocabulary, p: Parameters) -> None:
        d = p.mix.shape[1]
        # the biases meet a column of ones
        ones = np.ones((len(p.context), 1), np.float32)
        self.near = np.concatenate([p.context @ p.mix[:d], ones], axis=1)
        self.far = np.concatenate([p.context @ p.mix[d:], 0 * ones], axis=1)
        self.order, self.bounds = v.classes()
        self.class_of, self.place = np.empty(v.items, np.int32), np.empty(v.items, np.int32)
        self.class_of[self.order] = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        self.place[self.order] = np.arange(v.items) - np.repeat(self.bounds[:-1], np.diff(self.bounds))
        self.inside = [p.words[self.order[a:b]].T.copy() for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True)]
        self.top = p.class_vectors.T.copy()
        self.own, self.log_counts = np.full(len(v.hashes), -1, np.int32), np.log10(v.counts + 1.0)
        self.own[find(v.hashes, v.own)] = np.arange(len(v.own))

    def __call__(self, near: np.ndarray, far: np.ndarray, item: np.ndarray) -> np.ndarray:
        out = np.empty(len(item), np.float64)
        for i in range(0, len(item), CHUNK):
            out[i : i + CHUNK] = self._chunk(near[i : i + CHUNK], far[i : i + CHUNK], item[i : i + CHUNK])
        return out / np.log(10)

    def _chunk(self, near: np.ndarray, far: np.ndarray, item: np.ndarray) -> np.ndarray:
        of = self.class_of[item]
        order = np.argsort(of.astype(np.uint16), kind="stable")
        of, q = of[order], self.near[near[order]] + self.far[far[order]]
        found, place = log_normalised(q, self.top, of), self.place[item[order]]
        cuts = np.searchsorted(of, np.arange(len(self.bounds)))
        for c in np.flatnonzero(np.diff(cuts)):
            here = slice(cuts[c], cuts[c + 1])
            found[here] += log_normalised(q[here], self.inside[c], place[here])
        out = np.empty(len(item), np.float32)
        out[order] = found
        return out


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_table long, log_all double, log_shared double, log_slots double, log_items double, rest array<bigint>, rest_n array<int>"


def score_parts(docs: DataFrame, v: Vocabulary, p: Parameters, held_out: Column) -> DataFrame:
    """The sums that a row's scores are made of, and the tokens whose counts are not in the table."""
    shipped = docs.sparkSession.sparkContext.broadcast((v, p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, p = shipped.value
        with shared.one_blas_thread():
            scorer = Scorer(v, p)
            for batch in batches:
                for block in tk.blocks(batch.column("text")):
                    yield scored(v, scorer, batch, block)

    def scored(v: Vocabulary, scorer: Scorer, batch: pa.RecordBatch, block: tk.Block) -> pa.RecordBatch:
        h, ending, row = tokens(block)
        i = find(v.hashes, h)
        own = np.append(scorer.own, np.int32(-1))[i]  # the last for words that are not in the table
        item = np.where(ending < 0, np.int32(v.end), np.where(own >= 0, own, len(v.own) + ending.astype(np.int32)))
        total = lambda x: np.bincount(row, x, minlength=block.rows)
        ends = ending < 0
        known = i >= 0
        logs = np.where(ends, np.log10(v.item_counts[v.end] + 1.0), np.append(scorer.log_counts, 0.0)[i])
        known |= ends & bool(v.item_counts[v.end])
        inner = (item >= len(v.own)) & ~ends
        slots = np.where(inner, np.log10(v.slots)[np.clip(item - len(v.own), 0, SHARED - 1)], 0.0)
        lm = scorer(*contexts(v, item, row), item)
        # distinct tokens outside the table, by row
        out = np.flatnonzero((i < 0) & ~ends)
        order = out[np.lexsort((h[out], row[out]))]
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
        begins = np.flatnonzero(new)
        times = np.diff(np.append(begins, len(order))).astype(np.int32)
        cuts = pa.array(np.searchsorted(row[order][begins], np.arange(block.rows + 1)).astype(np.int32))
        rest = pa.ListArray.from_arrays(cuts, pa.array(h[order][begins].view(np.int64)))
        rest_n = pa.ListArray.from_arrays(cuts, pa.array(times))
        here = lambda c: batch.column(c).slice(block.first, block.rows)
        sums = [total(logs), total(np.where(inner, logs, 0.0)), total(slots), total(lm)]
        return pa.record_batch([here("doc_id"), here("held_out"), pa.array(total(None).astype(np.int64)), pa.array(total(known).astype(np.int64)), *(pa.array(s, pa.float64()) for s in sums), rest, rest_n], names=[x.split()[0] for x in _SCORED.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text")).transform(shared.arrow, run, _SCORED)


@dataclass(frozen=True)
class Model:
    counts: DataFrame  # of all training tokens, in the shared folder
    vocabulary: Vocabulary
    parameters: Parameters


def fit(training: DataFrame) -> Model:
    counts = shared.materialise(count_words(training))
    v = vocabulary(counts)
    return Model(counts, v, train(training, v))


def score_with(model: Model, docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    v = model.vocabulary
    parts = shared.materialise(score_parts(docs, v, model.parameters, held_out).withColumn("uid", F.monotonically_increasing_id()))
    rest = parts.select("uid", F.explode(F.arrays_zip("rest", "rest_n")).alias("x")).select("uid", F.col("x.rest").alias("hash"), F.col("x.rest_n").alias("n"))
    met = rest.join(model.counts.select("hash", "c"), "hash")  # a token without a count adds log10(1)
    sums = met.groupBy("uid").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rest_log"), F.sum("n").alias("rest_known"))
    joined = parts.drop("rest", "rest_n").join(sums, "uid", "left")
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_table") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("log_all") + rest_log - F.col("n_tokens") * F.log10(F.lit(float(v.denominator)))).alias("base_score"),
        (F.col("log_items") + F.col("log_shared") + rest_log - F.col("log_slots")).alias("score"),
    )


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """``score_with`` a model of the rows not held out."""
    return score_with(fit(docs.filter(~held_out)), docs, held_out)


def base_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and base scores alone, learned from all documents: the part that SQL can say."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counts = shared.materialise(count_words(docs))
    v = vocabulary(counts)
    found = score_with(Model(counts, v, fresh(v)[0]), docs, F.lit(False))
    return found.select("doc_id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"))


BASE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_append(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> ''), chr(10)) AS ws
  FROM documents
), t AS (
  SELECT doc_id, unnest(ws) AS w FROM d
), c AS (
  SELECT w, count(*) AS c FROM t GROUP BY w
), n AS (
  SELECT sum(c) AS n, count(*) AS v FROM c
)
SELECT doc_id, count(*) AS n_tokens, count(*) AS n_known, CAST(any_value(n) AS BIGINT) AS train_tokens,
       round(sum(log10((c + 1) / (n + v + 1))), 6) AS base_score
FROM t JOIN c ON t.w = c.w CROSS JOIN n GROUP BY doc_id
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, shared.id_remainder("doc_id", 7) == 2)
