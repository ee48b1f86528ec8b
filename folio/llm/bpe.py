"""Byte-level BPE by dynamic programming over byte prefixes.

For every prefix of a piece exactly one token can end the encoding of that
prefix.  ``PrefixTable`` stores that last token per prefix, found by trying the
tokens that end there, shortest first, against the last token of what remains:
a sequence of tokens is an encoding exactly when every two neighbours are one.
So appending only adds entries, and after an edit the table is filled from the
edit on until it runs in step with the old one again.

Work for a piece is linear in its bytes times the longest token, whatever the
text; there is no quadratic case for long runs without white space.

Defined results: a null or empty text has no tokens and decodes to nothing;
repeated rows are encoded each; a text of any length is encoded whole; an empty table
gives an empty result; further columns, whatever their names, are kept where they are
named and else not looked at.
"""

from __future__ import annotations

import base64
import contextlib
import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm import shared
from folio.llm import textkernel as tk

#: Entries of each of the two generations of a worker's cache; fewer where the worker's executor is full of other things.
CACHE_ENTRIES, SMALL_CACHE = 350_000, 100_000
#: Neighbours that a worker remembers.
PAIRS = 500_000
#: Lengths in bytes at which the table of a longer piece is kept for others that begin alike.
PREFIXES = (12, 9, 7, 5)
#: White_Space of Unicode, as patterns of tokenizers understand it.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pattern whose pieces never have white space behind other characters.
CUT_BEFORE_WHITE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Vocabulary:
    """Ranks of byte strings and which pairs of tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        # a token that its own bytes do not encode to can never appear
        self.usable = {t: r for t, r in ranks.items() if len(t) == 1 or self.merged(t) == [t]}
        # tokens by their bytes from the last to the first: by byte, the id of what is read so far (or -1) and what may come before
        nodes: dict[bytes, dict] = {b"": {}}
        for token in sorted(self.usable, key=len):
            for i in range(len(token) - 1, -1, -1):
                part, rest = token[i:], token[i + 1 :]
                if part not in nodes:
                    nodes[part] = {}
                    nodes[rest][part[0]] = (self.usable.get(part, -1), nodes[part])
        self.from_end = nodes[b""]
        self.reach = max(map(len, self.usable), default=0)
        self.pairs: dict[int, bool] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    ranks[base64.b64decode(token)] = int(rank)
        return cls(ranks)

    def merged(self, data: bytes) -> list[bytes]:
        """Plain BPE of a few bytes: merge the pair of lowest rank, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def neighbours(self, left: int, right: int) -> bool:
        """Whether these two tokens are the encoding of their joined bytes."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            a, b = self.bytes_of[left], self.bytes_of[right]
            known = self.pairs[key] = self.merged(a + b) == [a, b]
        return known


def fill(v: Vocabulary, data: bytes, last: list[int], in_step: tuple[list[int], int, int] | None = None) -> None:
    """Extend ``last``, the last tokens of the prefixes of ``data``, to all of them.

    ``in_step`` holds an older table, the shift of its positions and the position
    after an edit; once ``reach`` entries in a row beyond it equal the old ones,
    all later entries do too and are taken over.
    """
    top, pairs, neighbours, add = v.from_end, v.pairs.get, v.neighbours, last.append
    same = 0
    for i in range(len(last), len(data) + 1):
        found, node, j = -1, top, i
        while j:
            j -= 1
            step = node.get(data[j])
            if step is None:
                break
            token, node = step
            if token < 0:
                continue
            if j:
                left = last[j]
                if left < 0:
                    continue
                fits = pairs(left << 32 | token)
                if not (neighbours(left, token) if fits is None else fits):
                    continue
            found = token
            break
        add(found)
        if in_step:
            old, shift, after = in_step
            # the token must lie behind the edit, not only end there
            inside = i - len(v.bytes_of[found]) >= after if found >= 0 else i > after + v.reach
            same = same + 1 if inside and old[i - shift] == found else 0
            if same >= v.reach:
                last.extend(old[i - shift + 1 :])
                return


def walk_back(v: Vocabulary, last: list[int]) -> list[int]:
    """The tokens of the whole piece, from its table."""
    out, at, bytes_of = [], len(last) - 1, v.bytes_of
    while at:
        token = last[at]
        if token < 0:
            raise ValueError("the vocabulary lacks a byte of this text")
        out.append(token)
        at -= len(bytes_of[token])
    return out[::-1]


class PrefixTable:
    """The bytes of one piece and the last token of each of their prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        if data:
            self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        fill(self.vocabulary, self.data, self.last)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` in the place of the bytes ``[start, end)``."""
        old, shift = self.last, len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        self.last = old[: start + 1]
        fill(self.vocabulary, self.data, self.last, (old, shift, start + len(data)))

    def tokens(self) -> list[int]:
        return walk_back(self.vocabulary, self.last)


class Encoder:
    """Texts to ids and back; keeps the encodings of recent pieces."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, cache: int = CACHE_ENTRIES) -> None:
        import regex

        self.vocabulary, self.cache = vocabulary, cache
        self.split = regex.compile(pattern).findall
        # no piece of that pattern has white space behind other characters, so a text may be
        # cut there first, and the cheaper cut is what the cache is asked for; else pieces are
        self.cheaper = pattern == CUT_BEFORE_WHITE
        self.units = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall if self.cheaper else self.split
        self.begun: dict[bytes, list[int]] = {}
        self.pieces: dict[str, list[int]] = {}
        # the ids of units as decimal text
        self.recent: dict[str, str] = {}
        self.older: dict[str, str] = {}
        # all tokens' bytes in a row, for decoding whole arrays of ids
        sizes = np.array([len(t) for t in vocabulary.bytes_of], np.int64)
        self.flat, self.sizes, self.starts = np.frombuffer(b"".join(vocabulary.bytes_of), np.uint8), sizes, np.cumsum(sizes) - sizes

    def ids_of_piece(self, piece: bytes) -> list[int]:
        """Fill the table from the longest beginning whose entries are known, by exact appends."""
        whole = self.vocabulary.usable.get(piece)
        if whole is not None:
            return [whole]
        n, last, start, begun = len(piece), [-1], 0, self.begun
        for known in PREFIXES:
            if known < n and (table := begun.get(piece[:known])) is not None:
                last, start = table.copy(), known
                break
        fill(self.vocabulary, piece, last)
        for known in PREFIXES:
            if start < known < n:
                if len(begun) >= self.cache // 5:
                    begun.clear()
                begun[piece[:known]] = last[: known + 1]
        return walk_back(self.vocabulary, last)

    def unit(self, unit: str) -> str:
        """Ids as decimal text."""
        found = self.older.get(unit)
        if found is None:
            # a space and ASCII letters are one piece
            one = not self.cheaper or unit[0] == " " and unit[1:].isalpha() and unit.isascii()
            found = ",".join(map(str, self.ids_of_piece(unit.encode()) if one else self.encode(unit)))
        if len(unit) <= 64:
            if len(self.recent) >= self.cache:
                self.recent, self.older = {}, self.recent
            self.recent[unit] = found
        return found

    def encode(self, text: str) -> list[int]:
        out, pieces = [], self.pieces
        for p in self.split(text):
            ids = pieces.get(p)
            if ids is None:
                ids = self.ids_of_piece(p.encode())
                if len(p) <= 64:
                    if len(pieces) >= self.cache // 5:
                        pieces.clear()
                    pieces[p] = ids
            out += ids
        return out

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        """The bytes of all ids, copied from where their tokens stand in the row of all tokens."""
        ids = np.asarray(ids, np.int64)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        return self.flat[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes()

    def encode_text(self, text: str) -> str:
        """The ids of a text in decimal, with commas."""
        known = self.recent.get
        return ",".join([known(u) or self.unit(u) for u in self.units(text)])


def numbers(ids: str) -> np.ndarray:
    """Ids from their decimal text."""
    return np.fromstring(ids, np.int32, sep=",") if ids else np.zeros(0, np.int32)


_ENCODERS: dict[tuple[str, str, int], Encoder] = {}
tk.KEPT.append(_ENCODERS)


def encoder(path: str, pattern: str, cache: int = CACHE_ENTRIES) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = path, pattern, cache
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Vocabulary.load(path), pattern, cache)
    return _ENCODERS[key]


@contextlib.contextmanager
def _uncollected() -> Iterator[None]:
    """The caches are bounded and hold no cycles; walking them again and again finds nothing."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _texts(batch: pa.RecordBatch, rows: int = 64, column: str = "text") -> Iterator[tuple[int, list[str | None]]]:
    column = batch.column(column)
    for i in range(0, len(column), rows):
        yield i, column.slice(i, rows).to_pylist()


def encode(docs: DataFrame, path: str, pattern: str, *keep: str, cache: int = CACHE_ENTRIES) -> DataFrame:
    """``doc_id`` or the columns named, ``n_tokens`` and ``token_ids array<int>`` of every row, in one pass without a shuffle."""
    kept = [F.col(f"`{k}`") for k in keep] or [F.col("doc_id").cast("long").alias("doc_id")]
    own = docs.select(*kept).schema
    schema = T.StructType([*own, T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType()))])
    text = shared.hidden("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern, cache)
        with _uncollected():
            for batch in batches:
                for i, texts in _texts(batch, column=text):
                    ids = [numbers(e.encode_text(t or "")) for t in texts]
                    n = np.array([len(x) for x in ids], np.int64)
                    at = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                    lists = pa.ListArray.from_arrays(at, pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
                    yield pa.record_batch([*(batch.column(c).slice(i, len(texts)) for c in range(len(own))), pa.array(n), lists], names=schema.names)

    return docs.select(*kept, F.col("text").cast("string").alias(text)).transform(shared.arrow, run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``token_ids``; bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, r"(?s:.+)")
        for batch in batches:
            texts = [e.decode(ids or []).decode("utf-8", "replace") for ids in batch.column("token_ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "token_ids").transform(shared.arrow, run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: the encoding and its round trip, as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        with _uncollected():
            yield from digest(e, sha, batches)

    def digest(e: Encoder, sha, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ids, back = [], [], []
            for _, texts in _texts(batch):
                for text in texts:
                    found = e.encode_text(text or "")
                    counts.append(found.count(",") + 1 if found else 0)
                    ids.append(sha(found.encode()))
                    back.append(sha(e.decode(numbers(found))))
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).transform(shared.arrow, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_vocabulary() -> tuple[str, str]:
    """Path and split pattern of the multilingual byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), *default_vocabulary())
