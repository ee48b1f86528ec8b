"""Secret scanning: fixed patterns, and a linear-chain conditional random field beside them.

Patterns find the base spans.  The field tags the words of each line as begin,
inside or outside of a secret from their shape, the words around them and features
of the whole document, by gradient of the exact conditional likelihood, and is decoded
by Viterbi over every line.  What it tags and no base span meets is added.

It learns from a bounded, hash-picked sample of documents (of ``SAMPLE`` documents,
``LIKELY`` with and ``OTHER`` without something like a secret, ``FIT_BYTES`` at most) and of their lines
(``LINES_WITH``, ``LINES_WITHOUT``, picked by a hash of what they hold, wherever they
stand).  Two kinds of lines teach it more than the patterns know: lines with a base
span whose keyword and value are exchanged for others that no pattern meets, and plain
lines with such a secret planted in them (``planted``); beside them stand lines with
harmless names and values in the same places.

A line whose words all weigh against any tag, transitions included, has the path
"outside" as its best one; only other lines are walked through.

Spans are ``kind:start:end`` in code points, end exclusive, ordered by start, then
by kind (assign, access, hex, crf).  Null and empty texts have none; a text of any
length is scanned whole; rows that repeat a doc_id are scanned each; an empty table
gives an empty result, without documents to learn from the field tags nothing; further
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import shared
from folio.llm import textkernel as tk

#: Fixed patterns; the keywords of the first match in either case.
KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = re.compile(rf"""(?i:({KEYWORDS}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
_HEX_LONG = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)  # greedy runs, so the same as HEX with its length asked for
_KEYWORD_BYTES = re.compile(KEYWORDS.encode(), re.IGNORECASE)
KINDS = ("assign", "access", "hex", "crf")

#: Documents that are looked through for a fit, about; documents of it with and without something like a secret, and bytes of them.
SAMPLE, LIKELY, OTHER, FIT_BYTES = 20_000, 1000, 300, 8 << 20
#: Lines (or pieces of about ``LINE_WORDS`` words) with and without a base span that are learned from, at most; planted ones.
LINES_WITH, LINES_WITHOUT, PLANTED, LINE_WORDS = 1500, 2000, 1500, 60
#: Names and values that planted secrets have; harmless ones.
NAMES = ("passphrase", "credential", "auth_key", "private_key", "client_key", "access_code", "login_pass", "signing_key", "db_pass", "pin_code")
PREFIXES = ("", "", "", "sk-", "ghx_", "xoxb-", "ASIA", "pk_live_", "AIza")
HARMLESS = ("width", "colour", "version", "date", "page", "total", "host", "mode", "size", "name", "lang", "level")
OUT, BEGIN, INSIDE = 0, 1, 2
SHAPES, FLAGS = 16 * 7, 24
#: Cardinalities of the feature slots of a word; neighbours have one more value for none.
SLOTS = (SHAPES, FLAGS, 20, SHAPES + 1, FLAGS + 1, SHAPES + 1, FLAGS + 1, FLAGS + 1, 6)
_OFFSETS = np.concatenate([[0], np.cumsum(SLOTS)])
NEVER = -1e4


@dataclass(frozen=True)
class Field:
    """Weights of features by tag, of transitions, and of first tags."""

    emit: np.ndarray  # features x 3
    move: np.ndarray  # 3 x 3, from and to
    first: np.ndarray  # 3


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of the fixed patterns, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _HEX_LONG.finditer(text)]
    return sorted(found)


def _class_table() -> np.ndarray:
    kinds = np.full(256, 3)
    kinds[97:123], kinds[65:91], kinds[48:58] = 0, 1, 2
    kinds[128:] = 0
    return kinds


_KIND = _class_table()
_LENGTHS = np.array([4, 8, 12, 16, 20, 32])


def features(block: tk.Block) -> tuple[np.ndarray, np.ndarray, tk.Words]:
    """Feature indices of every word (one column for each slot), the line of each, the words."""
    data, w = block.data, tk.words(block, lower=False)
    n = len(w.start)
    if not n:
        return np.zeros((0, len(SLOTS)), np.int64), np.zeros(0, np.int64), w
    s, e = w.start, w.end
    kind = _KIND[data]

    def number(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[e] - total[s]

    lower, upper, digit, symbol = (number(kind == k) for k in range(4))
    length = np.searchsorted(_LENGTHS, e - s, side="right")
    shape = ((lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (symbol > 0)) * 7 + length
    turn = np.zeros(len(data), bool)
    turn[1:] = (kind[1:] < 3) & (kind[:-1] < 3) & ((kind[1:] == 2) != (kind[:-1] == 2))
    total = np.concatenate([[0], np.cumsum(turn)])
    turns = np.searchsorted([1, 2, 3, 5], total[e] - total[np.minimum(s + 1, e)], side="right")
    share = np.minimum(3, 4 * digit // (e - s))
    sign = (data == 61) | (data == 58)
    signs = number(sign)
    equal = np.where(signs == 0, 0, np.where(e - s == 1, 2, 1))
    quote = number((data == 34) | (data == 39)) > 0
    akia = np.zeros(n, bool)
    long = np.flatnonzero(e - s >= 4)
    akia[long] = (data[s[long]] == 65) & (data[s[long] + 1] == 75) & (data[s[long] + 2] == 73) & (data[s[long] + 3] == 65)
    keyword = np.zeros(n, bool)
    for r in range(block.rows):
        at = block.offsets[r]
        hits = [at + m.start() for m in _KEYWORD_BYTES.finditer(data[at : block.offsets[r + 1]].tobytes())]
        if hits:
            keyword[np.searchsorted(s, hits, side="right") - 1] = True
    flags = ((keyword * 3 + equal) * 2 + quote) * 2 + akia
    line_no = np.cumsum(data == 10)[s]
    new = np.ones(n, bool)
    new[1:] = (line_no[1:] != line_no[:-1]) | (w.row[1:] != w.row[:-1])
    line = np.cumsum(new) - 1

    def near(value: np.ndarray, none: int, by: int) -> np.ndarray:
        out = np.full(n, none)
        if by > 0:
            out[by:] = np.where(line[by:] == line[:-by], value[:-by], none)
        else:
            out[:by] = np.where(line[:by] == line[-by:], value[-by:], none)
        return out

    words_in = np.maximum(w.per_row(), 1)
    digits_in = np.bincount(w.row, digit > 0, minlength=block.rows)
    has_keyword = np.bincount(w.row, keyword, minlength=block.rows) > 0
    whole = has_keyword * 3 + np.searchsorted([0.02, 0.2], digits_in / words_in, side="right")
    slots = [shape, flags, turns * 4 + share, near(shape, SHAPES, 1), near(flags, FLAGS, 1), near(shape, SHAPES, -1), near(flags, FLAGS, -1), near(flags, FLAGS, 2), whole[w.row]]
    return np.stack(slots, axis=1) + _OFFSETS[:-1], line, w


def base_tags(block: tk.Block, w: tk.Words) -> np.ndarray:
    """Tags of the words that the base spans meet."""
    tags = np.zeros(len(w.start), np.int64)
    for r in range(block.rows):
        raw = block.data[block.offsets[r] : block.offsets[r + 1]].tobytes()
        text = raw.decode("utf-8", "replace")
        for start, _, end in base_spans(text):
            a = block.offsets[r] + len(text[:start].encode())
            b = block.offsets[r] + len(text[:end].encode())
            i = int(np.searchsorted(w.end, a, side="right"))
            j = int(np.searchsorted(w.start, b, side="left"))
            if i < j and tags[i] == OUT:
                tags[i] = BEGIN
            tags[i + 1 : j] = INSIDE
    return tags


def _pieces(line: np.ndarray, tags: np.ndarray) -> list[tuple[int, int]]:
    """Lines as word ranges; long ones are cut behind ``LINE_WORDS`` words, but never inside a span."""
    out = []
    cuts = np.flatnonzero(np.diff(line, prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(line)), strict=True):
        while a < b:
            c = min(a + LINE_WORDS, b)
            while c < b and tags[c] == INSIDE:
                c += 1
            out.append((a, c))
            a = c
    return out


def _lines(texts: pa.Array) -> tuple[list[str], list[str]]:
    """Pieces of lines with a base span, and without one: those with the smallest hashes, up to the limits."""
    found: tuple[list, list] = ([], [])
    most = LINES_WITH, LINES_WITHOUT
    for block in tk.blocks(texts):
        w = tk.words(block, lower=False)
        line_no = np.cumsum(block.data == 10)[w.start] if len(w.start) else np.zeros(0, np.int64)
        new = np.ones(len(w.start), bool)
        new[1:] = (line_no[1:] != line_no[:-1]) | (w.row[1:] != w.row[:-1])
        tags = base_tags(block, w)
        pieces = _pieces(np.cumsum(new) - 1, tags)
        if not pieces:
            continue
        first, last = (np.array(x) for x in zip(*pieces, strict=True))
        draw = w.hasher(w.start[first], w.end[last - 1])
        tagged = np.concatenate([[0], np.cumsum(tags > 0)])
        for plain in (0, 1):
            of = np.flatnonzero((tagged[last] == tagged[first]) == bool(plain))
            for k in of[np.argsort(draw[of], kind="stable")[: most[plain]]]:
                raw = block.data[w.start[first[k]] : w.end[last[k] - 1]].tobytes()
                found[plain].append((int(draw[k]), raw.decode("utf-8", "replace")))
    return tuple([text for _, text in sorted(set(x))[:n]] for x, n in zip(found, most, strict=True))


def _value(rng: np.random.Generator) -> str:
    """A value of chance letters and digits that no pattern meets by itself."""
    kinds = ("abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHJKMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/")
    alphabet = kinds[rng.integers(len(kinds))]
    body = "".join(alphabet[i] for i in rng.integers(len(alphabet), size=int(rng.integers(14, 44))))
    if not any(c.isdigit() for c in body) or body.isdigit():
        body = f"7{body[:6]}3q{body[6:]}"
    return PREFIXES[rng.integers(len(PREFIXES))] + body


def planted(lines: list[str], n: int, seed: int = 9) -> list[tuple[str, int, int]]:
    """``text, start, end`` (0, 0 for none): lines with a secret that no pattern knows, and with harmless values."""
    rng, out = np.random.default_rng(seed), []
    signs = ("=", ": ", " = ", ":", " : ", "=\"", ": '")
    for i in range(n if lines else 0):
        words = lines[i % len(lines)].split(" ")
        at = int(rng.integers(len(words) + 1))
        before, after = " ".join(words[:at]), " ".join(words[at:])
        sign, kind = signs[rng.integers(len(signs))], i % 5
        quote = sign[-1] if sign[-1] in "\"'" else ""
        if kind < 2:
            made = f"{NAMES[rng.integers(len(NAMES))]}{sign}{_value(rng)}{quote}"
        elif kind == 2:
            made = _value(rng)
        else:
            plain = words[int(rng.integers(len(words)))] or "plain"
            number = str(rng.integers(1, 10 ** int(rng.integers(1, 9))))
            value = (plain, number, f"{number[:4]}-{number[:2]}", f"v{number[:1]}.{number[:2]}")[rng.integers(4)]
            made = f"{HARMLESS[rng.integers(len(HARMLESS))]}{sign}{value}{quote}" if kind == 3 else number
        start = len(before) + 1 if before else 0
        text = (f"{before} " if before else "") + made + (f" {after}" if after else "")
        out.append((text, start, start + len(made) if kind < 3 else start))
    return out


def exchanged(lines: list[str], seed: int = 10) -> list[tuple[str, int, int]]:
    """Lines with one assigned base span, its keyword and value exchanged for others."""
    rng, out = np.random.default_rng(seed), []
    for line in lines:
        m = next((m for m in ASSIGN.finditer(line) if len(m[2]) >= MIN_ASSIGN), None)
        if m is None:
            continue
        text = line[: m.start(1)] + NAMES[rng.integers(len(NAMES))] + line[m.end(1) : m.start(2)]
        end = len(text) + len(value := _value(rng))
        text += value + line[m.end(2) :]
        if not base_spans(text):
            out.append((text, m.start(), end))
    return out


def _tags(w: tk.Words, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tags of the words of one line that code point spans meet."""
    tags = np.zeros(len(w.start), np.int64)
    for start, end in spans:
        a, b = len(text[:start].encode()), len(text[:end].encode())
        i, j = int(np.searchsorted(w.end, a, side="right")), int(np.searchsorted(w.start, b, side="left"))
        if i < j:
            tags[i] = max(tags[i], BEGIN)
            tags[i + 1 : j] = INSIDE
    return tags


def lessons(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Features and tags of all lines to learn from."""
    tagged, plain = _lines(texts)
    given = [(t, [(a, b) for a, _, b in base_spans(t)]) for t in tagged + plain]
    made = planted(plain or tagged, PLANTED) + exchanged(tagged)
    given += [(t, sorted({(a, b) for a, _, b in base_spans(t)} | ({(start, end)} if end > start else set()))) for t, start, end in made]
    xs, ys = [], []
    for text, spans in given:
        f, _, w = features(next(tk.blocks(pa.array([text.replace("\n", " ")]))))
        if len(f):
            xs.append(f.astype(np.int16))
            ys.append(_tags(w, text, spans))
    return xs, ys


def fit(texts: pa.Array, steps: int = 80, rate: float = 0.2, decay: float = 1e-4) -> Field:
    """Adam on the conditional log-likelihood; forward and backward sums run over all lines at once, scaled at every word."""
    xs, ys = lessons(texts)
    emit, move, first = np.zeros((_OFFSETS[-1], 3)), np.zeros((3, 3)), np.zeros(3)
    move[OUT, INSIDE] = first[INSIDE] = NEVER
    if not any(y.any() for y in ys):
        emit[:, 1:] = -10.0  # nothing to learn from: tag nothing
        return Field(emit, move, first)
    order = sorted(range(len(xs)), key=lambda i: -len(xs[i]))  # so that the lines that reach a place come first
    xs, ys = [xs[i] for i in order], [ys[i] for i in order]
    n, T = len(xs), len(xs[0])
    last = np.array([len(x) - 1 for x in xs])
    reach = np.searchsorted(-last, -np.arange(T), side="right")
    # words by place and then by line: all lines that have a word at a place lie side by side
    place = np.repeat(np.arange(T), reach)
    row = np.concatenate([np.arange(m) for m in reach])
    starts = np.concatenate([[0], np.cumsum([len(x) for x in xs])])
    at = starts[row] + place
    words, tags = np.concatenate(xs)[at], np.concatenate(ys)[at]
    one, flat = np.eye(3)[tags], words.ravel()
    next_place, next_row = place[place > 0], row[place > 0]
    before = np.eye(3)[np.concatenate(ys)[starts[next_row] + next_place - 1]]
    seen_move, seen_first = before.T @ one[place > 0], one[place == 0].sum(0)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (emit, move, first)]
    likely, fore, back = np.zeros((T, n, 3)), np.zeros((T, n, 3)), np.ones((T, n, 3))
    scaled = lambda z: z / (z.sum(axis=-1, keepdims=True) + 1e-300)
    for step in range(1, steps + 1):
        score = sum(emit[words[:, k]] for k in range(len(SLOTS)))
        likely[place, row] = np.exp(score - score.max(axis=1, keepdims=True))
        through = np.exp(move)
        fore[0] = scaled(np.exp(first - first.max()) * likely[0])
        for t in range(1, T):
            m = reach[t]
            fore[t, :m] = scaled((fore[t - 1, :m] @ through) * likely[t, :m])
        for t in range(T - 2, -1, -1):
            m = reach[t + 1]
            back[t, :m] = scaled((likely[t + 1, :m] * back[t + 1, :m]) @ through.T)
        mass = scaled(fore[place, row] * back[place, row])
        after = likely[next_place, next_row] * back[next_place, next_row]
        pair = fore[next_place - 1, next_row][:, :, None] * through * after[:, None, :]
        pair /= pair.sum((1, 2), keepdims=True) + 1e-300
        left = one - mass
        ge = np.stack([np.bincount(flat, np.repeat(left[:, k], len(SLOTS)), minlength=len(emit)) for k in range(3)], axis=1)
        grads = [ge / n - decay * emit, (seen_move - pair.sum(0)) / n, (seen_first - mass[place == 0].sum(0)) / n]
        for p, g, (m, v) in zip((emit, move, first), grads, state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        move[OUT, INSIDE] = first[INSIDE] = NEVER
    return Field(emit, move, first)


def viterbi(field: Field, score: np.ndarray) -> np.ndarray:
    """Best tags of one line from its emission scores; ties go to the smaller tag."""
    n = len(score)
    back = np.zeros((n, 3), np.int64)
    best = field.first + score[0]
    for t in range(1, n):
        through = best[:, None] + field.move
        back[t] = through.argmax(axis=0)
        best = through[back[t], np.arange(3)] + score[t]
    tags = np.zeros(n, np.int64)
    tags[-1] = best.argmax()
    for t in range(n - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


def tag_block(field: Field, block: tk.Block) -> tuple[np.ndarray, tk.Words]:
    """Tags of all words of a block."""
    f, line, w = features(block)
    tags = np.zeros(len(line), np.int64)
    if not len(line):
        return tags, w
    score = np.zeros((len(line), 3))
    for k in range(len(SLOTS)):
        score += field.emit[f[:, k]]
    gain = (score[:, 1:] - score[:, :1]).max(axis=1)
    moves = np.delete(field.move.ravel(), 0).max() - field.move[OUT, OUT]
    start = field.first[1:].max() - field.first[OUT]
    gain += 2 * max(0.0, moves, start)
    cuts = np.append(np.flatnonzero(np.diff(line, prepend=-1)), len(line))
    for k in np.unique(line[gain > 0]):
        a, b = cuts[k], cuts[k + 1]
        tags[a:b] = viterbi(field, score[a:b])
    return tags, w


def added_spans(field: Field, block: tk.Block, base: list[list[tuple[int, int, int]]]) -> None:
    """Adds to ``base``, by row, what the field tags and no base span meets."""
    tags, w = tag_block(field, block)
    begins = np.flatnonzero(tags == BEGIN)
    for i in begins:
        j = i + 1
        while j < len(tags) and tags[j] == INSIDE:
            j += 1
        r = int(w.row[i])
        at = block.offsets[r]
        start = len(block.data[at : w.start[i]].tobytes().decode("utf-8", "replace"))
        end = start + len(block.data[w.start[i] : w.end[j - 1]].tobytes().decode("utf-8", "replace"))
        if not any(a < end and start < b for a, _, b in base[r]):
            base[r].append((start, 3, end))
            base[r].sort()


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def train(docs: DataFrame) -> Field:
    """Fit on documents picked by a hash of their id, within the limits above."""
    text = F.col("text").cast("string")
    likely = F.coalesce(text.rlike(rf"(?i)({KEYWORDS})|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}"), F.lit(False))
    share = max(1, int((1 << 20) * SAMPLE / max(docs.count(), 1)))
    some = docs.filter(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 20)) < share)
    looked = shared.materialise(some.select("doc_id", text.alias("text"), likely.cast("string").alias("likely")))
    table = shared.sample_texts(looked, {"true": LIKELY, "false": OTHER}, FIT_BYTES, "likely")
    return fit(shared.chunk_of(table["text"]))


_FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """``_FOUND`` of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shipped.value
        for batch in batches:
            for block in tk.blocks(batch.column("text")):
                rows = [base_spans(block.data[block.offsets[r] : block.offsets[r + 1]].tobytes().decode("utf-8", "replace")) for r in range(block.rows)]
                counts = [[sum(k == kind for _, k, _ in spans) for spans in rows] for kind in range(3)]
                digest = [hashlib.sha256(written(spans).encode()).hexdigest() for spans in rows]
                added_spans(field, block, rows)
                yield pa.record_batch([batch.column("doc_id").slice(block.first, block.rows), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest), pa.array([written(s) for s in rows], pa.string())], names=[x.split()[0] for x in _FOUND.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).transform(shared.arrow, run, _FOUND)


def base_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of base spans alone: the part that SQL can say."""
    nothing = Field(np.zeros((_OFFSETS[-1], 3)) - [0.0, 10.0, 10.0], np.zeros((3, 3)), np.zeros(3))
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), nothing).select("doc_id", "n_assign", "n_access", "n_hex")


BASE_SQL = r"""
SELECT doc_id,
       CAST(len(list_filter(regexp_extract_all(t, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 6)) AS BIGINT) AS n_assign,
       CAST(len(list_filter(regexp_extract_all(t, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS BIGINT) AS n_access,
       CAST(len(list_filter(regexp_extract_all(t, '[0-9a-f]+'), lambda x: length(x) >= 24)) AS BIGINT) AS n_hex
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, train(docs))
