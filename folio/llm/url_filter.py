"""URL filters by a bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL, ``.host/path`` with the host in lower
case: ``*`` is any run of characters but ``/``, ``**`` any run, ``?`` one character but ``/``.
All globs are packed one after the other into the bits of a few 64-bit words, a bit for
the start of a glob and one for each of its characters.  One step of the automaton
reads a character for all globs: bits move up by one where the glob's next character
is the one read (Shift-And), and stay where a wildcard lets them.  Tasks run a step for
all URLs of a block at once.  A glob matches if its last bit is set at the end of the URL.

Rules of hosts (``example.com/en/``) fit the host and all hosts below it, where the path
starts with the rule's; they are globs ``*.example.com/en/**`` of the same automaton.  The longest
that fits wins, the blocking one among equally long ones.  Where none fits, a URL is
blocked if one of the filter's own globs matches, else allowed.

The rules are configuration and are sent to the tasks with the plan; a block holds as
many URLs as fit ``STATE_WORDS``, so memory stays bounded for any number of rules.  There
is no shuffle.

Defined results: a URL that is null or has no ``://`` has neither host nor path, no rule
fits it and no glob matches, so it is allowed; a URL of any length is read whole; rows that
repeat are judged each; an empty table gives an empty result; without any rule all is
allowed; further columns, whatever their names, are kept or not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import shared

#: Words of automaton states that a block of URLs may take.
STATE_WORDS = 1 << 20
_U = np.uint64


@dataclass(frozen=True)
class HostRule:
    """``host/path`` and whether it blocks."""

    rule: str
    blocks: bool

    def glob(self) -> str:
        host, slash, path = self.rule.partition("/")
        return "*." + _literal(host) + slash + _literal(path) + "**"


#: The rules of hosts of the registered query.
HOST_RULES = (
    HostRule("com/", False),
    HostRule("example.com/en/", True),
    HostRule("www.example.com/en/", False),
    HostRule("net/es/", True),
    HostRule("net/fr/", True),
)
#: Globs of hosts that sell or track.
BLOCKED = ("*.*casino*.**", "*.*-pills.**", "*.*-bets.**", "*.ads-*.**", "**/sitemap?.xml")


def _literal(text: str) -> str:
    """A text as a glob that matches only itself."""
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def glob_parts(glob: str) -> list[tuple[str, str]]:
    """``kind, character`` of a glob: ``c`` a character, ``?``, ``*`` or ``**``; a backslash takes the next one as it is."""
    parts, i = [], 0
    while i < len(glob):
        if glob[i] == "\\" and i + 1 < len(glob):
            parts.append(("c", glob[i + 1]))
            i += 2
        elif glob[i] == "*":
            run = len(glob) - i - len(glob[i:].lstrip("*"))
            parts.append(("**" if run > 1 else "*", ""))
            i += run
        else:
            parts.append(("?", "") if glob[i] == "?" else ("c", glob[i]))
            i += 1
    return parts


@dataclass
class Automaton:
    """Masks over the words of all globs: rows of ``moves`` and ``stays`` are character classes."""

    characters: np.ndarray  # sorted code points that globs name, and the slash; class 0 is any other
    moves: np.ndarray
    stays: np.ndarray
    start: np.ndarray
    last: list[tuple[int, int]] = field(default_factory=list)  # word and bit of each glob's end

    @property
    def words(self) -> int:
        return len(self.start)


def compile_globs(globs: Sequence[str]) -> Automaton:
    parsed = [glob_parts(g) for g in globs]
    named = sorted({ord(c) for parts in parsed for kind, c in parts if kind == "c"} | {ord("/")})
    row = {c: i + 1 for i, c in enumerate(named)}
    bits = sum(1 + sum(kind in "c?" for kind, _ in parts) for parts in parsed)
    words = max(1, -(-bits // 64))
    moves, stays, start = np.zeros((len(named) + 1, words), _U), np.zeros((len(named) + 1, words), _U), np.zeros(words, _U)
    made = Automaton(np.array(named, np.uint32), moves, stays, start)
    but_slash = np.arange(len(named) + 1) != row[ord("/")]
    at = 0
    for parts in parsed:
        start[at // 64] |= _U(1 << at % 64)
        for kind, c in parts:
            if kind in ("*", "**"):
                # the state reached so far stays
                stays[but_slash if kind == "*" else slice(None), at // 64] |= _U(1 << at % 64)
                continue
            at += 1
            moves[row[ord(c)] if kind == "c" else but_slash, at // 64] |= _U(1 << at % 64)
        made.last.append((at // 64, at % 64))
        at += 1
    return made


def run_automaton(auto: Automaton, urls: Sequence[str]) -> np.ndarray:
    """Whether each URL (row) is matched by each glob (column).

    URLs are taken from the longest to the shortest, so that those not yet at their end
    are always the first rows of the states.
    """
    codes = [np.frombuffer(u.encode("utf-32-le", "surrogatepass"), np.uint32) for u in urls]
    length = np.array([len(c) for c in codes], np.int64)
    order = np.argsort(-length, kind="stable")
    flat = np.concatenate([codes[i] for i in order]) if len(order) else np.zeros(0, np.uint32)
    at = np.minimum(np.searchsorted(auto.characters, flat), len(auto.characters) - 1)
    classes = np.where(auto.characters[at] == flat, at + 1, 0)
    length = length[order]
    begin = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64) if len(order) else length
    states = np.tile(auto.start, (len(order), 1))
    reading = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right") if len(order) else []
    for j, n in enumerate(reading):
        seen = classes[begin[:n] + j]
        now = states[:n]
        up = now << _U(1)
        up[:, 1:] |= now[:, :-1] >> _U(63)
        states[:n] = (up & auto.moves[seen]) | (now & auto.stays[seen])
    matched = np.empty((len(order), len(auto.last)), bool)
    for k, (word, bit) in enumerate(auto.last):
        matched[order, k] = (states[:, word] >> _U(bit)) & _U(1) != 0
    return matched


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to a slash, ``?`` or ``#`` (A-Z in lower case), and then up to ``?`` or ``#``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    part = lambda k: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*+)([^?#]*+)", k)
    return shared.ascii_lower(part(1)), part(2)


def judge(pages: DataFrame, *keep: str, rules: Sequence[HostRule] = HOST_RULES, blocked: Sequence[str] = BLOCKED, url: str = "url") -> DataFrame:
    """The columns named and ``host, path, rule, verdict`` of every row."""
    ranked = sorted(rules, key=lambda r: (-len(r.rule), not r.blocks, r.rule))
    auto = compile_globs([r.glob() for r in ranked] + list(blocked))
    names, n = pa.array([r.rule for r in ranked], pa.string()), len(ranked)
    blocks = np.array([r.blocks for r in ranked], bool)
    most = max(1, STATE_WORDS // auto.words)

    def decide(urls: list[str]) -> tuple[pa.Array, np.ndarray]:
        fits = run_automaton(auto, urls)
        host = np.concatenate([fits[:, :n], np.ones((len(urls), 1), bool)], axis=1).argmax(axis=1)  # the first that fits, n if none does
        own = fits[:, n:].any(axis=1)
        bad = np.where(host < n, np.append(blocks, False)[host], own)
        return names.take(pa.array(np.where(host < n, host, 0), mask=host == n)), bad

    canonical = shared.hidden("canonical")
    host, path = host_and_path(F.col(url))
    rows = pages.select(*keep, host.alias("host"), path.alias("path"))
    rows = rows.withColumn(canonical, F.when((F.col("host") != "") | (F.col("path") != ""), F.concat(F.lit("."), "host", "path")).otherwise(""))
    out = rows.drop(canonical).schema.add("rule", "string").add("verdict", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, most):
                part = batch.slice(first, most)
                rule, bad = decide(part.column(part.num_columns - 1).to_pylist())
                verdict = pa.array(np.where(bad, "block", "allow"), pa.string())
                yield pa.record_batch([*part.columns[:-1], rule, verdict], names=[*part.schema.names[:-1], "rule", "verdict"])

    return rows.transform(shared.arrow, run, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id").select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r(rule, verdict) AS (
  VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')
), f AS (
  SELECT page_id, rule, verdict FROM h JOIN r
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
   AND starts_with(path, substr(rule, strpos(rule, '/')))
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1
)
SELECT h.page_id, host, path, rule, coalesce(verdict, CASE WHEN
         regexp_matches('.' || host || path, '^(?s:[^/]*\.[^/]*casino[^/]*\..*|[^/]*\.[^/]*-pills\..*|[^/]*\.[^/]*-bets\..*|[^/]*\.ads-[^/]*\..*|.*/sitemap[^/]\.xml)$')
         THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN f ON h.page_id = f.page_id
"""
