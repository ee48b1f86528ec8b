import hashlib
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import bpe

PATH, PATTERN = bpe.default_vocabulary()
VOCABULARY = bpe.Vocabulary.load(PATH)
ENCODER = bpe.Encoder(VOCABULARY, PATTERN, cache=50)
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})


def ids(text: str) -> list[int]:
    found = bpe.numbers(ENCODER.encode_text(text))
    assert ENCODER.decode(found) == text.encode()
    return found.tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text("ab é\n\t  9's!漢\x1c\x85　", max_size=80)))
def test_as_tiktoken(text):
    want = REFERENCE.encode_ordinary(text)
    assert ENCODER.encode(text) == want and ids(text) == want
    assert ENCODER.decode(want) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, " " * 4000, "!?" * 2000, "<|endoftext|>", "漢字" * 1000])
def test_long_runs(text):
    assert ids(text) == REFERENCE.encode_ordinary(text)


def test_appends_and_edits_are_exact():
    rng = random.Random(3)
    piece = lambda n: bytes(rng.choice(b"abthei ng\xc3\xa9") for _ in range(n))
    for _ in range(150):
        a, b = piece(rng.randint(0, 90)), piece(rng.randint(0, 9))
        table = bpe.PrefixTable(VOCABULARY, a)
        table.append(b)
        assert table.last == bpe.PrefixTable(VOCABULARY, a + b).last
        i = rng.randint(0, len(table.data))
        j = min(len(table.data), i + rng.randint(0, 5))
        want = bpe.PrefixTable(VOCABULARY, table.data[:i] + b + table.data[j:])
        table.replace(i, j, b)
        assert (table.data, table.last) == (want.data, want.last)


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = bpe.digests(odd_docs, PATH, PATTERN).collect()
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for r in rows:
        t = REFERENCE.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(t), sha(",".join(map(str, t)).encode()), sha((r.text or "").encode())))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert bpe.digests(no_docs, PATH, PATTERN).count() == 0
    back = bpe.decode(bpe.encode(odd_docs, PATH, PATTERN), PATH).collect()
    assert sorted(str((r.doc_id, r.text or "")) for r in rows) == sorted(str((r.doc_id, r.text)) for r in back)


def test_any_pattern(spark):
    """Also one whose pieces have white space behind other characters."""
    pattern = r"\p{L}+| ?[^\s\p{L}]+[\r\n]*|\s+"
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=VOCABULARY.ranks, special_tokens={})
    e = bpe.Encoder(VOCABULARY, pattern)
    for text in ("a!!\n\n  b -\r\n\nc", "x  y.\n", " \n .\n\n\n"):
        found = bpe.numbers(e.encode_text(text))
        assert found.tolist() == other.encode_ordinary(text) and e.decode(found) == text.encode()


def test_bytes_come_from_the_ids():
    """Any ids decode, also those that no encoding gives and bytes that are no UTF-8."""
    rng = random.Random(2)
    for n in (0, 1, 50):
        some = [rng.randrange(len(VOCABULARY.bytes_of)) for _ in range(n)]
        assert ENCODER.decode(some) == REFERENCE.decode_bytes(some)


def test_kept_columns(odd_docs):
    got = bpe.encode(odd_docs, PATH, PATTERN, *(c for c in odd_docs.columns if c != "text"))
    assert got.columns == [*(c for c in odd_docs.columns if c != "text"), "n_tokens", "token_ids"]
    assert all(r.n_tokens == len(r.token_ids) for r in got.collect()) and got.count() == odd_docs.count()
