import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import textkernel as tk

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
texts = st.lists(st.one_of(st.none(), st.text("aAbB é漢\n\t.,9 ", max_size=40)), max_size=12)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 60))
def test_words_shingles_and_hashes(rows, limit):
    seen: dict[str, int] = {}
    done = 0
    for block in tk.blocks(pa.array(rows, pa.string()), limit):
        assert block.first == done
        done += block.rows
        for separators, pattern in ((tk.SPACE, SPACED), (tk.NON_WORD, ALNUM)):
            w = tk.words(block, separators)
            for r in range(block.rows):
                want = pattern.findall((rows[block.first + r] or "").translate(LOW))
                a, b = w.first[r], w.first[r + 1]
                got = [bytes(tk.LOWER[block.data[s:e]]).decode() for s, e in zip(w.start[a:b], w.end[a:b], strict=True)]
                assert got == want
                for word, h in zip(got, w.hash[a:b], strict=True):
                    assert seen.setdefault(word, int(h)) == int(h)
        w = tk.words(block)
        g, at = tk.shingles(w, block.rows)
        for r in range(block.rows):
            ws = SPACED.findall((rows[block.first + r] or "").translate(LOW))
            k = min(5, len(ws))
            want = {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if ws else set()
            assert at[r + 1] - at[r] == len(want)
    assert done == len(rows)
    assert len(set(seen.values())) == len(seen)
