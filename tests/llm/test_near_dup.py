import random

import numpy as np
import pyarrow as pa
from conftest import prose
from pyspark.sql import functions as F

from folio.llm import graph, near_dup
from folio.llm import textkernel as tk


def sets(rows):
    out = {}
    for doc_id, text in rows:
        w = (text or "").lower().split()
        k = min(5, len(w))
        out[doc_id] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    return out


def brute(rows):
    s = sets(rows)
    label = {i: i for i in s}
    ids = sorted(s)
    changed = True
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {i: (len(s[i]), label[i]) for i in s}


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_as_brute_force(spark, monkeypatch):
    """Families whose members are more and less alike, with groups small enough to be cut up."""
    monkeypatch.setattr(near_dup, "LIST", 4)
    monkeypatch.setattr(near_dup, "SUB", 16)
    monkeypatch.setattr(near_dup, "FAN", 3)
    rng = random.Random(5)
    rows = [(i, prose(i, 20 + i)) for i in range(40)]
    for base in range(4):
        words = prose(100 + base, 120).split()
        rows += [(1000 * (base + 1) + i, edited(words, rng.randrange(9), rng)) for i in range(60)]
    rows += [(9000 + i, "same text here") for i in range(20)] + [(9900, ""), (9901, None), (9902, " ")]
    rng.shuffle(rows)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    got = near_dup.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[1] == by[1][:1] and by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)]
    assert by[4] == [(1, 4)] and by[5] == [(1, 5)]
    assert {c for _, c in by[7] + by[8]} == {7} and len(by[7]) == 2
    assert by[None][0][1] is None
    assert near_dup.near_duplicates(no_docs).count() == 0
    kept = near_dup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("doc_id = 8").count() == 0 and kept.filter("doc_id IS NULL").count() == 1


def test_texts_that_share_an_id_are_not_lost(spark):
    a, b = prose(400, 60), prose(401, 60)
    rows = [(5, a + " x"), (11, a), (11, b), (20, b + " y"), (20, b + " y"), (30, prose(402, 50)), (30, prose(402, 50)), (31, None), (31, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("version", "node", "least", "uid", "m")})
    got = sorted((r.doc_id, r.component_id) for r in near_dup.near_duplicates(docs).collect())
    assert got == [(5, 5), (11, 5), (11, 11), (20, 11), (20, 11), (30, 30), (30, 30), (31, 31), (31, 31)]
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(5, a + " x"), (11, b), (30, prose(402, 50)), (31, ""), (31, "")])


def test_the_threshold_itself_links(spark):
    w = [f"w{i}" for i in range(11)]
    rows = [(1, " ".join(w)), (2, " ".join([*w[:10], "x"])), (3, " ".join([*w[:9], "y", w[10]]))]  # 6 of 8 shingles, 5 of 9
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3} and brute(rows)[2][1] == 1


def test_sketches_estimate_similarity():
    rng = random.Random(1)
    for edits in (0, 4, 12):
        words = prose(7, 300).split()
        texts = pa.array([" ".join(words), edited(words, edits, rng)])
        x = near_dup.signatures(next(tk.blocks(texts)))
        a, b = sets(enumerate(texts.to_pylist())).values()
        j = len(a & b) / len(a | b)
        flips = int(np.bitwise_count(x["sketch"][0] ^ x["sketch"][1]).sum())
        estimate = 1 + near_dup.BITS / (4 * near_dup.PERMS) * np.log(1 - 2 * flips / near_dup.BITS)
        assert abs(estimate - j) < 0.2


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}}
    assert graph.components(spark.createDataFrame([(1, 1)], "a long, b long").filter(F.lit(False))) is None
