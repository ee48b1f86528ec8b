import random

import numpy as np
import pytest
from compare import assert_same

from folio.functions import editing
from folio.operators import matching, segments
from folio.plans import catalogue, linkage


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows_as_sql(spark, smallest, name):
    assert_same(spark, smallest, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, smallest, name):
    assert catalogue.QUERIES[name](spark, smallest).count() >= 0


def test_lsh_finds_close_pairs_and_hardly_others(spark, smallest):
    left, right = linkage.listed_keys(spark, smallest), linkage.whole_keys(spark, smallest)
    copies = left.selectExpr("id + 100000 AS id", "concat(key, ' xyz') AS key")
    right = right.unionAll(copies)
    exact = {(r.l_id, r.r_id): r.distance for r in matching.block_pairs(left, right, 0.85).collect()}
    lsh = {(r.l_id, r.r_id) for r in matching.lsh_pairs(left, right, tables=5).collect()}
    assert lsh <= set(exact)  # its distance is that of hashed sets, so the bound is met but for collisions
    close = {p for p, distance in exact.items() if distance <= 0.1}
    assert len(close) >= 30 and close <= lsh


def edited(draw: random.Random, key: str, edits: int) -> str:
    key = list(key)
    for _ in range(edits):
        i, kind = draw.randrange(len(key) + 1), draw.randrange(3)
        key[i : i + (kind != 1)] = [] if kind == 2 else [draw.choice("abcdefgh ")]
    return "".join(key)


def test_banded_recall_over_the_whole_range(spark, smallest):
    """Of all exact pairs, and of those in each fifth of the distances, at least nine tenths are found, with their distance."""
    draw, left, right = random.Random(6), linkage.listed_keys(spark, smallest), linkage.whole_keys(spark, smallest)
    keys = [r.key for r in left.collect()]
    made = [(100_000 + i, edited(draw, keys[i % len(keys)], draw.randint(0, 150))) for i in range(900)]
    right = right.unionAll(spark.createDataFrame(made, "id long, key string"))
    exact = {(r.l_id, r.r_id): round(r.distance, 9) for r in matching.block_pairs(left, right).collect()}
    found = {(r.l_id, r.r_id): round(r.distance, 9) for r in matching.banded_pairs(left, right, recall=0.98).collect()}
    assert found.items() <= exact.items() and len(found) >= 0.9 * len(exact) > 500
    for low in (0, 0.2, 0.4, 0.6):
        mine = [p for p, distance in exact.items() if low <= distance <= low + 0.2]
        assert len(mine) > 20 and sum(p in found for p in mine) >= 0.9 * len(mine)


def test_bands_meet_their_recall():
    for distance in (0.1, 0.3, 0.5, 0.8):
        for recall in (0.9, 0.99):
            rows, bands = matching.bands_for(distance, recall)
            s = 1 - distance
            assert 1 - (1 - s**rows * (1 + rows * distance / 2)) ** bands >= recall and bands <= 32
    assert matching.bands_for(0.1, 0.9)[0] > matching.bands_for(0.8, 0.9)[0]


@pytest.mark.parametrize("max_distance", [0.3, 0.8, 1.0])
def test_list_joins_in_blocks_as_the_gram_join(spark, max_distance, monkeypatch):
    draw = random.Random(2)
    left = [(i, "".join(draw.choices("abcd ", k=draw.randint(2, 40)))) for i in range(60)]
    right = [(i, edited(draw, draw.choice(left)[1], draw.randint(0, 12)) * draw.choice([1, 1, 1, 4])) for i in range(200)]
    left += [(100, left[3][1]), (101, "ab"), (102, None)]
    right += [(300, right[5][1]), (301, ""), (302, None), (303, "abcd" * 20_000)]
    l, r = (spark.createDataFrame(x, "id long, key string") for x in (left, right))  # noqa: E741
    grams = lambda k: {k[i : i + 3] for i in range(len(k) - 2)} if k else set()
    far = lambda a, b: 1 - len(a & b) / len(a | b) if a & b else 2.0
    want = {(i, j): round(far(grams(a), grams(b)), 9) for i, a in left for j, b in right if far(grams(a), grams(b)) <= max_distance + 1e-9}
    rows = lambda df: {(x.l_id, x.r_id): round(x.distance, 9) for x in df.collect()}
    assert rows(matching.block_pairs(l, r, max_distance)) == want and len(want) > 20
    monkeypatch.setattr(matching, "BLOCK_BYTES", 100)
    monkeypatch.setattr(matching, "TEXT_BYTES", 64)
    assert rows(matching.block_pairs(l, r, max_distance, texts=False)) == want
    scored = {(x.l_id, x.r_id): round(x.score, 9) for x in matching.block_pairs(l, r, max_distance, threshold=0.6).collect()}
    plain = {(x.ref_id, x.transaction_id): round(x.score, 9) for x in matching.match_pairs(matching.block_pairs(l, r, max_distance), "k", 0.6).collect()}
    assert scored == plain and len(scored) > 10
    assert matching.block_pairs(l.limit(0), r).count() == matching.block_pairs(l, r.limit(0)).count() == 0


def test_list_joins_shuffle_no_text(spark, smallest):
    left, right = linkage.listed_keys(spark, smallest), linkage.whole_keys(spark, smallest)
    plan = matching.block_pairs(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "hashpartitioning" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.95, 1.0])
def test_edit_pairs_as_brute_force(spark, threshold, monkeypatch):
    draw = random.Random(4)
    left = [(i, "".join(draw.choices("abcdefgh ", k=draw.randint(1, 60)))) for i in range(80)]
    right = [(i, edited(draw, draw.choice(left)[1], draw.randint(0, 14))) for i in range(250)]
    left += [(200, left[0][1]), (201, ""), (202, None), (203, "é漢🙂" * 9)]
    right += [(400, left[0][1]), (401, ""), (402, None), (403, "é漢🙂" * 8 + "é漢x"), (404, "a" * 5000)]
    pairs = [(i, j, a, b) for i, a in left for j, b in right if a and b and abs(len(a) - len(b)) <= (1 - threshold) * max(len(a), len(b)) + 1e-9]
    coded = [editing.codes(a) for _, _, a, _ in pairs], [editing.codes(b) for _, _, _, b in pairs]
    edits = editing.edit_distances(*coded, np.arange(len(pairs)), np.arange(len(pairs)))
    want = {(i, j): round(1 - int(e) / max(len(a), len(b)), 9) for (i, j, a, b), e in zip(pairs, edits, strict=True) if e <= int((1 - threshold) * max(len(a), len(b)) + 1e-9)}
    l, r = (spark.createDataFrame(x, "id long, key string") for x in (left, right))  # noqa: E741
    rows = lambda: {(x.l_id, x.r_id): round(x.score, 9) for x in matching.edit_pairs(l, r, threshold).collect()}
    assert rows() == want and len(want) > 3
    monkeypatch.setattr(matching, "HOT", 3)  # segments in pieces
    assert rows() == want
    with pytest.raises(ValueError):
        matching.edit_pairs(l, r, 0.5)


def test_edit_distances_as_by_rows():
    draw = random.Random(1)
    texts = ["".join(draw.choices("abcde é🙂", k=k)) for k in (0, 1, 5, 63, 64, 65, 130, 200)] + ["".join(draw.choices("xyzé ", k=70))]

    def by_rows(a: str, b: str) -> int:
        before = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
            before = now
        return before[-1]

    p, t = np.array([(i, j) for i in range(len(texts)) for j in range(len(texts))]).T
    coded = [editing.codes(x) for x in texts]
    assert editing.edit_distances(coded, coded, p, t).tolist() == [by_rows(texts[i], texts[j]) for i, j in zip(p, t, strict=True)]
    assert editing.edit_distances([], [], p[:0], t[:0]).tolist() == []


def test_segments_of_an_index(spark, tmp_path, monkeypatch):
    """Deltas as a dictionary would take them; older ones are ignored; many are compacted, and then a read is a scan."""
    monkeypatch.setattr(segments, "DELTAS", 5)
    draw, path = random.Random(3), str(tmp_path / "i")
    docs = {i: f"start w{i % 3}" for i in range(30)}
    frame = lambda d: spark.createDataFrame(sorted(d.items()), "id long, document string")
    segments.create(frame(docs), path, "2024-01-01")
    for day in range(2, 9):
        delta = {i: f"day{day} w{i % 4} w1" if i % 3 else "" for i in draw.sample(range(40), 9)}
        gone = draw.sample(range(30), 2)
        removed = spark.createDataFrame([(i,) for i in gone], "id long")
        assert segments.apply_delta(frame(delta), path, f"2024-01-0{day}", removed)
        assert not segments.apply_delta(frame({1: "too late"}), path, f"2024-01-0{day}")
        assert not segments.apply_delta(frame({1: "too late"}), path, "2023-12-31")
        docs = {i: d for i, d in docs.items() if i not in gone} | delta
        want = {(t, i, d.split().count(t)) for i, d in docs.items() for t in d.split()}
        assert {tuple(r) for r in segments.postings(spark, path).select("token", "id", "tf").collect()} == want
        assert len(segments.read_log(spark, path).deltas) < 5
    segments.compact(spark, path)
    assert "Join" not in segments.postings(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in segments.postings(spark, path).select("token", "id", "tf").collect()} == want
    assert len(list((tmp_path / "i" / "postings").iterdir())) == 1


def test_only_absence_is_caught(monkeypatch):
    import importlib.util

    import __spark_entry__ as e

    monkeypatch.setattr(importlib.util, "find_spec", lambda name: None)
    assert not any(name.startswith("op") or name == "pipeline" for name in e.queries()) and len(e.queries()) > 60


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
